"""Connected components of an edge table by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annomart.llm.scratch import materialise


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges`` (``a``, ``b`` bigint, hashed
    ids): nodes share a label if and only if they are connected.

    Each round points every node at its smallest neighbour and maps both ends
    of all edges to these parents; with hashed ids the graph shrinks by a
    constant factor a round.  All steps are aggregations and joins over written
    tables; nothing of the graph reaches the driver but an emptiness test."""
    pair = lambda a, b: (F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))
    e = materialise(edges.filter("a <> b").select(*pair("a", "b")).distinct(), "cc-edges")
    labels = None
    while not e.isEmpty():
        both = e.select("a", "b").unionAll(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = materialise(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "cc-parent")
        to = lambda x: parent.select(F.col("node").alias(x), F.col("label").alias("p" + x))
        e = materialise(e.join(to("a"), "a").join(to("b"), "b").filter("pa <> pb").select(*pair("pa", "pb")).distinct(), "cc-edges")
        if labels is None:
            labels = parent
        else:
            nxt = parent.select(F.col("node").alias("label"), F.col("label").alias("up"))
            labels = materialise(labels.join(nxt, "label", "left").select("node", F.coalesce("up", "label").alias("label")), "cc-labels")
    if labels is None:
        return e.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return labels
