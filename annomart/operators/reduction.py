"""Short id lists first: sideways reduction of the tables that a lookup reads.

A lookup of a few ids must not shuffle whole tables.  ``short_list``
and ``few_objects`` resolve the ids to object keys and ``reduced`` keeps, by a semi join against a
broadcast key set, only the rows of a large table that belong to them, before
anything is joined or aggregated.  Key sets are written and counted first: a
set is broadcast up to ``MAX_KEYS`` keys, a larger one is joined by a shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage

SHORT = 10_000                  # distinct ids of a short list
MAX_KEYS = 1_000_000            # keys of a set that is broadcast


def short_list(ids: DataFrame, id_col: str) -> list[str] | None:
    """The distinct ids, if they are a short list."""
    rows = ids.select(F.col(id_col).cast("string")).distinct().limit(SHORT + 1).collect()
    return [r[0] for r in rows if r[0] is not None] if len(rows) <= SHORT else None


def few_objects(cat, names: list[str] | None, table: str = "feature", key: str = "feature_id", live: bool = True) -> DataFrame | None:
    """``(key, id)`` of the objects with these names (one row an object), written; None for a long list."""
    if names is None:
        return None
    few = F.broadcast(cat.spark.createDataFrame([(n,) for n in names], "id string"))
    t = cat[table].filter(~F.col("is_obsolete")) if live else cat[table]
    return stage(t.select(key, F.col("uniquename").alias("id")).join(few, "id").select(key, "id"))


def key_set(df: DataFrame, col: str) -> DataFrame:
    """Distinct values of a column, written and counted: with a broadcast hint up to ``MAX_KEYS``."""
    keys = stage(df.select(col).filter(F.col(col).isNotNull()).distinct())
    return F.broadcast(keys) if keys.count() <= MAX_KEYS else keys


def reduced(big: DataFrame, small: DataFrame | None, col: str, small_col: str | None = None) -> DataFrame:
    """The rows of ``big`` whose ``col`` occurs in ``small``; ``big`` itself when there is no small one."""
    if small is None:
        return big
    return big.join(key_set(small.select(F.col(small_col or col).alias(col)), col), col, "left_semi")
