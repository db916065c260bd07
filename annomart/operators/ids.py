"""U1 identifier validation / update and S2 id-list parsing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import exprs as X
from . import dims


def clean_id_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    """One id per line, trimmed, blank lines dropped (duplicates kept)."""
    return lines.select(F.trim(F.col(col)).alias("submitted_id")).filter(F.col("submitted_id") != "")


def update_ids(cat, ids: DataFrame, id_col: str = "submitted_id", primary_db: str = "annobase") -> DataFrame:
    """U1 ``update_ids``: ``(submitted_id, updated_id, status)`` per input row.

    * a live feature with exactly this uniquename -> one ``current`` row;
    * else non-current secondary accessions of the id in the primary database
      (``primary_db``, case-folded), pointing at a live feature of the same
      data class -> ``updated`` when there is one such row, ``split`` (one row
      each) when there are several.  Rows are counted, not distinct targets;
    * else ``(id, NULL, NULL)``.

    Two left joins per distinct id: to the live names and to the secondary
    rows; a target's row count is a partial aggregate by id.  The result is
    joined back so repeated submissions give repeated rows.
    """
    sub = ids.select(F.col(id_col).alias("submitted_id"))
    d = sub.select("submitted_id").distinct()
    feats = cat["feature"].filter(~F.col("is_obsolete")).select("feature_id", F.col("uniquename").alias("updated_id"))
    live = feats.select(F.col("updated_id").alias("submitted_id"), F.lit(True).alias("_live")).distinct()

    db = dims.db_ids(cat, [primary_db.lower()], case="lower").select("db_id")
    sec = (cat["dbxref"].join(db, "db_id", "left_semi").select("dbxref_id", F.col("accession").alias("submitted_id"))
           .join(cat["feature_dbxref"].filter(~F.col("is_current")).select("feature_id", "dbxref_id"), "dbxref_id")
           .join(feats, "feature_id")
           .filter(F.upper(X.data_class("updated_id")) == F.upper(X.data_class("submitted_id")))
           .groupBy("submitted_id", "updated_id").agg(F.count(F.lit(1)).alias("_k")))
    n = sec.groupBy("submitted_id").agg(F.sum("_k").alias("_n"))
    # a target that the id reaches _k times gives _k rows
    sec = (sec.join(n, "submitted_id").select(F.col("submitted_id").alias("_sid"), "updated_id", "_n",
                                              F.explode(F.sequence(F.lit(1), F.col("_k").cast("int"))).alias("_i")))
    resolved = (d.join(live, "submitted_id", "left")
                .join(sec, (F.col("submitted_id") == F.col("_sid")) & F.col("_live").isNull(), "left")
                .select("submitted_id", F.when(F.col("_live"), F.col("submitted_id")).otherwise(F.col("updated_id")).alias("updated_id"),
                        F.when(F.col("_live"), "current").when(F.col("_n") > 1, "split").when(F.col("_n") == 1, "updated").alias("status")))
    return sub.join(resolved, "submitted_id")
