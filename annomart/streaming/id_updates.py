"""Identifier validation on a stream of submitted id lists.

Id lists arrive as files in a directory (one id per line).  Structured
Streaming picks up new files; each micro-batch is resolved with the same
set-based :func:`update_ids` against the current annotation tables and
written to a result table (one directory per batch id).  The annotation side is static per batch, so
no streaming state is kept; the checkpoint location records which files
were processed, so a restarted query neither loses nor repeats a file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ids import update_ids


def start_id_updates(spark: SparkSession, cat, in_dir: str, out_path: str, checkpoint: str,
                     trigger_once: bool = False):
    """Start the stream: ``in_dir`` text files -> ``out_path`` parquet rows
    ``(source_file, submitted_id, updated_id, status)``."""
    lines = (spark.readStream.format("text").load(in_dir)
             .withColumn("source_file", F.input_file_name()))

    def resolve(batch: DataFrame, batch_id: int) -> None:
        ids = (batch.select("source_file", F.trim("value").alias("submitted_id"))
               .filter(F.col("submitted_id") != ""))
        res = update_ids(cat, ids.select("submitted_id").distinct())
        # one directory per batch, overwritten on a retry: exactly-once output
        ids.join(res, "submitted_id").write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}")

    w = lines.writeStream.foreachBatch(resolve).option("checkpointLocation", checkpoint)
    if trigger_once:
        w = w.trigger(availableNow=True)
    return w.start()
