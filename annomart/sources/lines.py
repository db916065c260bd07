"""Lines of text files in file order, records made of lines, and refused lines.

Spark reads files in splits, in any order.  A line's place is (path, start of
its split, order within the split), which orders the lines of one file as they
stand and files by path, however the files were cut and dealt out.  Counts
that run over a whole file (line numbers, record numbers) are made per split
and shifted by the totals of the splits before it, so no task sees more than a
split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SPLIT = ("path", "block")


def ordered_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``(path, block, line, value)`` per line (LF, CRLF or CR ends), blanks
    included; sorted by the first three, lines stand in file order."""
    df = spark.read.text(path)
    return df.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"),
                     F.monotonically_increasing_id().alias("line"), "value")


def place() -> Column:
    """The order of lines as one value."""
    return F.struct("path", "block", "line")


def running_count(lines: DataFrame, name: str, what: Column) -> DataFrame:
    """``name``: how many lines of the file up to this one (itself included) fulfil ``what``."""
    rows = lines.withColumn("_hit", F.coalesce(what, F.lit(False)).cast("long"))
    total = rows.groupBy(*SPLIT).agg(F.sum("_hit").alias("_n"))
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    shift = total.select(*SPLIT, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))       # one row a split
    within = Window.partitionBy(*SPLIT).orderBy("line").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (rows.withColumn("_run", F.sum("_hit").over(within)).join(shift, list(SPLIT))
            .withColumn(name, F.col("_run") + F.col("_before")).drop("_hit", "_run", "_before"))


def numbered_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``ordered_lines`` with ``line_number`` from 1 in each file."""
    return running_count(ordered_lines(spark, path), "line_number", F.lit(True))


def records(lines: DataFrame, end: str = r"^//\s*\z") -> DataFrame:
    """``(ord, value)``: records of lines, closed by a line that matches ``end``
    (and by the end of the file); ``value`` joins its lines, ``ord`` orders the
    records as they stand in the files.  A record may lie in several splits."""
    is_end = F.col("value").rlike(end)
    counted = running_count(lines, "_ends", is_end).filter(~is_end)
    body = F.array_sort(F.collect_list(F.struct("block", "line", "value")))
    rec = counted.groupBy("path", "_ends").agg(F.array_join(F.transform(body, lambda x: x["value"]), "\n").alias("value"))
    return rec.select(F.struct("path", F.col("_ends").alias("record")).alias("ord"), "value")


class Checked:
    """Parsed lines and what was refused.

    ``accepted``: the parsed rows.  ``refused``: ``(path, line_number, value,
    reason)`` of all other lines; ``accepted`` plus ``refused`` are the lines read.
    Reasons in ``IGNORED`` are no faults.  ``strict()`` gives the accepted rows
    of a read that fails at the first faulty line, naming it."""

    IGNORED = ("blank line", "comment")

    def __init__(self, lines: DataFrame, reason: Column, parsed: dict[str, Column]):
        self.lines, self.parsed = lines.withColumn("_reason", reason), parsed
        self.accepted = self._rows(self.lines.filter(F.col("_reason").isNull()))
        self.refused = self.lines.filter(F.col("_reason").isNotNull()).select("path", "line_number", "value", F.col("_reason").alias("reason"))

    def _rows(self, lines: DataFrame) -> DataFrame:
        return lines.select(*[c.alias(n) for n, c in self.parsed.items()])

    def strict(self) -> DataFrame:
        fault = F.col("_reason").isNotNull() & ~F.col("_reason").isin(*self.IGNORED)
        where = F.concat_ws(" ", F.lit("refused:"), "path", F.lit("line"), F.col("line_number").cast("string"), F.concat(F.lit("("), "_reason", F.lit("):")), "value")
        # in the filter itself, so that no pruning of columns can skip it
        keep = F.when(fault, F.raise_error(where).cast("boolean")).otherwise(F.col("_reason").isNull())
        return self._rows(self.lines.filter(keep))
