"""Sinks S9-S12.  Jobs write to a new path and publish it (the reference's
"build under one name then rename"); nothing is collected to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..session import flatten


def write_tsv(df: DataFrame, path: str, header: bool = False, mode: str = "overwrite") -> None:
    """Tab-separated, NULL as ``\\N`` (``COPY ... TO STDOUT`` format).
    Values starting with ``#`` are written as they are (no comment quoting)."""
    (flatten(df).write.mode(mode).option("sep", "\t").option("nullValue", "\\N").option("comment", "\u0001")
     .option("header", str(header).lower()).csv(path))


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Comma-separated with a header row."""
    flatten(df).write.mode(mode).option("header", "true").csv(path)


def write_mart(df: DataFrame, path: str, partition_by: list[str] | None = None,
               mode: str = "overwrite") -> str:
    """``CREATE TABLE AS``: write the mart as parquet at ``path`` and
    return it.  Write each build to a fresh path and swap the pointer a
    reader uses; an overwrite of the live path is never half-visible
    because the committer publishes files only on job commit."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def write_pivot_report(df: DataFrame, path: str) -> None:
    """Class x release pivot as a tab report with a ``#`` header."""
    cols = df.columns
    # one file with one header line: the report has one row per data class
    # (bounded by the id-prefix vocabulary), so a single writer task is safe
    renamed = df.withColumnRenamed(cols[0], "#" + cols[0]).coalesce(1)
    write_tsv(renamed, path, header=True)
