"""Flat-file sources S2-S8: every reader is ``spark.read`` plus the line
parser the queries also use on adapter-built lines, so a file and a table
of lines go through the same code.

Locations, summaries and hits also have a checked form (``check_...``), which
tells what was refused and why, and the readers a ``strict`` mode, which stops
at the first faulty line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..operators.ids import clean_id_lines
from ..plans import enzyme, reports
from .lines import Checked, numbered_lines, ordered_lines, place, records


def read_id_list(spark: SparkSession, path: str) -> DataFrame:
    """One id per line -> ``submitted_id`` (trimmed, blanks dropped)."""
    return clean_id_lines(spark.read.text(path))


def check_locations(spark: SparkSession, path: str) -> Checked:
    """S3 with refused lines: ``(line_id, location, scaffold, fmin, fmax)`` and the rest."""
    lines = numbered_lines(spark, path)
    scaffold, fmin, fmax = X.parse_location("value")
    blank = F.trim("value") == ""
    reason = (F.when(blank, "blank line").when(scaffold.isNull(), "not scaffold:min..max")
              .when(fmin.isNull() | fmax.isNull(), "number out of range"))
    return Checked(lines, reason, {"line_id": F.col("line"), "location": F.trim("value"), "scaffold": scaffold, "fmin": fmin, "fmax": fmax})


def read_locations(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    """S3: ``scaffold:min..max`` lines -> parsed locations.  Malformed lines are
    left out, or stop the read when ``strict`` (see ``check_locations``)."""
    if strict:
        return check_locations(spark, path).strict()
    return reports.parse_locations(spark.read.text(path))


def read_enzyme_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Enzyme.dat-style files, records closed by lines that are ``//`` only
    (LF or CRLF).  Of several records with one id the last one wins, files in
    order of their paths."""
    return enzyme.parse_enzyme_records(records(ordered_lines(spark, path)), order_col="ord")


def read_enzyme_classes(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Enzclass-style files -> ``(id, name)``; later lines win, files in order of their paths."""
    return enzyme.parse_enzyme_classes(ordered_lines(spark, path).withColumn("ord", place()), order_col="ord")


def check_summary_tsv(spark: SparkSession, path: str) -> Checked:
    """S6 with refused lines: ``(fbgn, symbol, summary)`` and the rest."""
    n = F.size(F.split("value", "\t"))
    reason = F.when(F.trim("value") == "", "blank line").when(F.col("value").startswith("#"), "comment").when(
        n != 3, F.concat(n.cast("string"), F.lit(" columns instead of 3")))
    part = F.split("value", "\t")
    return Checked(numbered_lines(spark, path), reason, {"fbgn": X.replace_first(F.get(part, 0), "FB:"), "symbol": F.get(part, 1),
                                                         "summary": F.get(part, 2)})


def read_summary_tsv(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    """TSV with ``#`` comment lines and columns (fbgn, symbol, summary)."""
    if strict:
        return check_summary_tsv(spark, path).strict()
    return reports.parse_summary_lines(spark.read.text(path))


def read_counts_tsv(spark: SparkSession, path: str) -> DataFrame:
    """Headerless TSV written by :func:`write_tsv` from R2."""
    schema = ("uniquename string, symbol string, gene_snapshot long, uniprot_function long, "
              "pathway_count long, gene_group_count long, interactive_fly long")
    return spark.read.schema(schema).option("sep", "\t").option("nullValue", "\\N").csv(path)


def check_hit_csv(spark: SparkSession, path: str) -> Checked:
    """S8 with refused lines: ``(path)`` of the hits, and lines that are blank or whose column 0 is empty."""
    first = F.from_csv(F.col("value"), "c0 STRING")["c0"]
    reason = F.when(F.trim("value") == "", "blank line").when(F.coalesce(F.trim(first), F.lit("")) == "", "no first column")
    return Checked(numbered_lines(spark, path), reason, {"path": first})


def read_hit_csv(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    """Ragged CSV, only column 0 used, blank lines ignored."""
    if strict:
        return check_hit_csv(spark, path).strict()
    return reports.parse_hit_lines(spark.read.text(path))
