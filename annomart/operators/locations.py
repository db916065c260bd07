"""Locations laid out by range, and slices of them.

``write_location_table`` sorts the locations by (length level, source, start)
over range partitions, so that a file, and a row group in it, holds neighbours
of like length, and writes beside them which file holds which part of which
source.  ``read_slice`` asks that list of files first and opens only those that
a query range can meet; for short lists the ranges also go into the Parquet
scan, where they skip row groups.  Without the sort by length level one
scaffold-long location would make every file look as if it reached everywhere.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .overlap import DEFAULT_BIN, overlap_join, own_level

MAX_RANGES = 64                 # query ranges that go into the scan as literals
MAX_FILES = 10_000              # files named one by one; beyond that the whole table is read
COLUMNS = ("feature_id", "srcfeature_id", "fmin", "fmax")


def write_location_table(featureloc: DataFrame, path: str, files: int | None = None) -> str:
    """Write ``featureloc`` to ``path`` as ``rows`` (range-partitioned Parquet) and
    ``files`` (file, level, source, extent).  Locations without both ends meet no
    range and are left out."""
    spark = featureloc.sparkSession
    files = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    loc = featureloc.select(*COLUMNS).filter(F.col("srcfeature_id").isNotNull() & F.col("fmin").isNotNull() & F.col("fmax").isNotNull())
    order = ["level", "srcfeature_id", "fmin"]
    rows = loc.withColumn("level", own_level(F.col("fmin"), F.col("fmax"))).repartitionByRange(files, *order).sortWithinPartitions(*order)
    rows.write.parquet(f"{path}/rows")
    written = spark.read.schema(rows.schema).parquet(f"{path}/rows")
    extent = written.groupBy(F.element_at(F.split(F.input_file_name(), "/"), -1).alias("file"), "level", "srcfeature_id").agg(
        F.min("fmin").alias("lo"), F.max("fmax").alias("hi"))
    extent.coalesce(1).write.parquet(f"{path}/files")           # a row for each file and each source in it
    return path


def files_of(spark: SparkSession, path: str, queries: DataFrame, query_cols) -> list[str] | None:
    """The files that some query range can meet; None when they are too many to name."""
    src, lo, hi = query_cols
    q = queries.select(F.col(src).alias("srcfeature_id"), F.col(lo).alias("q_lo"), F.col(hi).alias("q_hi"))
    extent = spark.read.parquet(f"{path}/files")
    hit = extent.join(q, "srcfeature_id").filter((F.col("lo") <= F.col("q_hi")) & (F.col("q_lo") <= F.col("hi"))).select("file").distinct()
    names = [r.file for r in hit.limit(MAX_FILES + 1).collect()]
    return sorted(names) if len(names) <= MAX_FILES else None


def read_slice(spark: SparkSession, path: str, queries: DataFrame, query_cols=("srcfeature_id", "fmin", "fmax")) -> DataFrame:
    """Rows of the table that can overlap a query range: all that do, and some neighbours."""
    schema = "feature_id bigint, srcfeature_id bigint, fmin bigint, fmax bigint"
    names = files_of(spark, path, queries, query_cols)
    if names == []:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).parquet(*([f"{path}/rows"] if names is None else [f"{path}/rows/{n}" for n in names]))
    ranges = queries.select(*query_cols).dropna().distinct().limit(MAX_RANGES + 1).collect()
    if 0 < len(ranges) <= MAX_RANGES:
        one = [(F.col("srcfeature_id") == s) & (F.col("fmin") <= hi) & (F.col("fmax") >= lo) for s, lo, hi in map(tuple, ranges)]
        rows = rows.filter(reduce(lambda a, b: a | b, one))
    return rows


def location_slice(spark: SparkSession, path: str, queries: DataFrame, *, query_cols=("srcfeature_id", "fmin", "fmax"),
                   wanted: DataFrame | None = None, bin_size: int = DEFAULT_BIN, inclusive: bool = True) -> DataFrame:
    """J14 over a location table: like ``featureloc_slice``, but reading the part
    of the locations that the query ranges can meet."""
    loc = read_slice(spark, path, queries, query_cols)
    if wanted is not None:
        loc = loc.join(wanted.select("feature_id"), "feature_id", "left_semi")
    return overlap_join(queries, loc, left_cols=query_cols, bin_size=bin_size, inclusive=inclusive)


def scratch_path(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/annomart-stage/locations-{uuid.uuid4().hex}"
