"""Written intermediates of the operators.

Every wide intermediate is a Parquet table in the folder that
``spark.checkpoint.dir`` names (shared by driver and executors), so a lost
executor costs a re-read and lineage stays short.  ``step`` also lets Spark
drop a finished step's shuffle files and keeps Arrow batches small while a
step runs; settings are put back afterwards.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from annomart.session import ensure_checkpoint_dir

_WRITTEN: list[str] = []
_RECORD: ContextVar[list[str] | None] = ContextVar("tables written", default=None)


@contextmanager
def settings(spark: SparkSession, **conf: object):
    """Session settings for the length of a block (``__`` stands for a dot)."""
    old = {}
    for k, v in conf.items():
        k = k.replace("__", ".")
        old[k] = spark.conf.get(k, None)
        spark.conf.set(k, str(v))
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def root(spark: SparkSession) -> str:
    """The scratch folder: the cluster's ``spark.checkpoint.dir``; its own only where none is set (tests)."""
    conf = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    return f"{(conf or ensure_checkpoint_dir(spark)).rstrip('/')}/annomart-llm"


def materialise(df: DataFrame, name: str, batch_rows: int | None = None, by: str | None = None, parts: int = 0) -> DataFrame:
    """Write ``df`` as Parquet and read it back.  ``batch_rows`` bounds the rows
    of an Arrow batch while it is computed (for tables of large rows).  With
    ``by``, a column of 0..``parts`` - 1, the table has a folder for each value,
    which ``sweep`` counts as a table of its own."""
    spark = df.sparkSession
    path = f"{root(spark)}/{name}-{uuid.uuid4().hex}"
    conf = {"spark__sql__classic__shuffleDependency__fileCleanup__enabled": "true"}
    if batch_rows:
        conf["spark__sql__execution__arrow__maxRecordsPerBatch"] = batch_rows
    with settings(spark, **conf):
        df.write.option("compression", "zstd").parquet(path, partitionBy=by)
    _WRITTEN.extend([f"{path}/{by}={i}" for i in range(parts)] if by else [path])
    if _RECORD.get() is not None:
        _RECORD.get().append(path)
    return spark.read.schema(df.schema).parquet(path)


def mark() -> int:
    return len(_WRITTEN)


def sweep(spark: SparkSession, since: int, until: int | None = None, keep: tuple[str, ...] = ()) -> None:
    """Delete the tables written between two marks, for callers that know
    that nothing reads them any more."""
    jvm, hconf = spark._jvm, spark._jsc.hadoopConfiguration()
    for i, path in enumerate(_WRITTEN[since:until], since):
        if path and path not in keep:
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(hconf).delete(p, True)
            _WRITTEN[i] = ""


@contextmanager
def recorded():
    """The tables written in the block by this run or thread, as a list that fills up."""
    written: list[str] = []
    token = _RECORD.set(written)
    try:
        yield written
    finally:
        _RECORD.reset(token)


def forget(spark: SparkSession, paths) -> None:
    """Delete written tables that nothing reads any more."""
    jvm, hconf = spark._jvm, spark._jsc.hadoopConfiguration()
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(hconf).delete(p, True)
