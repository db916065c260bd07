"""Session helpers: sensible defaults that never override a cluster's settings."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Defaults applied only where the session has no value of its own.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, app: str = "annomart") -> SparkSession:
    """A local session for tests and the bench (UI off, AQE on)."""
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", "16g")
         # delete reliable-checkpoint files of staged marts once unreferenced
         .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC"))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's ``spark.checkpoint.dir``; set a scratch one only
    where none is configured (tests, local runs)."""
    sc = spark.sparkContext
    if d := sc.getCheckpointDir():          # setting it again would nest another folder in it
        return d
    d = sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (checkpoints must survive "
                               "executor loss and may not use machine-local paths)")
        d = tempfile.mkdtemp(prefix="annomart-ckpt-", dir=os.environ.get("ANNOMART_SCRATCH", "/tmp"))
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def flatten(df: DataFrame, sep: str = ",") -> DataFrame:
    """Scalar view of a mart for comparisons: arrays -> joined text, structs
    -> JSON text, in column order.  NULL arrays stay NULL."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.ArrayType):
            inner = f.dataType.elementType
            if isinstance(inner, (T.StructType, T.ArrayType, T.MapType)):
                c = F.when(c.isNotNull(), F.to_json(c))
            else:
                c = F.array_join(c.cast("array<string>"), sep)
        elif isinstance(f.dataType, (T.StructType, T.MapType)):
            c = F.to_json(c)
        cols.append(c.alias(f.name))
    return df.select(*cols)


#: a write's shuffle files go when it ends; else they stay until the driver's next garbage collection
TIDY = ("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
_HOLDING = threading.Lock()
_holders: dict[tuple[int, str], int] = {}           # (session, setting) -> blocks under way


@contextmanager
def held(spark: SparkSession, key: str, value: str, unless=lambda now: now is not None):
    """A setting for the length of a block; a session's own stays (``unless``, of
    the value found).  Of several blocks at a time the first sets it, the last takes it back."""
    at = (id(spark), key)
    with _HOLDING:
        n = _holders.get(at, 0)
        ours = n > 0 or not unless(spark.conf.get(key, None))
        if ours:
            spark.conf.set(key, value)
            _holders[at] = n + 1
    try:
        yield
    finally:
        if ours:
            with _HOLDING:
                _holders[at] -= 1
                if not _holders[at]:
                    del _holders[at]
                    spark.conf.unset(key)


def write_table(df: DataFrame, path: str, by: str | None = None) -> None:
    """Write an intermediate table, packed, and leave no shuffle files behind."""
    with held(df.sparkSession, *TIDY):
        df.write.option("compression", "zstd").parquet(path, partitionBy=by)


def stage(df: DataFrame) -> DataFrame:
    """Write an intermediate mart as Parquet into the session's checkpoint
    folder (shared on a cluster) and read it back.

    Used where a mart feeds several later steps - the reference's
    ``CREATE TABLE`` then ``UPDATE`` pattern - so the mart is computed once,
    later steps prune its columns and see its size, and a lost executor costs
    a re-read instead of the whole derivation."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/annomart-stage/{uuid.uuid4().hex}"
    df = df.select(*[F.col(f"`{f.name}`").cast("string").alias(f.name) if isinstance(f.dataType, T.NullType) else F.col(f"`{f.name}`")
                     for f in df.schema.fields])
    write_table(df, path)
    return spark.read.schema(df.schema).parquet(path)
