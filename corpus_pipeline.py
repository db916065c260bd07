"""A document-cleaning pipeline made of the training-data operators.

``run(spark, sf_dir)`` applies ``STAGES`` to the documents table; each stage's
result is written as Parquet under ``spark.checkpoint.dir`` and read again as
the next stage's documents.  A stage works on all that its predecessor kept,
takes its statistics from that, and returns the columns of documents; the last
returns the packed pieces.  A stage's result must be written before the next
stage is called: that one deletes the intermediate tables of its predecessor.
Each run, and each thread, has a handle of its own on them.

Null and empty texts, null ids, repeated rows and further columns pass through
the stages as their operators define it: texts without words fail the quality
rules; a stage keeps the columns it gets; an empty table stays one.
"""

from __future__ import annotations

from collections.abc import Callable
from contextvars import ContextVar
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annomart.llm import op1_packing, op2_phrases, op3_jaccard, op7_quality, op9_decontam
from annomart.llm.scratch import forget, materialise, recorded

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
#: intermediate tables of the stage called last, of the run (or thread) that calls it
_last: ContextVar[tuple[str, ...]] = ContextVar("intermediate tables", default=())


def tidy(stage: Stage) -> Stage:
    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        forget(spark, _last.get())
        with recorded() as written:
            out = stage(spark, docs, sf_dir)
        _last.set(tuple(written))
        return out
    return run_stage


@tidy
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Op 7: documents that the rules reject go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return op7_quality.accepted(docs, op7_quality.trusted_texts(docs, labels))


@tidy
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Op 3 on 5-word shingles at 0.8: one document of each group stays."""
    return op3_jaccard.drop_near_duplicates(docs, width=5, percent=80)


@tidy
def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Op 2: words of repeated 35-word windows are cut out of the texts."""
    rest = [c for c in docs.columns if c != "text"]
    out = op2_phrases.remove_repeats(docs, cols=rest)
    out = out.withColumnRenamed("kept_text", "text")
    if "n_chars" in rest:
        out = out.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


@tidy
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Op 9: documents with a benchmark passage go."""
    return op9_decontam.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text"))


@tidy
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Op 1: sequences of 1024 tokens."""
    import public_tokenizers

    return op1_packing.pack(op1_packing.document_pieces(docs, str(public_tokenizers.path("byte_bpe_50k.json"))))


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("substrings", substrings),
    ("decontamination", decontamination),
    ("packing", packing),
]
#: token ids are beyond SQL; tests/llm/test_pipeline.py has the brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    handle = _last.set(())
    try:
        for name, stage in STAGES:
            docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
        forget(spark, _last.get())
    finally:
        _last.reset(handle)
    return docs
