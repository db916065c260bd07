"""Op 7 - quality rules: hashed n-gram log-likelihood ratio (native).

Words and adjacent word pairs of a text are hashed into ``buckets`` cells.
Two smoothed multinomials over the cells are fitted: one over a trusted sample,
one over the raw corpus (every document).  A text's verdict is
its mean log ratio ``log p_trusted - log p_raw`` per n-gram, compared with a
fixed ``threshold``; structural rules (length, repeated 5-word windows) are
applied beside it.  Everything is built from DataFrame functions; per-text
work stays inside its row (no shuffle of texts or of exploded words with
their documents), and the only wide result, the cell counts, has at most
``buckets`` rows.

Edge cases: null or blank text has no words (all counts 0, ``base_failed``);
null or repeated ids are kept, one result row per input row; other columns of
the input are ignored; with no trusted rows or an empty corpus the ratio is 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD_WS = " \t\n\x0b\x0c\r"                 # [\x20\x09-\x0D]
WS_RUN = r"[\x20\x09-\x0D]+"
#: production parameters
BUCKETS = 1 << 14
TRUSTED_ROWS = 50_000                       # bound of the labelled sample the target is fitted on
THRESHOLD = -0.07                           # mean log ratio per n-gram (natural log)
PRIOR = 8 * BUCKETS                         # n-grams
WINDOW = 5


def words(text: Column) -> Column:
    """``array<string>`` of the words; empty for null or blank text."""
    t = F.btrim(F.coalesce(text, F.lit("")), F.lit(WORD_WS))
    return F.when(F.length(t) > 0, F.split(t, WS_RUN)).otherwise(F.array().cast("array<string>"))


def _pairs(w: Column, width: int, f) -> Column:
    """``f`` over each run of ``width`` neighbouring words (empty for shorter texts)."""
    last = F.size(w) - width
    return F.when(last >= 0, F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), f)).otherwise(
        F.array().cast("array<bigint>"))


def cells(w: Column, buckets: int) -> Column:
    """Cell numbers of all words and adjacent word pairs."""
    one = F.transform(w, lambda x: F.pmod(F.xxhash64(x), F.lit(buckets).cast("bigint")))
    two = _pairs(w, 2, lambda i: F.pmod(F.xxhash64(w[i], w[i + 1]), F.lit(buckets).cast("bigint")))
    return F.concat(one, two)


def cell_counts(docs: DataFrame, text_col: str, buckets: int) -> DataFrame:
    """(cell, n) over the whole input; partial counts leave each task, never words."""
    return (docs.select(words(F.col(text_col)).alias("w")).select(F.explode(cells(F.col("w"), buckets)).alias("cell"))
            .groupBy("cell").agg(F.count(F.lit(1)).alias("n")))


def weights(trusted: DataFrame, corpus: DataFrame, text_col: str, buckets: int) -> DataFrame:
    """One row, ``weights array<double>``: ``log p_trusted - log p_raw`` per cell
    (``buckets`` values whatever the corpus size); all 0 without trusted rows.
    Both are smoothed: the corpus by one per cell, the trusted counts by
    ``PRIOR`` n-grams dealt out as in the corpus, so that a small sample says
    little about cells that it hardly reaches."""
    t = cell_counts(trusted, text_col, buckets).select("cell", F.col("n").alias("t"), F.lit(0).cast("bigint").alias("r"))
    r = cell_counts(corpus, text_col, buckets).select("cell", F.lit(0).cast("bigint").alias("t"), F.col("n").alias("r"))
    every = corpus.sparkSession.range(buckets).select(F.col("id").alias("cell"), F.lit(0).cast("bigint").alias("t"),
                                                      F.lit(0).cast("bigint").alias("r"))
    n = (t.unionAll(r).unionAll(every).groupBy("cell").agg(F.sum("t").alias("t"), F.sum("r").alias("r"))
         .agg(F.sort_array(F.collect_list(F.struct("cell", "t", "r"))).alias("c"),
              F.sum("t").alias("nt"), F.sum("r").alias("nr")))
    return n.select(F.transform("c", lambda x: F.when(
        F.col("nt") > 0,
        F.log(x["t"] * (F.col("nr") + buckets) / (x["r"] + 1) + PRIOR) - F.log(F.col("nt") + PRIOR)
    ).otherwise(F.lit(0.0))).alias("weights"))


def _sorted_windows(h: Column) -> Column:
    """(hash, position) pairs in order where the row repeats a window, which a
    hash set tells at once; empty for the other rows (nearly all)."""
    s = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(h)) < F.size(h), s).otherwise(F.array().cast("array<struct<h:bigint,i:int>>"))


def _repeated_starts(s: Column) -> Column:
    """Sorted positions of the windows of a sorted list that equal a neighbour."""
    same = lambda x, j: F.coalesce(F.get(s, j)["h"] == x["h"], F.lit(False))
    return F.array_sort(F.array_compact(F.transform(s, lambda x, i: F.when(same(x, i - 1) | same(x, i + 1), x["i"]))))


def _covered(starts: Column, width: int) -> Column:
    """Number of positions covered by windows of ``width`` at sorted ``starts``."""
    zero = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).alias("end"))
    return F.aggregate(starts, zero, lambda a, p: F.struct(
        (a["n"] + (p + width - F.greatest(a["end"], p))).alias("n"), (p + width).alias("end")), lambda a: a["n"])


def quality_rules(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  buckets: int = BUCKETS, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: id, the structural counts, ``llr`` (mean log
    ratio per n-gram), ``base_failed`` and ``kept``.  ``trusted`` holds texts of
    the target distribution."""
    wt = weights(trusted.select(F.col(text_col).alias("text")), docs.select(F.col(text_col).alias("text")), "text", buckets)
    base = docs.select(F.col(id_col).alias("__id"), F.coalesce(F.col(text_col), F.lit("")).alias("__t"))
    base = base.withColumn("__w", words(F.col("__t")))
    w = F.col("__w")
    base = base.withColumns({
        "__h": _pairs(w, WINDOW, lambda i: F.xxhash64(*[w[i + k] for k in range(WINDOW)])),
        "__g": cells(w, buckets),
        "__l": F.filter(F.split("__t", "\n"), lambda x: F.length(F.btrim(x, F.lit(WORD_WS))) > 0),
    })
    # a column of its own: inside a lambda the sort would run once per element
    base = base.withColumn("__s", _sorted_windows(F.col("__h")))
    # `buckets` numbers, so a bounded literal; the cast folds to a constant array
    table = F.split(F.lit(",".join(map(repr, wt.first()["weights"]))), ",").cast("array<double>")
    total = F.aggregate("__g", F.lit(0.0), lambda a, c: a + F.get(table, c.cast("int")))
    out = base.select(
        F.col("__id").alias(id_col), F.size("__w").cast("bigint").alias("n_words"),
        F.length(F.array_join("__w", "")).cast("bigint").alias("word_chars"),
        F.regexp_count("__t", F.lit(r"[#*$%&|<>]")).cast("bigint").alias("n_symbols"),
        (F.size("__l") - F.size(F.array_distinct("__l"))).cast("bigint").alias("n_dup_lines"),
        _covered(_repeated_starts(F.col("__s")), WINDOW).alias("n_repeat_words"),
        F.when(F.size("__g") > 0, total / F.size("__g")).otherwise(F.lit(0.0)).alias("llr"))
    out = out.withColumn("base_failed", (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("llr") >= F.lit(threshold)))


def trusted_texts(docs: DataFrame, labels: DataFrame, rows: int = TRUSTED_ROWS) -> DataFrame:
    """Texts labelled good and not toxic: a bounded sample of at most ``rows``
    ids, lowest hash first (so it is the same on every run); the ids are a
    broadcast of proven size."""
    ids = (labels.filter((F.col("quality") == 1) & (F.col("toxic") == 0) & F.col("doc_id").isNotNull())
           .select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))
    return docs.join(F.broadcast(ids), "doc_id", "left_semi")


def accepted(docs: DataFrame, trusted: DataFrame, text_col: str = "text", buckets: int = BUCKETS,
             threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` (all columns) that the rules keep."""
    whole = docs.select(F.struct(*docs.columns).alias("__row"), F.col(text_col))
    out = quality_rules(whole, trusted, "__row", text_col, buckets, threshold)
    # the always true, non-deterministic term keeps the optimizer from pushing the
    # verdict below the columns it is made of, where lambdas would repeat them
    return out.withColumn("kept", F.col("kept") & (F.monotonically_increasing_id() >= 0)).filter("kept").select("__row.*")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_rules(docs, trusted_texts(docs, labels)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "llr")
