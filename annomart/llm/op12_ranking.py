"""Op 12 - quality classifier by Bradley-Terry pairwise ranking.

Every text gets a vector of shape features (lengths, repetition of words,
windows and lines, frequencies of neighbouring byte classes).  Each labelled
good document is set against labelled bad ones (and the other way round, the
smaller class takes turns); the weights minimise the logistic loss of the
feature differences of these preference pairs, with a ridge, by Newton steps
whose gradient and Hessian Spark adds up over the pairs.  A document's raw
score is its weighted feature sum.  The threshold is a quantile of the raw
scores of the labelled documents, at the share of label 0 among them, and
``score`` is the logistic function of the distance to it, so 0.5 is the cut.

The fit uses at most ``TRAIN_ROWS`` labelled rows a class (lowest hash of the
id, about that number); the quantile uses all labelled rows, the scores every
document.

Edge cases: null and empty texts have the features of a text of no bytes and
get a score like any other; one row per input row, null and repeated ids are
kept (a null id has no label); a document with several labels counts with the
lowest; other columns are ignored.  With labels of one class or none the
weights are 0 and every score is 0.5.  An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from annomart.llm import arrays as A
from annomart.llm.scratch import materialise

TRAIN_ROWS = 100_000            # labelled rows of each class that the weights are fitted on
OPPONENTS = 2                   # pairs of each row of the larger class
RIDGE = 1e-3                    # per pair
STEPS = 12                      # Newton steps at most
PARTS = 16                      # tasks of a step
CELLS = 1 << 16                 # resolution of the quantile on the logistic scale
WINDOW = 5

#: byte classes: lower, upper, digit, blank, line end, sentence marks, exclamation, symbols, brackets and code, rest
CLASS = np.full(256, 9, np.int64)
for _i, _chars in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t\x0b\x0c\r", b"\n",
                             b".,;:?'\"-()", b"!", b"#*$%&", b"|<>{}[]/\\@_~^=+`")):
    CLASS[list(_chars)] = _i
CLASSES = 10
SHAPE = ("bytes", "words", "word_bytes", "distinct", "adjacent", "windows", "top_word", "lines", "line_words")
FEATURES = len(SHAPE) + CLASSES * CLASSES


def repeats(row: np.ndarray, value: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By row: distinct values, members of groups of two or more, size of the largest group."""
    o = np.lexsort((value, row))
    r, v = row[o], value[o]
    first = np.flatnonzero(np.r_[True, (r[1:] != r[:-1]) | (v[1:] != v[:-1])]) if len(r) else np.zeros(0, np.int64)
    size, of = np.diff(np.r_[first, len(r)]), r[first]
    top = np.zeros(n, np.int64)
    np.maximum.at(top, of, size)
    return np.bincount(of, minlength=n), A.sum_by(np.where(size > 1, size, 0), of, n), top


def features(buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """(texts, FEATURES) of the texts of a slice."""
    n, size = len(offs) - 1, np.diff(offs)
    row = np.repeat(np.arange(n), size)
    cls = CLASS[buf]
    inner = row[1:] == row[:-1]
    pairs = np.bincount(row[1:][inner] * CLASSES ** 2 + cls[:-1][inner] * CLASSES + cls[1:][inner], minlength=n * CLASSES ** 2)
    s, e, of = A.word_spans(buf, offs)
    h = A.span_hashes(buf, s, e)
    words = np.bincount(of, minlength=n)
    distinct, _, top = repeats(of, h, n)
    adjacent = A.sum_by((h[1:] == h[:-1]) & (of[1:] == of[:-1]), of[1:], n) if len(h) else np.zeros(n, np.int64)
    grams, within = A.gram_hashes(h, WINDOW), of[WINDOW - 1:] == of[:max(len(of) - WINDOW + 1, 0)]
    _, windows, _ = repeats(of[:len(grams)][within], grams[within], n)
    edge = np.union1d(np.flatnonzero(buf == 10) + 1, offs[:-1][size > 0])          # lines, with their ends
    edge = edge[edge < len(buf)]
    lines = np.bincount(np.searchsorted(offs, edge, "right") - 1, minlength=n)
    line_of = np.searchsorted(offs, edge, "right") - 1
    _, same, _ = repeats(line_of, A.span_hashes(buf, edge, np.r_[edge[1:], len(buf)][:len(edge)]), n)
    per = lambda x, y: x / np.maximum(y, 1)
    shape = [np.log1p(size), np.log1p(words), per(A.sum_by(e - s, of, n), words), per(distinct, words), per(adjacent, words),
             per(windows, words), per(top, words), per(same, lines), np.log1p(per(words, lines))]
    return np.concatenate([np.stack(shape, 1), per(pairs.reshape(n, -1), size[:, None])], 1)


def feature_table(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, f): the features of every text, as floats."""
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches):
        for b in batches:
            buf, offs = A.text_buffer(b.column(1))
            for i, j in A.slices(offs):
                x = features(buf[offs[i]:offs[j]], offs[i:j + 1] - offs[i]).astype(np.float32)
                f = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * FEATURES), pa.array(x.ravel()))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), f], ["id", "f"])

    return src.mapInArrow(A.trimmed(run), f"id {src.schema['id'].dataType.simpleString()}, f array<float>")


def matrix(col) -> np.ndarray:
    """Rows of a list column as a matrix of doubles."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    return col.flatten().to_numpy().astype(float).reshape(len(col), FEATURES)


# ------------------------------------------------------------------- training


def preference_pairs(good: DataFrame, bad: DataFrame, n_good: int, n_bad: int, opponents: int) -> DataFrame:
    """(pair, g, b) of (id, f) tables: each row of the larger one meets
    ``opponents`` rows of the other, which take turns.  Rows meet within
    buckets of the id's hash (64 rows of the smaller one on average, 64 buckets
    at most), so no task orders a whole class."""
    large, small, k = (good, bad, n_bad) if n_good >= n_bad else (bad, good, n_good)
    buckets = max(1, min(64, k // 64))

    def numbered(t):
        t = t.select(F.pmod(F.xxhash64("id", F.lit(3)), F.lit(buckets)).cast("int").alias("k"), "id", "f")
        return t.select("k", (F.row_number().over(Window.partitionBy("k").orderBy(F.xxhash64("id"), "id", "f")) - 1).alias("r"), "f")

    size = small.select(F.pmod(F.xxhash64("id", F.lit(3)), F.lit(buckets)).cast("int").alias("k")).groupBy("k").count().collect()
    turns = F.element_at(F.create_map(*[F.lit(v) for r in size for v in (r.k, r["count"])]), F.col("k"))
    meets = F.explode(F.sequence(F.lit(0).cast("bigint"), F.least(F.lit(opponents), turns) - 1)).alias("t")
    a = numbered(large).withColumn("n", turns).filter("n > 0").select("k", "r", "n", F.col("f").alias("x"), meets)
    a = a.select("k", "r", "t", "x", F.pmod(F.col("r") * opponents + F.col("t"), F.col("n")).cast("int").alias("o"))
    b = numbered(small).select("k", F.col("r").alias("o"), F.col("f").alias("y"))
    g, w = ("x", "y") if n_good >= n_bad else ("y", "x")
    return a.join(b, ["k", "o"]).select(((F.col("r") * opponents + F.col("t")) * buckets + F.col("k")).alias("pair"), F.col(g).alias("g"), F.col(w).alias("b"))


def newton(pairs: DataFrame, mean: np.ndarray, scale: np.ndarray, ridge: float, steps: int = STEPS) -> np.ndarray:
    """Weights of the standardised features that minimise
    ``mean(log(1 + exp(-w (g - b)))) + ridge / 2 |w|^2``.  The loss is convex;
    a step that does not lower it is halved."""
    d = len(mean)

    def sums(w: np.ndarray) -> tuple[int, float, np.ndarray, np.ndarray]:
        def run(batches):
            n, loss, grad, hess = 0, 0.0, np.zeros(d), np.zeros((d, d))
            for b in batches:
                x = (matrix(b.column("g")) - matrix(b.column("b"))) / scale
                m = x @ w
                p = 1 / (1 + np.exp(np.clip(m, -500, 500)))
                n, loss = n + len(x), loss + float(np.logaddexp(0, -m).sum())
                grad -= p @ x
                hess += (x * (p * (1 - p))[:, None]).T @ x
            yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([np.r_[loss, grad, hess.ravel()].tobytes()])], ["n", "v"])

        rows = pairs.mapInArrow(run, "n bigint, v binary").collect()                # one row a task: PARTS or so
        v = sum((np.frombuffer(r.v) for r in sorted(rows, key=lambda r: r.v)), np.zeros(1 + d + d * d))
        n = max(sum(r.n for r in rows), 1)
        v = v / n
        return n, v[0] + ridge / 2 * w @ w, v[1:d + 1] + ridge * w, v[d + 1:].reshape(d, d) + ridge * np.eye(d)

    w = np.zeros(d)
    n, loss, grad, hess = sums(w)
    for _ in range(steps):
        step = np.linalg.solve(hess, grad)
        for _ in range(8):
            _, new, g, h = sums(w - step)
            if new <= loss:
                break
            step = step / 2
        else:
            return w
        done = loss - new < 1e-9
        w, loss, grad, hess = w - step, new, g, h
        if done:
            break
    return w


def raw_score(f: Column, w: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> Column:
    """``w`` times the standardised features, as a Spark expression."""
    c = F.array(*[F.lit(float(v)) for v in w / scale])
    return F.aggregate(F.zip_with(f, c, lambda x, y: x.cast("double") * y), F.lit(-float(mean @ (w / scale))), lambda a, x: a + x)


def logistic(x: Column) -> Column:
    return 1 / (1 + F.exp(-F.least(F.greatest(x, F.lit(-700.0)), F.lit(700.0))))


def quantile(scores: DataFrame, share: float) -> float:
    """The least ``raw`` cut that ``share`` of the rows lie below, to a cell of the logistic scale."""
    cells = scores.groupBy(F.floor(logistic(F.col("raw")) * CELLS).alias("c")).count().collect()       # CELLS rows at most
    want, run = share * sum(r["count"] for r in cells), 0
    for r in sorted(cells):
        run += r["count"]
        if run >= want:
            p = min(max((r.c + 1) / CELLS, 1 / CELLS), 1 - 1 / CELLS)
            return float(np.log(p / (1 - p)))
    return 0.0


def rank_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
                   train_rows: int = TRAIN_ROWS, opponents: int = OPPONENTS, ridge: float = RIDGE) -> DataFrame:
    """(id, raw, score): every row of ``docs`` scored by a model of the rows of
    ``labels`` (id, 0/1), which are all used for training."""
    table = materialise(feature_table(docs, id_col, text_col), "op12-features")
    known = labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1)).groupBy(F.col(id_col).alias("id")).agg(F.min(label_col).alias("y"))
    train = materialise(table.join(known, "id"), "op12-train")
    n = {r.y: r["count"] for r in train.groupBy("y").count().collect()}
    if not n.get(0) or not n.get(1):
        return table.select(F.col("id").alias(id_col), F.lit(0.0).alias("raw"), F.lit(0.5).alias("score"))
    # a share of the hash space, so that about train_rows of each class are in it
    u = F.pmod(F.xxhash64("id", F.lit(12)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    some = {y: train.filter((F.col("y") == y) & (u <= train_rows / n[y])).select("id", "f") for y in (0, 1)}
    m = {y: t.count() for y, t in some.items()}
    if not m[0] or not m[1]:
        return table.select(F.col("id").alias(id_col), F.lit(0.0).alias("raw"), F.lit(0.5).alias("score"))
    pairs = preference_pairs(some[1], some[0], m[1], m[0], opponents).repartition(PARTS, "pair").sortWithinPartitions("pair")
    pairs = materialise(pairs, "op12-pairs")

    def moments(batches):
        s = np.zeros((2, FEATURES))
        k = 0
        for b in batches:
            for c in "gb":
                x = matrix(b.column(c))
                s, k = s + [x.sum(0), (x * x).sum(0)], k + len(x)
        yield pa.RecordBatch.from_arrays([pa.array([k]), pa.array([s.tobytes()])], ["n", "v"])

    got = pairs.mapInArrow(moments, "n bigint, v binary").collect()
    k = sum(r.n for r in got)
    mean, square = sum((np.frombuffer(r.v) for r in sorted(got, key=lambda r: r.v)), np.zeros(2 * FEATURES)).reshape(2, -1) / k
    scale = np.sqrt(np.maximum(square - mean * mean, 0))
    scale = np.where(scale > 1e-6, scale, 1e9)                    # constant features have no say
    w = newton(pairs, mean, scale, ridge)
    scored = table.select("id", raw_score(F.col("f"), w, mean, scale).alias("raw"))
    cut = quantile(train.select(raw_score(F.col("f"), w, mean, scale).alias("raw")), n[0] / (n[0] + n[1]))
    return scored.select(F.col("id").alias(id_col), "raw", logistic(F.col("raw") - cut).alias("score"))


def held_out(id_col: str) -> Column:
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(3)) == 1


def op12_quality_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality").filter(~held_out("doc_id"))
    out = rank_documents(docs, labels)
    return out.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
