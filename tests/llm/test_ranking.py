"""Op 12: features against plain Python, the fit against its definition, held-out accuracy."""
import collections
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from annomart.llm import op12_ranking as R

from .data import awkward, frame

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(t):
    raw = (t or "").encode()
    w = [x.encode() for x in WORD.findall(t or "")]
    many = lambda xs: sum(n for n in collections.Counter(xs).values() if n > 1)
    lines = [x for x in re.findall(rb"[^\n]*\n|[^\n]+", raw)]
    per = lambda a, b: a / max(b, 1)
    shape = [math.log1p(len(raw)), math.log1p(len(w)), per(sum(map(len, w)), len(w)), per(len(set(w)), len(w)),
             per(sum(a == b for a, b in zip(w, w[1:])), len(w)), per(many([tuple(w[i:i + 5]) for i in range(len(w) - 4)]), len(w)),
             per(max(collections.Counter(w).values(), default=0), len(w)), per(many(lines), len(lines)), math.log1p(per(len(w), len(lines)))]
    pairs = np.zeros(100)
    for a, b in zip(raw, raw[1:]):
        pairs[R.CLASS[a] * 10 + R.CLASS[b]] += 1
    return shape + (pairs / max(len(raw), 1)).tolist()


def test_features(spark):
    rows = [*awkward(3, n=40, long=80), (200, "a b c d e\n" * 4 + "f g\n\n \nf g"), (201, "\n\n"), (202, "x\n"), (203, "é\nÉ 9!")]
    got = sorted((r.id is None, r.id or 0, list(r.f)) for r in R.feature_table(frame(spark, rows), "doc_id", "text").collect())
    want = sorted((d is None, d or 0, np.float32(brute(t)).tolist()) for d, t in rows)
    assert [g[:2] for g in got] == [w[:2] for w in want]
    for g, w in zip(got, want):
        assert g[2] == pytest.approx(w[2], rel=1e-5, abs=1e-6)


def table(spark, n_good=300, n_bad=90):
    good = [(i, f"Some words of text number {i}, which go on. And another {i * 7} follows here.") for i in range(n_good)]
    bad = [(1000 + i, f"BUY{i}!! NOW!! ### {i} $$$ " * 3) for i in range(n_bad)]
    docs = good + bad + [(5000, None), (5001, ""), (None, "no id"), (3, "Again text number three.")]
    labels = spark.createDataFrame([(i, 1, 0) for i, _ in good] + [(i, 0, 0) for i, _ in bad] + [(3, 1, 0), (None, 0, 0), (9999, 0, 0)],
                                   "doc_id long, quality int, text int")
    return frame(spark, docs), labels


def test_pairs_and_newton(spark):
    docs, labels = table(spark)
    f = R.feature_table(docs, "doc_id", "text")
    good, bad = f.filter("id < 1000"), f.filter("id between 1000 and 2000")
    pairs = R.preference_pairs(good, bad, good.count(), bad.count(), 2).cache()
    assert pairs.count() == 2 * good.count() == pairs.select("pair").distinct().count()
    flat = R.preference_pairs(bad, good, bad.count(), good.count(), 2)                     # the smaller class takes turns
    assert flat.count() == pairs.count()
    x = np.array([np.array(r.g) - np.array(r.b) for r in pairs.collect()])
    d = R.FEATURES
    w = R.newton(pairs.select("pair", "g", "b"), np.zeros(d), np.ones(d), 0.01)
    grad = -(x / (1 + np.exp(x @ w))[:, None]).mean(0) + 0.01 * w
    assert abs(grad).max() < 1e-6
    assert (x @ w > 0).mean() > 0.99


def test_scores(spark):
    docs, labels = table(spark)
    out = R.rank_documents(docs, labels).collect()
    assert len(out) == docs.count() and all(0 < r.score < 1 for r in out)
    assert min(r.score for r in out if r.doc_id is not None and r.doc_id < 300) >= 0.5 > max(r.score for r in out if r.doc_id is not None and 1000 <= r.doc_id < 2000)
    few = R.rank_documents(docs, labels, train_rows=50).collect()                          # a bounded sample learns it, too
    assert np.mean([r.score >= 0.5 for r in few if r.doc_id is not None and r.doc_id < 300]) > 0.9
    again = R.rank_documents(docs.repartition(7), labels).collect()
    by = lambda rows: sorted((r.doc_id is None, r.doc_id or 0, round(r.score, 9)) for r in rows)
    assert by(out) == by(again)


def test_without_labels_or_rows(spark):
    docs, labels = table(spark)
    for some in (labels.limit(0), labels.filter("quality = 1")):
        assert {r.score for r in R.rank_documents(docs, some).collect()} == {0.5}
    assert R.rank_documents(docs.limit(0), labels).count() == 0


def test_query_on_held_out_rows(spark):
    out = R.op12_quality_ranking(spark, SF).cache()
    for r in out.collect():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and r.predicted == (r.score >= 0.5)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = out.filter("held_out").join(labels, "doc_id").collect()
    good, bad = ([r.score for r in rows if r.quality == q] for q in (1, 0))
    assert len(rows) > 100 and sum(g > b for g in good for b in bad) / len(good) / len(bad) > 0.98
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.97


def test_held_out_labels_are_never_learnt(spark, monkeypatch, tmp_path):
    for t in ("documents", "labels"):
        df = spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet")
        if t == "labels":
            df = df.withColumn("quality", F.when(R.held_out("doc_id"), 1 - F.col("quality")).otherwise(F.col("quality")))
        df.write.parquet(f"{tmp_path}/{t}.parquet")
    by = lambda d: sorted((r.doc_id, round(r.score, 9)) for r in R.op12_quality_ranking(spark, d).collect())
    assert by("/root/testdata/sf0.001") == by(str(tmp_path))
