"""Ops 4 and 7 against brute force; the Elias-Fano trie."""
import collections
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from annomart.llm import arrays as A
from annomart.llm import op7_quality as Q
from annomart.llm.eliasfano import EliasFano, Trie
from annomart.llm.op4_lm import WEIGHT, train_and_score

from .data import awkward, frame

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SF = "/root/testdata/sf0.001"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def test_elias_fano():
    rng = np.random.default_rng(0)
    for n in (0, 1, 5, 1000, 20000):
        v = np.sort(rng.integers(0, max(1, n * 50), n))
        e = EliasFano(EliasFano.build(v))
        assert not n or (e.get(np.arange(n)) == v.astype(np.uint64)).all()
        x = rng.integers(0, max(2, n * 60), 2000).astype(np.uint64)
        i, found = e.successor(x)
        assert (i == np.searchsorted(v, x)).all() and (found == np.isin(x, v)).all()
        for few in (x, x[:20], v[:0].astype(np.uint64)):       # sorted queries: blocks read in one pass, or too far apart for it
            few = np.sort(few)
            i, found = e.successor(few)
            assert (i == np.searchsorted(v, few)).all() and (found == np.isin(few, v)).all()
        at = rng.integers(0, max(n, 1), min(n, 300))
        assert (e.get(at) == v[at].astype(np.uint64)).all() and (e.get(at[:2]) == v[at[:2]].astype(np.uint64)).all()


def test_distinct():
    rng = np.random.default_rng(2)
    for n in (0, 1, 2, 3000):
        for high, low in ((1, 1), (40, 90), (1 << 20, 1 << 21), (1 << 32, 1 << 32)):   # the last does not fit beside the index
            x = rng.integers(0, high, n).astype(np.uint64) << np.uint64(32) | rng.integers(0, low, n).astype(np.uint64)
            for got, want in zip(A.distinct(x), np.unique(x, return_inverse=True)):
                assert got.tolist() == want.tolist()
            for got, want in zip(A.distinct_hashes(x), np.unique(x, return_inverse=True)):   # small values agree in their high bits
                assert got.tolist() == want.tolist()
            for got, want in zip(A.distinct_hashes(A.mix(x)), np.unique(A.mix(x), return_inverse=True)):
                assert got.tolist() == want.tolist()


def test_trie(tmp_path):
    rng = np.random.default_rng(1)
    k = np.unique(rng.integers(0, 300, 5000).astype(np.uint64) << np.uint64(32) | rng.integers(0, 90000, 5000).astype(np.uint64))
    c, s = k >> np.uint64(32), k & np.uint64(0xFFFFFFFF)
    code = rng.integers(1, 65536, len(k)).astype(np.uint16)
    words = Trie.build(c, s, code)
    words.tofile(tmp_path / "t")
    have = dict(zip(zip(c.tolist(), s.tolist()), code.tolist()))
    q = rng.integers(0, 320, 4000), rng.integers(0, 90100, 4000)
    for t in (Trie(words), Trie.open(str(tmp_path / "t"))):
        assert (t.look_up(c, s) == code).all()
        assert t.look_up(*q).tolist() == [have.get(p, 0) for p in zip(*map(np.ndarray.tolist, q))]
    assert words.nbytes < 12 * len(k)


@pytest.mark.parametrize("split", [1 << 18, 20])
def test_language_model(spark, split):
    rows = awkward(8, n=60, long=120)
    out, model = train_and_score(frame(spark, rows), split=split, chunk_bytes=4000, bucket_bytes=6000, shard_bytes=3000)
    uni, bi, texts = collections.Counter(), collections.Counter(), 0
    toks = [WORD.findall((t or "").translate(LOW)) + [0] for _, t in rows]
    held = [zlib.crc32(b"" if d is None else str(d).encode()) % 7 == 2 for d, _ in rows]
    for w, h in zip(toks, held):
        if not h:
            uni.update(w)
            bi.update(zip([1, *w], w))
            texts += 1
    n, v = sum(uni.values()), len(uni)
    want = []
    for (d, _), w, h in zip(rows, toks, held):
        p1 = [(uni[x] + 1) / (n + v + 1) for x in w]
        before = [texts, *(uni[x] for x in w[:-1])]
        score = sum(math.log10(bi[p] / (c + WEIGHT) + WEIGHT / (c + WEIGHT) * q) for p, c, q in zip(zip([1, *w], w), before, p1))
        want.append((d, h, len(w), sum(uni[x] > 0 for x in w), n, sum(map(math.log10, p1)), score))
    rank = lambda r: (r[0] is None, r[0] or 0, r[2], r[5])
    got = sorted(map(tuple, out.collect()), key=rank)
    for a, b in zip(got, sorted(want, key=rank), strict=True):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5]) and a[6] == pytest.approx(b[6], abs=2e-4 * a[2])
    assert sum(r[6] for r in got if r[1]) > sum(r[5] for r in got if r[1])
    tries = [Trie(np.frombuffer(r.trie, np.uint64)) for r in model.collect()]
    assert sum(t.n for t in tries) == len(bi)


def test_language_model_without_rows(spark):
    out, model = train_and_score(frame(spark, []).limit(0))
    assert out.count() == 0 and model.count() == 0


@pytest.mark.parametrize("order", [3, 4])
@pytest.mark.parametrize("split", [1 << 18, 8])
def test_language_model_of_higher_order(spark, order, split):
    rows = awkward(8, n=60, long=120)
    out, model = train_and_score(frame(spark, rows), split=split, order=order, chunk_bytes=4000, bucket_bytes=6000, shard_bytes=3000)
    toks = [WORD.findall((t or "").translate(LOW)) + [0] for _, t in rows]
    held = [zlib.crc32(b"" if d is None else str(d).encode()) % 7 == 2 for d, _ in rows]
    grams = lambda w, k: [tuple(([1] + w)[max(0, i - k + 2):i + 2]) for i in range(len(w))]
    c = {k: collections.Counter(g for w, h in zip(toks, held) if not h for g in grams(w, k) if len(g) == k) for k in range(2, order + 1)}
    uni = collections.Counter(x for w, h in zip(toks, held) if not h for x in w)
    n, v = sum(uni.values()), len(uni)

    def p(g):
        if len(g) == 1:
            return (uni[g[0]] + 1) / (n + v + 1)
        ctx = g[:-1]
        total = (held.count(False) if ctx == (1,) else uni[ctx[0]]) if len(ctx) == 1 else c[len(ctx)][ctx]
        return (c[len(g)][g] + WEIGHT * p(g[1:])) / (total + WEIGHT)

    want = sorted(sum(math.log10(p(g)) for g in grams(w, order)) for w in toks)
    got = sorted(r.score for r in out.collect())
    assert got == pytest.approx(want, abs=1e-6)                # small counts are exact
    # the written tries hold every n-gram of the training texts, whole
    have = collections.Counter()
    for r in model.collect():
        t, k = Trie(np.frombuffer(r.trie, np.uint64)), 2
        while t is not None:
            have[k] += int((t.codes[:t.n] > 0).sum())
            t, k = t.below, k + 1
    assert have == {k: len(x) for k, x in c.items()}


def test_query_is_of_order_3_and_reads_a_written_model(spark, monkeypatch):
    from annomart.llm import op4_lm

    seen, write = {}, op4_lm.materialise
    monkeypatch.setattr(op4_lm, "materialise", lambda df, name, *a, **kw: seen.setdefault(name, []).append(write(df, name, *a, **kw)) or seen[name][-1])
    df = op4_lm.op4_lm_scores(spark, SF)
    assert df.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    tries = [Trie(np.frombuffer(r.trie, np.uint64)) for m in seen["op4-model"] for r in m.collect()]
    assert sum(t.n for t in tries) > 0 and sum(t.below.n for t in tries) > 0 and all(t.below.below is None for t in tries)


def brute_counts(t):
    t = t or ""
    w = WORD.findall(t)
    win = collections.defaultdict(list)
    for i in range(len(w) - 4):
        win[tuple(w[i:i + 5])].append(i)
    rep = {i + k for v in win.values() if len(v) > 1 for i in v for k in range(5)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(rep),
            len(w) < 10 or 100 * len(rep) > 20 * len(w))


def test_quality_counts(spark):
    rows = [*awkward(9, n=40, long=60), (200, "a b c d e\n" * 4 + "f #|<> g\n\n \nf #|<> g"), (201, "p q r s t p q r s t x " + "y z " * 9)]
    df = frame(spark, rows)
    out = Q.quality_rules(df, df.filter("doc_id < 10"), buckets=256)
    got = [(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in out.collect()]
    rank = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(got, key=rank) == sorted(((d, *brute_counts(t)) for d, t in rows), key=rank)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_quality_ratio_tells_apart(spark):
    good = [(i, " ".join(f"good{(i * 7 + k) % 50}" for k in range(80))) for i in range(40)]
    bad = [(100 + i, " ".join(f"bad{(i * 5 + k) % 50}" for k in range(80))) for i in range(10)]
    df = frame(spark, good + bad)
    out = {r.doc_id: r for r in Q.quality_rules(df, df.filter("doc_id < 20"), buckets=1 << 12).collect()}
    assert min(out[d].llr for d, _ in good) > 0 > max(out[d].llr for d, _ in bad)
    again = {r.doc_id: r.llr for r in Q.quality_rules(df.repartition(5), df.filter("doc_id < 20"), buckets=1 << 12).collect()}
    assert all(abs(again[d] - out[d].llr) < 1e-9 for d in again)
    kept = Q.accepted(df, df.filter("doc_id < 20"), threshold=0.0, buckets=1 << 12)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == [d for d, r in sorted(out.items()) if r.llr >= 0 and not r.base_failed]


def test_quality_ratio_equals_plain_counts(spark):
    """``llr`` and ``kept`` from counts of words and word pairs in plain Python;
    the cells of the hashed words come from Spark."""
    rows = awkward(4, n=40, long=60)
    df, buckets = frame(spark, rows), 128
    target = {i for i, _ in rows[:12]}
    words = {r.w for r in df.select(F.explode(Q.words(F.col("text"))).alias("w")).distinct().collect()}
    pairs = {(a, b) for _, t in rows for w in [WORD.findall(t or "")] for a, b in zip(w, w[1:])}
    cell1 = {r.w: r.c for r in spark.createDataFrame([(w,) for w in words], "w string").select("w", F.pmod(F.xxhash64("w"), F.lit(buckets)).alias("c")).collect()}
    cell2 = {(r.a, r.b): r.c for r in spark.createDataFrame(list(pairs), "a string, b string").select(
        "a", "b", F.pmod(F.xxhash64("a", "b"), F.lit(buckets)).alias("c")).collect()}
    grams = [[cell1[x] for x in w] + [cell2[p] for p in zip(w, w[1:])] for w in (WORD.findall(t or "") for _, t in rows)]
    raw, good = (collections.Counter(c for (d, _), g in zip(rows, grams) if keep(d) for c in g) for keep in (lambda d: True, lambda d: d in target))
    nr, nt = raw.total(), good.total()
    prior = Q.PRIOR
    weight = [math.log((good[c] + prior * (raw[c] + 1) / (nr + buckets)) / (nt + prior)) - math.log((raw[c] + 1) / (nr + buckets)) for c in range(buckets)]
    want = sorted((repr(d), round(sum(weight[c] for c in g) / len(g), 9) if g else 0.0) for (d, _), g in zip(rows, grams))
    threshold = float(np.median([x for _, x in want]))
    out = Q.quality_rules(df, df.filter(F.col("doc_id").isin(list(target))), buckets=buckets, threshold=threshold).collect()
    got = sorted((repr(r.doc_id), round(r.llr, 9)) for r in out)
    assert [g[0] for g in got] == [w[0] for w in want] and [g[1] for g in got] == pytest.approx([w[1] for w in want], abs=1e-8)
    assert all(r.kept == (not r.base_failed and r.llr >= threshold) for r in out) and len({r.kept for r in out}) == 2


def test_quality_without_rows_or_target(spark):
    df = frame(spark, awkward(1))
    assert Q.quality_rules(df.limit(0), df.limit(0), buckets=64).count() == 0
    assert {r.llr for r in Q.quality_rules(df, df.limit(0), buckets=64).collect()} == {0.0}
