"""Op 3 against brute force."""
import re

import numpy as np
import pytest

from annomart.llm import arrays as A
from annomart.llm import op3_jaccard
from annomart.llm.op3_jaccard import Bands, drop_near_duplicates, jaccard_components, parity_words, tied

from .data import awkward, frame

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(t, width):
    w = WORD.findall((t or "").translate(LOW))
    return {tuple(w)} if 0 < len(w) < width else {tuple(w[i:i + width]) for i in range(len(w) - width + 1)}


def brute(rows, width, percent):
    sets = [shingles(t, width) for _, t in rows]
    group = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= percent * len(a | sets[j]):
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    least = {}
    for (d, _), g in zip(rows, group):
        least[g] = min((x for x in (least.get(g), d) if x is not None), default=None)
    return [(d, len(s), least[g]) for (d, _), s, g in zip(rows, sets, group)], group


def key(r):
    return tuple((x is None, x or 0) for x in r)


@pytest.mark.parametrize("width,percent,tile", [(3, 90, 2 << 20), (5, 80, 700)])
def test_components(spark, width, percent, tile):
    rows = awkward(5, n=120, long=150)
    want, group = brute(rows, width, percent)
    got = jaccard_components(frame(spark, rows), width=width, percent=percent, tile_bytes=tile)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)
    assert len(set(group)) < len(rows) - 25


def test_one_of_each_group_stays(spark):
    rows = awkward(6, n=80, long=120)
    _, group = brute(rows, 5, 80)
    out = drop_near_duplicates(frame(spark, rows), tile_bytes=900)
    assert out.columns == frame(spark, rows).columns
    best = {}
    for (d, t), g in zip(rows, group):
        if shingles(t, 5):
            best[g] = min(best.get(g, (2, 0)), (d is None, d or 0))
    want = sorted([x[1] for x in best.values() if not x[0]] + [d for d, t in rows if not shingles(t, 5) and d is not None])
    got = [r.doc_id for r in out.collect()]
    assert sorted(d for d in got if d is not None) == want


def test_empty(spark):
    df = frame(spark, []).limit(0)
    assert jaccard_components(df).count() == 0 and drop_near_duplicates(df).count() == 0


def test_ties_run_over_batches():
    rng = np.random.default_rng(2)
    key, f = rng.integers(0, 30, 400), rng.integers(0, 60, 400)
    o = np.lexsort((f, key))
    key, f = key[o], f[o]
    import pyarrow as pa
    for size in (1, 7, 50, 400):
        it = (pa.RecordBatch.from_arrays([pa.array(key[i:i + size]), pa.array(f[i:i + size])], ["key", "f"]) for i in range(0, 400, size))
        got = {tuple(r.values()) for b in tied(it) for r in b.to_pylist()}
        assert got == {(min(f[key == k]), x) for k in set(key.tolist()) for x in f[key == k] if x != min(f[key == k])}


def test_every_linked_pair_shares_a_key():
    rng = np.random.default_rng(1)
    for percent in (80, 90):
        bands = Bands(percent)
        for n in [1, 2, 5, 9, 10, 11, 17, 18, 19, 27, 40, 41, 60, 100, 250, 400, 1000]:
            for _ in range(12):
                a = np.unique(rng.integers(0, 1 << 63, n).astype(A.U))
                most = bands.differ(2 * len(a))
                drop = int(rng.integers(0, most + 1))
                b = np.unique(np.r_[a[drop:], rng.integers(0, 1 << 63, int(rng.integers(0, most + 1))).astype(A.U)])
                both = len(np.intersect1d(a, b))
                if 100 * both < percent * (len(a) + len(b) - both):
                    continue
                if both < len(a) or both < len(b):
                    assert len(np.intersect1d(bands.keys(a), bands.keys(b)))
                k = 1 + n // 8
                word = lambda u: parity_words(u, ((u >> A.U(6)) % A.U(k)).astype(np.int64), k)
                assert np.bitwise_count(word(a) ^ word(b)).sum() <= len(a) + len(b) - 2 * both


@pytest.mark.parametrize("percent", [51, 55, 60])
def test_linked_pairs_two_bands_apart_share_a_key(percent):
    """A low threshold links sizes that lie two bands apart."""
    rng, bands = np.random.default_rng(3), Bands(percent)
    apart = 0
    for n in range(40, 200, 4):
        big = np.unique(rng.integers(0, 1 << 63, n * 100 // percent).astype(A.U))
        small = np.sort(rng.permutation(big)[:n])
        apart += bands.of(len(big))[0] - bands.of(n)[0] > 1
        assert np.intersect1d(bands.keys(small), bands.keys(big)).size
    assert apart


def test_bands_of_a_high_threshold_are_the_own_and_the_next():
    for percent in (67, 80, 90, 100):
        bands = Bands(percent)
        for n in range(1, 3000):
            t = int(np.searchsorted(bands.lo, n, "right")) - 1
            assert bands.of(n) == ([t, t + 1] if n * 100 >= percent * int(bands.lo[t + 1]) else [t])


def members(monkeypatch):
    """The rows of the verified clusters' tables, as they are written."""
    found, write = [], op3_jaccard.materialise

    def watched(df, name, *args, **kw):
        out = write(df, name, *args, **kw)
        if name == "op3-members":
            found.append(sorted(r.f for r in out.collect()))
        return out

    monkeypatch.setattr(op3_jaccard, "materialise", watched)
    return found


def words(rng, n):
    return [f"w{x}" for x in rng.integers(0, 10**9, n)]


def test_copies_in_many_tasks_are_verified_once(spark, monkeypatch):
    found, rng = members(monkeypatch), np.random.default_rng(5)
    pairs = []
    for _ in range(4):
        w = words(rng, 120)
        pairs += [" ".join(w), " ".join([*w[:60], "x", *w[61:]])]
    docs = spark.createDataFrame([(i * 10 + c, t) for c in range(9) for i, t in enumerate(pairs)], "doc_id long, text string").repartition(9, "doc_id")
    out = drop_near_duplicates(docs)
    assert sorted(r.doc_id for r in out.collect()) == [0, 20, 40, 60]
    assert len(found) == 1 and len(found[0]) == len(set(found[0])) == 8


def test_texts_that_share_a_passage_are_not_verified_together(spark, monkeypatch):
    """A chain of texts, each with a passage of the one before, and one near copy."""
    found, rng = members(monkeypatch), np.random.default_rng(6)
    parts = [words(rng, 45) for _ in range(41)]
    texts = [" ".join(parts[i] + words(rng, 90) + parts[i + 1]) for i in range(40)]
    texts.append(" ".join([*texts[7].split(" ")[:-2], "other", "end"]))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    assert {r.doc_id for r in drop_near_duplicates(docs).collect()} == set(range(40))
    assert len(found) == 1 and len(found[0]) == 2


def test_linked_pairs_pass_the_short_sketches():
    rng = np.random.default_rng(7)
    import pyarrow as pa
    for percent in (51, 80, 90):
        for n in [1, 2, 9, 31, 32, 33, 40, 63, 64, 65, 127, 129, 500, 9000]:
            a = np.unique(rng.integers(0, 1 << 63, n).astype(A.U))
            for b in (a[:max(1, -(-len(a) * percent // 100))], np.unique(np.r_[a, rng.integers(0, 1 << 63, len(a) * 100 // percent - len(a)).astype(A.U)])):
                assert 100 * min(len(a), len(b)) >= percent * max(len(a), len(b))
                for tiles in ([0, 0], [0, 1]):
                    t = pa.table({"f": [1, 2], "tile": tiles, "n": [len(a), len(b)], "sketch": [op3_jaccard.short_sketch(u).tobytes() for u in (a, b)]})
                    assert sorted(sum(op3_jaccard.alike(t, percent), [])) == [1, 2]


@pytest.mark.parametrize("few", [0, 1 << 21])
def test_rows_are_picked_by_number(spark, monkeypatch, few):
    monkeypatch.setattr(op3_jaccard, "FEW_WORDS", few)
    rows = spark.createDataFrame([(r, r % 7) for p in (0, 3) for r in range(p << 33, (p << 33) + 200)], "__row long, v long").repartition(5)
    keep = [0, 1, 63, 64, 127, 199, (3 << 33) + 62, (3 << 33) + 63]
    out = op3_jaccard.with_row(rows, spark.createDataFrame([(k,) for k in keep + keep], "__row long"))
    assert out.columns == ["__row", "v"] and sorted(r["__row"] for r in out.collect()) == keep
