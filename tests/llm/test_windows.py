"""Ops 2 and 5 against brute force, with sizes that force many chunks, buckets and shards."""
import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from annomart.llm.op2_phrases import locate, remove_repeats
from annomart.llm.op5_suffixes import Text, remove_seen

from .data import awkward, frame

SMALL = {"chunk_bytes": 3000, "bucket_bytes": 5000, "shard_bytes": 2000}
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_words(rows, window):
    seen = {}
    toks = [WORD.findall(t or "") for _, t in rows]
    for w in toks:
        for i in range(len(w) - window + 1):
            k = tuple(w[i:i + window])
            seen[k] = seen.get(k, 0) + 1
    out = []
    for (d, _), w in zip(rows, toks):
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i:i + window])] > 1:
                gone.update(range(i, i + window))
        out.append((d, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def brute_bytes(rows, length):
    first, top = {}, 1 << 63
    rows = [(d, (t or "").encode()) for d, t in rows]
    for d, b in rows:
        for i in range(len(b) - length + 1):
            k = b[i:i + length]
            first[k] = min(first.get(k, top), top if d is None else d)
    out = []
    for d, b in rows:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if first[b[i:i + length]] < (top if d is None else d):
                gone[i:i + length] = b"\1" * length
        spans = len(re.findall(rb"\x01+", bytes(gone)))
        out.append((d, len(b), sum(gone), spans, hashlib.sha256(bytes(c for c, g in zip(b, gone) if not g)).hexdigest()))
    return out


def key(r):
    return tuple((x is None, "" if x is None else x) for x in r)


@pytest.mark.parametrize("window,gram", [(35, 12), (6, 3)])
def test_repeated_phrases(spark, window, gram):
    rows = awkward(1)
    df = remove_repeats(frame(spark, rows), cols=["doc_id", "n_words", "key"][:1], window=window, gram=gram, phrases=50, **SMALL)
    got = [(r.doc_id, r.n_words, r.n_removed, " ".join(WORD.findall(r.kept_text or ""))) for r in df.collect()]
    assert sorted(got, key=key) == sorted(brute_words(rows, window), key=key)


def test_repeated_phrases_text(spark):
    """Texts without repeats keep their bytes, null stays null, all columns ride along."""
    rows = awkward(2)
    df = frame(spark, rows)
    out = remove_repeats(df.select("doc_id", "text", "chunk", "rest"), window=35, gram=12, **SMALL)
    assert out.columns == ["doc_id", "text", "chunk", "rest", "kept_text", "n_words", "n_removed"]
    assert out.filter("n_removed = 0 and not (text <=> kept_text)").count() == 0
    assert out.filter("text is null and kept_text is not null").count() == 0
    assert out.filter("n_removed > 0").count() > 5
    cut = out.filter("n_removed > 0").collect()
    for r in cut:
        assert len(WORD.findall(r.kept_text)) == r.n_words - r.n_removed


@pytest.mark.parametrize("length,gram", [(50, 20), (12, 5)])
def test_suffix_dedup(spark, length, gram):
    rows = awkward(3, n=40, long=120)
    out = remove_seen(frame(spark, rows), length=length, gram=gram, **SMALL)
    got = [tuple(r) for r in out.select("doc_id", "n_bytes", "n_removed", F.size("spans"), F.sha2("kept", 256)).collect()]
    assert sorted(got, key=key) == sorted(brute_bytes(rows, length), key=key)
    r = out.filter("n_removed > 0").first()
    assert sum(s.end - s.start for s in r.spans) == r.n_removed == r.n_bytes - len(r.kept)


def test_empty_tables(spark):
    df = frame(spark, awkward(1)).limit(0)
    assert remove_repeats(df).count() == 0 and remove_seen(df).count() == 0


def test_suffix_order_is_sorted():
    rng = np.random.default_rng(0)
    for trial in range(150):
        length, k, letters = (int(rng.integers(a, b)) for a, b in ((1, 12), (1, 20), (1, 4)))
        count = rng.integers(1, 9, k)
        size = count + length - 1
        data = rng.integers(97, 97 + letters, size.sum()).astype(np.uint8)
        if trial % 3 == 0:
            data[rng.random(len(data)) < .2] = 0
        t = Text(data, size, count, length)
        o = t.suffix_order()
        strings = [data[p:p + length].tobytes() for p in o]
        assert sorted(o) == sorted(t.wanted) and strings == sorted(strings)
        cls = t.class_starts(o)
        assert len(cls) == len(set(strings))


def test_automaton_finds_each_occurrence():
    ids = np.array([1, 2, 3, 1, 2, 3, 4, 9, 1, 2, 3, 4], np.int64)
    hit = locate(ids, np.array([0, 8, 12]), np.array([6, 2]), np.array([1, 1]),
                 np.array([hash(tuple(ids[i:i + 3])) for i in [0, 1, 2, 3, 4, 5, 8, 9]]), 3)
    assert hit.tolist() == [True, False, False, True, True, False, True, True]
