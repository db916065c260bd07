"""Op 9 - benchmark decontamination by the q-gram lemma.

Texts and benchmark items are reduced to their ASCII letters (lower case),
digits and non-ASCII bytes.  Within ``k`` edits an item of length ``m`` keeps
at least ``m + 1 - q (k + 1)`` of its q-grams, on diagonals at most ``k``
apart.  So the shared q-grams of a text and an item are counted (each item
position once) in overlapping diagonal bands of width ``2 (k + 1)``, only
bands that reach the bound are retained, and banded alignment of the item
against the retained region decides.  ``k`` is the item's share ``edit_rate``
of its length, reduced until the bound is positive; an item shorter than ``q``
must occur exactly.

The benchmark is the stated query set: it is split by size into blocks of at
most ``BLOCK_BYTES`` of text, and each block is one pass over all documents
with the block's index in the tasks (bounded by the block).  No text or
candidate is dropped and each text is read whole, in slices of whole texts.

Edge cases: null or empty texts and items match nothing; repeated items each
report; repeated or null ids report row by row; an empty benchmark gives no
rows; other columns are ignored (or carried, in ``decontaminate``).  Very long
and repetitive texts take time for each shared q-gram, but bounded memory.
An excerpt that leaves out more than ``edit_rate`` of an item is not reported.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annomart.llm import arrays as A

Q = 16
EDIT_RATE = 0.05
BLOCK_BYTES = 4 << 20
PAIRS = 1 << 20                 # shared q-grams expanded at once
_TABLE_BITS = 22

KEEP = np.zeros(256, bool)
KEEP[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def reduce_text(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(kept bytes, their positions, offsets of the rows in them)."""
    at = np.flatnonzero(KEEP[buf])
    return A.LOWER[buf[at]], at, np.searchsorted(at, offs)


def byte_grams(b: np.ndarray, q: int) -> np.ndarray:
    """Hash of the ``q`` bytes from each position."""
    n = len(b)
    if n < q:
        return np.zeros(0, A.U)
    run = np.zeros(n + 1, A.U)
    np.cumsum(A.BYTE[b] * A.powers(n), out=run[1:])
    return A.mix((run[q:] - run[:-q]) * A.powers(n + 1, A._Q)[:n - q + 1])


def distinct(key: np.ndarray) -> np.ndarray:
    """The distinct columns, in order."""
    key = key[:, np.lexsort(key[::-1])]
    return key[:, np.r_[True, (key[:, 1:] != key[:, :-1]).any(axis=0)][:key.shape[1]]]


class Index:
    """q-gram index of a block of items."""

    def __init__(self, items: list[tuple[object, str | None]], q: int = Q, edit_rate: float = EDIT_RATE):
        self.ids, self.text = [], []
        for i, t in items:
            b = np.frombuffer((t or "").encode(), np.uint8)
            b = A.LOWER[b[KEEP[b]]] if len(b) else b
            if len(b):
                self.ids.append(i)
                self.text.append(b)
        size = np.array([len(b) for b in self.text], np.int64)
        self.gram = np.minimum(size, q)
        self.edits = np.array([max([k for k in range(int(n * edit_rate) + 1) if n + 1 - g * (k + 1) >= 1], default=0)
                               for n, g in zip(size, self.gram)], np.int64)
        self.bound = size + 1 - self.gram * (self.edits + 1)
        self.tables = []
        for g in np.unique(self.gram):
            h, item, pos = [], [], []
            for i in np.flatnonzero(self.gram == g):
                x = byte_grams(self.text[i], int(g))
                h.append(x)
                item.append(np.full(len(x), i))
                pos.append(np.arange(len(x)))
            h, item, pos = np.concatenate(h), np.concatenate(item), np.concatenate(pos)
            o = np.argsort(h, kind="stable")
            seen = np.zeros(1 << _TABLE_BITS, bool)
            seen[(h >> A.U(64 - _TABLE_BITS)).astype(np.int64)] = True
            self.tables.append((int(g), h[o], item[o], pos[o], seen))

    def bands(self, b: np.ndarray, cut: np.ndarray, g: int, h: np.ndarray, item: np.ndarray, pos: np.ndarray, seen: np.ndarray):
        """(row, item, band) that share enough item positions.  Hits are expanded
        ``PAIRS`` at a time, text position by text position; a band is counted
        as soon as no later position can reach it, so that what is kept are the
        distinct item positions of the last bands, also in texts of one letter."""
        x = byte_grams(b, g)
        p = np.flatnonzero(seen[(x >> A.U(64 - _TABLE_BITS)).astype(np.int64)])
        x = x[p]
        lo, hi = np.searchsorted(h, x, "left"), np.searchsorted(h, x, "right")
        p, lo, n = p[hi > lo], lo[hi > lo], (hi - lo)[hi > lo]
        row = np.searchsorted(cut, p, "right") - 1
        inside = p + g <= cut[row + 1] if len(p) else np.zeros(0, bool)
        p, lo, n, row = p[inside], lo[inside], n[inside], row[inside]
        size = np.array([len(t) for t in self.text], np.int64)
        held = np.zeros((4, 0), np.int64)
        upto, a = np.cumsum(n), 0
        while a < len(p):
            z = max(a + 1, int(np.searchsorted(upto, (upto[a - 1] if a else 0) + PAIRS, "right")))
            e, r = A.ragged(lo[a:z], n[a:z]), np.repeat(row[a:z], n[a:z])
            i, o = item[e], pos[e]
            band = (np.repeat(p[a:z], n[a:z]) - o) // (self.edits[i] + 1)
            # each hit belongs to two overlapping bands; one item position counts once
            held = distinct(np.concatenate([held, np.stack([r, i, band, o]), np.stack([r, i, band - 1, o])], axis=1))
            a = z
            step = self.edits[held[1]] + 1
            # later hits lie on diagonals from here on
            done = (held[0] < row[a]) | ((held[2] + 2) * step <= p[a] - size[held[1]]) if a < len(p) else np.ones(held.shape[1], bool)
            key, held = held[:, done], held[:, ~done]
            first = np.flatnonzero(np.r_[True, (key[:3, 1:] != key[:3, :-1]).any(axis=0)]) if key.shape[1] else np.zeros(0, np.int64)
            count = np.diff(np.r_[first, key.shape[1]])
            yield from map(tuple, key[:3, first[count >= self.bound[key[1, first]]]].T.tolist())

    def scan(self, buf: np.ndarray, offs: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        """(row, item, edits, first byte, end byte) of every verified region."""
        b, at, cut = reduce_text(buf, offs)
        found = [band for table in self.tables for band in self.bands(b, cut, *table)]
        out: dict[tuple[int, int, int], tuple[int, int]] = {}
        for r, i, d in sorted(found):
            k = int(self.edits[i])
            hit = align(self.text[i], b, d * (k + 1), (d + 2) * (k + 1) - 1, int(cut[r]), int(cut[r + 1]), k)
            if hit:
                edits, s, e = hit
                spot = (r, i, int(at[e - 1]) + 1)
                if spot not in out or edits < out[spot][0]:
                    out[spot] = (edits, int(at[s]))
        return merged([(r, i, k, s - int(offs[r]), e - int(offs[r])) for (r, i, e), (k, s) in out.items()])


def merged(hits: list[tuple[int, int, int, int, int]]) -> list[tuple[int, int, int, int, int]]:
    """Of overlapping regions of one row and item the closest stays (then the first)."""
    out: list[tuple[int, int, int, int, int]] = []
    for h in sorted(hits, key=lambda h: (h[0], h[1], h[2], h[3], h[4])):
        if not any(o[:2] == h[:2] and o[3] < h[4] and h[3] < o[4] for o in out[::-1]):
            out.append(h)
    return out


def _band(item: np.ndarray, text: np.ndarray, lo: int, hi: int, free_start: bool) -> tuple[np.ndarray, int]:
    """Edit distances of the whole item to text prefixes, for text positions on
    diagonals ``lo..hi`` (text index minus item index); returns the last row."""
    width, big = hi - lo + 1, len(item) + len(text) + 1
    col = np.arange(width) + lo                              # text prefix length in row 0
    row = np.where((col >= 0) & (col <= len(text)), 0 if free_start else col, big)
    ramp = np.arange(width)
    padded = np.r_[np.full(max(0, -lo) + 1, 256, np.int64), text.astype(np.int64),
                   np.full(max(0, hi + len(item) - len(text)) + 1, 257, np.int64)]
    shift = max(0, -lo) + 1
    for i, c in enumerate(item, 1):
        col = ramp + lo + i
        same = padded[col - 1 + shift] == c                   # diagonal step consumes text[col - 1]
        new = row + ~same
        new[:-1] = np.minimum(new[:-1], row[1:] + 1)          # item byte without a partner
        new = np.where((col >= 0) & (col <= len(text)), new, big)
        row = np.minimum(np.minimum.accumulate(new - ramp) + ramp, big)   # text bytes without a partner
    return row, lo + len(item)


def align(item: np.ndarray, text: np.ndarray, d_lo: int, d_hi: int, begin: int, end: int, k: int):
    """Best occurrence of ``item`` in ``text[begin:end]`` near diagonals
    ``d_lo..d_hi``: (edits, start, end), or None beyond ``k`` edits."""
    for d in range(max(d_lo, begin), min(d_hi, end - len(item)) + 1):         # verbatim, the usual case
        if text[d] == item[0] and (text[d:d + len(item)] == item).all():
            return 0, d, d + len(item)
    if k == 0:
        return None
    lo, hi = max(begin, d_lo - k), min(end, d_hi + len(item) + k)
    part = text[lo:hi]
    row, first = _band(item, part, d_lo - k - lo, d_hi + k - lo, True)
    best = int(row.min())
    if best > k:
        return None
    stop = int(np.flatnonzero(row == best)[0]) + first
    back, first = _band(item[::-1], part[:stop][::-1], -k, k, False)          # from the end to the start
    reach = np.flatnonzero(back == back.min())
    size = min(int(reach[np.argmin(np.abs(reach + first - len(item)))]) + first, stop)
    return best, lo + stop - size, lo + stop


def item_blocks(benchmark: DataFrame, id_col: str, text_col: str, block_bytes: int):
    """Blocks of the benchmark, each of bounded size, one at a time on the driver."""
    sized = benchmark.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).filter(F.length("text") > 0)
    total, n = sized.agg(F.sum(F.octet_length("text")), F.count(F.lit(1))).first()
    blocks = -(-(total or 0) * 2 // block_bytes)
    if blocks <= 1:
        if n:
            yield [(r["id"], r["text"]) for r in sized.collect()]              # at most half of block_bytes
        return
    # blocks of half the size on average; hashing may fill one more, and an item larger than a block is one by itself
    part = sized.withColumn("b", F.pmod(F.xxhash64("id", "text"), F.lit(blocks)))
    for b in range(blocks):
        yield [(r["id"], r["text"]) for r in part.filter(F.col("b") == b).collect()]


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", q: int = Q, edit_rate: float = EDIT_RATE,
                  block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per occurrence: (id, item, n_edits, start_byte, end_byte); bytes
    of the text's UTF-8 form, ends exclusive."""
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind, item_kind = (t.schema[c].dataType.simpleString() for t, c in ((src, "id"), (benchmark, item_col)))
    schema = f"id {kind}, item {item_kind}, n_edits int, start_byte bigint, end_byte bigint"
    item_type = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[item_kind]
    out = None
    for items in item_blocks(benchmark, item_col, item_text_col, block_bytes):

        def run(batches, items=items):
            index = Index(items, q, edit_rate)
            for b in batches:
                buf, offs = A.text_buffer(b.column(1))
                for i, j in A.slices(offs):
                    hits = index.scan(buf[offs[i]:offs[j]], offs[i:j + 1] - offs[i])
                    if hits:
                        r, it, k, s, e = zip(*hits)
                        yield pa.RecordBatch.from_arrays(
                            [b.column(0).take(pa.array([i + x for x in r])), pa.array([index.ids[x] for x in it], item_type),
                             pa.array(k, pa.int32()), pa.array(s, pa.int64()), pa.array(e, pa.int64())],
                            ["id", "item", "n_edits", "start_byte", "end_byte"])

        part = src.mapInArrow(A.trimmed(run), schema)
        out = part if out is None else out.unionAll(part)
    if out is None:
        out = docs.sparkSession.createDataFrame([], schema)
    return out.withColumnRenamed("id", id_col).withColumnRenamed("item", item_col)


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", q: int = Q, edit_rate: float = EDIT_RATE,
                  block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs`` (all columns) that hold no occurrence of any item."""
    for items in item_blocks(benchmark, item_col, item_text_col, block_bytes):

        def run(batches, items=items):
            index = Index(items, q, edit_rate)
            for b in batches:
                buf, offs = A.text_buffer(b.column(b.schema.get_field_index(text_col)))
                keep = np.ones(b.num_rows, bool)
                for i, j in A.slices(offs):
                    for hit in index.scan(buf[offs[i]:offs[j]], offs[i:j + 1] - offs[i]):
                        keep[i + hit[0]] = False
                yield b.filter(pa.array(keep))

        docs = docs.mapInArrow(A.trimmed(run), docs.schema)
    return docs


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text"))
