"""Op 5 - suffix-array dedup by two-stage sorting.

Texts are UTF-8 byte strings.  Every byte is removed that lies in a
``length``-byte string which also starts in a document with a smaller id;
strings are judged on the input.

The routing of :mod:`annomart.llm.passages` brings all strings that can be
equal to one shard.  There the distinct segments form one text whose suffixes
at window starts are ordered in two stages: only suffixes smaller than their
successor are sorted directly (by ``length`` bytes); the others follow by one
scan over the first-byte buckets, each finished bucket placing the larger
predecessors of its suffixes in order.  Adjacent common prefixes then give the
classes of equal strings, and the smallest id of a class decides.

Edge cases: null text is empty; a null id is larger than every id (its text
never removes another's bytes); equal ids do not remove each other's bytes;
texts shorter than ``length`` lose nothing; kept bytes may cut a character, so
they are returned as binary.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annomart.llm import arrays as A
from annomart.llm.passages import Chunk, covered, repeated_windows

LENGTH = 50
GRAM = 20


class Text:
    """Distinct segments as one byte text.  A suffix ends with its segment and
    counts as followed by zeros."""

    def __init__(self, data: np.ndarray, size: np.ndarray, count: np.ndarray, length: int):
        self.t, self.length = data, length
        self.end = np.cumsum(size)
        n = len(data)
        self.stop = np.zeros(n + 1, bool)
        self.stop[self.end] = True                             # position behind a segment
        self.seg = np.repeat(np.arange(len(size), dtype=np.int32), size)
        self.left = (self.end[self.seg] - np.arange(n)).astype(np.int32)       # bytes from here to the segment's end
        padded = np.r_[data, np.zeros(8, np.uint8)].astype(A.U)
        self.eight = np.zeros(n + 1, A.U)                      # eight bytes from each position
        for i in range(8):
            self.eight = (self.eight << A.U(8)) | padded[i:i + n + 1]
        self.wanted = A.ragged(self.end - size, count)         # window starts
        # smaller: is the suffix smaller than its successor?  Decided by the first other byte.
        nxt = np.r_[data[1:], 0].astype(np.int16)
        nxt[self.end - 1] = 0
        here = data.astype(np.int16)
        decided = (here != nxt) | self.stop[1:]
        at = np.flatnonzero(decided)
        first = at[np.searchsorted(at, np.arange(n))] if n else at
        self.smaller = nxt[first] > here[first]

    def reader(self, p: np.ndarray):
        """``word(k, pick)``: bytes 8k to 8k + 7 of the suffixes ``p[pick]`` as
        numbers that order them; zeros behind the segment and beyond ``length``."""
        room = np.minimum(self.left[p], self.length)
        ragged = bool(len(p)) and int(room.min()) < self.length

        def word(k: int, pick=slice(None)) -> np.ndarray:
            x = self.eight[np.minimum(p[pick] + 8 * k, len(self.t))]
            if self.length < 8 * k + 8:
                cut = A.U(64 - 8 * (self.length - 8 * k))
                x = x >> cut << cut
            if ragged:
                r = room[pick] - 8 * k
                few = np.flatnonzero(r < min(8, self.length - 8 * k))
                bits = (A.U(64) - A.U(8) * np.clip(r[few], 1, 8).astype(A.U))
                x[few] = np.where(r[few] > 0, x[few] >> bits << bits, A.U(0))
            return x

        return word

    def by_text(self, p: np.ndarray) -> np.ndarray:
        """``p`` in order of the first ``length`` bytes: sorted by eight, then
        only runs of equal ones that still vary are sorted by the next eight."""
        word = self.reader(p)
        x = word(0)
        o = np.argsort(x)
        x = x[o]
        tied, run = np.arange(len(p)), np.zeros(len(p), np.int64)
        for k in range(1, -(-self.length // 8) + 1):
            run = np.cumsum(np.r_[True, (run[1:] != run[:-1]) | (x[1:] != x[:-1])][:len(x)])
            keep = np.bincount(run)[run] > 1 if len(run) else np.zeros(0, bool)
            tied, run = tied[keep], run[keep]
            if not len(tied) or 8 * k >= self.length:
                break
            x = word(k, o[tied])
            vary = np.zeros(int(run[-1]) + 1, bool)
            vary[run[1:][(run[1:] == run[:-1]) & (x[1:] != x[:-1])]] = True
            sub = np.flatnonzero(vary[run])
            order = sub[np.lexsort((x[sub], run[sub]))]
            o[tied[sub]], x[sub] = o[tied[order]], x[order]
        return p[o]

    def suffix_order(self) -> np.ndarray:
        """Window starts in suffix order (equal strings are neighbours)."""
        t, n = self.t, len(self.t)
        inside = np.zeros(n + 1, bool)
        inside[self.wanted] = True
        # the successors that the scan needs: on to the next directly sorted suffix
        p = self.wanted[~self.smaller[self.wanted]]
        while len(p):
            p = p[~self.stop[p + 1]] + 1
            p = p[~inside[p]]
            inside[p] = True
            p = p[~self.smaller[p]]
        every = np.flatnonzero(inside[:-1])
        direct = every[self.smaller[every]]
        direct = self.by_text(direct)
        cut = np.searchsorted(t[direct], np.arange(257))
        larger = inside.copy()
        larger[:-1][self.smaller] = False
        # suffixes of one byte come first in their bucket
        tail = every[self.stop[every + 1]]
        tail = tail[~self.smaller[tail]]
        pending: list[list[np.ndarray]] = [[] for _ in range(256)]
        deal = lambda q: [pending[c].append(q[a:b]) for c, a, b in by_byte(t, q)]
        deal(tail)
        out = []
        for c in range(256):
            if not pending[c] and cut[c] == cut[c + 1]:
                continue
            bucket = []
            while pending[c]:                                  # runs of one byte lengthen round by round
                q = np.concatenate(pending[c])
                pending[c] = []
                bucket.append(q)
                induced(t, q, larger, self.stop, deal)
            s = direct[cut[c]:cut[c + 1]]
            induced(t, s, larger, self.stop, deal)
            out += [*bucket, s]
        order = np.concatenate(out) if out else np.zeros(0, np.int64)
        keep = np.zeros(n + 1, bool)
        keep[self.wanted] = True
        return order[keep[order]]

    def class_starts(self, order: np.ndarray) -> np.ndarray:
        """Where a suffix's common prefix with the one before is shorter than ``length``."""
        new = np.zeros(len(order), bool)
        new[:1] = True
        word = self.reader(order)
        for k in range(-(-self.length // 8)):
            w = word(k)
            new[1:] |= w[1:] != w[:-1]
        return np.flatnonzero(new)


def by_byte(t: np.ndarray, q: np.ndarray) -> list[tuple[int, int, int]]:
    """Sorts ``q`` by first byte in place, keeping its order; (byte, from, to)."""
    if not len(q):
        return []
    o = np.argsort(t[q], kind="stable")
    q[:] = q[o]
    first = A.run_starts(t[q])
    return [(int(t[q[a]]), int(a), int(b)) for a, b in zip(first, np.r_[first[1:], len(q)])]


def induced(t: np.ndarray, done: np.ndarray, larger: np.ndarray, stop: np.ndarray, deal) -> None:
    """Places the predecessors of a finished stretch that are larger than their successor."""
    p = done[(done > 0) & ~stop[done]] - 1
    deal(p[larger[p]])


def shard_bits(s: dict, length: int = LENGTH) -> np.ndarray:
    """One bit per window of a shard's segments: does the string start in a
    document with an id smaller than any that the segment has in its chunk?"""
    begin = np.cumsum(s["size"]) - s["size"]
    run = np.zeros(len(s["data"]) + 1, A.U)
    np.cumsum(A.BYTE[s["data"]] * A.powers(len(s["data"])), out=run[1:])
    h = A.mix((run[begin + s["size"]] - run[begin]) * A.powers(len(run), A._Q)[begin] ^ s["size"].astype(A.U))
    _, first, back = np.unique(h, return_index=True, return_inverse=True)
    least = np.full(len(first), np.iinfo(np.int64).max)
    np.minimum.at(least, back, s["value"])
    size, count = s["size"][first], s["count"][first]
    text = Text(s["data"][A.ragged(begin[first], size)], size, count, length)
    order = text.suffix_order()
    cls = text.class_starts(order)
    seg = text.seg[order]
    low = np.minimum.reduceat(least[seg], cls) if len(cls) else cls
    smallest = np.empty(len(order), np.int64)
    at = np.empty(len(text.t), np.int64)
    at[text.wanted] = np.arange(len(text.wanted))
    smallest[at[order]] = np.repeat(low, np.diff(np.r_[cls, len(order)]))
    offset = np.cumsum(count) - count
    return smallest[A.ragged(offset[back], s["count"])] < np.repeat(s["value"], s["count"])


def remove_seen(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                gram: int = GRAM, **sizes: int) -> DataFrame:
    """(id, n_bytes, n_removed, spans array<struct<start, end>>, kept binary)
    per row; spans are the maximal removed byte ranges."""
    top = np.iinfo(np.int64).max

    def ids(c: Chunk, at: np.ndarray) -> np.ndarray:
        x = c.rest.column(id_col).fill_null(top).to_numpy()
        return x[np.searchsorted(c.cut, at, "right") - 1]

    def value(c: Chunk, start: np.ndarray, slot: np.ndarray, n: int) -> np.ndarray:
        least = np.full(n, top)
        np.minimum.at(least, slot, ids(c, start))
        return least

    def extra(c: Chunk, start: np.ndarray, slot: np.ndarray, n: int) -> np.ndarray:
        return value(c, start, slot, n)[slot] < ids(c, start)

    def finish(c: Chunk, hit: np.ndarray):
        gone = covered(len(c.buf), hit, length)
        edge = np.zeros(len(c.buf) + 1, bool)
        edge[c.offs] = True
        begin = np.flatnonzero(gone & np.r_[True, ~gone[:-1] | edge[1:-1]][:len(gone)])
        end = np.flatnonzero(gone & np.r_[~gone[1:] | edge[1:-1], True][-len(gone):]) + 1 if len(gone) else begin
        row = np.searchsorted(c.offs, begin, "right") - 1
        n = len(c.offs) - 1
        upto = np.r_[0, np.cumsum(~gone)][c.offs]
        kept = pa.BinaryArray.from_buffers(pa.binary(), n, [None, pa.py_buffer(upto.astype(np.int32).tobytes()),
                                                            pa.py_buffer(c.buf[~gone].tobytes())])
        span = pa.StructArray.from_arrays([pa.array(begin - c.offs[row]), pa.array(end - c.offs[row])], ["start", "end"])
        spans = pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(n + 1)).astype(np.int32)), span)
        size = np.diff(c.offs)
        yield pa.RecordBatch.from_arrays([c.rest.column(id_col), pa.array(size), pa.array(size - np.diff(upto)), spans, kept],
                                         [id_col, "n_bytes", "n_removed", "spans", "kept"])

    schema = f"`{id_col}` bigint, n_bytes bigint, n_removed bigint, spans array<struct<start:bigint,end:bigint>>, kept binary"
    return repeated_windows(docs.select(F.col(id_col).cast("bigint").alias(id_col), F.col(text_col).alias("__t")), "__t", [id_col],
                            False, length, gram, value, lambda s: shard_bits(s, length), False, finish, schema, "op5", extra, **sizes)


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return remove_seen(docs).select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("bigint").alias("n_spans"),
                                    F.sha2("kept", 256).alias("kept_sha256"))


OP5_SQL = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, encode(coalesce(text, '')) AS b FROM documents),
win AS MATERIALIZED (
  SELECT r, doc_id, i, md5(array_slice(b, i, i + 49)) AS h
  FROM (SELECT r, doc_id, b, unnest(range(1, octet_length(b) - 48)) AS i FROM d WHERE octet_length(b) >= 50)),
seen AS (SELECT h, min(doc_id) AS first_id FROM win GROUP BY h),
hit AS (SELECT r, i FROM win JOIN seen USING (h) WHERE first_id < doc_id),
step AS (SELECT r, i, CASE WHEN i - lag(i) OVER (PARTITION BY r ORDER BY i) <= 50 THEN 0 ELSE 1 END AS fresh FROM hit),
run AS (SELECT r, i, sum(fresh) OVER (PARTITION BY r ORDER BY i) AS g FROM step),
span AS (SELECT r, min(i) AS s, max(i) + 49 AS e FROM run GROUP BY r, g),
rest AS (SELECT r, coalesce(lag(e) OVER (PARTITION BY r ORDER BY s), 0) + 1 AS a, s - 1 AS z FROM span
         UNION ALL SELECT r, max(e) + 1, octet_length(any_value(b)) FROM span JOIN d USING (r) GROUP BY r),
kept AS (SELECT r, string_agg(hex(array_slice(b, a, z)), '' ORDER BY a) AS t FROM rest JOIN d USING (r) WHERE a <= z GROUP BY r),
lost AS (SELECT r, count(*) AS n_spans, sum(e - s + 1) AS n FROM span GROUP BY r)
SELECT doc_id, CAST(octet_length(b) AS BIGINT) AS n_bytes, CAST(coalesce(lost.n, 0) AS BIGINT) AS n_removed,
       coalesce(n_spans, 0) AS n_spans, sha256(CASE WHEN lost.n IS NULL THEN b ELSE unhex(coalesce(t, '')) END) AS kept_sha256
FROM d LEFT JOIN lost USING (r) LEFT JOIN kept USING (r)
"""
