"""Repeated windows over a whole corpus: the plumbing that ops 2 and 5 share.

Texts are written once as *chunks* (some megabytes of whole texts in a row).
A window of ``window`` elements (words or bytes) is keyed by the smallest hash
of the ``gram``-element runs inside it, so equal windows have equal keys and
neighbouring windows mostly share theirs: a *run* of windows with one key is
handled as one segment of text.

1. ``flag``: every chunk sends a 32-bit fingerprint of each run's key to the
   key's bucket; the bucket answers, per chunk, one bit per run: does the key
   occur again anywhere?  (A superset of what repeats.)
2. ``segments``: each chunk sends the text of its flagged runs, every distinct
   segment once with its count or smallest id, to the key's shard.
3. the operator judges a shard (all segments of its keys) and answers, per
   chunk, one bit per window.
4. ``finish``: each chunk applies its answers to its texts.

Blobs of packed numbers travel in Spark rows: Spark partitions, shuffles and
retries, a task holds one chunk, one bucket or one shard.  Bucket and shard
numbers grow with the input so that each stays at some megabytes; a passage
that many texts share costs its shard one segment per chunk, however often it
occurs in it.  All intermediates are written tables.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annomart.llm import arrays as A
from annomart.llm.scratch import materialise

CHUNK_BYTES = 2 << 20
BUCKET_BYTES = 24 << 20        # text per bucket of key fingerprints
SHARD_BYTES = 6 << 20          # segment text per shard

U = A.U


def chunk_table(docs: DataFrame, text_col: str, cols: list[str], name: str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(chunk, n_bytes, data, offs, rest): whole texts in input order,
    compressed (they are shuffled more than once); ``rest`` is an Arrow stream
    of the columns ``cols`` of the same rows."""
    src = docs.select(*[F.col(c) for c in cols], F.col(text_col).alias("__text"))

    def run(batches):
        part, k = TaskContext.get().partitionId(), 0
        for b in batches:
            at = b.schema.get_field_index("__text")
            rest = pa.RecordBatch.from_arrays(b.columns[:at], b.schema.names[:at])
            buf, offs = A.text_buffer(b.column(at))
            for i, j in A.slices(offs, chunk_bytes):
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, rest.schema) as w:
                    w.write_batch(rest.slice(i, j - i))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part << 32 | k]), pa.array([int(offs[j] - offs[i])]),
                     pa.array([pa.compress(buf[offs[i]:offs[j]].tobytes(), codec="zstd", asbytes=True)], pa.binary()),
                     pa.array([(offs[i:j + 1] - offs[i]).astype("<i8").tobytes()], pa.binary()),
                     pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["chunk", "n_bytes", "data", "offs", "rest"])
                k += 1

    return materialise(src.mapInArrow(A.trimmed(run), "chunk bigint, n_bytes bigint, data binary, offs binary, rest binary"), name, batch_rows=2000)


@dataclass
class Chunk:
    """One chunk's texts as elements with running hash sums."""

    id: int
    buf: np.ndarray
    offs: np.ndarray
    rest: pa.RecordBatch
    values: np.ndarray             # hash of each element
    cut: np.ndarray                # element offsets of the texts
    first: np.ndarray | None       # first byte and end byte of each element; None: elements are bytes
    last: np.ndarray | None
    sums: np.ndarray

    @classmethod
    def of(cls, row: dict, words: bool, lower: bool = False) -> Chunk:
        buf = np.frombuffer(pa.decompress(row["data"], decompressed_size=row["n_bytes"], codec="zstd", asbytes=True), np.uint8)
        buf, offs = A.LOWER[buf] if lower else buf, np.frombuffer(row["offs"], "<i8")
        rest = pa.ipc.open_stream(row["rest"]).read_next_batch()
        first = last = None
        cut, values = offs, A.BYTE[buf]
        if words:
            first, last, of = A.word_spans(buf, offs)
            cut = np.searchsorted(of, np.arange(len(offs)))
            values = A.span_hashes(buf, first, last)
        sums = np.zeros(len(values) + 1, U)
        np.cumsum(values * A.powers(len(values)), out=sums[1:])
        return cls(row["chunk"], buf, offs, rest, values, cut, first, last, sums)

    def hashes(self, s: np.ndarray, e: np.ndarray) -> np.ndarray:
        """Hash of each element range."""
        return A.mix((self.sums[e] - self.sums[s]) * A.powers(len(self.sums), A._Q)[s] ^ (e - s).astype(U))

    def grams(self, k: int) -> np.ndarray:
        n = len(self.values) - k + 1
        if n <= 0:
            return np.zeros(0, U)
        return A.mix((self.sums[k:] - self.sums[:n]) * A.powers(len(self.sums), A._Q)[:n])

    def bytes_of(self, s: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Byte range of element ranges (not empty)."""
        return (s, e) if self.first is None else (self.first[s], self.last[e - 1])


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    step = 1
    cur = x
    while 2 * step <= width:
        cur = np.minimum(cur[:-step], cur[step:])
        step *= 2
    extra = width - step
    return np.minimum(cur[:-extra], cur[extra:]) if extra else cur


def window_runs(c: Chunk, window: int, gram: int, inner: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first window, number of windows, key, repeats inside) of every run.
    ``inner``: tell whether the key's gram occurs twice inside the run."""
    none = np.zeros(0, np.int64)
    if len(c.values) < window:
        return none, none, np.zeros(0, U), np.zeros(0, bool)
    g = c.grams(gram)
    low = sliding_min(g, window - gram + 1)
    edge = np.zeros(len(low) + 1, np.int64)
    long = np.flatnonzero(np.diff(c.cut) >= window)
    np.add.at(edge, c.cut[long], 1)
    np.add.at(edge, c.cut[long + 1] - window + 1, -1)
    at = np.flatnonzero(np.cumsum(edge[:-1]) > 0)
    if not len(at):
        return none, none, np.zeros(0, U), np.zeros(0, bool)
    k = low[at]
    new = np.flatnonzero(np.r_[True, (k[1:] != k[:-1]) | (np.diff(at) != 1)])
    start, count = at[new], np.diff(np.r_[new, len(at)])
    again = np.zeros(len(start), bool)
    if inner:
        size = count + window - gram
        same = g[A.ragged(start, size)] == np.repeat(k[new], size)
        again = np.add.reduceat(same, np.cumsum(size) - size, dtype=np.int64) > 1
    return start, count, k[new], again


def deal(keys: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(mixed keys, order by part, part in that order)."""
    x = A.mix(keys ^ U(0x5851F42D4C957F2D))
    part = (x % U(parts)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    return x, order, part[order]


def cuts(sorted_part: np.ndarray) -> list[tuple[int, int, int]]:
    """(part, from, to) of each run of equal parts."""
    first = A.run_starts(sorted_part)
    return [(int(sorted_part[a]), int(a), int(b)) for a, b in zip(first, np.r_[first[1:], len(sorted_part)])]


def blob(x: np.ndarray, kind: str) -> bytes:
    return x.astype(kind).tobytes()


def squeeze(x: np.ndarray, kind: str) -> bytes:
    """Numbers as compressed byte planes (their high bytes are mostly alike)."""
    x = x.astype(kind)
    raw = np.frombuffer(x.tobytes(), np.uint8).reshape(-1, x.itemsize).T.tobytes()
    return len(x).to_bytes(4, "little") + (pa.compress(raw, codec="zstd", asbytes=True) if raw else b"")


def unsqueeze(b: bytes, kind: str) -> np.ndarray:
    n, size = int.from_bytes(b[:4], "little"), np.dtype(kind).itemsize
    if not n:
        return np.zeros(0, kind)
    raw = pa.decompress(b[4:], decompressed_size=n * size, codec="zstd", asbytes=True)
    return np.frombuffer(np.frombuffer(raw, np.uint8).reshape(size, n).T.tobytes(), kind)


def rows(cols: dict[str, list], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(cols[f.name], f.type) for f in schema], schema=schema)


def per_chunk(answers: DataFrame, part: str) -> DataFrame:
    """The answers of all buckets or shards to a chunk, as one row."""
    return answers.groupBy("chunk").agg(F.sort_array(F.collect_list(F.struct(part, "bits"))).alias("answers"))


def joined_bits(answers: list[dict] | None) -> list[np.ndarray]:
    return [np.unpackbits(np.frombuffer(a["bits"], np.uint8)) for a in answers or []]


def each_chunk(words: bool, f: Callable[[Chunk, dict], Iterator[pa.RecordBatch]]):
    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                row = b.slice(i, 1).to_pylist()[0]
                yield from f(Chunk.of(row, words), row)
    return A.trimmed(run)


Judge = Callable[[dict], np.ndarray]


def repeated_windows(docs: DataFrame, text_col: str, cols: list[str], words: bool, window: int, gram: int,
                     value: Callable[[Chunk, np.ndarray, np.ndarray, int], np.ndarray], judge: Judge, inner: bool,
                     finish: Callable[[Chunk, np.ndarray], Iterator[pa.RecordBatch]], schema: str, name: str,
                     extra: Callable[[Chunk, np.ndarray, np.ndarray, int], np.ndarray] | None = None,
                     chunk_bytes: int = CHUNK_BYTES, bucket_bytes: int = BUCKET_BYTES,
                     shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Runs the four steps; ``value`` gives the number that a chunk attaches to
    each distinct segment, ``judge`` the bits of a shard's windows, ``extra``
    the runs that are hit by what the chunk itself knows, ``finish`` the result
    rows of a chunk from its window starts that were hit."""
    chunks = chunk_table(docs, text_col, cols, f"{name}-chunks", chunk_bytes)
    total = chunks.agg(F.sum("n_bytes")).first()[0] or 0
    buckets = max(8, -(-total // bucket_bytes))

    flag_schema = pa.schema([("bucket", pa.int32()), ("chunk", pa.int64()), ("marks", pa.binary())])

    def mark(c: Chunk, _row):
        start, _, key, _ = window_runs(c, window, gram, False)
        if len(start):
            x, order, part = deal(key, buckets)
            marks = (x >> U(32)).astype("<u4")[order]
            p = cuts(part)
            yield rows({"bucket": [q for q, _, _ in p], "chunk": [c.id] * len(p),
                        "marks": [marks[a:b].tobytes() for _, a, b in p]}, flag_schema)

    def again(t: pa.Table) -> pa.Table:
        size = np.array([len(x.as_py()) // 4 for x in t.column("marks")], np.int64)
        marks = np.frombuffer(b"".join(x.as_py() for x in t.column("marks")), "<u4")
        order = np.argsort(marks, kind="stable")
        s = marks[order]
        twin = np.zeros(len(s) + 1, bool)
        twin[1:-1] = s[1:] == s[:-1]
        hit = np.empty(len(s), bool)
        hit[order] = twin[1:] | twin[:-1]
        end = np.cumsum(size)
        bits = [np.packbits(hit[b - n:b]).tobytes() for n, b in zip(size, end)]
        return pa.table({"chunk": t.column("chunk"), "bucket": t.column("bucket"), "bits": pa.array(bits, pa.binary()),
                         "hits": pa.array([int(hit[b - n:b].sum()) for n, b in zip(size, end)], pa.int64())})

    flags = materialise(chunks.mapInArrow(each_chunk(words, mark), "bucket int, chunk bigint, marks binary")
                        .groupBy("bucket").applyInArrow(again, "chunk bigint, bucket int, bits binary, hits bigint"),
                        f"{name}-flags", batch_rows=4)
    hits = flags.agg(F.sum("hits")).first()[0] or 0
    shards = max(8, -(-hits * (window + 12) * (7 if words else 1) // shard_bytes))

    seg_schema = pa.schema([("shard", pa.int32()), ("chunk", pa.int64()), ("data", pa.binary()), ("size", pa.binary()),
                            ("count", pa.binary()), ("value", pa.binary()), ("key", pa.binary()),
                            ("start", pa.binary()), ("slot", pa.binary())])
    seg_ddl = "shard int, chunk bigint, data binary, size binary, `count` binary, value binary, key binary, start binary, slot binary"

    def send(c: Chunk, row):
        start, count, key, twice = window_runs(c, window, gram, inner)
        if len(start):
            _, order, part = deal(key, buckets)
            got = joined_bits(row["answers"])
            have = [b - a for _, a, b in cuts(part)]
            hit = np.zeros(len(start), bool)
            hit[order] = np.concatenate([g[:n] for g, n in zip(got, have)]).astype(bool)
            pick = np.flatnonzero(hit | twice)
            start, count, key = start[pick], count[pick], key[pick]
        n, empty = len(start), dict.fromkeys(seg_schema.names)
        if not n:
            yield rows({k: [v] for k, v in (empty | {"shard": -1, "chunk": c.id, "start": b"", "count": b"", "slot": b""}).items()}, seg_schema)
            return
        end = start + count + window - 1
        _, first, back = np.unique(c.hashes(start, end), return_index=True, return_inverse=True)
        _, order, part = deal(key[first], shards)
        slot = np.empty(len(first), np.int64)
        slot[order] = np.arange(len(first))
        slot, own = slot[back], first[order]                     # own: a run of each distinct segment, by shard
        val = value(c, start, slot, len(first))
        lo, hi = c.bytes_of(start[own], end[own])
        out = {k: [] for k in seg_schema.names}
        for q, a, b in cuts(part):
            data = c.buf[A.ragged(lo[a:b], hi[a:b] - lo[a:b])].tobytes()
            r = empty | {"shard": q, "chunk": c.id, "data": data, "size": blob(hi[a:b] - lo[a:b], "<i4"),
                         "count": blob(count[own[a:b]], "<i4"), "value": blob(val[a:b], "<i8"), "key": blob(key[own[a:b]], "<u8")}
            for k, v in r.items():
                out[k].append(v)
        r = empty | {"shard": -1, "chunk": c.id, "start": blob(start, "<i8"), "count": blob(count, "<i4"), "slot": blob(slot, "<i4")}
        for k, v in r.items():
            out[k].append(v)
        yield rows(out, seg_schema)

    with_flags = chunks.join(per_chunk(flags, "bucket").hint("shuffle_hash"), "chunk", "left")
    sent = materialise(with_flags.mapInArrow(each_chunk(words, send), seg_ddl), f"{name}-segments", batch_rows=4)

    def answer(t: pa.Table) -> pa.Table:
        cat = lambda k, kind: np.frombuffer(b"".join(x.as_py() for x in t.column(k)), kind)
        count = cat("count", "<i4").astype(np.int64)
        bits = judge({"data": cat("data", np.uint8), "size": cat("size", "<i4").astype(np.int64), "count": count,
                      "value": cat("value", "<i8"), "key": cat("key", "<u8")})
        per = np.array([int(np.frombuffer(x.as_py(), "<i4").sum()) for x in t.column("count")], np.int64)
        end = np.cumsum(per)
        return pa.table({"chunk": t.column("chunk"), "shard": t.column("shard"),
                         "bits": pa.array([np.packbits(bits[b - n:b]).tobytes() for n, b in zip(per, end)], pa.binary()),
                         "n": pa.array(per)})

    segs = sent.filter("shard >= 0").select("shard", "chunk", "data", "size", "count", "value", "key")
    answers = materialise(segs.groupBy("shard").applyInArrow(answer, "chunk bigint, shard int, bits binary, n bigint"), f"{name}-answers")

    plan = sent.filter("shard < 0").select("chunk", F.col("start").alias("p_start"), F.col("count").alias("p_count"), F.col("slot").alias("p_slot"))
    packed = answers.groupBy("chunk").agg(F.sort_array(F.collect_list(F.struct("shard", "bits", "n"))).alias("answers"))
    side = plan.join(packed, "chunk", "left")

    def apply(c: Chunk, row):
        start = np.frombuffer(row["p_start"], "<i8")
        count = np.frombuffer(row["p_count"], "<i4").astype(np.int64)
        slot = np.frombuffer(row["p_slot"], "<i4").astype(np.int64)
        hit = start
        if len(start):
            bits = np.concatenate([g[:a["n"]] for g, a in zip(joined_bits(row["answers"]), row["answers"])]).astype(bool)
            size = np.zeros(int(slot.max()) + 1, np.int64)
            size[slot] = count
            got = bits[A.ragged((np.cumsum(size) - size)[slot], count)]
            if extra is not None:
                got |= np.repeat(extra(c, start, slot, len(size)), count)
            hit = A.ragged(start, count)[got]
        yield from finish(c, hit)

    done = chunks.join(side.hint("shuffle_hash"), "chunk").mapInArrow(each_chunk(words, apply), schema)
    return materialise(done, f"{name}-result", batch_rows=4)


def covered(n: int, starts: np.ndarray, window: int) -> np.ndarray:
    """Which of ``n`` elements a window at one of ``starts`` covers."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, np.minimum(starts + window, n), -1)
    return np.cumsum(edge[:-1]) > 0
