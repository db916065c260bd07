"""Op 1 - best-fit packing by bin completion.

``document_pieces`` turns texts into token pieces, ``pack`` puts items into as
few bins as it can.  Only the histogram of item lengths (at most ``capacity``
rows, whatever the input) reaches the driver, where a branch-and-bound search
plans the bins by *pattern*: it takes the largest remaining length, enumerates
all undominated fillings of the space beside it one by one, applies one as often as the
counts allow, and cuts a branch whose waste cannot beat the incumbent; best
fit decreasing gives the first incumbent; the search ends at the lower bound,
when nothing is left to try, or after ``nodes`` steps.  The items then find their place by
their rank among the items of their length: partition-wise counts give the
ranks, so no length, however frequent, is gathered in one task.

Edge cases: null text is an empty text (one piece, the end id alone); an empty
table packs into nothing; null or repeated ids are kept as they are; ties of
length are broken by input order; all columns of the packed items ride along.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from annomart.llm import arrays as A
from annomart.llm.byte_bpe import byte_bpe
from annomart.llm.scratch import materialise

CAPACITY = 1024
END_ID = 2
NODES = 1500                    # search nodes after the incumbents
KNOWN_UNITS = 800_000           # token ids kept per Python worker for repeated words
ENCODED = 4096                  # words encoded at once

# --------------------------------------------------------------------- tokens

#: first bytes of white space outside ASCII, with their next byte where it matters
_WIDE = [(0xC2, (0x85, 0xA0)), (0xE1, (0x9A,)), (0xE2, (0x80, 0x81)), (0xE3, (0x80,))]


class UnitIds:
    """Token ids of texts, word by word.

    A byte-level tokenizer never joins across the gap before a word, so a text
    is the concatenation of units (gap + word, then a last gap), each encoded
    once and remembered by hash.  Texts with white space outside ASCII are one
    unit as a whole."""

    def __init__(self, path: str, limit: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        # the library itself encodes the units with special strings, which are one id each
        self.library, self.bpe, self.limit = Tokenizer.from_file(path), byte_bpe(path), limit
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.clear()

    def encode(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all units, ids of each)."""
        whole = "\n".join(units)
        odd = [i for i, u in enumerate(units) if any(t in u for t in self.special)] if any(t in whole for t in self.special) else []
        if not odd:
            return self.bpe.encode_units(units)
        own = dict(zip(odd, [x.ids for x in self.library.encode_batch([units[i] for i in odd], add_special_tokens=False)]))
        one = [(np.array(own[i], np.int64), 0) if i in own else self.bpe.encode_units([u]) for i, u in enumerate(units)]
        return np.concatenate([x for x, _ in one]), np.array([len(x) for x, _ in one])

    def clear(self) -> None:
        self.hash, self.at, self.len = np.zeros(0, A.U), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids, self.used = np.zeros(1 << 16, np.uint32), 0

    def units(self, buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, end, row) of the units of each text."""
        wide = np.zeros(len(buf), bool)
        for lead, nexts in _WIDE:
            wide[:-1] |= (buf[:-1] == lead) & np.isin(buf[1:], nexts)
        whole = A.sum_by(np.ones(int(wide.sum()), np.int64),
                         np.searchsorted(offs, np.flatnonzero(wide), "right") - 1, len(offs) - 1) > 0
        _, ends, row = A.word_spans(buf, offs)
        ends, row = ends[~whole[row]], row[~whole[row]]
        tail = np.flatnonzero(np.diff(offs) > 0)
        ends, row = np.r_[ends, offs[tail + 1]], np.r_[row, tail]
        o = np.argsort(ends, kind="stable")
        ends, row = ends[o], row[o]
        keep = np.diff(ends, prepend=-1) > 0                     # a text that ends with its last word
        ends, row = ends[keep], row[keep]
        return np.r_[0, ends[:-1]][:len(ends)], ends, row

    def __call__(self, buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, ids before each text)."""
        s, e, row = self.units(buf, offs)
        if not len(s):
            return np.zeros(0, np.uint32), np.zeros(len(offs), np.int64)
        h, first, back = np.unique(A.span_hashes(buf, s, e), return_index=True, return_inverse=True)
        if len(self.hash) + len(h) > self.limit:
            self.clear()
        at = np.minimum(np.searchsorted(self.hash, h), max(len(self.hash) - 1, 0))
        new = np.flatnonzero(self.hash[at] != h) if len(self.hash) else np.arange(len(h))
        if len(new):
            n, total = np.empty(len(new), np.int64), 0
            for a in range(0, len(new), ENCODED):               # a full encoding is far larger than its ids
                got, size = self.encode([buf[s[i]:e[i]].tobytes().decode("utf-8", "replace") for i in first[new[a:a + ENCODED]]])
                n[a:a + len(size)] = size
                end = self.used + total + len(got)
                if end > len(self.ids):
                    self.ids = np.r_[self.ids[:self.used + total], np.zeros(end // 2, np.uint32)]
                self.ids[self.used + total:end] = got
                total = end - self.used
            hh, aa, ll = (np.r_[self.hash, h[new]], np.r_[self.at, self.used + np.cumsum(n) - n], np.r_[self.len, n])
            self.used += total
            o = np.argsort(hh, kind="stable")
            self.hash, self.at, self.len = hh[o], aa[o], ll[o]
            at = np.searchsorted(self.hash, h)
        at, n = self.at[at][back], self.len[at][back]
        return self.ids[A.ragged(at, n)], np.r_[0, np.cumsum(A.sum_by(n, row, len(offs) - 1))]


_UNITS: dict[str, UnitIds] = {}


def unit_ids(path: str) -> UnitIds:
    """One table per Python worker (workers are reused from task to task)."""
    if path not in _UNITS:
        _UNITS[path] = UnitIds(path, KNOWN_UNITS)
    return _UNITS[path]


def document_pieces(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
                    capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Pieces of at most ``capacity`` ids: (id, piece, start, length, ids_crc32
    and, on request, ``ids`` array<int>).  Longer texts are cut from the end,
    so that only their first piece may be shorter."""
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches):
        ids_of = unit_ids(vocabulary)
        for b in batches:
            buf, offs = A.text_buffer(b.column(1))
            for i, j in A.slices(offs):
                ids, cut = ids_of(buf[offs[i]:offs[j]], offs[i:j + 1] - offs[i])
                rows, piece, start, length, crc, lists = [], [], [], [], [], []
                for r in range(j - i):
                    own = np.append(ids[cut[r]:cut[r + 1]], np.uint32(end_id)).astype("<u4")
                    pos, k, size = 0, 0, (len(own) - 1) % capacity + 1
                    while pos < len(own):
                        rows.append(i + r)
                        piece.append(k)
                        start.append(pos)
                        length.append(size)
                        crc.append(zlib.crc32(own[pos:pos + size].tobytes()))
                        if with_ids:
                            lists.append(own[pos:pos + size].astype(np.int32))
                        pos, k, size = pos + size, k + 1, capacity
                cols = [b.column(0).take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32()),
                        pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
                names = ["id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    cols, names = [*cols, pa.array(lists, pa.list_(pa.int32()))], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(cols, names)

    kind = src.schema["id"].dataType.simpleString()
    schema = f"id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids array<int>" * with_ids
    return src.mapInArrow(A.trimmed(run), schema).withColumnRenamed("id", id_col)


# -------------------------------------------------------------------- planning

Plan = list[tuple[tuple[int, ...], int]]      # (lengths in a bin, number of such bins)


def lower_bound(count: np.ndarray, capacity: int) -> int:
    """Bins that any packing needs: total length, and items over half a bin with what cannot join them."""
    size = np.arange(len(count))
    total = int((count * size).sum())
    best = -(-total // capacity)
    for k in range(0, capacity // 2 + 1):
        big = int(count[capacity - k + 1:].sum())
        half = count[capacity // 2 + 1:capacity - k + 1]
        n = int(half.sum())
        room = n * capacity - int((half * size[capacity // 2 + 1:capacity - k + 1]).sum())
        small = int((count[k:capacity // 2 + 1] * size[k:capacity // 2 + 1]).sum())
        best = max(best, big + n + max(0, -(-(small - room) // capacity)))
    return best


def best_fit_decreasing(count: np.ndarray, capacity: int) -> Plan:
    """Best fit decreasing over lengths with multiplicities."""
    bins: dict[int, list[list]] = {}             # free space -> [lengths, number]
    for s in range(len(count) - 1, 0, -1):
        left = int(count[s])
        for free in sorted(f for f in bins if f >= s):
            # space `free` takes its items one by one until less than s is left
            while left and bins.get(free):
                have, k = bins[free].pop()
                m = min(free // s, -(-left // k)) if left >= k else 1
                use = min(k, left // m)
                if use < k:
                    bins[free].append([have, k - use])
                bins.setdefault(free - m * s, []).append([have + (s,) * m, use])
                left -= use * m
            if not left:
                break
        q = capacity // s
        if left >= q:
            bins.setdefault(capacity - q * s, []).append([(s,) * q, left // q])
            left %= q
        if left:
            bins.setdefault(capacity - left * s, []).append([(s,) * left, 1])
    return [(have, k) for group in bins.values() for have, k in group if k]


def reachable(sizes: list[int], count: dict[int, int], room: int) -> list[int]:
    """Sums up to ``room`` (as bits) of the items from each place of ``sizes`` on."""
    reach, mask = [1], (1 << room + 1) - 1
    for s in reversed(sizes):
        r, left, step = reach[-1], min(count[s], room // s), 1
        while left:
            r |= r << min(step, left) * s & mask
            left, step = left - min(step, left), step * 2
        reach.append(r)
    return reach[::-1]


def fillings(count: dict[int, int], room: int, waste: int) -> Iterator[tuple[int, ...]]:
    """All undominated fillings of ``room`` by items of ``count``, least waste
    first, one by one: a filling leaves at most ``waste`` free and no item out
    that would still fit, and holds more than the largest single item that fits
    (which dominates it otherwise)."""
    fit = sorted((s for s, n in count.items() if n and s <= room), reverse=True)
    if not fit:
        if room <= waste:
            yield ()
        return

    def exact(i: int, total: int) -> Iterator[tuple[int, ...]]:
        """Fillings of exactly ``total`` by the items from ``big[i]`` on, largest first."""
        if not total:
            yield ()
            return
        while i < len(big) and reach[i] >> total & 1:
            s = big[i]
            for m in range(min(count[s], total // s), 0, -1):
                if reach[i + 1] >> total - m * s & 1:
                    for rest in exact(i + 1, total - m * s):
                        yield (s,) * m + rest
            i += 1

    big = None
    for free in range(min(waste, room - fit[0]) + 1):
        rest = tuple(s for s in fit if s <= free for _ in range(count[s]))      # all of these would still fit
        total = room - free - sum(rest)
        if total < 0:
            return
        if big is None or big[-1:] and big[-1] <= free:
            big = [s for s in fit if s > free]
            reach = reachable(big, count, room)
        if room - free == fit[0]:
            if rest in ((), (fit[0],)):
                yield (fit[0],)
        elif reach[0] >> total & 1:
            for have in exact(0, total):
                yield have + rest


def bin_completion(count: np.ndarray, capacity: int, nodes: int = NODES) -> Plan:
    """Branch and bound over patterns; returns the best plan found.  ``nodes``
    is the only limit of the search."""
    best = best_fit_decreasing(count, capacity)
    n_best, floor = sum(k for _, k in best), lower_bound(count, capacity)
    total = int((count * np.arange(len(count))).sum())
    left, path, spent = count.copy(), [], 0
    stack: list = []                              # per level: [fillings not yet tried, largest, waste so far, bins so far]
    waste = used = 0
    while n_best > floor and spent < nodes:
        budget = (n_best - 1) * capacity - total - waste         # waste that still beats the incumbent
        sizes = [int(s) for s in np.flatnonzero(left)[::-1]]
        spent += 1
        if not sizes:
            if used < n_best:
                best, n_best = list(path), used
            options: Iterator = iter(())
        elif budget < 0:
            options = iter(())
        else:
            top = sizes[0]
            options = fillings({s: int(left[s]) - (s == top) for s in sizes}, capacity - top, budget)
            # the waste bound of the incumbent, once the rest is packed best-fit
            if spent % 64 == 1:
                rest = best_fit_decreasing(left, capacity)
                if used + sum(k for _, k in rest) < n_best:
                    best, n_best = [*path, *rest], used + sum(k for _, k in rest)
        stack.append([options, sizes[0] if sizes else 0, waste, used])
        while stack and (filling := next(stack[-1][0], None)) is None:           # back up to an open filling
            stack.pop()
            if stack:
                for s in path[-1][0]:
                    left[s] += path[-1][1]
                path.pop()
        if not stack:
            break
        _, top, waste, used = stack[-1]
        pattern = (top, *filling)
        need = {s: pattern.count(s) for s in pattern}
        times = min(int(left[s]) // m for s, m in need.items())
        for s in pattern:
            left[s] -= times
        path.append((pattern, times))
        waste, used = waste + times * (capacity - sum(pattern)), used + times
    return best


# --------------------------------------------------------------------- placing

def pack(items: DataFrame, length_col: str = "length", capacity: int = CAPACITY, nodes: int = NODES) -> DataFrame:
    """All columns of ``items`` and ``sequence_id``, ``offset`` (both bigint):
    gapless from 0 in each sequence.  Lengths must lie in 1..``capacity``; input
    columns with the names of the new ones are replaced."""
    items = items.drop("sequence_id", "offset")

    def ranked(batches):                          # rank among the partition's items of that length
        part, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for b in batches:
            n = b.column(b.schema.get_field_index(length_col)).to_numpy(zero_copy_only=False)
            if len(n) and (n.min() < 1 or n.max() > capacity):
                raise ValueError(f"item lengths must be in 1..{capacity}")
            o = np.argsort(n, kind="stable")
            first = A.run_starts(n[o])
            size = np.diff(np.r_[first, len(n)])
            rank = np.empty(len(n), np.int64)
            rank[o] = seen[n[o]] + np.arange(len(n)) - np.repeat(first, size)
            seen[n[o][first]] += size
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.full(len(n), part, np.int32)), pa.array(rank)],
                                             [*b.schema.names, "__part", "__rank"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in items.schema.fields)
    staged = materialise(items.mapInArrow(ranked, f"{schema}, __part int, __rank bigint"), "pack-items", batch_rows=2000)
    per = staged.groupBy("__part", F.col(length_col).alias("__len")).agg(F.count(F.lit(1)).alias("__n"))
    count = np.zeros(capacity + 1, np.int64)
    for r in per.groupBy("__len").agg(F.sum("__n").alias("n")).collect():      # at most `capacity` rows
        count[r["__len"]] = r["n"]
    plan = bin_completion(count, capacity, nodes)

    # slots of each length in order of rank: (first rank, copies per bin, first bin, offset in the bin)
    slots: dict[int, list[tuple[int, int, int, int]]] = {}
    taken, bins = np.zeros(capacity + 1, np.int64), 0
    for pattern, times in plan:
        at = 0
        for s in sorted(set(pattern), reverse=True):
            m = pattern.count(s)
            slots.setdefault(s, []).append((int(taken[s]), m, bins, at))
            taken[s] += m * times
            at += m * s
        bins += times
    tables = {s: np.array(v, np.int64) for s, v in slots.items()}              # bounded by capacity and nodes

    def place(batches):
        for b in batches:
            col = lambda c: b.column(b.schema.get_field_index(c)).to_numpy(zero_copy_only=False)
            n, rank = col(length_col), col("__rank") + col("__base")
            seq, off = np.zeros(len(n), np.int64), np.zeros(len(n), np.int64)
            for s in np.unique(n):
                i, t = np.flatnonzero(n == s), tables[int(s)]
                k = t[np.searchsorted(t[:, 0], rank[i], "right") - 1]
                seq[i] = k[:, 2] + (rank[i] - k[:, 0]) // k[:, 1]
                off[i] = k[:, 3] + (rank[i] - k[:, 0]) % k[:, 1] * s
            keep = [c for c in b.schema.names if not c.startswith("__")]
            yield pa.RecordBatch.from_arrays([*(b.column(b.schema.get_field_index(c)) for c in keep), pa.array(seq),
                                              pa.array(off)], [*keep, "sequence_id", "offset"])

    base = per.select("__part", "__len", (F.sum("__n").over(
        Window.partitionBy("__len").orderBy("__part")) - F.col("__n")).alias("__base"))
    joined = staged.withColumn("__len", F.col(length_col)).join(base, ["__part", "__len"])
    return joined.mapInArrow(place, f"{schema}, sequence_id bigint, offset bigint")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return pack(document_pieces(docs, str(public_tokenizers.path("byte_bpe_50k.json"))))
