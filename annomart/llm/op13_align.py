"""Op 13 - cross-tokenizer alignment by an associative monoid of fragments.

Two tokenizers read the same bytes (a space, then the text).  Offsets where
tokens of both end cut the tokens into groups; every A token of a group is
linked to every B token of it.

``Fragment`` describes a byte range by the tokens that *end* in it: an open
head (up to the first common end), closed groups, and an open tail; a range
without a common end is open as a whole.  ``compose`` joins neighbours: tail
and head between them make a group.  It is associative, so a long document
(over ``part_bytes``) is cut at fixed byte offsets, its parts are encoded by
tasks of their own (each sees its range and the few bytes up to the nearest
safe gap on both sides, so its tokens are those of the whole text), and a tree
of grouped reductions, ``FAN`` neighbours at a time, gives the document's
fragment.  Shorter documents are one fragment.

Neither tokenizer joins across the gap between a visible character and a
space, so texts are sequences of segments, each aligned once per task and
remembered (bounded tables).

Corpus counts: documents are written in chunks, each with its sorted distinct
id pairs and the number of its documents that hold them.  Pair counts are
summed over chunks by Spark, the best count of each A id comes from a window,
and every chunk gets the figures of its own pairs back by a shuffled join.
Nothing passes through the driver and no side is broadcast by force.

Edge cases: null and empty texts, and texts whose joined tokens differ from
space + text (for example those with U+2581), have no tokens: zeros and an
empty hash.  One row per input row; null and repeated ids are kept as they
are, and repeated rows count as documents of their own; other columns are
ignored.  A run of more than ``SLACK`` bytes without a gap is not cut.
"""

from __future__ import annotations

import hashlib
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from annomart.llm import arrays as A
from annomart.llm.byte_bpe import byte_bpe
from annomart.llm.scratch import materialise

PART_BYTES = 1 << 16            # longer documents are cut into ranges of this size
SLACK = 1 << 12                 # bytes that a part may look beyond its range
CHUNK_BYTES = 2 << 20           # text of a chunk of documents
FAN = 16                        # fragments composed by one task of the tree
KNOWN_SEGMENTS = 200_000        # remembered per task
KNOWN_BYTES = 16 << 20
LEARNT = 4096                   # segments encoded at once
NONE = np.zeros(0, np.int64)

# ------------------------------------------------------------------ the monoid


class Fragment(NamedTuple):
    """Tokens that end in a byte range: ``head`` and ``tail`` are (A ids, B ids)."""
    cut: bool = False                                   # whether tokens of both end at some offset of the range
    head: tuple[np.ndarray, np.ndarray] = (NONE, NONE)  # all tokens of a range without such an offset
    tail: tuple[np.ndarray, np.ndarray] = (NONE, NONE)
    ok: bool = True                                     # the tokens' bytes are those of the text
    n_a: int = 0
    n_b: int = 0
    n_groups: int = 0                                   # of closed groups only, as all below
    n_links: int = 0
    text: bytes = b""                                   # `a1,a2|b1;` per group
    keys: np.ndarray = NONE                             # distinct linked pairs, A << 32 | B
    times: np.ndarray = NONE                            # their links


def both(x, y):
    return np.concatenate([x[0], y[0]]), np.concatenate([x[1], y[1]])


def pair_counts(keys: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return NONE, NONE
    o = np.argsort(keys, kind="stable")
    keys, times = keys[o], times[o]
    at = A.run_starts(keys)
    return keys[at], np.add.reduceat(times, at)


def group(a: np.ndarray, b: np.ndarray) -> Fragment:
    """One closed group, as a fragment that starts and ends with a cut."""
    ia, ta = np.unique(a, return_counts=True)
    ib, tb = np.unique(b, return_counts=True)
    text = f"{','.join(map(str, a.tolist()))}|{','.join(map(str, b.tolist()))};".encode()
    return Fragment(True, n_groups=1, n_links=len(a) * len(b), text=text, keys=(ia[:, None] << 32 | ib).ravel(),
                    times=(ta[:, None] * tb).ravel())


def closed(parts: list[Fragment], head, tail, ok: bool, n_a: int, n_b: int) -> Fragment:
    keys, times = pair_counts(np.concatenate([p.keys for p in parts]), np.concatenate([p.times for p in parts]))
    return Fragment(True, head, tail, ok, n_a, n_b, sum(p.n_groups for p in parts), sum(p.n_links for p in parts),
                    b"".join(p.text for p in parts), keys, times)


def compose(x: Fragment, y: Fragment) -> Fragment:
    """The fragment of two neighbouring ranges."""
    ok, n_a, n_b = x.ok and y.ok, x.n_a + y.n_a, x.n_b + y.n_b
    if not x.cut and not y.cut:
        return Fragment(False, both(x.head, y.head), ok=ok, n_a=n_a, n_b=n_b)
    if not x.cut:
        return Fragment(True, both(x.head, y.head), y.tail, ok, n_a, n_b, y.n_groups, y.n_links, y.text, y.keys, y.times)
    if not y.cut:
        return Fragment(True, x.head, both(x.tail, y.head), ok, n_a, n_b, x.n_groups, x.n_links, x.text, x.keys, x.times)
    a, b = both(x.tail, y.head)
    parts = [x, group(a, b), y] if len(a) or len(b) else [x, y]
    return closed(parts, x.head, y.tail, ok, n_a, n_b)


def compose_all(parts: list[Fragment]) -> Fragment:
    """Neighbours in pairs, level by level."""
    while len(parts) > 1:
        parts = [compose(*parts[i:i + 2]) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
    return parts[0] if parts else Fragment()


def whole(f: Fragment) -> Fragment:
    """A document's fragment: its start is a cut, so its head is a group."""
    return compose(Fragment(True), f)


def fragment(a: np.ndarray, a_end: np.ndarray, b: np.ndarray, b_end: np.ndarray) -> Fragment:
    """The fragment of a range from its tokens and their end offsets."""
    common = np.intersect1d(a_end, b_end, assume_unique=True)
    if not len(common):
        return Fragment(False, (a, b), n_a=len(a), n_b=len(b))
    ga, gb = np.searchsorted(common, a_end), np.searchsorted(common, b_end)
    groups = [group(a[ga == i], b[gb == i]) for i in range(1, len(common))]
    pick = lambda i: (a[ga == i], b[gb == i])
    if not groups:
        return Fragment(True, pick(0), pick(len(common)), n_a=len(a), n_b=len(b))
    return closed(groups, pick(0), pick(len(common)), True, len(a), len(b))


# ------------------------------------------------------------------- encoding


def joined(col) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of space + text; nothing for null and empty texts."""
    buf, offs = A.text_buffer(col)
    size = np.diff(offs)
    full = size > 0
    new = np.r_[0, np.cumsum(size + full)]
    out = np.full(new[-1], 32, np.uint8)
    body = np.ones(len(out), bool)
    body[new[:-1][full]] = False
    out[body] = buf
    return out, new


def gaps(buf: np.ndarray) -> np.ndarray:
    """Offsets of spaces after a visible character: no token of either side goes across."""
    p = np.flatnonzero(buf[1:] == 32) + 1
    c1, c2, c3 = (buf[np.maximum(p - k, 0)] for k in (1, 2, 3))
    # white space and invisible characters outside ASCII end like this; others with such bytes just stay joined
    odd = ((c2 == 0xC2) & np.isin(c1, (0x85, 0xA0, 0xAD))) | ((c3 == 0xE1) & np.isin(c2, (0x9A, 0xA0)))
    odd |= ((c3 == 0xE2) & np.isin(c2, (0x80, 0x81))) | ((c3 == 0xE3) & (c2 == 0x80)) | ((c3 == 0xEF) & (c2 == 0xBB))
    return p[((c1 > 32) & (c1 < 127)) | ((c1 >= 128) & ~odd)]


class Segments:
    """Aligned segments, remembered by hash; the columns are by segment number."""

    def __init__(self, path_a: str, path_b: str):
        from sentencepiece import SentencePieceProcessor

        self.a, self.b = byte_bpe(path_a), SentencePieceProcessor(model_file=path_b)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any("▁" in p.lstrip("▁") for p in pieces):
            raise ValueError("a piece goes across a gap")
        self.space = self.b.piece_to_id("▁")
        self.bytes_a = self.a.token_bytes
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.len_a, self.len_b = (np.array([len(t) for t in x]) for x in (self.bytes_a, self.bytes_b))
        # texts of a token inside its group and at the end of its side, A first
        self.word = [f"{i}{c}".encode() for n, ends in ((len(self.bytes_a), ",|"), (len(self.bytes_b), ",;")) for i in range(n) for c in ends]
        self.word_size = np.array([len(w) for w in self.word])
        self.clear()

    def clear(self) -> None:
        self.hash, self.number, self.size = np.zeros(0, A.U), NONE, 0
        self.stats = np.zeros((0, 5), np.int64)                 # ok, A tokens, B tokens, groups, links
        self.at, self.n = NONE, NONE                            # its pairs
        self.keys, self.times = NONE, NONE
        self.text: list[bytes] = []

    def encode(self, segment: bytes) -> tuple[np.ndarray, np.ndarray]:
        s = segment.decode("utf-8", "replace")
        b = self.b.encode(s[1:]) if len(s) > 1 else [self.space]
        return np.array(self.a.encode(s), np.int64), np.array(b, np.int64)

    def __call__(self, buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Numbers of the segments at these spans."""
        if len(self.text) > KNOWN_SEGMENTS or self.size > KNOWN_BYTES:
            self.clear()
        h, first, back = np.unique(A.span_hashes(buf, start, end), return_index=True, return_inverse=True)
        if len(self.hash):
            at = np.minimum(np.searchsorted(self.hash, h), len(self.hash) - 1)
            new = np.flatnonzero(self.hash[at] != h)
        else:
            new = np.arange(len(h))
        if len(new):
            found = [self.learn([buf[start[i]:end[i]].tobytes() for i in first[new[k:k + LEARNT]]]) for k in range(0, len(new), LEARNT)]
            stats, n, keys, times = (np.concatenate(c) for c in zip(*found))
            self.at = np.r_[self.at, len(self.keys) + np.cumsum(n) - n]
            self.stats, self.n = np.concatenate([self.stats, stats]), np.r_[self.n, n]
            self.keys, self.times = np.r_[self.keys, keys], np.r_[self.times, times]
            both = np.r_[self.hash, h[new]]
            number = np.r_[self.number, len(self.text) - len(new) + np.arange(len(new))]
            o = np.argsort(both, kind="stable")
            self.hash, self.number = both[o], number[o]
        return self.number[np.searchsorted(self.hash, h)][back]

    def tokens(self, segs: list[bytes]):
        """(ok, A tokens, B tokens) of segments; tokens as (segment, id, end offset in it)."""
        size = np.array([len(x) for x in segs])
        strs = [x.decode("utf-8", "replace") for x in segs]
        if all(x[-1].isprintable() and x[-1] != " " for x in strs):      # as in texts: none joins with the next
            whole, end, side = "".join(strs), np.cumsum(size), []
            ids_b = [i for x in self.b.encode([x[1:] or x for x in strs], num_threads=1) for i in x]
            for flat, table, lens in ((self.a.encode(whole), self.bytes_a, self.len_a), (ids_b, self.bytes_b, self.len_b)):
                if b"".join([table[i] for i in flat]) != whole.encode():
                    break
                ids = np.array(flat, np.int64)
                run = np.cumsum(lens[ids])
                seg = np.searchsorted(end, run)
                side.append((seg, ids, run - (end - size)[seg]))
            if len(side) == 2 and all(np.isin(end, e + (end - size)[g], assume_unique=True).all() for g, _, e in side):
                return np.ones(len(segs), bool), *side
        ids_a, ids_b = list(map(self.a.encode, strs)), self.b.encode([x[1:] for x in strs], num_threads=1)
        ids_b = [x if len(t) > 1 else [self.space] for x, t in zip(ids_b, strs)]
        ok = np.array([b"".join([self.bytes_a[i] for i in x]) == t == b"".join([self.bytes_b[i] for i in y])
                       for x, y, t in zip(ids_a, ids_b, segs)])
        side = []
        for ids, lens in ((ids_a, self.len_a), (ids_b, self.len_b)):
            n = np.array([len(x) if k else 0 for x, k in zip(ids, ok)])
            flat = np.fromiter((i for x, k in zip(ids, ok) if k for i in x), np.int64, int(n.sum()))
            run, seg = np.cumsum(lens[flat]), np.repeat(np.arange(len(segs)), n)
            side.append((seg, flat, run - np.r_[0, run][np.cumsum(n) - n][seg]))
        return ok, *side

    def learn(self, segs: list[bytes]):
        """(stats, pairs of each, keys, times) of new segments; their group texts go to ``text``."""
        m = len(segs)
        ok, (sa, fa, ea), (sb, fb, eb) = self.tokens(segs)
        ea, eb = sa << 32 | ea, sb << 32 | eb
        cut = np.intersect1d(ea, eb, assume_unique=True)
        ga, gb, of = np.searchsorted(cut, ea), np.searchsorted(cut, eb), cut >> 32
        na, nb = np.bincount(ga, minlength=len(cut)), np.bincount(gb, minlength=len(cut))
        stats = np.stack([ok, np.bincount(sa, minlength=m), np.bincount(sb, minlength=m), np.bincount(of, minlength=m),
                          A.sum_by(na * nb, of, m)], 1).astype(np.int64)
        # pairs: distinct ids of both sides by group
        ua, ub = np.sort(ga << 32 | fa), np.sort(gb << 32 | fb)
        ia, ib = A.run_starts(ua), A.run_starts(ub)
        ta, tb = np.diff(np.r_[ia, len(ua)]), np.diff(np.r_[ib, len(ub)])
        ua, ub = ua[ia], ub[ib]
        width, g = np.bincount(ub >> 32, minlength=len(cut)), ua >> 32
        n = width[g]
        j = A.ragged((np.cumsum(width) - width)[g], n)
        key = np.repeat(ua & 0xFFFFFFFF, n) << 32 | (ub[j] & 0xFFFFFFFF)
        # group texts: the A tokens, then the B tokens of each group
        code = np.empty(len(fa) + len(fb), np.int64)
        code[np.arange(len(fa)) + (np.cumsum(nb) - nb)[ga]] = fa * 2 + np.r_[ga[1:] != ga[:-1], True][:len(ga)]
        code[np.arange(len(fb)) + np.cumsum(na)[gb]] = (fb + len(self.bytes_a)) * 2 + np.r_[gb[1:] != gb[:-1], True][:len(gb)]
        text = b"".join([self.word[c] for c in code.tolist()])
        at = np.r_[0, np.cumsum(self.word_size[code])][np.r_[0, np.cumsum(stats[:, 1] + stats[:, 2])]].tolist()
        self.text += [text[i:k] for i, k in zip(at, at[1:])]
        self.size += sum(map(len, segs))
        return stats, np.bincount(of[g], n, minlength=m).astype(np.int64), key, np.repeat(ta, n) * tb[j]


@cache
def segments(path_a: str, path_b: str) -> Segments:
    return Segments(path_a, path_b)


def spans(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of the segments of every row."""
    mark = np.zeros(len(buf), bool)
    mark[gaps(buf)] = True
    mark[offs[:-1][np.diff(offs) > 0]] = True
    start = np.flatnonzero(mark)
    return start, np.r_[start[1:], len(buf)][:len(start)], np.searchsorted(offs, start, "right") - 1


# --------------------------------------------------------------------- chunks

DOC = ("n_a", "n_b", "n_groups", "n_links")


def squeeze(x: np.ndarray) -> bytes:
    """Integers below 2**31 as compressed byte planes."""
    return pa.compress(np.ascontiguousarray(x.astype("<i4").view(np.uint8).reshape(-1, 4).T).tobytes(), "zstd", asbytes=True)


def unsqueeze(x: bytes, n: int) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(pa.decompress(x, n * 4, "zstd", asbytes=True), np.uint8).reshape(4, n).T).view("<i4")[:, 0].astype(np.int64)


class Packer:
    """Chunk rows: documents with their pairs as places in the chunk's sorted pair list."""

    def __init__(self, tag: int):
        self.n, self.tag = 0, tag

    def row(self, ids: pa.Array, stats: np.ndarray, sha: list[str], doc: np.ndarray, keys: np.ndarray, at: np.ndarray, times: np.ndarray) -> pa.RecordBatch:
        """``doc`` (sorted), ``at`` (places in the sorted ``keys``) and ``times``: the distinct pairs of each document."""
        chunk = self.tag << 62 | TaskContext.get().partitionId() << 31 | self.n
        self.n += 1
        one = lambda x, t: pa.array([x], pa.list_(t))
        cols = [pa.array([chunk], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                *[one(stats[:, i], pa.int64()) for i in range(len(DOC))], one(sha, pa.string()),
                one(keys, pa.int64()), one(np.bincount(at, minlength=len(keys)), pa.int64()),
                one(np.bincount(doc, minlength=len(ids)), pa.int64()),
                pa.array([squeeze(np.diff(at, prepend=0))]), pa.array([squeeze(times)])]
        return pa.RecordBatch.from_arrays(cols, ["chunk", "ids", *DOC, "sha", "keys", "docs", "n_pairs", "place", "times"])


def chunk_schema(kind: str) -> str:
    return (f"chunk bigint, ids array<{kind}>, " + ", ".join(f"{c} array<bigint>" for c in DOC)
            + ", sha array<string>, keys array<bigint>, docs array<bigint>, n_pairs array<bigint>, place binary, times binary")


def encode_chunk(seg: Segments, buf: np.ndarray, offs: np.ndarray):
    """(stats, hashes, doc, keys, place, times) of whole documents, for ``Packer.row``."""
    n = len(offs) - 1
    s, e, row = spans(buf, offs)
    no = seg(buf, s, e) if len(s) else NONE
    bad = np.flatnonzero(A.sum_by(1 - seg.stats[no, 0], row, n) > 0)
    stats = np.stack([A.sum_by(seg.stats[no, i], row, n) for i in range(1, 5)], 1)
    stats[bad] = 0
    cut, text, sha = np.searchsorted(row, np.arange(n + 1)), seg.text, []
    for i in range(n):
        own = b"".join([text[k] for k in no[cut[i]:cut[i + 1]].tolist()])
        sha.append(hashlib.sha256(own[:-1]).hexdigest() if stats[i, 0] else "")
    keep = ~np.isin(row, bad)
    row = row[keep]
    known, back = np.unique(no[keep], return_inverse=True)
    size = seg.n[known]
    pick = A.ragged(seg.at[known], size)
    keys, place = np.unique(seg.keys[pick], return_inverse=True)
    where = A.ragged((np.cumsum(size) - size)[back], size[back])
    doc, times = np.repeat(row, size[back]) << 32 | place[where], seg.times[pick][where]
    doc, times = pair_counts(doc, times)
    return stats, sha, doc >> 32, keys, doc & 0xFFFFFFFF, times


def short_chunks(docs: DataFrame, path_a: str, path_b: str, chunk_bytes: int) -> DataFrame:
    """Chunks of whole documents (``id``, ``text``)."""
    def run(batches):
        seg, pack, held, size = segments(path_a, path_b), Packer(0), [], 0

        def flush():
            t = pa.Table.from_batches(held).combine_chunks()
            held.clear()
            buf, offs = joined(t.column(1))
            return pack.row(t.column(0).combine_chunks() if t.column(0).num_chunks != 1 else t.column(0).chunk(0),
                            *encode_chunk(seg, buf, offs))

        for b in batches:
            if b.num_rows:
                held.append(b)
                size += b.nbytes
            if size >= chunk_bytes:
                yield flush()
                size = 0
        if held:
            yield flush()
        seg.clear()                                             # workers outlive their tasks

    return docs.mapInArrow(A.trimmed(run), chunk_schema(docs.schema["id"].dataType.simpleString()))


# -------------------------------------------------------------- long documents

FRAGMENT = ("cut boolean, ok boolean, head_a array<bigint>, head_b array<bigint>, tail_a array<bigint>, tail_b array<bigint>, n_a bigint, "
            "n_b bigint, n_groups bigint, n_links bigint, body binary, keys array<bigint>, times array<bigint>")


def to_rows(rows: list[tuple], fragments: list[Fragment], schema: pa.Schema) -> pa.RecordBatch:
    """(key, id, part) rows and their fragments as a batch."""
    cells = [[*r, f.cut, f.ok, f.head[0], f.head[1], f.tail[0], f.tail[1], f.n_a, f.n_b, f.n_groups, f.n_links, f.text, f.keys, f.times]
             for r, f in zip(rows, fragments)]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*cells), schema.types)], schema=schema)


def from_rows(t) -> list[Fragment]:
    get = {c: t.column(c).to_pylist() for c in ("cut", "ok", "n_a", "n_b", "n_groups", "n_links", "body")}
    lists = {c: [np.asarray(v.values, np.int64) for v in t.column(c)] for c in ("head_a", "head_b", "tail_a", "tail_b", "keys", "times")}
    return [Fragment(get["cut"][i], (lists["head_a"][i], lists["head_b"][i]), (lists["tail_a"][i], lists["tail_b"][i]), get["ok"][i],
                     get["n_a"][i], get["n_b"][i], get["n_groups"][i], get["n_links"][i], get["body"][i], lists["keys"][i], lists["times"][i])
            for i in range(t.num_rows)]


def cut_points(buf: np.ndarray, part_bytes: int, slack: int) -> list[tuple[int, int, int]]:
    """(gap before, offset, gap after) of each place where a document is cut."""
    safe, out = gaps(buf), []
    for t in range(part_bytes, len(buf), part_bytes):
        i = int(np.searchsorted(safe, t, "right"))
        if 0 < i < len(safe) and t - safe[i - 1] <= slack and safe[i] - t <= slack:
            out.append((int(safe[i - 1]), t, int(safe[i])))
    return out


def document_parts(docs: DataFrame, part_bytes: int, slack: int) -> DataFrame:
    """(key, id, part, lo, hi, text): byte ranges of long documents; tokens that
    end in (lo, hi] of ``text`` are the part's own."""
    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                buf, _ = joined(b.column(2).slice(i, 1))
                cuts = [(0, 0, 0), *cut_points(buf, part_bytes, slack), (len(buf), len(buf), len(buf))]
                for k, (x, y) in enumerate(zip(cuts, cuts[1:])):
                    yield pa.RecordBatch.from_arrays(
                        [b.column(0).slice(i, 1), b.column(1).slice(i, 1), pa.array([k], pa.int64()), pa.array([x[1] - x[0]], pa.int64()),
                         pa.array([y[1] - x[0]], pa.int64()), pa.array([buf[x[0]:y[2]].tobytes()])], ["key", "id", "part", "lo", "hi", "text"])

    kind = docs.schema["id"].dataType.simpleString()
    rows = docs.select(F.monotonically_increasing_id().alias("key"), "id", "text")
    return rows.mapInArrow(run, f"key bigint, id {kind}, part bigint, lo bigint, hi bigint, text binary")


def part_fragment(seg: Segments, text: bytes, lo: int, hi: int) -> Fragment:
    """The fragment of the tokens that end in (lo, hi] of ``text``, which starts and ends at gaps."""
    buf = np.frombuffer(text, np.uint8)
    s, e, _ = spans(buf, np.array([0, len(buf)]))

    def edge(i):                                             # a segment that the range holds in part
        own = buf[s[i]:e[i]].tobytes()
        a, b = seg.encode(own)
        if b"".join(map(seg.bytes_a.__getitem__, a)) != own or b"".join(map(seg.bytes_b.__getitem__, b)) != own:
            return Fragment(ok=False)
        ea, eb = s[i] + np.cumsum(seg.len_a[a]), s[i] + np.cumsum(seg.len_b[b])
        ka, kb = (ea > lo) & (ea <= hi), (eb > lo) & (eb <= hi)
        return fragment(a[ka], ea[ka], b[kb], eb[kb])

    inner = np.flatnonzero((s >= lo) & (e <= hi))
    left, right = np.flatnonzero((s < lo) & (e > lo)), np.flatnonzero((s >= lo) & (s < hi) & (e > hi))
    parts = [edge(i) for i in left]
    if len(inner):
        no = seg(buf, s[inner], e[inner])
        n = seg.n[no]
        keys, times = pair_counts(seg.keys[A.ragged(seg.at[no], n)], seg.times[A.ragged(seg.at[no], n)])
        _, n_a, n_b, n_groups, n_links = map(int, seg.stats[no].sum(0))
        parts.append(Fragment(True, ok=bool(seg.stats[no, 0].all()), n_a=n_a, n_b=n_b, n_groups=n_groups, n_links=n_links,
                              text=b"".join([seg.text[k] for k in no.tolist()]), keys=keys, times=times))
    return compose_all(parts + [edge(i) for i in right])


def arrow_schema(kind: pa.DataType) -> pa.Schema:
    many = pa.list_(pa.int64())
    kinds = [("key", pa.int64()), ("id", kind), ("part", pa.int64()), ("cut", pa.bool_()), ("ok", pa.bool_()), ("head_a", many),
             ("head_b", many), ("tail_a", many), ("tail_b", many), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
             ("n_links", pa.int64()), ("body", pa.binary()), ("keys", many), ("times", many)]
    return pa.schema(kinds)


def long_chunks(docs: DataFrame, path_a: str, path_b: str, part_bytes: int, slack: int, chunk_bytes: int) -> DataFrame:
    """Chunks of long documents: parts encoded apart, fragments composed in a tree."""
    parts = materialise(document_parts(docs, part_bytes, slack).repartition("key", "part"), "op13-parts", batch_rows=16)
    kind = docs.schema["id"].dataType.simpleString()
    schema = f"key bigint, id {kind}, part bigint, {FRAGMENT}"

    def encode(batches):
        seg = segments(path_a, path_b)
        for b in batches:
            c = {n: b.column(n).to_pylist() for n in ("key", "id", "part", "lo", "hi", "text")}
            if b.num_rows:
                yield to_rows(list(zip(c["key"], c["id"], c["part"])),
                              [part_fragment(seg, *x) for x in zip(c["text"], c["lo"], c["hi"])], arrow_schema(b.schema.field("id").type))
        seg.clear()

    def reduce(t: pa.Table) -> pa.Table:
        t = t.sort_by("part")
        f = compose_all(from_rows(t))
        row = (t.column("key")[0].as_py(), t.column("id")[0].as_py(), t.column("part")[0].as_py() // FAN)
        return pa.Table.from_batches([to_rows([row], [f], arrow_schema(t.schema.field("id").type))])

    tree, last = parts.mapInArrow(A.trimmed(encode), schema), parts.agg(F.max("part")).first()[0] or 0
    while last > 0:
        tree = tree.groupBy("key", F.floor(F.col("part") / FAN).alias("up")).applyInArrow(reduce, schema)
        last //= FAN

    def finish(batches):
        pack, held, size = Packer(1), [], 0

        def flush():
            fs = [whole(f) for _, f in held]
            stats = np.array([[f.n_a, f.n_b, f.n_groups, f.n_links] if f.ok else [0] * 4 for f in fs], np.int64).reshape(-1, 4)
            sha = [hashlib.sha256(f.text[:-1]).hexdigest() if f.ok and f.n_a else "" for f in fs]
            n = [len(f.keys) if f.ok else 0 for f in fs]
            cat = lambda x: np.concatenate([v for v, k in zip(x, n) if k] or [NONE])
            keys, at = np.unique(cat([f.keys for f in fs]), return_inverse=True)
            out = pack.row(pa.concat_arrays([i for i, _ in held]), stats, sha, np.repeat(np.arange(len(fs)), n), keys, at,
                           cat([f.times for f in fs]))
            held.clear()
            return out

        for b in batches:
            for i, f in enumerate(from_rows(b)):
                held.append((b.column(1).slice(i, 1), f))
                size += len(f.text) + 16 * len(f.keys)
                if size >= chunk_bytes:
                    yield flush()
                    size = 0
        if held:
            yield flush()

    return tree.mapInArrow(A.trimmed(finish), chunk_schema(kind))


# ------------------------------------------------------------------- operator


def align(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text", part_bytes: int = PART_BYTES,
          slack: int = SLACK, chunk_bytes: int = CHUNK_BYTES) -> tuple[DataFrame, DataFrame]:
    """(documents, pairs).  Documents: id, ``n_a``, ``n_b``, ``n_groups``,
    ``n_links``, ``n_best``, ``count_sum``, ``groups_sha256``, one row per input
    row.  Pairs: ``a``, ``b``, ``count`` (documents that link them), ``best``
    (the count is the highest of its ``a``).  ``path_a`` is a byte-level BPE
    file, ``path_b`` a sentencepiece model; every executor can open both."""
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    is_long = F.coalesce(F.octet_length("text"), F.lit(0)) >= part_bytes
    chunks = materialise(short_chunks(src.filter(~is_long), path_a, path_b, chunk_bytes)
                         .unionAll(long_chunks(src.filter(is_long), path_a, path_b, part_bytes, slack, chunk_bytes)), "op13-chunks", batch_rows=256)
    own = chunks.select("chunk", F.explode(F.arrays_zip("keys", "docs")).alias("p")).select("chunk", "p.keys", "p.docs")
    total = own.groupBy(F.col("keys").alias("key")).agg(F.sum("docs").alias("count"))
    a = F.shiftright("key", 32)
    total = total.withColumn("a", a).withColumn("best", F.col("count") == F.max("count").over(Window.partitionBy("a")))
    total = materialise(total, "op13-pairs")
    figures = own.select(F.col("chunk").alias("of"), F.col("keys").alias("key")).join(total.select("key", "count", "best"), "key")

    def finish(key, left: pa.Table, right: pa.Table) -> pa.Table:
        right = right.sort_by("key")
        count, best = (right.column(c).to_numpy().astype(np.int64) for c in ("count", "best"))
        out = []
        for i in range(left.num_rows):
            get = {c: left.column(c)[i].values for c in ("ids", *DOC, "sha")}
            n = np.asarray(left.column("n_pairs")[i].values, np.int64)
            total = int(n.sum())
            place = np.cumsum(unsqueeze(left.column("place")[i].as_py(), total))
            times, doc = unsqueeze(left.column("times")[i].as_py(), total), np.repeat(np.arange(len(n)), n)
            more = [pa.array(A.sum_by(times * x[place], doc, len(n)), pa.int64()) for x in (best, count)]
            out.append(pa.Table.from_arrays([get["ids"], *[get[c] for c in DOC], *more, get["sha"]],
                                            ["id", *DOC, "n_best", "count_sum", "groups_sha256"]))
        return pa.concat_tables(out)

    kind = src.schema["id"].dataType.simpleString()
    schema = f"id {kind}, " + ", ".join(f"{c} bigint" for c in (*DOC, "n_best", "count_sum")) + ", groups_sha256 string"
    body = chunks.select("chunk", "ids", *DOC, "sha", "n_pairs", "place", "times")
    out = body.groupBy("chunk").cogroup(figures.groupBy("of")).applyInArrow(finish, schema)
    pairs = total.select("a", F.col("key").bitwiseAND(F.lit(0xFFFFFFFF)).alias("b"), "count", "best")
    return out.withColumnRenamed("id", id_col), pairs


def op13_align_tokenizers(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return align(docs, str(public_tokenizers.path("byte_bpe_50k.json")), str(public_tokenizers.path("piece_bpe_32k.model")))[0]
