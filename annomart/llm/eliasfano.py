"""Elias-Fano sequences and an n-gram trie on one buffer, queried in batches.

Everything is a view on one array of 64-bit words, so a trie opens from bytes
or from a memory-mapped file without copying or decoding."""

from __future__ import annotations

import numpy as np

U = np.uint64
ONE = U(1)
BLOCK = 1 << 15                 # sorted queries answered at once
DENSE = 16                      # values read for each query at most, else they are sought one by one


def select_in_word(w: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Position of the ``r``-th (from 0) set bit of each word."""
    pos, r = np.zeros(len(w), np.int64), r.copy()
    for half in (32, 16, 8, 4, 2, 1):
        low = w & U((1 << half) - 1)
        c = np.bitwise_count(low).astype(np.int64)
        up = r >= c
        r -= np.where(up, c, 0)
        w = np.where(up, w >> U(half), low)
        pos += np.where(up, half, 0)
    return pos


def pack(values: np.ndarray, bits: int) -> np.ndarray:
    """``bits``-bit numbers side by side (one spare word at the end)."""
    out = np.zeros(len(values) * bits // 64 + 2, U)
    if bits:
        at = np.arange(len(values)) * bits
        word, off = at >> 6, (at & 63).astype(U)
        np.bitwise_or.at(out, word, values << off)
        over = off.astype(np.int64) + bits > 64
        np.bitwise_or.at(out, word[over] + 1, values[over] >> (U(64) - off[over]))
    return out


def unpack(packed: np.ndarray, bits: int, i: np.ndarray) -> np.ndarray:
    if not bits:
        return np.zeros(len(i), U)
    at = i * bits
    word, off = at >> 6, (at & 63).astype(U)
    high = np.where(off > 0, packed[word + 1] << ((U(64) - off) & U(63)), U(0))
    return (packed[word] >> off | high) & U((1 << bits) - 1)


class EliasFano:
    """A monotone sequence: low bits packed, high parts in unary with a rank directory."""

    def __init__(self, words: np.ndarray):
        self.n, self.bits, n_low, n_high = (int(x) for x in words[:4])
        self.low = words[4:4 + n_low]
        self.high = words[4 + n_low:4 + n_low + n_high]
        self.zeros = words[4 + n_low + n_high:4 + n_low + 2 * n_high].view(np.int64)    # zeros before each word
        self.size = 4 + n_low + 2 * n_high

    @staticmethod
    def build(values: np.ndarray) -> np.ndarray:
        n, top = len(values), int(values[-1]) + 1 if len(values) else 1
        bits = max(0, (top // max(n, 1)).bit_length() - 1)
        v = values.astype(U)
        low = pack(v & U((1 << bits) - 1), bits)
        at = (v >> U(bits)).astype(np.int64) + np.arange(n)
        high = np.zeros(((n + (top >> bits) + 2) >> 6) + 1, U)
        np.bitwise_or.at(high, at >> 6, ONE << (at & 63).astype(U))
        zeros = np.cumsum(64 - np.bitwise_count(high).astype(np.int64))
        zeros = np.r_[0, zeros[:-1]]
        return np.concatenate([np.array([n, bits, len(low), len(high)], U), low, high, zeros.view(U)])

    def span(self, a: int, b: int) -> np.ndarray:
        """Values at positions ``a`` to ``b``, read in one pass."""
        if a >= b:
            return np.zeros(0, U)
        ones = np.arange(len(self.zeros)) * 64 - self.zeros
        w, end = np.searchsorted(ones, [a, b - 1], "right") - 1
        bits = np.unpackbits(self.high[w:end + 1].view(np.uint8), bitorder="little")
        skip = a - int(ones[w])
        p = w * 64 + np.flatnonzero(bits)[skip:skip + b - a]
        i = np.arange(a, b)
        return (p - i).astype(U) << U(self.bits) | unpack(self.low, self.bits, i)

    def get(self, i: np.ndarray) -> np.ndarray:
        """Values at positions ``i``."""
        if len(i):
            a, b = int(i.min()), int(i.max()) + 1
            if b - a <= DENSE * len(i):
                return self.span(a, b)[i - a]
        ones = np.arange(len(self.zeros)) * 64 - self.zeros
        w = np.searchsorted(ones, i, "right") - 1
        p = w * 64 + select_in_word(self.high[w], i - ones[w])
        return (p - i).astype(U) << U(self.bits) | unpack(self.low, self.bits, i)

    def successor(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index of the first value >= x, whether it equals x).  Sorted queries go in
        blocks: the buckets of high parts that a block touches are read in one pass."""
        if not self.n or len(x) < 2 or not (x[1:] >= x[:-1]).all():
            return self._probe(x)
        idx, found = np.empty(len(x), np.int64), np.empty(len(x), bool)
        for a in range(0, len(x), BLOCK):
            q = x[a:a + BLOCK]
            (first, last), _ = self._probe(q[[0, -1]])
            last = min(int(last) + 1, self.n)
            if last - first <= DENSE * len(q):
                v = self.span(int(first), last)
                k = np.searchsorted(v, q)
                idx[a:a + BLOCK] = first + k
                found[a:a + BLOCK] = v[np.minimum(k, len(v) - 1)] == q if len(v) else False
            else:
                idx[a:a + BLOCK], found[a:a + BLOCK] = self._probe(q)
        return idx, found

    def _probe(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        h, low = (x >> U(self.bits)).astype(np.int64), x & U((1 << self.bits) - 1)
        total = len(self.high) * 64 - self.n
        beyond = h > total
        h = np.minimum(h, total)
        idx = np.where(h == 0, 0, self._zero(h - 1) + 1 - h)
        last = np.where(h == total, self.n, self._zero(np.minimum(h, total - 1)) - h)
        end = last.copy()
        open_ = np.flatnonzero(~beyond & (idx < end))
        while len(open_):                                      # halve the bucket of equal high parts
            i = (idx[open_] + end[open_]) >> 1
            on = unpack(self.low, self.bits, i) < low[open_]
            idx[open_[on]] = i[on] + 1
            end[open_[~on]] = i[~on]
            open_ = open_[idx[open_] < end[open_]]
        found = ~beyond & (idx < last)
        q = np.flatnonzero(found)
        found[q] = unpack(self.low, self.bits, idx[q]) == low[q]
        idx[beyond] = self.n
        return idx, found

    def _zero(self, r: np.ndarray) -> np.ndarray:
        """Position of the ``r``-th (from 0) zero of the high parts."""
        w = np.maximum(np.searchsorted(self.zeros, r, "right") - 1, 0)
        return w * 64 + select_in_word(~self.high[w], np.maximum(r - self.zeros[w], 0))


class Trie:
    """One level: contexts, and under each its successors with a code.  Levels
    may follow one another on the buffer (``below``); the contexts of the next
    are the places of this one's successors.

    A successor is stored relative to its context: the largest successors of
    all earlier contexts are added, which makes the level monotone; pointers
    and these bases are monotone as well.  Every sequence is Elias-Fano."""

    def __init__(self, words: np.ndarray):
        self.words, at = words, 1
        self.n = int(words[0])
        self.parts = []
        for _ in range(4):
            self.parts.append(EliasFano(words[at:]))
            at += self.parts[-1].size
        self.contexts, self.pointers, self.bases, self.successors = self.parts
        size = at + -(-self.n // 4)
        self.codes = words[at:size].view(np.uint16)
        self.below = Trie(words[size:]) if size < len(words) else None

    @staticmethod
    def build(context: np.ndarray, successor: np.ndarray, code: np.ndarray) -> np.ndarray:
        """Words of a trie of distinct pairs, sorted by (context, successor)."""
        n = len(context)
        first = np.flatnonzero(np.r_[True, context[1:] != context[:-1]]) if n else np.zeros(0, np.int64)
        end = np.r_[first[1:], n][:len(first)]
        top = successor[end - 1].astype(np.int64) + 1 if n else first
        base = np.r_[0, np.cumsum(top)]
        rel = np.repeat(base[:-1], end - first) + successor.astype(np.int64)
        codes = np.zeros(-(-n // 4) * 4, np.uint16)
        codes[:n] = code
        return np.concatenate([np.array([n], U), EliasFano.build(context[first]), EliasFano.build(np.r_[first, n]),
                               EliasFano.build(base), EliasFano.build(rel), codes.view(U)])

    @classmethod
    def open(cls, path: str) -> Trie:
        """A trie file, memory-mapped."""
        return cls(np.memmap(path, U, "r"))

    def find(self, context: np.ndarray, successor: np.ndarray) -> np.ndarray:
        """Places of the pairs among all successors (-1 where there is none)."""
        out = np.full(len(context), -1, np.int64)
        if not self.n or not len(context):
            return out
        first = np.flatnonzero(np.r_[True, context[1:] != context[:-1]])    # neighbours with one context share its search
        j, known = self.contexts.successor(context[first].astype(U))
        size = np.diff(np.r_[first, len(context)])
        j = j[known]
        q = np.flatnonzero(np.repeat(known, size))
        of = np.repeat(np.arange(len(j)), size[known])
        base, limit, start = self.bases.get(j), self.bases.get(j + 1), self.pointers.get(j).astype(np.int64)
        x = base[of] + successor[q].astype(U)
        inside = x < limit[of]                                 # beyond the context's largest successor otherwise
        q, x, of = q[inside], x[inside], of[inside]
        i, hit = self.successors.successor(x)
        hit &= i >= start[of]
        out[q[hit]] = i[hit]
        return out

    def code_at(self, place: np.ndarray) -> np.ndarray:
        """Codes at places (0 at -1)."""
        out = np.zeros(len(place), np.uint16)
        out[place >= 0] = self.codes[place[place >= 0]]
        return out

    def look_up(self, context: np.ndarray, successor: np.ndarray) -> np.ndarray:
        """Codes of the pairs (0 where there is none)."""
        return self.code_at(self.find(context, successor))
