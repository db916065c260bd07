"""Texts of an Arrow batch as flat numpy arrays: words, rolling hashes, sums.

All hashes are polynomial over random 64-bit byte codes, modulo 2**64, so any
slice is hashed from one running sum.  They are fixed: the same text hashes to
the same value in every task.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
SLICE_BYTES = 1 << 21          # texts handled at once inside a task

IS_WS = np.zeros(256, bool)
IS_WS[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def release() -> None:
    """Give freed memory back to the system: Python workers outlive their tasks."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):                           # another C library
        pass


def trimmed(f: Callable[..., Iterator[pa.RecordBatch]]):
    """A ``mapInArrow`` function that gives memory back now and then and at its end."""
    def run(batches):
        for i, b in enumerate(f(batches)):
            yield b
            if i % 8 == 7:
                release()
        release()
    return run


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser."""
    x = x.astype(U, copy=True)
    x ^= x >> U(30)
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


BYTE = mix(np.arange(1, 257, dtype=U) * U(0x9E3779B97F4A7C15))
_P = 0xD1342543DE82EF95
_Q = pow(_P, -1, 1 << 64)
_POW = {b: np.ones(1, U) for b in (_P, _Q)}


def powers(n: int, base: int = _P) -> np.ndarray:
    have = _POW[base]
    if len(have) < n:
        have = np.full(max(n, 1 << 16), base, U)
        have[0] = 1
        _POW[base] = have = np.multiply.accumulate(have)
    return have[:n]


def text_buffer(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; null counts as empty."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    if pa.types.is_string(arr.type) or pa.types.is_large_string(arr.type):
        arr = arr.cast(pa.large_string())
    arr = arr.cast(pa.large_binary())
    if arr.null_count:
        arr = pc.fill_null(arr, b"")
    if not len(arr):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, o, d = arr.buffers()
    offs = np.frombuffer(o, np.int64, len(arr) + 1, arr.offset * 8)
    buf = np.frombuffer(d, np.uint8) if d is not None and d.size else np.zeros(0, np.uint8)
    return buf[offs[0]:offs[-1]], offs - offs[0]


def slices(offs: np.ndarray, limit: int = SLICE_BYTES):
    """Ranges [a, b) of rows of at most ``limit`` bytes (or of one row)."""
    n, a = len(offs) - 1, 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(offs, offs[a] + limit, "right")) - 1)
        yield a, b
        a = b


def word_spans(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of every word ``[^\\x20\\x09-\\x0D]+``."""
    n = len(buf)
    if not n:
        return (np.zeros(0, np.int64),) * 3
    solid = ~IS_WS[buf]
    edge = np.zeros(n + 1, bool)
    edge[offs] = True
    left = edge[:-1].copy()
    left[1:] |= ~solid[:-1]
    right = edge[1:].copy()
    right[:-1] |= ~solid[1:]
    starts = np.flatnonzero(solid & left)
    ends = np.flatnonzero(solid & right) + 1
    return starts, ends, np.searchsorted(offs, starts, "right") - 1


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, limit: int = SLICE_BYTES) -> np.ndarray:
    """64-bit hash of each byte span (sorted, not overlapping), in bounded steps."""
    out = np.empty(len(starts), U)
    a = 0
    while a < len(starts):
        lo = starts[a]
        b = max(a + 1, int(np.searchsorted(ends, lo + limit, "right")))
        hi = ends[b - 1]
        s, e = starts[a:b] - lo, ends[a:b] - lo
        run = np.zeros(hi - lo + 1, U)
        np.cumsum(BYTE[buf[lo:hi]] * powers(hi - lo), out=run[1:])
        out[a:b] = (run[e] - run[s]) * powers(hi - lo + 1, _Q)[s]
        a = b
    return mix(out ^ (ends - starts).astype(U))


def gram_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` consecutive items (``len(h) - k + 1`` values)."""
    if len(h) < k:
        return np.zeros(0, U)
    out = np.zeros(len(h) - k + 1, U)
    for i in range(k):
        out = out * U(_P) + h[i:i + len(out)]
    return mix(out)


def run_starts(sorted_values: np.ndarray) -> np.ndarray:
    """Index of the first of each run of equal neighbours."""
    if not len(sorted_values):
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.r_[True, sorted_values[1:] != sorted_values[:-1]])


def distinct(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``np.unique`` with the inverse, of 64-bit values.  Where the bits that vary and
    the index fit in one word, the words are sorted themselves."""
    n = len(x)
    if n < 2:
        return x.copy(), np.zeros(n, np.int64)
    index = (n - 1).bit_length()
    low = x & U(0xFFFFFFFF)
    wide = int(low.max()).bit_length()
    if int((x >> U(32)).max()).bit_length() + wide + index > 64:
        return np.unique(x, return_inverse=True)
    key = ((x >> U(32)) << U(wide) | low) << U(index) | np.arange(n, dtype=U)
    key.sort()
    at = (key & U((1 << index) - 1)).astype(np.int64)
    key >>= U(index)
    new = np.empty(n, bool)
    new[0] = True
    np.not_equal(key[1:], key[:-1], out=new[1:])
    back = np.empty(n, np.int64)
    back[at] = np.cumsum(new) - 1
    key = key[new]
    return (key >> U(wide)) << U(32) | key & U((1 << wide) - 1), back


def distinct_hashes(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``distinct`` of hashes: their high bits are sorted beside the index, which is
    the whole order unless two different hashes agree in these bits."""
    n = len(x)
    if n < 2:
        return x.copy(), np.zeros(n, np.int64)
    index = U((n - 1).bit_length())
    key = x >> index << index | np.arange(n, dtype=U)
    key.sort()
    at = (key & ((U(1) << index) - U(1))).astype(np.int64)
    sorted_, high = x[at], key >> index
    new = np.empty(n, bool)
    new[0] = True
    np.not_equal(sorted_[1:], sorted_[:-1], out=new[1:])
    if (new[1:] & (high[1:] == high[:-1])).any():
        return np.unique(x, return_inverse=True)
    back = np.empty(n, np.int64)
    back[at] = np.cumsum(new) - 1
    return sorted_[new], back


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenated index ranges ``start .. start + length``."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


def sum_by(values: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Integer sums of ``values`` by sorted ``rows``."""
    run = np.r_[0, np.cumsum(values)]
    cut = np.searchsorted(rows, np.arange(n + 1))
    return run[cut[1:]] - run[cut[:-1]]
