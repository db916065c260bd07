"""Op 11 - embedding whitening by bit-sliced scatter.

Entries become integers on a grid (``floor(64 * c) + 1000000``).  The distinct
vectors (a Spark ``distinct``) are taken in blocks; each block shifts every
dimension to its own minimum, packs the bit planes of the shifted integers
across rows into 64-bit words, and gets every cross-product exactly as a sum of
``2**(a + b) * popcount(plane_a & plane_b)``.  The shift is undone in integers,
blocks add up within a task, tasks add up in Spark as decimals, so the scatter
matrix is exact whatever the partitioning.  It is centred as integers
(``n * sum(x y) - sum(x) sum(y)``) before the first division and before
``eigh``.  The driver holds one such matrix (dimensions squared), never rows.

Edge cases: null vectors and those with null or non-finite entries are dropped
(no result row); null and repeated ids stay, repeated vectors count once in the
fit; other columns are ignored.  Vectors of different lengths are fitted apart,
each length on its own.  Components without variance (rank below the
dimensions, one distinct vector, empty vectors; double precision of the largest
value decides) are not returned, as their projection would be 0 / 0.  Entries beyond 2**47 are held at that bound; a
``deviation`` beyond a long is null.  An empty table gives no rows.
"""

from __future__ import annotations

from decimal import Decimal
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annomart.llm import arrays as A

SCALE, SHIFT = 64, 1_000_000
BOUND = float(1 << 53)          # of 64 * c
COMPONENTS = 16
BLOCK = 8192                    # rows whose planes are held at once
LONG = (1 << 63) - 1


def vectors(col: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, length, flat grid values less ``SHIFT``) of the usable vectors of a batch."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    size = np.diff(col.offsets.to_numpy())
    flat = col.values.slice(col.offsets[0].as_py(), int(size.sum()))
    c = flat.cast(pa.float64(), safe=False).fill_null(np.nan).to_numpy(zero_copy_only=False)
    bad = ~np.isfinite(c)
    row = np.repeat(np.arange(len(col)), size)
    use = np.ones(len(col), bool)
    use[row[bad]] = False
    use &= ~np.asarray(col.is_null())
    x = np.floor(np.clip(np.where(bad, 0.0, c) * SCALE, -BOUND, BOUND)).astype(np.int64)
    return np.flatnonzero(use), size[use], x[use[row]]


# -------------------------------------------------------------------- scatter


def exact(x: np.ndarray, bound: int) -> np.ndarray:
    """``x`` as it is when sums up to ``bound`` fit a long, else as Python integers."""
    return x if bound < LONG else x.astype(object)


def scatter(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact (cross-products, sums) of the columns of a block of integer rows."""
    rows, dims = x.shape
    low = x.min(0)
    y = x - low
    bits = [int(v).bit_length() for v in y.max(0)]
    plane = [(d, b) for d in range(dims) for b in range(bits[d])]
    cross, total = np.zeros((dims, dims), np.int64), np.zeros(dims, np.int64)
    top = max(bits, default=0)
    if plane:
        of = np.array([d for d, _ in plane])
        packed = np.zeros((len(plane), -(-rows // 64) * 8), np.uint8)
        for k, (d, b) in enumerate(plane):
            packed[k, :-(-rows // 8)] = np.packbits((y[:, d] >> b & 1).astype(bool))
        word = packed.view(np.uint64)
        pop = np.zeros((len(plane),) * 2, np.int64)
        for k in range(len(plane)):
            pop[k, k:] = np.bitwise_count(word[k] & word[k:]).sum(1, dtype=np.int64)
        pop = exact(np.triu(pop) + np.triu(pop, 1).T, rows << 2 * top)
        weight = exact(np.array([1 << b for _, b in plane], np.int64), rows << 2 * top)
        at, live = A.run_starts(of), np.unique(of)
        sums = np.add.reduceat(pop.diagonal() * weight, at)
        inner = np.add.reduceat(np.add.reduceat(pop * weight[:, None] * weight, at, axis=0), at, axis=1)
        cross, total = cross.astype(inner.dtype), total.astype(inner.dtype)
        cross[np.ix_(live, live)], total[live] = inner, sums
    limit = 4 * rows * max(int(abs(low).max(initial=0)) + (1 << top), 1) ** 2
    low, cross, total = (exact(v, limit) for v in (low, cross, total))
    return cross + np.outer(low, total) + np.outer(total, low) + rows * np.outer(low, low), total + rows * low


class Whitening(NamedTuple):
    """A fitted space: ``components`` (unit columns, falling ``values``) of the covariance of the grid integers."""
    n: int
    sums: list[int]             # of the grid integers less ``SHIFT``
    components: np.ndarray
    values: np.ndarray
    explained: np.ndarray
    identity_error: float


def decompose(n: int, sums: list[int], cross: np.ndarray, components: int) -> Whitening:
    """Centred as integers, divided once, then ``eigh``."""
    s = np.array(sums, object)
    centred = n * cross.astype(object) - np.outer(s, s)
    cov = np.array([[v / (n * n) for v in row] for row in centred], float).reshape(len(sums), len(sums))
    e, u = np.linalg.eigh(cov)
    e, u = e[::-1], u[:, ::-1]
    keep = min(components, int((e > len(e) * np.finfo(float).eps * max(e[0], 0)).sum())) if len(e) else 0
    e, u = e[:keep], u[:, :keep]
    w = u / np.sqrt(e)
    error = float(abs(w.T @ cov @ w - np.eye(keep)).max(initial=0.0))
    return Whitening(n, [int(v) for v in sums], u, e, e / np.trace(cov) if keep else e, error)


def fit(table: DataFrame, vector_col: str = "embedding", components: int = COMPONENTS) -> dict[int, Whitening]:
    """The whitening of the distinct grid vectors of each vector length."""
    def grid(batches):
        for b in batches:
            _, size, x = vectors(b.column(0))
            cut = np.r_[0, np.cumsum(size)] * 8
            raw = x.astype("<i8").tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([raw[i:j] for i, j in zip(cut, cut[1:])], pa.binary())], ["x"])

    def totals(batches):
        cross, sums, n, held = {}, {}, {}, {}

        def take(d):
            x = np.frombuffer(b"".join(held.pop(d)), "<i8").astype(np.int64).reshape(-1, d)
            c, s = scatter(x)
            cross[d], sums[d] = cross.get(d, 0) + c.astype(object), sums.get(d, 0) + s.astype(object)
            n[d] = n.get(d, 0) + len(x)

        for b in batches:
            for v in b.column(0).to_pylist():
                if v:
                    held.setdefault(len(v) // 8, []).append(v)
                    if len(held[len(v) // 8]) == BLOCK:
                        take(len(v) // 8)
        for d in list(held):
            take(d)
        for d in n:                                             # -1: the sums, and at (-1, -1) the number of rows
            cells = [(-1, -1, n[d]), *((i, -1, v) for i, v in enumerate(sums[d]))]
            cells += [(i, j, cross[d][i, j]) for i in range(d) for j in range(i, d)]
            i, j, v = zip(*cells)
            yield pa.RecordBatch.from_arrays([pa.array([d] * len(i), pa.int32()), pa.array(i, pa.int32()), pa.array(j, pa.int32()),
                                              pa.array([Decimal(int(k)) for k in v], pa.decimal128(38, 0))], ["dims", "i", "j", "v"])

    distinct = table.select(F.col(vector_col).alias("v")).mapInArrow(grid, "x binary").distinct()
    cells = distinct.mapInArrow(A.trimmed(totals), "dims int, i int, j int, v decimal(38,0)")
    found: dict[int, dict] = {}
    for r in cells.groupBy("dims", "i", "j").agg(F.sum("v").alias("v")).collect():      # dimensions squared, not rows
        found.setdefault(r.dims, {})[r.i, r.j] = int(r.v)
    out = {}
    for d, v in found.items():
        cross = np.array([[v[min(i, j), max(i, j)] for j in range(d)] for i in range(d)], object)
        out[d] = decompose(v[-1, -1], [v[i, -1] for i in range(d)], cross, components)
    return out


def whiten(table: DataFrame, model: dict[int, Whitening], id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per usable vector and component: id, ``component`` (from 1), ``n``,
    ``deviation``, ``whitened``, ``explained``, ``identity_error``."""
    src = table.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v"))

    def project(x: np.ndarray, m: Whitening) -> tuple[np.ndarray, pa.Array]:
        """(whitened, deviation) of grid rows."""
        s = np.array(m.sums, object)
        most = m.n * int(abs(x).max(initial=0)) + max(map(abs, m.sums), default=0)
        d = exact(x, len(s) * most * most) * m.n - (s if len(s) * most * most >= LONG else s.astype(np.int64))
        dev = (d * d).sum(1)
        return (d / m.n).astype(float) @ m.components / np.sqrt(m.values), pa.array([v if v <= LONG else None for v in dev.tolist()], pa.int64())

    def run(batches):
        for b in batches:
            row, size, flat = vectors(b.column(1))
            at = np.cumsum(size) - size
            for d in np.unique(size).tolist():
                m = model.get(d)
                k = len(m.values) if m else 0
                pick = np.flatnonzero(size == d)
                if not k:
                    continue
                w, dev = project(flat[A.ragged(at[pick], size[pick])].reshape(-1, d), m)
                every = pa.array(np.repeat(np.arange(len(pick)), k))
                ids = b.column(0).take(pa.array(row[pick])).take(every)
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(pick))), pa.array(np.full(len(every), m.n)),
                     dev.take(every), pa.array(w.ravel()), pa.array(np.tile(m.explained, len(pick))),
                     pa.array(np.full(len(every), m.identity_error))],
                    ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    kind = src.schema["id"].dataType.simpleString()
    out = src.mapInArrow(run, f"id {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double")
    return out.withColumnRenamed("id", id_col)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return whiten(table, fit(table))
