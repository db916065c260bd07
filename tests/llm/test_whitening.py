"""Op 11 against exact integer arithmetic."""
import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import types as T

from annomart.llm import op11_whitening as W

SF = "/root/testdata/sf0.001"
SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                       *[T.StructField(n, T.LongType()) for n in ("component", "n", "x", "id", "whitened")]])


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(i, v, 1, None, 3, 4, 5) for i, v in rows], SCHEMA).repartition(parts)


def usable(v):
    return v is not None and all(c is not None and math.isfinite(c) for c in v)


def check(rows, got):
    """Every row of one vector length against brute force."""
    keep = [(i, [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v]) for i, v in rows if usable(v)]
    fit = sorted({tuple(x) for _, x in keep})
    n, dims = len(fit), len(fit[0])
    s = [sum(x[d] for x in fit) for d in range(dims)]
    cov = np.array([[float(sum((Fraction(x[i]) - Fraction(s[i], n)) * (Fraction(x[j]) - Fraction(s[j], n)) for x in fit) / n)
                     for j in range(dims)] for i in range(dims)])
    e, u = np.linalg.eigh(cov)
    k = min(16, int((e > dims * 2.3e-16 * e[-1]).sum()))
    by = {}
    for r in got:
        by.setdefault((r.vec_id, r.deviation), []).append(r)
    want = {}
    for i, x in keep:
        want.setdefault((i, sum((n * a - b) ** 2 for a, b in zip(x, s))), []).append(x)
    assert {key: len(v) for key, v in by.items()} == {key: k * len(v) for key, v in want.items()}
    sign = {}
    for key, xs in want.items():
        for r in by[key]:
            assert r.n == n and r.identity_error <= 1e-4 and r.explained == pytest.approx(e[-r.component] / np.trace(cov), rel=1e-9)
            centred = np.array([[float(Fraction(a) - Fraction(b, n)) for a, b in zip(x, s)] for x in xs])
            p = centred @ u[:, -r.component] / math.sqrt(e[-r.component])
            f = sign.setdefault(r.component, 1 if min(abs(p - r.whitened)) < min(abs(p + r.whitened)) else -1)
            assert min(abs(f * p - r.whitened)) < 1e-6
    return n, k


def some(n, dims, seed=0, scale=0.3):
    r = np.random.default_rng(seed)
    return [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(r.normal(0, scale, (n, dims)) @ r.normal(0, 1, (dims, dims)))]


def test_scatter_is_exact():
    r = np.random.default_rng(1)
    for rows, dims, top in ((1, 3, 5), (130, 7, 90), (64, 4, 1 << 40), (700, 5, 1 << 53), (50, 3, 1)):
        x = r.integers(-top, top, (rows, dims)) if top > 1 else np.full((rows, dims), -9)
        c, s = W.scatter(x)
        y = x.astype(object)
        assert (c == y.T @ y).all() and (s == y.sum(0)).all()


@pytest.mark.parametrize("dims", [1, 5, 20])
def test_equals_brute_force(spark, dims):
    rows = some(150, dims)
    rows += [(i, rows[i % 7][1]) for i in range(200, 260)] + [(None, rows[3][1]), (5, rows[9][1]), (5, rows[5][1])]
    rows += [(300, None), (301, [None] * dims), (302, [float("nan")] * dims), (303, [float("-inf")] * dims), (304, [0.0] * (dims - 1) + [None]),
             (305, [-0.0] * dims), (306, [1e-30] * dims), (307, [-1e-30] * dims)]
    t = frame(spark, rows)
    assert check(rows, W.whiten(t, W.fit(t)).collect())[1] == min(dims, 16)


def test_lengths_ranks_and_extremes(spark):
    a, b = some(40, 3), [(1000 + i, v) for i, v in some(30, 6, seed=2)]
    flat = [(2000 + i, [float(i % 5), 1.0, 2.0, float(i % 5)]) for i in range(20)]             # rank 1
    t = frame(spark, a + b + flat + [(9, []), (10, [1.0] * 8), (11, [1.0] * 8)])
    out = W.whiten(t, W.fit(t)).collect()
    assert check(a, [r for r in out if r.vec_id is not None and r.vec_id < 1000])[1] == 3
    assert check(b, [r for r in out if 1000 <= r.vec_id < 2000])[1] == 6
    assert check(flat, [r for r in out if r.vec_id >= 2000]) == (5, 1)                         # one distinct vector: no component
    huge = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(([3e38, 1.0], [-3e38, 2.0], [0.0, 5.0], [1.0, 9.0]))]
    t = frame(spark, huge)
    out = W.whiten(t, W.fit(t)).collect()
    # beside an extreme dimension the other's variance is below double precision: one component
    assert len(out) == 4 and any(r.deviation is None for r in out) and all(math.isfinite(r.whitened) for r in out)


def test_empty_table_and_partitioning(spark):
    t = frame(spark, []).limit(0)
    assert W.fit(t) == {} and W.whiten(t, {}).count() == 0
    rows = some(500, 12, seed=4)
    one, many = (W.fit(frame(spark, rows, p))[12] for p in (1, 7))
    assert one.sums == many.sums and one.n == many.n and (one.values == many.values).all()


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()]
    assert check(rows, W.op11_whitening(spark, SF).collect())[1] == 16
