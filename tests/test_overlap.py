import random

from annomart.operators.overlap import candidates, overlap_join


def _intervals(n, seed, src=3, span=5000, width=900):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        lo = rnd.randrange(0, span)
        out.append((i, rnd.randrange(src), lo, lo + rnd.randrange(0, width)))
    return out


def _brute(a, b, inclusive=True):
    res = set()
    for i, s1, l1, h1 in a:
        for j, s2, l2, h2 in b:
            ok = (l1 <= h2 and l2 <= h1) if inclusive else (l1 < h2 and l2 < h1)
            if s1 == s2 and ok:
                res.add((i, j))
    return res


def test_overlap_equals_brute_force(spark):
    a, b = _intervals(300, 1), _intervals(300, 2)
    L = spark.createDataFrame(a, "lid long, srcfeature_id long, fmin long, fmax long")
    R = spark.createDataFrame(b, "rid long, srcfeature_id long, fmin long, fmax long")
    for bin_size in (100, 1000, 100_000):
        got = [(r.lid, r.rid) for r in overlap_join(L, R, bin_size=bin_size).select("lid", "rid").collect()]
        assert len(got) == len(set(got)), "a pair must be emitted once"
        assert set(got) == _brute(a, b)
    half = {(r.lid, r.rid) for r in overlap_join(L, R, bin_size=250, inclusive=False).collect()}
    assert half == _brute(a, b, inclusive=False)


def test_overlap_edges(spark):
    # touching ends, containment, same start, long span over many bins, other source, no match
    a = [(1, 0, 100, 200), (2, 0, 0, 10_000), (3, 1, 100, 200), (4, 0, 5000, 5001)]
    b = [(10, 0, 200, 300), (11, 0, 150, 160), (12, 0, 100, 101), (13, 0, 9_999, 20_000), (14, 2, 0, 10)]
    L = spark.createDataFrame(a, "lid long, srcfeature_id long, fmin long, fmax long")
    R = spark.createDataFrame(b, "rid long, srcfeature_id long, fmin long, fmax long")
    got = {(r.lid, r.rid) for r in overlap_join(L, R, bin_size=64).collect()}
    assert got == _brute(a, b)
    assert (1, 10) in got and (2, 13) in got and (3, 10) not in got


def test_partition_count_invariance(spark):
    a, b = _intervals(200, 5), _intervals(200, 6)
    L = spark.createDataFrame(a, "lid long, srcfeature_id long, fmin long, fmax long")
    R = spark.createDataFrame(b, "rid long, srcfeature_id long, fmin long, fmax long")
    results = []
    for n in ("1", "8"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        results.append(sorted((r.lid, r.rid) for r in overlap_join(L, R, bin_size=500).collect()))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert results[0] == results[1]


def _sides(spark, rows, other=None):
    df = spark.createDataFrame(rows, "k long, s long, a long, b long")
    r = spark.createDataFrame(other, "m long, s long, a long, b long") if other else df.withColumnRenamed("k", "m")
    named = lambda d, p: d.select(d.columns[0], d.s.alias(f"{p}_src"), d.a.alias(f"{p}_lo"), d.b.alias(f"{p}_hi"))
    return df, r, named(df, "l"), named(r, "r")


def _short(n):
    return [(i, 1, i * 1000, i * 1000 + 300) for i in range(n)]


def test_candidates_grow_with_the_intervals(spark):
    """One scaffold, disjoint short intervals: a constant number of candidates each."""
    count = {}
    for n in (1000, 16000):
        _, _, L, R = _sides(spark, _short(n))
        count[n] = candidates(L, R).count()
    assert count[1000] >= 1000 and count[16000] <= 16.5 * count[1000] and count[16000] <= 4 * 16000


def test_a_scaffold_long_interval_adds_its_own_pairs_only(spark):
    n = 4000
    _, _, L, R = _sides(spark, _short(n))
    few = candidates(L, R).count()
    rows = _short(n) + [(n, 1, 0, n * 1000), (n + 1, 2, 0, 5)]
    df, r, L, R = _sides(spark, rows)
    assert candidates(L, R).count() <= few + 2 * (2 * n + 10)            # it meets all of both sides
    got = [(x.k, x.m) for x in overlap_join(df, r, left_cols=("s", "a", "b"), right_cols=("s", "a", "b")).select("k", "m").collect()]
    assert len(got) == len(set(got)) and sorted(got) == sorted([(i, i) for i in range(n + 2)] + [(i, n) for i in range(n)] + [(n, i) for i in range(n)])


def test_candidates_of_mixed_lengths_follow_the_pairs(spark):
    rnd = random.Random(9)
    rows = [(i, rnd.randrange(3), lo := rnd.randrange(2_000_000), lo + int(10 ** rnd.uniform(0, 5))) for i in range(1500)]
    df, r, L, R = _sides(spark, rows, [(i, rnd.randrange(3), lo := rnd.randrange(2_000_000), lo + int(10 ** rnd.uniform(0, 5))) for i in range(1500)])
    pairs = overlap_join(df, r, left_cols=("s", "a", "b"), right_cols=("s", "a", "b"), bin_size=100)
    got = [(x.k, x.m) for x in pairs.select("k", "m").collect()]
    right = r.collect()
    want = {(x[0], y[0]) for x in rows for y in right if x[1] == y.s and x[2] <= y.b and y.a <= x[3]}
    assert len(got) == len(set(got)) and set(got) == want
    assert candidates(L, R, 100).count() <= 16 * len(want) + 8 * 3000


def test_null_reversed_and_negative_coordinates(spark):
    a = [(1, 0, None, 5), (2, 0, 5, None), (3, None, 1, 2), (4, 0, -500, -100), (5, 0, 9, 3), (6, 0, 4, 4)]
    b = [(10, 0, -200, 4), (11, 0, 2, 20), (12, 0, 20, 2), (13, None, 1, 2)]
    df, r, _, _ = _sides(spark, a, b)
    got = {(x.k, x.m) for x in overlap_join(df, r, left_cols=("s", "a", "b"), right_cols=("s", "a", "b"), bin_size=3).collect()}
    assert got == {(x[0], y[0]) for x in a for y in b if None not in x + y and x[1] == y[1] and x[2] <= y[3] and y[2] <= x[3]}


def test_short_intervals_make_few_rows_and_no_nested_loop(spark):
    _, _, L, R = _sides(spark, _short(50))
    plan = candidates(L, R)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Subquery" in plan


def test_empty_sides(spark):
    _, _, L, R = _sides(spark, _short(5))
    assert candidates(L.limit(0), R).count() == candidates(L, R.limit(0)).count() == 0
