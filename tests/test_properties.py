"""Property tests: the interval join equals a brute-force nested loop."""
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from annomart.operators.overlap import overlap_join

interval = st.tuples(st.integers(0, 2), st.integers(0, 3000), st.integers(0, 1500))


def _rows(items):
    return [(i, s, lo, lo + w) for i, (s, lo, w) in enumerate(items)]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(interval, min_size=0, max_size=40), st.lists(interval, min_size=0, max_size=40),
       st.sampled_from([1, 7, 100, 5000]), st.booleans())
def test_overlap_join_matches_nested_loop(spark, left, right, bin_size, inclusive):
    a, b = _rows(left), _rows(right)
    L = spark.createDataFrame(a, "lid long, srcfeature_id long, fmin long, fmax long")
    R = spark.createDataFrame(b, "rid long, srcfeature_id long, fmin long, fmax long")
    got = [(r.lid, r.rid) for r in overlap_join(L, R, bin_size=bin_size, inclusive=inclusive).collect()]
    want = {(i, j) for i, s1, l1, h1 in a for j, s2, l2, h2 in b
            if s1 == s2 and ((l1 <= h2 and l2 <= h1) if inclusive else (l1 < h2 and l2 < h1))}
    assert len(got) == len(set(got)) and set(got) == want


row = st.tuples(st.integers(0, 3), st.one_of(st.none(), st.integers(0, 4)), st.text("ab", max_size=2))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(row, min_size=0, max_size=30))
def test_first_per_key_matches_python(spark, rows):
    from annomart.operators.keys import first_per_key
    df = spark.createDataFrame(rows, "k int, o int, v string")
    got = sorted(tuple(r) for r in first_per_key(df, ["k"], ["o"]).collect())
    best = {}
    for k, o, v in rows:
        rank = (o is None, -1 if o is None else o, v)
        if k not in best or rank < best[k][0]:
            best[k] = (rank, (k, o, v))
    assert got == sorted(t for _, t in best.values())
