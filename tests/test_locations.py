"""Slices of a table laid out by range."""
import random

import pytest

from annomart.operators import locations as L
from annomart.queries import cat

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    rnd = random.Random(4)
    rows = [(i, rnd.randrange(6), lo := rnd.randrange(1_000_000), lo + int(10 ** rnd.uniform(0, 3.5))) for i in range(20_000)]
    rows += [(90_000, 0, 0, 1_000_000), (90_001, 3, 10, 900_000), (90_002, None, 1, 2), (90_003, 1, None, 5), (90_004, 1, 5, None)]
    df = spark.createDataFrame(rows, "feature_id long, srcfeature_id long, fmin long, fmax long")
    path = str(tmp_path_factory.mktemp("loc")) + "/t"
    return rows, L.write_location_table(df, path, files=16)


def queries(spark, ranges):
    return spark.createDataFrame([(k, *r) for k, r in enumerate(ranges)], "q long, scaffold long, lo long, hi long")


def slice_of(spark, path, ranges, **kw):
    out = L.location_slice(spark, path, queries(spark, ranges), query_cols=("scaffold", "lo", "hi"), **kw)
    got = [(r.q, r.feature_id) for r in out.select("q", "feature_id").collect()]
    assert len(got) == len(set(got))
    return set(got)


def brute(rows, ranges):
    return {(k, f) for k, (s, lo, hi) in enumerate(ranges) for f, src, a, b in rows
            if None not in (s, lo, hi, src, a, b) and s == src and a <= hi and lo <= b}


def test_slices_equal_brute_force(spark, table):
    rows, path = table
    rnd = random.Random(5)
    short = [(rnd.randrange(7), lo := rnd.randrange(1_000_000), lo + 200) for _ in range(20)]
    for ranges in (short, [(0, 500_000, 500_000)], [(9, 1, 5)], [(2, None, 5), (2, 7, 3), (None, 1, 2)], short * 5,
                   [(k % 6, k * 5000, k * 5000 + 50) for k in range(150)]):
        assert slice_of(spark, path, ranges) == brute(rows, ranges)
    wanted = spark.createDataFrame([(f,) for f in range(0, 20_000, 3)], "feature_id long")
    assert slice_of(spark, path, short, wanted=wanted) == {(k, f) for k, f in brute(rows, short) if f < 20_000 and f % 3 == 0}
    assert L.location_slice(spark, path, queries(spark, [(1, 1, 2)]).limit(0), query_cols=("scaffold", "lo", "hi")).count() == 0


def scan_rows(df):
    """Rows that the file scans of a finished plan put out."""
    df.collect()
    todo, n = [df._jdf.queryExecution().executedPlan()], 0
    while todo:
        p = todo.pop()
        name = p.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(p.executedPlan())
        elif name.endswith("QueryStageExec"):
            todo.append(p.plan())
        if name == "FileSourceScanExec":
            n += p.metrics().get("numOutputRows").get().value()
        todo += [p.children().apply(i) for i in range(p.children().size())]
    return n


def test_files_and_rows_read_fall_with_the_list(spark, table):
    rows, path = table
    cols = ("scaffold", "lo", "hi")
    every = len(L.read_slice(spark, path, queries(spark, [(s, 0, 1_000_000) for s in range(6)]), cols).inputFiles())
    few = L.read_slice(spark, path, queries(spark, [(2, 400_000, 400_100)]), cols)
    assert every == 16 and 1 <= len(few.inputFiles()) <= 5
    assert scan_rows(few) < len(rows) / 3
    two = L.read_slice(spark, path, queries(spark, [(2, 400_000, 400_100), (4, 10, 20)]), cols)
    assert len(few.inputFiles()) <= len(two.inputFiles()) < every


def test_bounds_reach_the_scan(spark, table):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = L.read_slice(spark, table[1], queries(spark, [(2, 400_000, 400_100)]), ("scaffold", "lo", "hi"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "EqualTo(srcfeature_id,2)" in text and "LessThanOrEqual(fmin,400100)" in text and "GreaterThanOrEqual(fmax,400000)" in text


def test_report_reads_the_laid_out_table(spark):
    from annomart.plans import reports as rp
    c = cat(spark, SF)
    lines = c["location_lines"].limit(1)
    one, every = (rp.overlapping_transcripts(c, rp.parse_locations(x)) for x in (lines, c["location_lines"]))
    ranged = lambda df: [f for f in df.inputFiles() if "featureloc_ranges" in f]
    assert 0 < len(ranged(one)) < len(ranged(every))
