"""Typed tables are staged as they come."""

import time
import uuid

from annomart.sources import tables


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_typed_tables_are_staged_without_a_shuffle(spark, tmp_path):
    """A view without joins is written by the tasks that read its sources; the
    session's setting of open writers is as before."""
    part = spark.createDataFrame([(i, f"bolt {i}", f"Brand#{i % 5}", "LARGE", i, 1.0) for i in range(40)],
                                 "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double")
    orders = spark.createDataFrame([(i, i, "PFO"[i % 3], "5-LOW") for i in range(60)],
                                   "o_orderkey long, o_custkey long, o_orderstatus string, o_orderpriority string")
    customer = spark.createDataFrame([(i, i % 25) for i in range(20)], "c_custkey long, c_nationkey int")
    for n, df in (("part", part), ("orders", orders), ("customer", customer)):
        df.coalesce(1).write.parquet(f"{tmp_path}/{n}.parquet")
    c = tables.Catalog(spark, str(tmp_path), partition_typed=True)
    want = c._build("featureprop")
    group, path = uuid.uuid4().hex, f"{tmp_path}/staged.parquet"
    conf = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(conf)
    spark.sparkContext.setJobGroup(group, group)
    try:
        c._write_staged("featureprop", path)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    tracker = spark.sparkContext.statusTracker()
    stages = {s for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds}
    assert len(stages) == 1
    assert spark.conf.get(conf) == before
    got = spark.read.schema(want.schema).parquet(path).select(*want.columns)
    assert rows(got) == rows(want) and got.count() > 0


def test_written_tables_are_packed_and_leave_no_shuffle_files(spark, tmp_path):
    """Also of several writes at a time; the session's setting is as before."""
    from concurrent.futures import ThreadPoolExecutor

    from annomart.session import TIDY, held, stage
    def files():
        found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {n for n in found.mkString("\n").split("\n") if "/shuffle_" in n}

    before, old = spark.conf.get(TIDY[0], None), files()
    with ThreadPoolExecutor(3) as pool:
        got = list(pool.map(lambda n: stage(spark.range(500).repartition(5, "id").selectExpr("id + 1 AS n")), range(3)))
    until = time.time() + 20                    # files go a moment later
    while files() - old and time.time() < until:
        time.sleep(0.2)
    assert not files() - old
    assert [df.count() for df in got] == [500] * 3
    assert all(f.endswith(".zstd.parquet") for df in got for f in df.inputFiles())
    with held(spark, *TIDY):
        assert spark.conf.get(TIDY[0]) == "true"
    assert spark.conf.get(TIDY[0], None) == before
