"""Plan-shape checks over every registered query (sf0.001)."""
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "BatchEvalPython", "ArrowEvalPython")


def test_no_pair_blowup_or_python_in_any_plan(spark):
    bad = []
    for name, fn in sorted(E.queries().items()):
        plan = fn(spark, SF)._jdf.queryExecution().executedPlan().toString()
        bad += [(name, k) for k in FORBIDDEN if k in plan]
    assert bad == []


def test_type_filters_reach_the_scan(spark):
    from annomart.queries import cat
    from annomart.operators.lookups import edges
    plan = edges(cat(spark, SF), "alleleof")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "type_id" in plan


@pytest.mark.parametrize("name", ["dataclass_gene", "gene_disease", "update_ids"])
def test_partition_count_invariance(spark, name):
    res = []
    for n in ("1", "8"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        df = E.queries()[name](spark, SF)
        res.append(sorted(tuple("" if v is None else str(v) for v in r) for r in df.collect()))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert res[0] == res[1]
