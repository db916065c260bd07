"""Lookups of a short id list read and shuffle a small part of the tables."""
import pytest
from pyspark.sql import functions as F

from annomart.operators import lookups, reduction
from annomart.queries import all_entity_ids, cat
from fixtures import FEATURE, catalog

SF = "/root/testdata/sf0.01"


def _plans(plan):
    todo = [plan]
    while todo:
        p = todo.pop()
        name = p.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(p.executedPlan())
        elif name.endswith("QueryStageExec"):
            todo.append(p.plan())
        yield name, p
        todo += [p.children().apply(i) for i in range(p.children().size())]


@pytest.fixture
def shuffled(spark, monkeypatch):
    """Rows shuffled by what ``run`` computes, the staged steps included."""
    from annomart import session
    count = []

    def finished(df):
        rows = df.collect()
        plan = df._jdf.queryExecution().executedPlan()
        count.append(sum(p.metrics().get("shuffleRecordsWritten").get().value() for n, p in _plans(plan) if n == "ShuffleExchangeExec"))
        return rows

    real = session.stage

    def stage(df):
        finished(df)
        return real(df)

    for module in (lookups, reduction):
        monkeypatch.setattr(module, "stage", stage)

    def run(make):
        count.clear()
        rows = finished(make())
        return rows, sum(count)
    return run


def _ids(c, n=600):
    """``n`` ids of all classes, some twice, some unknown."""
    some = all_entity_ids(c).distinct().orderBy(F.xxhash64("id")).limit(n - 10)
    return c.spark.createDataFrame([tuple(r) for r in some.collect()] + [("FBgn9999999",)] * 5 + [(some.first()[0],)] * 4 + [(None,)], "id string")


LOOKUPS = {
    "U2 symbol": lambda c, ids: lookups.current_synonym(c, ids, "id", "symbol"),
    "U2 fullname": lambda c, ids: lookups.current_synonym(c, ids, "id", "fullname"),
    "U3 subject": lambda c, ids: lookups.related_features(c, ids, "id", "alleleof|associated_with", "FBal|FBtp", "subject"),
    "U3 object": lambda c, ids: lookups.related_features(c, ids, "id", "%", None, "object"),
    "U4": lambda c, ids: lookups.feature_props(c, ids, "id", "%"),
    "U5": lambda c, ids: lookups.pub_props(c, ids.unionAll(c["pub"].select("uniquename").limit(50)), "id", "%"),
    "U7": lambda c, ids: lookups.ontology_terms(c, ids, "id", "molecular_function"),
    "U8": lambda c, ids: lookups.stocks(c, ids, "id"),
}


@pytest.mark.parametrize("name", LOOKUPS)
def test_short_lists_give_the_same_rows(spark, monkeypatch, name):
    c = cat(spark, SF)
    ids = _ids(c)
    rank = lambda rows: sorted(tuple((v is None, str(v)) for v in r) for r in rows)
    short = rank(LOOKUPS[name](c, ids).collect())
    monkeypatch.setattr(reduction, "SHORT", 0)
    assert short and short == rank(LOOKUPS[name](c, ids).collect())


def test_short_lists_shuffle_little(spark, shuffled, monkeypatch):
    c = cat(spark, SF)
    ids = _ids(c)
    tables = {t: c[t].count() for t in ("feature_synonym", "feature", "feature_relationship", "featureprop")}
    for name in ("U2 symbol", "U3 subject", "U4", "U8"):
        _, short = shuffled(lambda: LOOKUPS[name](c, ids))
        assert short < sum(tables.values()) / 40, (name, short, tables)      # mostly the result itself
    monkeypatch.setattr(reduction, "SHORT", 0)
    _, long = shuffled(lambda: LOOKUPS["U3 subject"](c, ids))
    assert long > tables["feature_synonym"] / 2


def test_large_tables_are_reduced_before_the_first_shuffle(spark):
    c = cat(spark, SF)
    df = lookups.feature_props(c, _ids(c), "id", "%")
    df.collect()
    assert "struct<featureprop_id" in df._jdf.queryExecution().executedPlan().toString()
    for name, p in _plans(df._jdf.queryExecution().executedPlan()):
        if name == "ShuffleExchangeExec":
            text = p.toString()
            assert "struct<featureprop_id" not in text or "LeftSemi" in text


def test_large_key_sets_are_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(reduction, "MAX_KEYS", 3)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    big, small = spark.range(100).withColumnRenamed("id", "k"), spark.range(5).withColumnRenamed("id", "k")
    plan = lambda n: reduction.reduced(big, small.limit(n), "k")._jdf.queryExecution().executedPlan().toString()
    try:
        assert "BroadcastHashJoin" in plan(2) and "BroadcastHashJoin" not in plan(5)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_related_symbol_is_that_of_the_name(spark, monkeypatch):
    """Two live features of one name: the symbol is the name's, whichever feature the edge leads to."""
    feature = spark.createDataFrame([(1, "FBgn0000001", "g", 5, 1, False, False), (2, "FBal0000002", "a", 9, 1, False, False),
                                     (3, "FBal0000002", "a", 9, 1, False, False)], FEATURE)
    edge = spark.createDataFrame([(10, 3, 1, 1, 0, None)], "feature_relationship_id long, subject_id long, object_id long, type_id long, rank long, value string")
    syn = spark.createDataFrame([(100, "s", "of the name", 3), (101, "t", "of the other", 3)], "synonym_id long, name string, synonym_sgml string, type_id long")
    link = spark.createDataFrame([(2, 100, True, False), (3, 101, True, False)], "feature_id long, synonym_id long, is_current boolean, is_internal boolean")
    c = catalog(spark, feature=feature, feature_relationship=edge, synonym=syn, feature_synonym=link)
    ids = spark.createDataFrame([("FBgn0000001",)], "id string")
    for short in (10, 0):
        monkeypatch.setattr(reduction, "SHORT", short)
        assert [(r.subject_id, r.symbol) for r in lookups.related_features(c, ids, "id", "alleleof").collect()] == [(3, "of the name")]
