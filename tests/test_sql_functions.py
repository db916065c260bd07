"""The lookups as SQL functions: the same rows as the DataFrame forms, no Python in the plan."""
import pytest
from pyspark.sql import functions as F

from annomart.functions import exprs as X
from annomart.functions import sql
from annomart.operators import ids as I
from annomart.operators import lookups as L
from annomart.queries import all_entity_ids, cat

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def session(spark):
    c = cat(spark, SF)
    assert set(sql.register(c, "anno_")) == {f"anno_{n}" for n in sql.FUNCTIONS}
    return c


def rows(df):
    return sorted(tuple((v is None, str(v)) for v in r) for r in df.collect())


def some(c, n=150):
    ids = [r.id for r in all_entity_ids(c).distinct().orderBy(F.xxhash64("id")).limit(n).collect()] + ["FBgn9999999"]
    return ids + ids[:3], c.spark.createDataFrame([(i,) for i in ids + ids[:3]], "id string")


def literal(ids):
    return "array(" + ", ".join(repr(i) for i in ids) + ")"


CASES = {
    "update_ids": ("anno_update_ids({ids})", lambda c, d: I.update_ids(c, d, "id")),
    "related subject": ("anno_related_features({ids}, 'alleleof|associated_with', 'FBal|FBt_', 'subject')",
                        lambda c, d: L.related_features(c, d, "id", "alleleof|associated_with", "FBal|FBt_", "subject")),
    "related object": ("anno_related_features({ids}, '%', NULL, 'object')", lambda c, d: L.related_features(c, d, "id", "%", None, "object")),
    "feature_props": ("anno_feature_props({ids}, '%')", lambda c, d: L.feature_props(c, d, "id", "%")),
    "feature_props of a type": ("anno_feature_props({ids}, 'derived_stock_%')", lambda c, d: L.feature_props(c, d, "id", "derived_stock_%")),
    "ontology_terms": ("anno_ontology_terms({ids}, 'molecular_function')", lambda c, d: L.ontology_terms(c, d, "id", "molecular_function")),
}


@pytest.mark.parametrize("name", CASES)
def test_table_functions(spark, session, name):
    ids, df = some(session)
    if name == "update_ids":
        ids = [r.value.strip() for r in session["submitted_ids"].distinct().limit(200).collect()]
        df = spark.createDataFrame([(i,) for i in ids], "id string")
    call, frame = CASES[name]
    out = spark.sql(f"SELECT * FROM {call.format(ids=literal(ids))}")
    want = frame(session, df)
    assert out.columns == want.columns
    assert rows(out) == rows(want) and (out.count() > 0)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "NestedLoop" not in plan and "Cartesian" not in plan


def test_pub_and_member_props(spark, session):
    pubs = [r.uniquename for r in session["pub"].limit(80).collect()]
    got = spark.sql(f"SELECT * FROM anno_pub_props({literal(pubs)}, '%')")
    assert rows(got) == rows(L.pub_props(session, spark.createDataFrame([(p,) for p in pubs], "id string"), "id", "%"))
    members = [r.grpmember_id for r in session["grpmember"].limit(300).collect()]
    got = spark.sql(f"SELECT * FROM anno_group_member_props({literal(members)}, 'derived%')")
    want = L.group_member_props(session, spark.createDataFrame([(m,) for m in members], "member long"), "member", "derived%")
    assert rows(got) == rows(want)


def test_scalar_functions(spark, session):
    every = all_entity_ids(session)
    every.createOrReplaceTempView("anno_every")
    for kind in ("symbol", "fullname"):
        got = spark.sql(f"SELECT id, anno_current_{kind}(id) AS {kind} FROM anno_every")
        assert rows(got) == rows(L.current_synonym(session, every, "id", kind))
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "NestedLoop" not in plan
    assert rows(spark.sql("SELECT id, anno_current_synonym(id, 'symbol') AS symbol FROM anno_every")) == rows(
        L.current_synonym(session, every, "id", "symbol"))
    groups = {r.grp_id for r in spark.sql("SELECT grp_id FROM anno_grp WHERE anno_is_pathway(grp_id)").collect()}
    assert groups == {r.grp_id for r in L.pathway_groups(session).collect()} & {r.grp_id for r in session["grp"].select("grp_id").collect()}
    assert spark.sql("SELECT anno_data_class('fbGN1'), anno_is_evidence_experimental('x Inferred from direct assay')").first()[:] == ("FBgn", True)


@pytest.mark.parametrize("pattern", ["%", "FBti|FBtr", "a_c", "a%c", "(x|y)+z", "1.5", r"50\%", r"a\_b", "^x$", ""])
def test_similar_patterns(spark, session, pattern):
    values = ["FBti", "FBtr", "FBt", "abc", "a_c", "a\nc", "abbc", "xyxz", "1.5", "1x5", "50%", "50x", "a_b", "axb", "x", "^x$", ""]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    df.createOrReplaceTempView("anno_values")
    got = {r.v for r in spark.sql("SELECT v FROM anno_values WHERE v RLIKE anno_similar_pattern(:p)", args={"p": pattern}).collect()}
    assert got == {r.v for r in df.filter(X.similar_to("v", pattern)).collect()}
