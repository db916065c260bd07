"""The mart build job, staging and publishing."""
import os
import shutil

import pytest
from pyspark.sql import functions as F

from annomart.operators.keys import check_all, check_fk, check_unique
from annomart.plans import build
from annomart.queries import cat
from annomart.sources import schema
from annomart.sources.tables import Catalog, annotation_catalog, publish
from fixtures import catalog

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("marts"))
    return out, build.build_marts(cat(spark, SF), out)


def test_build_writes_checks_and_publishes(spark, built):
    out, found = built
    assert set(os.listdir(f"{build.current(spark, out)}/gene")) - {"_SUCCESS"} == {n for n, _ in build.generation1(None)}
    assert len(os.listdir(f"{build.current(spark, out)}/dataclass")) == 12 and sorted(os.listdir(out)) == ["current", "versions"]
    bad = build.read_mart(spark, out, "checks", "_key_violations")
    assert {r["table"]: r["count"] for r in bad.groupBy("table").count().collect()} == found
    tools = build.read_mart(spark, out, "gene", "tool").filter("construct_id is not null")
    constructs = build.read_mart(spark, out, "gene", "construct").selectExpr("id as construct_id")
    assert tools.count() > 0 and tools.join(constructs, "construct_id", "left_anti").count() == 0


def test_real_tables_end_to_end(spark, built, tmp_path):
    """Annotation tables in files, nothing else beside them; the same marts."""
    derived, src, out = cat(spark, SF), f"{tmp_path}/tables", f"{tmp_path}/marts"
    for name, cols in schema.COLUMNS.items():
        df = derived[name]
        df.select(*[c for c in cols.split() if c in df.columns or (name, c) not in schema.OPTIONAL]).write.parquet(f"{src}/{name}.parquet")
    c = annotation_catalog(spark, src)
    for name in ("part", "lineitem", "submitted_ids", "type_terms"):
        with pytest.raises(KeyError):
            c[name]
    assert build.build_marts(c, out) == built[1]
    assert "is_obsolete" not in c["cell_line"].columns
    for kind in ("gene", "dataclass"):
        for name in os.listdir(f"{build.current(spark, out)}/{kind}"):
            a, b = (build.read_mart(spark, o, kind, name) for o in (out, built[0]))
            keys = lambda df: df.select(F.xxhash64(F.to_json(F.struct(*sorted(df.columns)))).alias("h")).groupBy("h").count()
            assert a.columns == b.columns and a.count() == b.count()
            assert keys(a).exceptAll(keys(b)).count() == 0, name


def test_tables_without_needed_columns_are_refused(spark, tmp_path):
    spark.range(3).selectExpr("id as stock_id").write.parquet(f"{tmp_path}/stock.parquet")
    with pytest.raises(ValueError, match="is_obsolete.*uniquename"):
        annotation_catalog(spark, str(tmp_path))["stock"]


def _version(spark, out, run, n):
    spark.range(n).write.parquet(f"{out}/versions/{run}/gene/t")


def test_readers_see_old_or_new_marts_wherever_a_build_dies(spark, tmp_path, monkeypatch):
    out = f"{tmp_path}/marts"
    assert build.current(spark, out) is None
    with pytest.raises(FileNotFoundError):
        build.read_mart(spark, out, "gene", "t")
    _version(spark, out, "one", 1)
    build.publish_version(spark, out, "one")
    rows = lambda: build.read_mart(spark, out, "gene", "t").count()
    real_fs = build._fs

    class Dies:                                                    # a file system that fails before or after a step
        def __init__(self, fs, step, after):
            self.fs, self.step, self.after = fs, step, after

        def __getattr__(self, name):
            def call(*args):
                if name == self.step and not self.after:
                    raise OSError(name)
                result = getattr(self.fs, name)(*args)
                if name == self.step:
                    raise OSError(name)
                return result
            return call

    for k, (step, after, n) in enumerate([("create", False, 1), ("create", True, 1), ("mkdirs", False, 1), ("mkdirs", True, 1),
                                          ("rename", False, 1), ("rename", True, 2)]):
        run = f"try{k}"
        _version(spark, out, run, 2)
        monkeypatch.setattr(build, "_fs", lambda s, p: (Dies(real_fs(s, p)[0], step, after), real_fs(s, p)[1]))
        with pytest.raises(OSError):
            build.publish_version(spark, out, run)
        monkeypatch.setattr(build, "_fs", real_fs)
        assert rows() == n
    _version(spark, out, "unfinished", 9)
    assert build.recover(spark, out, unfinished=False) == []
    assert rows() == 2 and len(build.recover(spark, out)) >= 6 and rows() == 2
    assert sorted(os.listdir(f"{out}/versions")) == ["one", "try5"]
    for k in range(3):                                             # older versions go, the last two stay
        _version(spark, out, f"new{k}", 3 + k)
        build.publish_version(spark, out, f"new{k}")
        build.recover(spark, out, unfinished=False)
    assert rows() == 5 and sorted(os.listdir(f"{out}/versions")) == ["new1", "new2"]
    with pytest.raises(OSError):
        build.publish_version(spark, out, "never-written")
    assert rows() == 5


def test_strict_build_publishes_nothing_when_keys_are_violated(spark, tmp_path, monkeypatch):
    out = f"{tmp_path}/marts"
    twice = spark.createDataFrame([("a",), ("a",)], "feature_id string")
    monkeypatch.setattr(build, "generation1", lambda c, b: [("gene", lambda m: twice)])
    monkeypatch.setattr(build.rel, "generation2", lambda c: {})
    monkeypatch.setattr(build.rel, "key_checks", lambda c, m: check_all({"gene": twice}, [("gene", ["feature_id"])], [], []))
    monkeypatch.setattr(build, "generation1_key_checks", lambda m: check_all(m, [("gene", ["feature_id"])], [], []))
    with pytest.raises(ValueError, match="violated keys"):
        build.build_marts(cat(spark, SF), out, strict=True)
    assert build.current(spark, out) is None
    assert build.build_marts(cat(spark, SF), out) == {"gene": 2} and build.current(spark, out)


MARTS = {"parent": "id string, code string", "child": "id string, parent_id string, code string, n long"}


def _planted(spark):
    return {"parent": spark.createDataFrame([("p1", "x"), ("p2", "x"), ("p2", "y|z"), (None, "q")], MARTS["parent"]),
            "child": spark.createDataFrame([("c1", "p1", "a|b", 1), ("c2", "p9", "a", 1), ("c3", "p9", "b", None), ("c4", None, None, 2),
                                            ("c4", "p2", None, 2), ("c5", "p2", "a", 1)], MARTS["child"])}


def test_every_kind_of_violation_is_found(spark):
    m = _planted(spark)
    rules = dict(unique=[("parent", ["id"]), ("child", ["code", "n"])], unique_or_null=[("child", ["code"]), ("child", ["id"])],
                 foreign=[("child", "parent_id", "parent", "id")])
    out = check_all(m, **rules)
    got = sorted(map(tuple, out.collect()))
    single = check_unique(m["parent"], ["id"], "parent").unionByName(check_unique(m["child"], ["code", "n"], "child"))
    single = single.unionByName(check_unique(m["child"], ["code"], "child", primary=False)).unionByName(
        check_unique(m["child"], ["id"], "child", primary=False)).unionByName(check_fk(m["child"], ["parent_id"], m["parent"], ["id"], "child.parent_id"))
    assert got == sorted(map(tuple, single.collect()))
    assert ("parent", "p2", 2) in got and ("parent", "<null>", 1) in got and ("child.parent_id", "p9", 2) in got and ("child", "c4", 2) in got
    assert ("child", "a|1", 2) in got and not any(t == "child.parent_id" and k in ("p1", "p2") for t, k, _ in got)
    # parts are compared one by one
    two = spark.createDataFrame([("a|b", "c"), ("a", "b|c")], "x string, y string")
    assert check_all({"t": two}, [("t", ["x", "y"])], [], []).count() == 0


def test_key_checks_scan_each_mart_once_and_shuffle_once(spark, tmp_path):
    m = {}
    for name, df in _planted(spark).items():
        df.write.parquet(f"{tmp_path}/{name}")
        m[name] = spark.read.parquet(f"{tmp_path}/{name}")
    plan = check_all(m, [("parent", ["id"]), ("child", ["id"])], [("child", ["code"])], [("child", "parent_id", "parent", "id")])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == 2 and text.count("Exchange") == 1 and "Join" not in text


def test_generation1_checks_find_planted_violations(spark, built):
    """One violation of each constraint, planted into the written marts."""
    out, _ = built
    marts = {n: build.read_mart(spark, out, "gene", n) for n, _ in build.generation1(None)}
    clean = {(r.table, r.key) for r in build.generation1_key_checks(marts).collect()}
    broken = dict(marts)
    for name, key in (("gene", "feature_id"), ("insertion", "id"), ("tool", "id"), ("pathway", "grp_id")):
        broken[name] = marts[name].unionByName(marts[name].limit(1))
    nobody = {c: F.lit("nobody") for c in ("allele_id", "construct_id", "tool_id")}
    broken["tool_use"] = marts["tool_use"].unionByName(marts["tool_use"].limit(1).withColumns(nobody))
    broken["pathway_disease"] = marts["pathway_disease"].unionByName(marts["pathway_disease"].limit(1).withColumn("pathway_member_id", F.lit("nobody")))
    new = {(r.table, r.key) for r in build.generation1_key_checks(broken).collect()} - clean
    assert {t for t, _ in new} == {"gene", "insertion", "tool", "pathway", "tool_use.allele_id", "tool_use.construct_id", "tool_use.tool_id",
                                   "pathway_disease.pathway_member_id"}
    assert sum(k == "nobody" for _, k in new) == 4


def test_publish_needs_a_complete_table(spark, tmp_path):
    df = spark.range(3)
    df.write.parquet(f"{tmp_path}/t.tmp")
    publish(spark, f"{tmp_path}/t.tmp", f"{tmp_path}/t")                 # a path without a scheme
    assert spark.read.parquet(f"{tmp_path}/t").count() == 3
    df.write.parquet(f"{tmp_path}/u.tmp")
    publish(spark, f"{tmp_path}/u.tmp", f"{tmp_path}/t")                 # the first one stays
    assert not os.path.exists(f"{tmp_path}/u.tmp")
    with pytest.raises(OSError):
        publish(spark, f"{tmp_path}/missing", f"{tmp_path}/v")


def test_changed_data_is_staged_again(spark, tmp_path):
    src = f"{tmp_path}/data"
    os.makedirs(src)
    for name in os.listdir(SF):                                    # contents only: the given files may be read-only
        shutil.copyfile(f"{SF}/{name}", f"{src}/{name}")
    first = Catalog(spark, src)
    n = first["ontology_terms"].count()
    part = spark.read.parquet(f"{src}/part.parquet").toPandas()
    os.remove(f"{src}/part.parquet")
    part.head(100).to_parquet(f"{src}/part.parquet")
    second = Catalog(spark, src)
    assert second._stage_root() != first._stage_root()
    assert second["ontology_terms"].count() == 10 < n


def test_composite_foreign_key_ignores_rows_with_a_null_part(spark):
    child = spark.createDataFrame([(1, "a"), (1, None), (None, "a"), (2, "b")], "x long, y string")
    parent = spark.createDataFrame([(1, "a")], "x long, y string")
    assert [tuple(r) for r in check_fk(child, ["x", "y"], parent, ["x", "y"], "t").collect()] == [("t", "2|b", 1)]


def test_every_line_item_is_in_the_derived_views(spark):
    c = cat(spark, SF)
    n = c["lineitem"].count()
    assert c["feature_cvterm"].count() == n and c["feature_grpmember"].count() == n and c["submitted_ids"].count() == n
    keys = c["lineitem"].selectExpr("l_orderkey * 8 + l_linenumber as k").distinct().count()
    edges = c["feature_relationship"].selectExpr("floor(feature_relationship_id / 32) as k", "feature_relationship_id % 32 as e")
    assert edges.filter("e = 11").select("k").distinct().count() == keys


def test_hops_follow_feature_ids(spark):
    """A second feature of the same name lends its edges to no other."""
    feature = spark.createDataFrame(
        [(1, "FBgn0000001", 1, False, False), (2, "FBtr0000001", 5, False, False), (3, "FBtr0000001", 5, True, True),
         (4, "FBal0000001", 2, False, False), (5, "FBtp0000001", 3, False, False), (6, "FBto0000001", 9, False, False)],
        "feature_id long, uniquename string, type_id long, is_analysis boolean, is_obsolete boolean")
    edge = lambda *rows: spark.createDataFrame(rows, "subject_id long, object_id long, type_id long")
    base = [(2, 1, 23), (4, 5, 22), (4, 6, 24)]
    for extra, n in (((3, 4, 22), 0), ((2, 4, 22), 1)):
        c = catalog(spark).override("feature", feature).override("feature_relationship", edge(*base, extra))
        for t, ddl in (("cvterm", "cvterm_id long, cv_id long, name string, is_obsolete long, dbxref_id long"),
                       ("cvtermprop", "cvterm_id long, type_id long, value string"),
                       ("feature_cvterm", "feature_cvterm_id long, feature_id long, cvterm_id long, is_not boolean"),
                       ("featureprop", "featureprop_id long, feature_id long, type_id long, value string, rank long"),
                       ("feature_synonym", "feature_id long, synonym_id long, is_current boolean, is_internal boolean"),
                       ("synonym", "synonym_id long, name string, synonym_sgml string, type_id long")):
            rows = []
            if t == "cvterm":
                rows = [(i, 6, x, 0, None) for i, x in ((1, "gene"), (20, "alleleof"), (21, "has_reg_region"), (22, "associated_with"),
                                                       (23, "attributed_as_expression_of"), (24, "encodes_tool"),
                                                       (61, "propagate_transgenic_uses"), (70, "symbol"))]
            c.override(t, spark.createDataFrame(rows, ddl))
        from annomart.plans import gene_marts as gm
        assert gm.allele(c, counters=False).count() == n
