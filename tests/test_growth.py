"""What keeps the shared steps of the marts small: rows that meet distinct
links, symbols of the classes that are looked up."""

import re

from pyspark.sql import functions as F

from annomart.operators.lookups import symbols_by_name
from annomart.plans import gene_marts as gm

from fixtures import FEATURE, catalog

EDGE = "feature_relationship_id long, subject_id long, object_id long, type_id long, rank long, value string"
LINK = "feature_id long, synonym_id long, is_current boolean, is_internal boolean"


def small(spark):
    """Construct 2 and allele 1 with parallel edges; two features named FBto1."""
    def feature(i, name, obsolete=False):
        return (i, name, name, 5, 202, False, obsolete)

    terms = [(2, 2, "associated_with"), (3, 3, "symbol"), (6, 2, "has_reg_region"), (7, 2, "encodes_tool"), (8, 2, "producedby"),
             (10, 2, "encodes_tool"), (11, 1, "tool_uses")]
    return catalog(
        spark,
        cvterm=spark.createDataFrame([(i, cv, n, 0, 100 + i) for i, cv, n in terms],
                                     "cvterm_id long, cv_id long, name string, is_obsolete long, dbxref_id long"),
        feature=spark.createDataFrame([feature(1, "FBal1"), feature(2, "FBtp1"), feature(3, "FBto1"), feature(4, "FBto1"), feature(5, "FBti1"),
                                       feature(6, "FBto2", True), feature(7, "FBgn1")], FEATURE),
        feature_relationship=spark.createDataFrame(
            [(k, s, o, t, 0, None) for k, (s, o, t) in enumerate([
                (1, 2, 2), (1, 2, 2), (5, 2, 8), (5, 2, 8),             # the construct, twice from each side
                (2, 3, 7), (2, 4, 7), (2, 3, 10), (2, 6, 7), (2, 7, 6),     # tools of the construct; one is obsolete
                (1, 3, 7), (1, 3, 7)])], EDGE),
        feature_synonym=spark.createDataFrame([(3, 31, True, False), (4, 30, True, False), (3, 32, True, False), (7, 33, True, False),
                                               (2, 34, False, False)], LINK),
        synonym=spark.createDataFrame([(i, f"n{i}", f"s{i}", 3) for i in range(30, 35)],
                                      "synonym_id long, name string, synonym_sgml string, type_id long"))


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def above_union(df) -> list[str]:
    """Names of the plan's nodes above its union."""
    out, node = [], df._jdf.queryExecution().optimizedPlan()
    while node.nodeName() != "Union":
        out.append(node.nodeName())
        node = node.children().apply(0)
    return out


def test_constructs_and_tools_of_parallel_edges(spark):
    c = small(spark)
    alleles = spark.createDataFrame([("r1", "FBal1"), ("r1", "FBal1"), ("r2", "FBal1")], "id string, fbal_id string")
    ins = spark.createDataFrame([("i1", "FBti1"), ("i1", "FBti1")], "id string, fbti_id string")
    cons = gm.construct(c, ins, alleles)
    assert rows(cons) == [("FBtp1", None, "i1", None, "FBtp1|i1|"), ("FBtp1", None, None, "r1", "FBtp1||r1"),
                          ("FBtp1", None, None, "r2", "FBtp1||r2")]
    tools = gm.tool(c, cons, alleles)
    got = rows(tools.select("fbid", "symbol", "rel_type", "construct_id", "allele_id"))
    # the lowest feature named FBto1 and its lowest synonym give the symbol
    want = [(f, s, r, k, None) for k in ("FBtp1||r1", "FBtp1||r2", "FBtp1|i1|")
            for f, s, r in (("FBto1", "s31", "encodes_tool"), ("FBgn1", "s33", "has_reg_region"))]
    assert got == sorted(want + [("FBto1", "s31", "encodes_tool", None, r) for r in ("r1", "r2")], key=str)
    # rows and links are made distinct before they meet, not what they make together
    assert "Aggregate" not in above_union(cons) + above_union(tools)


def test_tool_uses_are_terms_of_a_name_once(spark):
    c = small(spark)
    c.override("feature_cvterm", spark.createDataFrame([(1, 3, 11), (2, 4, 11), (3, 3, 11)], "feature_cvterm_id long, feature_id long, cvterm_id long"))
    c.override("feature_cvtermprop", spark.createDataFrame([(1, 11), (2, 11), (3, 11), (3, 11)], "feature_cvterm_id long, type_id long"))
    c.override("dbxref", spark.createDataFrame([(111, 2, "0011")], "dbxref_id long, db_id long, accession string"))
    alleles = spark.createDataFrame([], "id string, fbal_id string")
    cons = spark.createDataFrame([], "id string, fbtp_id string")
    tools = spark.createDataFrame([("t1", "FBto1"), ("t2", "FBto1"), ("t2", "FBto1")], "id string, fbid string")
    out = gm.tool_use(c, alleles, cons, tools)
    assert rows(out) == [("tool_uses", "GO:0011", None, None, "t1"), ("tool_uses", "GO:0011", None, None, "t2")]
    plan = out._jdf.queryExecution().optimizedPlan()
    assert plan.nodeName() != "Aggregate"


def test_symbols_of_some_classes(spark):
    c = small(spark)
    assert rows(symbols_by_name(c)) == [("FBgn1", "s33"), ("FBto1", "s31")]
    some = symbols_by_name(c, ["FBto"])
    assert rows(some) == [("FBto1", "s31")]
    assert str(some._jdf.queryExecution().optimizedPlan()).count("Aggregate") == 1


def test_diseases_of_a_gene_meet_its_members_last(spark):
    from annomart.plans.groups import pathway_disease
    c = small(spark)
    c.override("cvterm", c["cvterm"].unionAll(spark.createDataFrame(
        [(50, 4, "evidence_code", 0, 150), (51, 4, "qualifier", 0, 151), (60, 4, "flu", 0, 160)], c["cvterm"].schema)))
    c.override("dbxref", spark.createDataFrame([(160, 3, "77")], "dbxref_id long, db_id long, accession string"))
    c.override("feature_cvterm", spark.createDataFrame([(1, 7, 60), (2, 1, 60), (3, 1, 60)], "feature_cvterm_id long, feature_id long, cvterm_id long"))
    c.override("feature_cvtermprop", spark.createDataFrame([(1, 50, "IEA"), (2, 50, "CEA"), (3, 50, "CEA"), (3, 51, "model of")],
                                                           "feature_cvterm_id long, type_id long, value string"))
    members = spark.createDataFrame([("FBgn1", "m1"), ("FBgn1", "m2"), ("FBgn1", "m2"), ("FBgn9", "m3")], "fbgn_id string, id string")
    alleles = spark.createDataFrame([(7, "FBal1"), (7, "FBal1"), (8, "FBal1")], "gene_id long, fbal_id string")
    out = pathway_disease(c, members, alleles)
    assert rows(out) == sorted([("FBgn1", "DOID:77", "flu", q, e, m) for m in ("m1", "m2")
                                for q, e in ((None, False), (None, True), ("model of", True))], key=str)
    assert out._jdf.queryExecution().optimizedPlan().nodeName() != "Aggregate"


def test_marts_are_derived_together_and_shared_ones_once(spark):
    import threading
    c = small(spark)
    both, built = threading.Barrier(2), []

    def shared():
        built.append(1)
        return spark.range(3)

    def mart(n):
        both.wait(timeout=60)           # alone it would wait in vain
        return c.derived("shared", shared).withColumn("n", F.lit(n))

    got = c.derived_all({f"m{n}": lambda n=n: mart(n) for n in (1, 2)})
    assert {n: rows(df) for n, df in got.items()} == {f"m{n}": [(i, n) for i in range(3)] for n in (1, 2)}
    assert built == [1]


def test_gene_alleles_take_names_from_the_written_mart(spark):
    from annomart.plans.relationships import gene_allele
    c = small(spark)
    terms = [(20, 2, "alleleof", 0, 120), (21, 2, "allele", 0, 121), (22, 2, "attributed_as_expression_of", 0, 122)]
    c.override("cvterm", c["cvterm"].unionAll(spark.createDataFrame(terms, c["cvterm"].schema)))
    c.override("feature", spark.createDataFrame([(1, "FBal1", "a", 21, 202, False, False), (7, "FBgn1", "g", 5, 202, False, False)], FEATURE))
    c.override("feature_relationship", spark.createDataFrame([(1, 1, 7, 20, 0, None), (2, 1, 7, 20, 1, None)], EDGE))
    c.override("cvtermprop", spark.createDataFrame([], "cvterm_id long, type_id long, value string"))
    c.override("feature_cvterm", spark.createDataFrame([], "feature_cvterm_id long, feature_id long, cvterm_id long"))
    names = spark.createDataFrame([("FBal1", "n", None, "s", "s<1>")] * 2 + [("FBal2", "x", None, None, None)],
                                  "id string, name string, name_sgml string, symbol string, symbol_sgml string")
    out = gene_allele(c, names)
    assert rows(out) == [("FBal1", "FBgn1", False, "FBal1", "n", None, "s", "s<1>")]


def test_construct_flags_are_of_alleles(spark):
    c = small(spark)
    c.override("cvterm", c["cvterm"].unionAll(spark.createDataFrame([(40, 4, "In vitro construct - x", 0, 140)], c["cvterm"].schema)))
    c.override("cvtermprop", spark.createDataFrame([(40, None, "origin_of_mutation")], "cvterm_id long, type_id long, value string"))
    c.override("feature_cvterm", spark.createDataFrame([(1, 7, 40), (2, 1, 40)], "feature_cvterm_id long, feature_id long, cvterm_id long"))
    assert set(rows(gm._construct_flag_names(c))) == {("FBal1",)}


def test_combinations_are_written_once(spark):
    from annomart import queries
    c, calls = small(spark), []

    class Marts:
        @staticmethod
        def split_system_combination(cat):
            calls.append(1)
            return spark.range(2)

    assert rows(queries._combinations(c, Marts)) == rows(queries._combinations(c, Marts)) == [(0,), (1,)]
    assert calls == [1]


def test_member_rows_meet_their_gene_last(spark, tmp_path):
    """No member row passes the joins of the enrichments."""
    from annomart.plans import groups
    from annomart.sources.tables import Catalog
    base = {
        "region": ([(0, "R")], "r_regionkey int, r_name string"),
        "nation": ([(0, "N", 0), (24, "H", 0)], "n_nationkey int, n_name string, n_regionkey int"),
        "part": ([(i, f"bolt {i}", f"Brand#{i % 5}", "LARGE", i) for i in range(40)],
                 "p_partkey long, p_name string, p_brand string, p_type string, p_size int"),
        "supplier": ([(i, f"S{i}") for i in range(12)], "s_suppkey long, s_name string"),
        "customer": ([(i, 24) for i in range(10)], "c_custkey long, c_nationkey int"),
        "orders": ([(i, i % 10, "PFO"[i % 3], "5-LOW") for i in range(60)],
                   "o_orderkey long, o_custkey long, o_orderstatus string, o_orderpriority string"),
        "lineitem": ([(i % 60, i % 40, i % 12, i % 7 + 1, "ANR"[i % 3]) for i in range(300)],
                     "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_returnflag string"),
        "documents": ([(i, "x", "en", "web") for i in range(60)], "doc_id long, text string, lang string, source string"),
    }
    for n, (data, schema) in base.items():
        spark.createDataFrame(data, schema).coalesce(1).write.parquet(f"{tmp_path}/{n}.parquet")
    c = Catalog(spark, str(tmp_path))
    alleles = spark.createDataFrame([(1 + 32 * g, f"FBal{k}", None, False) for g in range(40) for k in (3, 1, 2)],
                                    "gene_id long, fbal_id string, symbol string, is_construct boolean")
    out = groups.pathway_member(c, alleles)
    node = out._jdf.queryExecution().optimizedPlan()
    while node.nodeName() != "Join":
        node = node.children().apply(0)
    side = node.children().apply(0)
    while side.children().size():
        assert side.nodeName() != "Join"
        side = side.children().apply(0)
    found = out.collect()
    assert found and {r["antibody"] for r in found} == {True, False}
    assert any(r["pathway_pubs"] for r in found)
    lists = [[a["id"] for a in r["classical_alleles"] or []] for r in found]
    assert any(lists) and all(x in ([], ["FBal1", "FBal2", "FBal3"]) for x in lists)


def test_tool_rows_are_dealt_once(spark):
    """Making rows distinct and joining them by name take one shuffle."""
    c = small(spark)
    c.override("feature_cvterm", spark.createDataFrame([(1, 3, 11)], "feature_cvterm_id long, feature_id long, cvterm_id long"))
    c.override("feature_cvtermprop", spark.createDataFrame([(1, 11)], "feature_cvterm_id long, type_id long"))
    c.override("dbxref", spark.createDataFrame([(111, 2, "0011")], "dbxref_id long, db_id long, accession string"))
    table = spark.createDataFrame([("r1", "x")], "id string, name string")
    cons, al, tools = (table.withColumnRenamed("name", n) for n in ("fbtp_id", "fbal_id", "fbid"))
    for df in (gm.tool(c, cons, al), gm.tool_use(c, al, cons, tools)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "REPARTITION_BY_COL" in plan
        # no shuffle deals rows by their id
        assert not re.search(r"hashpartitioning\([^)]*(construct|allele|tool)_id#", plan)


def test_mutagen_annotations_are_found_before_alleles(spark):
    """Annotations of other terms are not shuffled; of an accession the lowest id and name of a row's allele."""
    c = small(spark)
    terms = [(40, 4, "ems", 0, 140), (41, 4, "a ray", 0, 141), (42, 4, "other", 0, 142)]
    c.override("cvterm", c["cvterm"].unionAll(spark.createDataFrame(terms, c["cvterm"].schema)))
    c.override("cvtermprop", spark.createDataFrame([(i, None, v) for i, v in ((40, "origin_of_mutation"), (41, "origin_of_mutation"), (42, "x"))],
                                                   "cvterm_id long, type_id long, value string"))
    c.override("dbxref", spark.createDataFrame([(140, 2, "7"), (141, 2, "7"), (142, 2, "8")], "dbxref_id long, db_id long, accession string"))
    c.override("feature_cvterm", spark.createDataFrame([(1, 1, 40), (2, 1, 41), (3, 1, 42), (4, 7, 40), (5, 1, 40), (6, 1, None)],
                                                       "feature_cvterm_id long, feature_id long, cvterm_id long"))
    alleles = spark.createDataFrame([("r1", "FBal1"), ("r1", "FBal1"), ("r2", "FBal1"), ("r3", "FBal9"), ("r4", None)], "id string, fbal_id string")
    out = gm.allele_mutagen(c, alleles)
    assert rows(out) == [("r1", "GO:7", "a ray"), ("r2", "GO:7", "a ray")]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "rightHint=(strategy=broadcast)" in plan


def test_generation1_marts_are_derived_together(spark, monkeypatch):
    """A mart that others read is built once, whichever asks first."""
    from annomart import queries
    from annomart.plans import build
    c, built = small(spark), []

    def mart(name, *needs):
        def make(m):
            for n in needs:
                assert m[n].count() == 2
            built.append(name)
            return spark.range(2)
        return name, make

    monkeypatch.setattr(queries, "cat", lambda spark, sf_dir: c)
    monkeypatch.setattr(c, "stage_all", lambda names: None)
    together = []
    monkeypatch.setattr(c, "derived_all", lambda builders, real=c.derived_all: together.append(sorted(builders)) or real(builders))
    monkeypatch.setattr(build, "generation1", lambda cat: [mart("gene"), mart("allele"), mart("insertion", "allele"), mart("tool", "insertion", "allele")])
    monkeypatch.setattr(build, "generation1_key_checks", lambda marts: marts)
    found = queries.q_key_checks_generation1(spark, "")
    assert set(found) == {"gene", "allele", "insertion", "tool"} and sorted(built) == ["allele", "gene", "insertion", "tool"]
    assert together == [["gene_allele_rows", "insertion", "mart1:gene", "tool"]]


def test_a_result_is_not_written_beside_itself(spark):
    c, built = small(spark), []
    make = lambda: built.append(1) or spark.range(3)
    assert c.result("t", make).inputFiles() == [] and c.result("t", make).count() == 3
    written = c.derived("t", make)
    assert c.result("t", make) is written and len(written.inputFiles()) and len(built) == 3
