from pyspark.sql import functions as F

from annomart.functions import exprs as X
from annomart.plans.relationships import diopt_score


def one(spark, col, value, schema="s string"):
    return spark.createDataFrame([(value,)], schema).select(col.alias("r")).first()["r"]


def test_data_class(spark):
    assert one(spark, X.data_class("s"), "fbGN0000490") == "FBgn"
    assert one(spark, X.data_class("s"), "FB") == "FB"


def test_id_pattern_rejects_trailing_newline(spark):
    df = spark.createDataFrame([("FBgn0000001",), ("FBgn0000001\n",), ("FBgn00x1",), ("FBal0000001",)], "s string")
    got = [r.s for r in df.filter(X.is_id_of("s", "FBgn")).collect()]
    assert got == ["FBgn0000001"]
    assert X.id_pattern(["FBgn", "FBal"]) == "^FB(gn|al)[0-9]+\\z"


def test_similar_to_translation(spark):
    assert X.similar_to_regex("FBti|FBtr") == "\\A(?:FBti|FBtr)\\z"
    df = spark.createDataFrame([("has_reg_region",), ("tagged_with",), ("xhas_reg",), ("tagged_wit",)], "s string")
    got = sorted(r.s for r in df.filter(X.similar_to("s", "has_reg%|tagged_wit_")).collect())
    assert got == ["has_reg_region", "tagged_with"]
    # literal alternation uses isin
    assert sorted(r.s for r in df.filter(X.similar_to("s", "tagged_with|nope")).collect()) == ["tagged_with"]


def test_evidence(spark):
    df = spark.createDataFrame([("Inferred from direct assay",), ("inferred from direct assay",),
                                ("inferred from electronic annotation",)], "s string")
    ci = [r.s for r in df.filter(X.is_evidence_experimental("s")).collect()]
    cs = [r.s for r in df.filter(X.is_evidence_experimental("s", case_sensitive=True)).collect()]
    assert len(ci) == 2 and cs == ["inferred from direct assay"]


def test_word_boundary(spark):
    df = spark.createDataFrame([("CEC",), ("xCEC",), ("IEA; CEA",), ("CEAx",)], "s string")
    assert sorted(r.s for r in df.filter(X.has_word("s", ["CEC", "CEA"])).collect()) == ["CEC", "IEA; CEA"]


def test_parse_location(spark):
    df = spark.createDataFrame([(" 3L:37,238..59593 ",), ("junk",), ("2R:1..x",)], "s string")
    sc, lo, hi = X.parse_location("s")
    rows = df.select(sc.alias("a"), lo.alias("b"), hi.alias("c")).collect()
    assert (rows[0].a, rows[0].b, rows[0].c) == ("3L", 37238, 59593)
    assert rows[1].a is None and rows[2].b is None


def test_replace_first_and_split_part(spark):
    assert one(spark, X.replace_first("s", "FB:"), "FB:FBgn1 FB:") == "FBgn1 FB:"
    assert one(spark, X.split_part("s", "\t", 3), "a\tb") is None
    assert one(spark, X.list_size("s", ", "), None) is None


def test_diopt_score(spark):
    df = spark.createDataFrame([("diopt methods: A, B, C\nnext line",), ("Diopt methods: A",),
                                ("note; diopt methods: A",), ("diopt methods: X",)], "value string")
    assert [r.s for r in df.select(diopt_score().alias("s")).collect()] == [3, None, None, 1]


def test_selected_summary(spark):
    df = spark.createDataFrame([(0, 0, 5, 5, 0, 1), (0, 2, 0, 0, 1, 1), (0, 0, 0, 0, 0, 0)],
                               "a int, b int, c int, d int, e int, f int")
    got = [r.s for r in df.select(X.selected_summary("a", "b", "c", "d", "e", "f").alias("s")).collect()]
    assert got == ["Alliance Gene Description", "UniProt Function", "Automatic summary"]


def test_similar_to_operators_and_newlines(spark):
    df = spark.createDataFrame([(x,) for x in ("aab", "ab", "b", "a+b", "a\nb", "xyz", "x[z", "a.b")], "s string")
    hits = lambda p: {r.s for r in df.filter(X.similar_to("s", p)).collect()}
    assert hits("a+b") == {"aab", "ab"} and hits("a*b") == {"aab", "ab", "b"} and hits("a?b") == {"ab", "b"}
    assert hits("a%b") == {"aab", "ab", "a+b", "a\nb", "a.b"} and hits("a_b") == {"aab", "a+b", "a\nb", "a.b"}
    assert hits("x[xyz]z") == {"xyz"} and hits("a{2}b") == {"aab"} and hits("a\\+b") == {"a+b"} and hits("(x|a).b") == {"a.b"}


def test_replace_first_after_a_newline(spark):
    df = spark.createDataFrame([("one\ntwo two",)], "s string")
    assert df.select(X.replace_first("s", "two", "2")).first()[0] == "one\n2 two"
