from fixtures import FEATURE, catalog

from annomart.operators.keys import check_fk, check_unique, first_per_key
from annomart.plans import reports


def _release(spark, feats, strains):
    empty_loc = spark.createDataFrame([], "feature_id long, srcfeature_id long, fmin long, fmax long")
    pub = spark.createDataFrame([(1, "FBrf0000001", None, 10, False)],
                                "pub_id long, uniquename string, miniref string, type_id long, is_obsolete boolean")
    cat = catalog(spark, feature=spark.createDataFrame(feats, FEATURE), featureloc=empty_loc, pub=pub,
                  strain=spark.createDataFrame(strains, "strain_id long, uniquename string, is_obsolete boolean"),
                  interaction_group=spark.createDataFrame([], "uniquename string, is_obsolete boolean"),
                  cell_line=spark.createDataFrame([], "cell_line_id long, uniquename string"),
                  grp=spark.createDataFrame([], "grp_id long, uniquename string, is_analysis boolean, is_obsolete boolean"))
    return cat


def test_class_counts_pivot(spark):
    r1 = _release(spark, [(1, "FBgn0000001", "a", 5, 1, False, False), (2, "FBal0000002", "b", 9, 1, False, False),
                          (3, "FBog0000003", "c", 5, 1, False, False), (4, "FBsn0000004", "d", 5, 1, False, False)],
                  [(1, "FBsn0000009", False), (2, "FBsn0000010", False)])
    r2 = _release(spark, [(1, "FBgn0000001", "a", 5, 1, False, False), (5, "FBgn0000005", "e", 5, 1, False, True)],
                  [])
    got = {r.data_class: (r.r1, r.r2) for r in reports.data_class_counts({"r1": r1, "r2": r2}).collect()}
    assert got["FBgn"] == (1, 1)
    assert got["FBal"] == (1, 0)          # absent in a release -> 0
    assert "FBog" not in got              # excluded prefix
    assert got["FBsn"] == (2, 0)          # dedicated count replaces the feature count
    assert got["FBrf"] == (1, 1)


def test_first_per_key_and_checks(spark):
    df = spark.createDataFrame([("a", 3, "x"), ("a", 1, "y"), ("b", 2, "z"), (None, 5, "n")], "k string, o int, v string")
    got = sorted((r.k or "", r.v) for r in first_per_key(df, ["k"], ["o"]).collect())
    assert got == [("", "n"), ("a", "y"), ("b", "z")]
    dup = {(r.key, r.n_violations) for r in check_unique(df, ["k"], "t").collect()}
    assert dup == {("a", 2), ("<null>", 1)}
    assert check_unique(df.filter("k is not null"), ["k"], "t", primary=False).count() == 1
    parent = spark.createDataFrame([("a",)], "k string")
    orphans = {(r.key, r.n_violations) for r in check_fk(df, ["k"], parent, ["k"], "t").collect()}
    assert orphans == {("b", 1)}
