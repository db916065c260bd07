from fixtures import FEATURE, catalog

from annomart.operators.ids import update_ids
from annomart.operators.lookups import current_synonym, related_features, stocks


def _features(spark):
    return spark.createDataFrame([
        (1, "FBgn0000001", "g1", 5, 1, False, False),
        (2, "FBgn0000002", "g2", 5, 1, False, True),     # obsolete
        (3, "FBgn0000003", "g3", 5, 1, False, False),
        (4, "FBgn0000004", "g4", 5, 1, False, False),
        (5, "FBal0000005", "a5", 9, 1, False, False),
        (6, "FBal0000006", "a6", 9, 1, False, True),     # obsolete allele
        (7, "FBgn0000007", "g7", 5, 1, False, False),
    ], FEATURE)


def test_update_ids_cases(spark):
    dbxref = spark.createDataFrame([
        (10, 1, "FBgn0000002", None),   # obsolete id, secondary of 3 -> updated
        (11, 1, "FBgn0000099", None),   # secondary of 3 and 4 -> split
        (12, 1, "FBgn0000098", None),   # secondary of an allele only -> class differs -> unknown
        (13, 2, "FBgn0000097", None),   # other db -> unknown
    ], "dbxref_id long, db_id long, accession string, description string")
    db = spark.createDataFrame([(1, "ANNOBASE", None), (2, "GO", None)], "db_id long, name string, urlprefix string")
    fdbx = spark.createDataFrame([
        (3, 10, False), (3, 11, False), (4, 11, False), (5, 12, False), (7, 13, False), (7, 10, True),
    ], "feature_id long, dbxref_id long, is_current boolean")
    cat = catalog(spark, feature=_features(spark), dbxref=dbxref, db=db, feature_dbxref=fdbx)
    ids = spark.createDataFrame([(i,) for i in ["FBgn0000001", "FBgn0000001", "FBgn0000002", "FBgn0000099",
                                                "FBgn0000098", "FBgn0000097", "FBgn0000123"]], "submitted_id string")
    got = sorted(tuple(r) for r in update_ids(cat, ids).collect())
    assert got == sorted([
        ("FBgn0000001", "FBgn0000001", "current"), ("FBgn0000001", "FBgn0000001", "current"),
        ("FBgn0000002", "FBgn0000003", "updated"),
        ("FBgn0000099", "FBgn0000003", "split"), ("FBgn0000099", "FBgn0000004", "split"),
        ("FBgn0000098", None, None), ("FBgn0000097", None, None), ("FBgn0000123", None, None),
    ])


def _names(spark):
    syn = spark.createDataFrame([
        (100, "s1", "s1<up>", 3), (101, "s1b", "s1b", 3), (102, "full1", "full1", 4),
        (103, "int", "int", 3), (104, "old", "old", 3),
    ], "synonym_id long, name string, synonym_sgml string, type_id long")
    fs = spark.createDataFrame([
        (1, 101, True, False), (1, 100, True, False),  # two current symbols: lowest id wins
        (1, 102, True, False), (3, 103, True, True),   # internal -> ignored
        (4, 104, False, False),                         # not current -> ignored
    ], "feature_id long, synonym_id long, is_current boolean, is_internal boolean")
    return syn, fs


def test_current_synonym(spark):
    syn, fs = _names(spark)
    cat = catalog(spark, feature=_features(spark), synonym=syn, feature_synonym=fs)
    ids = spark.createDataFrame([("FBgn0000001",), ("FBgn0000003",), ("FBgn0000004",), ("FBxx9",)], "id string")
    got = dict((r.id, r.symbol) for r in current_synonym(cat, ids, "id", "symbol").collect())
    assert got == {"FBgn0000001": "s1<up>", "FBgn0000003": None, "FBgn0000004": None, "FBxx9": None}
    full = dict((r.id, r.fullname) for r in current_synonym(cat, ids, "id", "fullname").collect())
    assert full["FBgn0000001"] == "full1"


def test_related_features_directions(spark):
    fr = spark.createDataFrame([
        (1000, 5, 1, 1, 0, None),   # FBal5 alleleof FBgn1
        (1001, 6, 1, 1, 0, None),   # obsolete allele -> dropped
        (1002, 5, 3, 2, 1, "v"),    # FBal5 associated_with FBgn3
        (1003, 2, 5, 1, 0, None),   # obsolete source FBgn2 -> allele still found from FBgn2's side
    ], "feature_relationship_id long, subject_id long, object_id long, type_id long, rank long, value string")
    syn, fs = _names(spark)
    cat = catalog(spark, feature=_features(spark), feature_relationship=fr, synonym=syn, feature_synonym=fs)
    ids = spark.createDataFrame([("FBgn0000001",), ("FBal0000005",), ("FBal0000005",)], "id string")
    sub = related_features(cat, ids, "id", "alleleof", "FBal", "subject").collect()
    assert [(r.id, r.uniquename, r.type) for r in sub] == [("FBgn0000001", "FBal0000005", "alleleof")]
    obj = related_features(cat, ids, "id", "alleleof|associated_with", None, "object").collect()
    got = sorted((r.id, r.uniquename, r.type, r.symbol) for r in obj)
    # duplicate input id -> duplicate results; obsolete target FBgn2 never appears
    assert got == sorted([("FBal0000005", "FBgn0000001", "alleleof", "s1<up>"),
                          ("FBal0000005", "FBgn0000001", "alleleof", "s1<up>"),
                          ("FBal0000005", "FBgn0000003", "associated_with", None),
                          ("FBal0000005", "FBgn0000003", "associated_with", None)])


def test_stocks_parse(spark):
    fp = spark.createDataFrame([
        (1, 5, 7, "12\t@FBst0000001:w[1]; x@\n13\t @FBst0000002:geno:extra@ \n14", 0),
    ], "featureprop_id long, feature_id long, type_id long, value string, rank long")
    cat = catalog(spark, feature=_features(spark), featureprop=fp)
    ids = spark.createDataFrame([("FBal0000005",)], "id string")
    key = lambda t: tuple("" if v is None else v for v in t)
    got = sorted((tuple(r) for r in stocks(cat, ids, "id").collect()), key=key)
    assert got == sorted([
        ("FBal0000005", "FBst0000001", "Bloomington", "12", "w[1]; x"),
        ("FBal0000005", "FBst0000002", "Bloomington", "13", "geno"),
        ("FBal0000005", None, "Bloomington", "14", None),
    ], key=key)


def test_gene_disease_literal_vs_intended_join(spark):
    """The reference's parent-gene join accepts any relation type."""
    from annomart.plans.relationships import gene_disease
    feats = spark.createDataFrame([
        (1, "FBgn0000001", "g1", 5, 1, False, False),
        (5, "FBal0000005", "a5", 9, 1, False, False),
        (6, "FBal0000006", "a6", 9, 1, False, False),
    ], FEATURE)
    fr = spark.createDataFrame([(1000, 5, 1, 1, 0, None),   # a5 alleleof g1
                                (1001, 6, 1, 2, 0, None)],  # a6 associated_with g1 (not alleleof)
                               "feature_relationship_id long, subject_id long, object_id long, type_id long, rank long, value string")
    cvterm = spark.createDataFrame([
        (1, 2, "alleleof", 0, 101), (2, 2, "associated_with", 0, 102), (20, 4, "disease x", 0, 120),
        (30, 1, "evidence_code", 0, 130), (31, 1, "qualifier", 0, 131),
    ], "cvterm_id long, cv_id long, name string, is_obsolete long, dbxref_id long")
    dbxref = spark.createDataFrame([(120, 3, "0000042", None)], "dbxref_id long, db_id long, accession string, description string")
    fc = spark.createDataFrame([(1, 5, 20, False), (2, 6, 20, False)], "feature_cvterm_id long, feature_id long, cvterm_id long, is_not boolean")
    fcp = spark.createDataFrame([(1, 30, "CEA", 0), (2, 30, "IEA", 0), (2, 31, "model of x", 0)],
                                "feature_cvterm_id long, type_id long, value string, rank long")
    cat = catalog(spark, feature=feats, feature_relationship=fr, cvterm=cvterm, dbxref=dbxref,
                  feature_cvterm=fc, feature_cvtermprop=fcp)
    literal = sorted(tuple(r) for r in gene_disease(cat).collect())
    intended = sorted(tuple(r) for r in gene_disease(cat, literal_joins=False).collect())
    assert literal == [("FBgn0000001", "DOID:0000042", False, "model of x"), ("FBgn0000001", "DOID:0000042", True, "")]
    assert intended == [("FBgn0000001", "DOID:0000042", True, "")]


def test_similar_type_resolution(spark):
    """Property lookups match type names like SIMILAR TO: '_' is any character."""
    from annomart.operators import dims
    cvterm = spark.createDataFrame([(1, 1, "known_lesion", 0, 1), (2, 1, "knownXlesion", 0, 2),
                                    (3, 1, "known_lesions", 0, 3), (4, 1, "known_lesion", 1, 4)],
                                   "cvterm_id long, cv_id long, name string, is_obsolete long, dbxref_id long")
    cat = catalog(spark, cvterm=cvterm)
    assert sorted(dims.resolve_terms(cat, "known_lesion", live_only=True, similar=True)) == [1, 2]
    assert sorted(dims.resolve_terms(cat, "known_lesion")) == [1, 4]
