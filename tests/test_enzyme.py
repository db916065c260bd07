from fixtures import catalog

from annomart.plans import enzyme as ez

RECORDS = [
    "ID   1.1.1.1\nDE   Alcohol dehydrogenase.\nCA   (1) A primary alcohol + NAD(+) =\nCA   an aldehyde + NADH.\n"
    "CA   (2) A secondary alcohol 2.7.1.1 + NAD(+) = a ketone.\nCC   ignored\n",
    "ID   1.1.1.2\nDE   Transferred entry: 1.1.1.3.\n",
    "ID   1.1.1.4\n",
]
CLASSES = ["1. 1. 1.-    With NAD(+) or NADP(+) as acceptor.", "1. 2. -.-  Acting on aldehydes.",
           "header line", "1. 1. 1.-    Renamed."]


def test_parse_records_split_after_periods(spark):
    recs = spark.createDataFrame([(r,) for r in RECORDS], "value string")
    rows = {(r.id, r.field, r.rank): r.value for r in ez.parse_enzyme_records(recs).collect()}
    assert rows[("1.1.1.1", "DE", 0)] == "Alcohol dehydrogenase."
    # three CA lines joined, re-split after periods (inside numbers too)
    assert rows[("1.1.1.1", "CA", 0)] == "(1) A primary alcohol + NAD(+) = an aldehyde + NADH."
    assert rows[("1.1.1.1", "CA", 1)] == "(2) A secondary alcohol 2."
    assert ("1.1.1.4", "ID", 0) in rows


def test_parse_classes_last_wins(spark):
    lines = spark.createDataFrame([(i, l) for i, l in enumerate(CLASSES)], "n long, value string")
    got = {r.id: r.name for r in ez.parse_enzyme_classes(lines, order_col="n").collect()}
    assert got == {"1.1.1.-": "Renamed.", "1.2.-.-": "Acting on aldehydes."}


def test_extend_ec_fallbacks(spark):
    recs = ez.parse_enzyme_records(spark.createDataFrame([(r,) for r in RECORDS], "value string"))
    lines = spark.createDataFrame([(i, l) for i, l in enumerate(CLASSES)], "n long, value string")
    classes = ez.parse_enzyme_classes(lines, order_col="n")
    ecs = spark.createDataFrame([("1.1.1.1", 1), ("1.1.1.2", 2), ("1.1.1.-", 3), ("1.2", 4), ("9.9.9.9", 5),
                                 ("1.1.1.4", 6)], "ec string, dbxref_id long")
    out = ez.extend_ec(ecs, recs, classes).collect()
    by = {}
    for r in out:
        by.setdefault(r.dbxref_id, []).append((r.type, r.rank, r.value))
    assert 2 not in by                     # transferred: nothing, no class fallback
    assert by[3] == [("ec_class", 0, "Renamed.")]
    assert 5 not in by and 6 not in by     # miss; record with no fields emits nothing
    # the CA text splits after every period, inside "2.7.1.1" too: 5 pieces
    assert sorted(t for t, _, _ in by[1]) == ["ec_catalytic_activity"] * 5 + ["ec_description"]
    misses = [r.ec for r in ez.ec_misses(ecs, recs, classes).collect()]
    assert misses == ["9.9.9.9"] or sorted(misses) == ["1.2", "9.9.9.9"]


def test_ensure_terms_and_replace_props(spark):
    cvterm = spark.createDataFrame([(1, 7, "ec_description", 0, 1), (2, 7, "other_prop", 0, 2)],
                                   "cvterm_id long, cv_id long, name string, is_obsolete long, dbxref_id long")
    cv = spark.createDataFrame([(7, "dbxrefprop type")], "cv_id long, name string")
    old = spark.createDataFrame([(10, 1, "old description", 0), (10, 2, "kept", 0)],
                                "dbxref_id long, type_id long, value string, rank long")
    cat = catalog(spark, cvterm=cvterm, cv=cv, dbxrefprop=old)
    types = {r.name: r.cvterm_id for r in ez.ensure_terms(cat, list(ez.EC_PROPTYPES.values())).collect()}
    assert types["ec_description"] == 1                       # existing term reused
    assert len(set(types.values())) == 3 and all(v not in (2,) for v in types.values())
    again = {r.name: r.cvterm_id for r in ez.ensure_terms(cat, list(ez.EC_PROPTYPES.values())).collect()}
    assert again == types                                     # created ids are stable
    new = spark.createDataFrame([(10, "1.1.1.1", "ec_description", "new description", 0),
                                 (10, "1.1.1.1", "ec_class", "A class", 0)],
                                "dbxref_id long, ec string, type string, value string, rank long")
    out = sorted((r.type_id, r.value) for r in ez.replace_props(cat, new, ez.ensure_terms(cat, list(ez.EC_PROPTYPES.values()))).collect())
    assert out == sorted([(2, "kept"), (1, "new description"), (types["ec_class"], "A class")])


def test_last_of_repeated_records_wins(spark):
    recs = spark.createDataFrame([(1, "ID   1.1.1.1\nDE   Old.\nCA   x.\n"), (2, "ID   1.1.1.1\nDE   New.\n"), (3, "CC   no id\n")],
                                 "n long, value string")
    got = {(r.field, r.value, r.rank) for r in ez.parse_enzyme_records(recs, order_col="n").collect()}
    assert got == {("DE", "New.", 0), ("ID", "1.1.1.1", 0)}
