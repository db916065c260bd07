"""S2-S12 on real files in a fresh scratch folder."""
import os
import tempfile

import pytest

from annomart.sources import files, sinks
from annomart.sources.lines import numbered_lines, ordered_lines


def _scratch():
    return tempfile.mkdtemp(prefix="annomart-files-", dir="/tmp")


def _write(root, name, text):
    p = os.path.join(root, name)
    with open(p, "w") as fh:
        fh.write(text)
    return p


def test_readers(spark):
    root = _scratch()
    ids = files.read_id_list(spark, _write(root, "ids.txt", "FBgn0000001\n\n  FBgn0000002 \nFBgn0000001\n"))
    assert sorted(r.submitted_id for r in ids.collect()) == ["FBgn0000001", "FBgn0000001", "FBgn0000002"]

    locs = files.read_locations(spark, _write(root, "loc.txt", "3L:37,238..59,593\nbad line\n2R:5..9\n"))
    got = sorted((r.scaffold, r.fmin, r.fmax, r.location) for r in locs.collect())
    assert got == [("2R", 5, 9, "2R:5..9"), ("3L", 37238, 59593, "3L:37,238..59,593")]

    dat = ("ID   1.1.1.1\nDE   Alcohol dehydrogenase.\nCA   A + B =\nCA   C + D.\n//\n"
           "ID   1.1.1.2\nDE   Deleted entry.\n//\n")
    recs = files.read_enzyme_records(spark, _write(root, "enzyme.dat", dat))
    got = sorted((r.id, r.field, r.rank, r.value) for r in recs.filter("field <> 'ID'").collect())
    assert got == [("1.1.1.1", "CA", 0, "A + B = C + D."), ("1.1.1.1", "DE", 0, "Alcohol dehydrogenase."),
                   ("1.1.1.2", "DE", 0, "Deleted entry.")]

    classes = files.read_enzyme_classes(spark, _write(root, "enzclass.txt", "1. 1. 1.-    First.\nnoise\n1. 1. 1.-  Second.\n"))
    assert [(r.id, r.name) for r in classes.collect()] == [("1.1.1.-", "Second.")]

    summ = files.read_summary_tsv(spark, _write(root, "s.tsv", "# header\nFB:FBgn1\tw\tNo description available\nFB:FBgn2\ty\ttext\n"))
    assert sorted((r.fbgn, r.summary) for r in summ.collect()) == [("FBgn1", "No description available"),
                                                                   ("FBgn2", "text")]

    hits = files.read_hit_csv(spark, _write(root, "hits.csv", '/reports/FBsf0000012.html,3\n\n"/x,FBsf0000013",4\n'))
    assert sorted(r.path for r in hits.collect()) == ["/reports/FBsf0000012.html", "/x,FBsf0000013"]


def test_sinks_roundtrip(spark):
    root = _scratch()
    df = spark.createDataFrame([("FBgn1", None, 1, 0, 0, 0, 2), ("FBgn2", "y", 0, 0, 0, 0, 0)],
                               "uniquename string, symbol string, a long, b long, c long, d long, e long")
    out = os.path.join(root, "counts")
    sinks.write_tsv(df, out)
    text = "".join(open(os.path.join(out, f)).read() for f in sorted(os.listdir(out)) if f.endswith(".csv"))
    assert "FBgn1\t\\N\t1\t0\t0\t0\t2" in text
    back = files.read_counts_tsv(spark, out)
    assert sorted((r.uniquename, r.symbol, r.interactive_fly) for r in back.collect()) == [("FBgn1", None, 2),
                                                                                          ("FBgn2", "y", 0)]
    piv = spark.createDataFrame([("FBgn", 3, 4)], "data_class string, r1 long, r2 long")
    rep = os.path.join(root, "report")
    sinks.write_pivot_report(piv, rep)
    text = "".join(open(os.path.join(rep, f)).read() for f in sorted(os.listdir(rep)) if f.endswith(".csv"))
    assert text.splitlines()[0] == "#data_class\tr1\tr2"
    mart = sinks.write_mart(df, os.path.join(root, "mart"))
    assert spark.read.parquet(mart).count() == 2


def test_write_csv_header(spark):
    root = _scratch()
    df = spark.createDataFrame([("FBgn1", 2)], "fbid string, num_aspects long")
    out = os.path.join(root, "csv")
    sinks.write_csv(df, out)
    back = spark.read.option("header", "true").csv(out)
    assert back.columns == ["fbid", "num_aspects"] and back.count() == 1


def test_annotation_tables_have_explicit_schemas(spark, tmp_path):
    from annomart.queries import cat
    from annomart.sources.schema import COLUMNS, OPTIONAL, table_schema
    from annomart.sources.tables import jdbc_options, read_annotation_tables
    c = cat(spark, "/root/testdata/sf0.001")
    for n in ("cvterm", "feature", "pub"):
        c[n].write.parquet(f"{tmp_path}/{n}.parquet")
    got = read_annotation_tables(spark, str(tmp_path), ["cvterm", "feature", "pub"])
    for n, df in got.items():
        assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in table_schema(n)]
        assert df.exceptAll(c[n].select(*df.columns)).count() == 0
    for n in COLUMNS:                                   # the derived views have these columns
        have = {f.name: f.dataType for f in c[n].schema}
        assert all(have.get(f.name) == f.dataType for f in table_schema(n) if (n, f.name) not in OPTIONAL), n
    opts = jdbc_options({"url": "jdbc:x", "lowerBound": 1, "upperBound": 9, "numPartitions": 3}, "public.grp", "grp")
    assert opts["partitionColumn"] == "grp_id" and opts["dbtable"] == "public.grp"
    assert opts["customSchema"].startswith("grp_id BIGINT, uniquename STRING") and opts["customSchema"].endswith("is_obsolete BOOLEAN")


RECORDS = """ID   1.1.1.1
DE   First.
//
ID   1.1.1.2
DE   See http://example.org//
CA   A = B.
//
ID   1.1.1.3
DE   Old third.
// 
ID   1.1.1.1
DE   Second
DE   name.
//
ID   1.1.1.4
//x no end
DE   Open at the end.
"""


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("split", [1 << 20, 48])
def test_enzyme_records_of_several_files_in_order(spark, tmp_path, end, split):
    """Later records win, files by path, whatever the splits and line ends."""
    for name, text in (("b.dat", RECORDS), ("a.dat", "ID   1.1.1.1\nDE   From a.\n//\nID   1.1.1.5\nDE   Only in a.\n//\n"),
                       ("c.dat", "ID   1.1.1.3\nDE   New third.\n//\n" + "ID   9.9.9.9\nDE   Filler.\n//\n" * 40)):
        with open(f"{tmp_path}/{name}", "w", newline="") as f:
            f.write(text.replace("\n", end))
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", 0)
    try:
        lines = ordered_lines(spark, str(tmp_path))
        assert lines.rdd.getNumPartitions() > 20 if split < 100 else True
        got = {(r.id, r.field): r.value for r in files.read_enzyme_records(spark, str(tmp_path)).collect() if r.field != "ID"}
        number = sorted((r.path[-5:], r.line_number, r.value) for r in numbered_lines(spark, str(tmp_path)).collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == {("1.1.1.1", "DE"): "Second name.", ("1.1.1.2", "DE"): "See http://example.org//", ("1.1.1.2", "CA"): "A = B.",
                   ("1.1.1.3", "DE"): "New third.", ("1.1.1.4", "DE"): "Open at the end.", ("1.1.1.5", "DE"): "Only in a.", ("9.9.9.9", "DE"): "Filler."}
    assert [(n, v) for p, n, v in number if p == "b.dat"] == list(enumerate(RECORDS.splitlines(), 1))


def test_enzyme_classes_of_several_files_in_order(spark, tmp_path):
    for name, text in (("2.txt", "1. 1. 1.-  Last.\n"), ("1.txt", "1. 1. 1.-  First.\n1. 2. 1.-  Kept.\n" * 30)):
        with open(f"{tmp_path}/{name}", "w") as f:
            f.write(text)
    assert {r.id: r.name for r in files.read_enzyme_classes(spark, str(tmp_path)).collect()} == {"1.1.1.-": "Last.", "1.2.1.-": "Kept."}


def test_refused_lines_are_told(spark, tmp_path):
    texts = {"loc": "3L:37,238..59,593\n\nbad line\n2R:5..9\n2R:5-9\nX:1..99999999999999999999\n   \n",
             "sum": "# header\nFB:FBgn1\tw\ttext\nFBgn2\tonly two\n\nFBgn3\ta\tb\tc\n", "hit": '/r/FBsf0000012.html,3\n\n,4\n"",5\n"/x,FBsf0000013",4\n'}
    for name, text in texts.items():
        with open(f"{tmp_path}/{name}", "w") as f:
            f.write(text)
    made = {"loc": files.check_locations(spark, f"{tmp_path}/loc"), "sum": files.check_summary_tsv(spark, f"{tmp_path}/sum"),
            "hit": files.check_hit_csv(spark, f"{tmp_path}/hit")}
    for name, c in made.items():
        lines = texts[name].splitlines()
        refused = {r.line_number: (r.value, r.reason) for r in c.refused.collect()}
        assert c.accepted.count() + len(refused) == len(lines)
        assert all(lines[n - 1] == v for n, (v, _) in refused.items())
    reasons = {k: {r.line_number: r.reason for r in c.refused.collect()} for k, c in made.items()}
    assert reasons["loc"] == {2: "blank line", 3: "not scaffold:min..max", 5: "not scaffold:min..max", 6: "number out of range", 7: "blank line"}
    assert reasons["sum"] == {1: "comment", 3: "2 columns instead of 3", 4: "blank line", 5: "4 columns instead of 3"}
    assert reasons["hit"] == {2: "blank line", 3: "no first column", 4: "no first column"}
    assert sorted(r.path for r in made["hit"].accepted.collect()) == ["/r/FBsf0000012.html", "/x,FBsf0000013"]
    assert sorted((r.scaffold, r.fmin, r.fmax) for r in made["loc"].accepted.collect()) == [("2R", 5, 9), ("3L", 37238, 59593)]
    with pytest.raises(Exception, match="line 3 .not scaffold"):
        files.read_locations(spark, f"{tmp_path}/loc", strict=True).count()
    with pytest.raises(Exception, match="2 columns instead of 3"):
        files.read_summary_tsv(spark, f"{tmp_path}/sum", strict=True).select("fbgn").collect()
    with open(f"{tmp_path}/good", "w") as f:
        f.write("2R:5..9\n\n3L:1..2\n")
    assert files.read_locations(spark, f"{tmp_path}/good", strict=True).count() == 2      # blank lines do not stop it
