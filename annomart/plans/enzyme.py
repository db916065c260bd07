"""Enzyme (EC) metadata enrichment: R5 EC numbers in use, S4/S5 file
parsing, R6 record/class lookup with ordered fallbacks, R7 replacement of
the EC property rows, R8 get-or-create of the property types."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import dims

# fixed values: file fields kept and the dbxrefprop type each one feeds
EC_PROPTYPES = {"DE": "ec_description", "CA": "ec_catalytic_activity", "class": "ec_class"}
# fixed values: records that must not be used
TRANSFERRED_OR_DELETED = r"^(Transferred|Deleted) entry"
# fixed value: layout of a class line in the nomenclature file
CLASS_LINE = r"^(\d.*?\.\-)\s+(.*)$"


def ec_numbers(cat) -> DataFrame:
    """EC accessions linked to a live ontology term: one row per dbxref
    (lowest term id wins), ``(ec, dbxref_id, accession, cv, cvname)``."""
    ec_db = cat["db"].filter(F.col("name") == "EC").select("db_id")
    ec = cat["dbxref"].join(ec_db, "db_id", "left_semi").select(F.col("accession").alias("ec"), "dbxref_id")
    terms = (cat["cvterm"].filter(F.col("is_obsolete") == 0)
             .select("cvterm_id", "cv_id", F.col("name").alias("cvname"), F.col("dbxref_id").alias("t_dbxref"))
             .join(cat["cv"].select("cv_id", F.col("name").alias("cv")), "cv_id")
             .join(cat["dbxref"].select(F.col("dbxref_id").alias("t_dbxref"), F.col("accession").alias("go")),
                   "t_dbxref"))
    rows = ec.join(cat["cvterm_dbxref"], "dbxref_id").join(terms, "cvterm_id")
    best = rows.groupBy("dbxref_id").agg(
        F.min_by(F.struct("ec", "go", "cv", "cvname"), F.col("cvterm_id")).alias("s"))
    return best.select(F.col("s.ec").alias("ec"), "dbxref_id", F.concat(F.lit("GO:"), "s.go").alias("accession"),
                       F.col("s.cv").alias("cv"), F.col("s.cvname").alias("cvname"))


def parse_enzyme_records(records: DataFrame, col: str = "value", order_col: str | None = None) -> DataFrame:
    """One record per row -> ``(id, field, value, rank)`` for DE and CA.

    A record is read inside its row.  Values keep line order; a field with
    several lines is joined with blanks and re-split after each period (F19),
    so the pieces and their positions become the values and ranks.  Of several
    records with one id the last wins (``order_col``, else file order)."""
    lines = F.split(F.col(col), "\n")

    def tagged(tag):
        return F.transform(F.filter(lines, lambda x: x.rlike(rf"^{tag}\s+")),
                           lambda x: F.regexp_extract(x, rf"^{tag}\s+(.*)$", 1))

    def pieces(v):
        return F.when(F.size(v) > 1, F.filter(F.split(F.array_join(v, " "), r"(?<=\.)\s*"), lambda x: x != "")).otherwise(v)

    def ranked(field, v):
        return F.transform(v, lambda x, i: F.struct(F.lit(field).alias("field"), x.alias("value"), i.cast("long").alias("rank")))

    order = F.col(order_col) if order_col else F.monotonically_increasing_id()
    rec = records.select(order.alias("_ord"), F.try_element_at(tagged("ID"), F.lit(-1)).alias("id"),
                         pieces(tagged("DE")).alias("de"), pieces(tagged("CA")).alias("ca")).filter("id is not null")
    last = rec.groupBy("id").agg(F.max_by(F.struct("de", "ca"), "_ord").alias("r"))
    # an ID-only record still counts as found
    return last.select("id", F.inline(F.concat(ranked("DE", F.col("r.de")), ranked("CA", F.col("r.ca")), ranked("ID", F.array("id")))))


def parse_enzyme_classes(lines: DataFrame, col: str = "value", order_col: str | None = None) -> DataFrame:
    """``^(\\d.*?\\.-)\\s+(.*)$`` lines -> ``(id, name)``, blanks removed
    from the id; for a repeated id the last line wins (``order_col``, else
    file order)."""
    df = lines if order_col else lines.withColumn("_ord", F.monotonically_increasing_id())
    order = order_col or "_ord"
    m = df.select(order, F.regexp_extract(col, CLASS_LINE, 1).alias("id"), F.regexp_extract(col, CLASS_LINE, 2)
                  .alias("name")).filter(F.col("id") != "")
    m = m.withColumn("id", F.regexp_replace("id", r"\s+", ""))
    return m.groupBy("id").agg(F.max_by("name", order).alias("name"))


def extend_ec(ecs: DataFrame, records: DataFrame, classes: DataFrame) -> DataFrame:
    """The dbxrefprop rows to add for each EC number in use.

    J16 ordered fallbacks as three joins: a record with this id (unless
    transferred / deleted - then nothing, and no class fallback), else the
    class of the id, else the class of ``id + '.-'``.  Output
    ``(dbxref_id, ec, type, value, rank)``; misses give no rows
    (see :func:`ec_misses`)."""
    rec_ids = records.select(F.col("id").alias("ec")).distinct()
    dead = (records.filter((F.col("field") == "DE") & F.col("value").rlike(TRANSFERRED_OR_DELETED))
            .select(F.col("id").alias("ec")).distinct())
    with_rec = ecs.join(rec_ids, "ec", "left_semi")
    live = with_rec.join(dead, "ec", "left_anti")
    from_rec = (live.join(records.filter(F.col("field") != "ID").withColumnRenamed("id", "ec"), "ec")
                .select("dbxref_id", "ec", F.when(F.col("field") == "DE", EC_PROPTYPES["DE"])
                        .otherwise(EC_PROPTYPES["CA"]).alias("type"), "value", "rank"))
    rest = ecs.join(rec_ids, "ec", "left_anti")
    cls = classes.select(F.col("id").alias("cid"), F.col("name"))
    exact = rest.join(cls, rest["ec"] == cls["cid"]).select("dbxref_id", "ec", "name")
    rest2 = rest.join(cls.select(F.col("cid").alias("ec")), "ec", "left_anti")
    alt = rest2.join(cls, F.concat(rest2["ec"], F.lit(".-")) == cls["cid"]).select("dbxref_id", "ec", "name")
    from_cls = exact.unionByName(alt).select("dbxref_id", "ec", F.lit(EC_PROPTYPES["class"]).alias("type"),
                                             F.col("name").alias("value"), F.lit(0).cast("long").alias("rank"))
    return from_rec.unionByName(from_cls)


def ec_misses(ecs: DataFrame, records: DataFrame, classes: DataFrame) -> DataFrame:
    """EC numbers found neither as a record nor as a class (the reference
    reports them on stderr)."""
    ids = records.select(F.col("id").alias("ec")).distinct()
    c = classes.select(F.col("id").alias("ec"))
    c_alt = classes.select(F.regexp_replace("id", r"\.-\z", "").alias("ec"))
    return ecs.join(ids, "ec", "left_anti").join(c, "ec", "left_anti").join(c_alt, "ec", "left_anti")


def ensure_terms(cat, names: list[str], cv_name: str = "dbxrefprop type") -> DataFrame:
    """``(name, cvterm_id)`` for the property types, creating missing
    ones.  A created type gets a surrogate id hashed from (cv, name) (F22),
    so re-running gives the same id and no global numbering is needed."""
    from ..operators.keys import surrogate_key
    cv = dims.cv_ids(cat, cv_name).select("cv_id")
    have = (cat["cvterm"].join(cv, "cv_id", "left_semi").filter(F.col("name").isin(names))
            .groupBy("name").agg(F.min("cvterm_id").alias("cvterm_id")))
    wanted = cat["cvterm"].sparkSession.createDataFrame([(n,) for n in names], "name string")
    new = (wanted.join(have, "name", "left_anti")
           .select("name", surrogate_key(F.lit(cv_name), F.col("name")).alias("cvterm_id")))
    return have.unionByName(new)


def replace_props(cat, new_rows: DataFrame, types: DataFrame) -> DataFrame:
    """The dbxrefprop table after deleting every row of the EC property
    types and inserting ``new_rows`` (written to a new path by the caller)."""
    t = types.select(F.col("name").alias("type"), F.col("cvterm_id").alias("type_id"))
    old = cat["dbxrefprop"].join(t.select("type_id"), "type_id", "left_anti")
    add = new_rows.join(t, "type").select("dbxref_id", "type_id", "value", "rank")
    return old.select("dbxref_id", "type_id", "value", "rank").unionByName(add)
