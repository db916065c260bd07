"""The lookup functions as SQL: session-level scalar and table functions over a catalog.

``register(cat)`` defines temporary views of the catalog's tables and temporary
SQL functions with the lookups' semantics (U1-U7, U11, F1, F2)::

    SELECT * FROM related_features(array('FBgn0000001'), 'alleleof', 'FBal', 'subject');
    SELECT uniquename, current_symbol(uniquename) FROM feature;

They are SQL bodies, which Catalyst inlines where they are called: a table
function becomes joins, a scalar function with a lookup becomes one left join
for all rows (the subquery is decorrelated), and no Python worker is involved.
Array arguments keep repeated ids, as the DataFrame forms do.  ``SIMILAR TO``
patterns know ``%``, ``_`` (``\\%``, ``\\_`` for the characters), ``|`` and groups.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.lookups import ENTITY_TABLES, FEATURE_ENTITY
from ..operators.lookups import _objects as objects
from . import exprs as X

TABLES = ("feature", "feature_relationship", "featureprop", "feature_cvterm", "feature_dbxref", "cv", "cvterm", "db", "dbxref",
          "pub", "pubprop", "grp", "grp_cvterm", "grpmember", "grpmemberprop")


def synonym_links(cat) -> DataFrame:
    """``(uniquename, kind, k, n, name)``: every current, public synonym of every
    live object, in the table of its data class; the lowest ``(k, n)`` of a
    uniquename and kind is its current synonym.  Stocks: genotypes as symbols."""
    special = [c.upper() for c in ENTITY_TABLES]
    cls = F.upper(F.substring("uniquename", 1, 4))
    kinds = (cat["synonym"].select("synonym_id", F.col("synonym_sgml").alias("name"), "type_id")
             .join(cat["cvterm"].select(F.col("cvterm_id").alias("type_id"), F.col("name").alias("kind")), "type_id"))
    out = None
    for c, (table, link, _, key) in [*((k.upper(), e) for k, e in ENTITY_TABLES.items()), (None, FEATURE_ENTITY)]:
        own = cls == c if c else ~cls.isin(special)
        obj = objects(cat, table).filter(~F.col("is_obsolete") & own).select(F.col(key).alias("k"), "uniquename")
        lnk = cat[link].filter(F.col("is_current") & ~F.col("is_internal")).select(F.col(key).alias("k"), "synonym_id")
        rows = obj.join(lnk, "k").join(kinds, "synonym_id").select("uniquename", "kind", "k", F.col("synonym_id").alias("n"), "name")
        if c is None:                                           # a stock's symbol is its genotype, nothing else
            rows = rows.filter(~((cls == "FBST") & (F.col("kind") == "symbol")))
        out = rows if out is None else out.unionByName(rows)
    st = cat["stock"].filter(~F.col("is_obsolete") & (cls == "FBST")).select("stock_id", "uniquename")
    geno = cat["genotype"].select("genotype_id", F.col("uniquename").alias("name"))
    return out.unionByName(st.join(cat["stock_genotype"], "stock_id").join(geno, "genotype_id").select(
        "uniquename", F.lit("symbol").alias("kind"), F.lit(0).cast("long").alias("k"), F.col("genotype_id").alias("n"), "name"))


#: name -> (parameters, result, body); {p} is the prefix of views and functions
FUNCTIONS = {
    "data_class": ("id STRING", "STRING", "concat(upper(substring(id, 1, 2)), lower(substring(id, 3, 2)))"),
    "is_evidence_experimental": ("value STRING", "BOOLEAN", f"value RLIKE '(?i){X.EXPERIMENTAL_EVIDENCE}'"),
    "similar_pattern": ("pattern STRING", "STRING", r"""concat('(?s)\\A(?:', replace(replace(replace(replace(regexp_replace(replace(replace(
        pattern, r'\%', '\u0001'), r'\_', '\u0002'), '([.^$])', r'\\$1'), '%', '.*'), '_', '.'), '\u0001', '%'), '\u0002', '_'), ')\\z')"""),
    "current_synonym": ("id STRING, kind STRING", "STRING", """(SELECT min_by(s.name, struct(s.k, s.n)) FROM {p}synonym_links s
        WHERE s.uniquename = {p}current_synonym.id AND s.kind = {p}current_synonym.kind)"""),
    "current_symbol": ("id STRING", "STRING", """(SELECT min_by(s.name, struct(s.k, s.n)) FROM {p}synonym_links s
        WHERE s.kind = 'symbol' AND s.uniquename = {p}current_symbol.id)"""),
    "current_fullname": ("id STRING", "STRING", """(SELECT min_by(s.name, struct(s.k, s.n)) FROM {p}synonym_links s
        WHERE s.kind = 'fullname' AND s.uniquename = {p}current_fullname.id)"""),
    "is_pathway": ("grp_id BIGINT", "BOOLEAN", """coalesce((SELECT bool_or(x.accession = '0007034') FROM {p}grp_cvterm g JOIN {p}cvterm c ON g.cvterm_id = c.cvterm_id
        JOIN {p}dbxref x ON c.dbxref_id = x.dbxref_id JOIN {p}db d ON x.db_id = d.db_id
        WHERE upper(d.name) = 'FBCV' AND g.grp_id = {p}is_pathway.grp_id), false)"""),
    "update_ids": ("ids ARRAY<STRING>", "TABLE(submitted_id STRING, updated_id STRING, status STRING)", """
        WITH live AS (SELECT DISTINCT uniquename FROM {p}feature WHERE NOT is_obsolete),
        secondary AS (SELECT x.accession, t.uniquename, count(*) OVER (PARTITION BY x.accession) AS n
          FROM {p}dbxref x JOIN {p}db d ON d.db_id = x.db_id AND lower(d.name) = 'annobase'
          JOIN {p}feature_dbxref fx ON fx.dbxref_id = x.dbxref_id AND NOT fx.is_current
          JOIN {p}feature t ON t.feature_id = fx.feature_id AND NOT t.is_obsolete
          WHERE upper(left(t.uniquename, 4)) = upper(left(x.accession, 4)))
        SELECT i.id, CASE WHEN l.uniquename IS NOT NULL THEN i.id ELSE s.uniquename END,
               CASE WHEN l.uniquename IS NOT NULL THEN 'current' WHEN s.n > 1 THEN 'split' WHEN s.n = 1 THEN 'updated' END
        FROM explode({p}update_ids.ids) AS i(id) LEFT JOIN live l ON l.uniquename = i.id
        LEFT JOIN secondary s ON s.accession = i.id AND l.uniquename IS NULL"""),
    "related_features": (
        "ids ARRAY<STRING>, rel_types STRING, data_classes STRING, direction STRING",
        "TABLE(id STRING, feature_relationship_id BIGINT, object_id BIGINT, subject_id BIGINT, uniquename STRING, symbol STRING, rank BIGINT, value STRING, type STRING)",
        """SELECT i.id, r.feature_relationship_id, r.object_id, r.subject_id, t.uniquename, s.symbol, r.rank, r.value, c.name
        FROM explode({p}related_features.ids) AS i(id) JOIN {p}feature n ON n.uniquename = i.id
        JOIN (SELECT *, object_id AS near, subject_id AS far, false AS by_subject FROM {p}feature_relationship
              UNION ALL SELECT *, subject_id, object_id, true FROM {p}feature_relationship) r
          ON r.near = n.feature_id AND r.by_subject = ({p}related_features.direction <=> 'object')
        JOIN {p}cvterm c ON c.cvterm_id = r.type_id AND c.name RLIKE {p}similar_pattern({p}related_features.rel_types)
        JOIN {p}feature t ON t.feature_id = r.far AND NOT t.is_obsolete
          AND {p}data_class(t.uniquename) RLIKE {p}similar_pattern(coalesce({p}related_features.data_classes, '%'))
        LEFT JOIN (SELECT uniquename, min_by(name, struct(k, n)) AS symbol FROM {p}synonym_links WHERE kind = 'symbol' GROUP BY uniquename) s
          ON s.uniquename = t.uniquename"""),
    "feature_props": ("ids ARRAY<STRING>, kind STRING", "TABLE(id STRING, featureprop_id BIGINT, feature_id BIGINT, type STRING, value STRING, rank BIGINT)",
                      """SELECT i.id, p.featureprop_id, p.feature_id, c.name, p.value, p.rank FROM explode({p}feature_props.ids) AS i(id)
        JOIN {p}feature f ON f.uniquename = i.id AND NOT f.is_obsolete JOIN {p}featureprop p ON p.feature_id = f.feature_id
        JOIN {p}cvterm c ON c.cvterm_id = p.type_id AND c.is_obsolete = 0 AND c.name RLIKE {p}similar_pattern({p}feature_props.kind)"""),
    "pub_props": ("ids ARRAY<STRING>, kind STRING", "TABLE(id STRING, pub_id BIGINT, type STRING, value STRING)",
                  """SELECT i.id, p.pub_id, c.name, p.value FROM explode({p}pub_props.ids) AS i(id)
        JOIN {p}pub b ON b.uniquename = i.id AND NOT b.is_obsolete JOIN {p}pubprop p ON p.pub_id = b.pub_id
        JOIN {p}cvterm c ON c.cvterm_id = p.type_id AND c.is_obsolete = 0 AND c.name RLIKE {p}similar_pattern({p}pub_props.kind)"""),
    "group_member_props": ("members ARRAY<BIGINT>, kind STRING", "TABLE(member BIGINT, type STRING, value STRING, rank BIGINT)",
                           """SELECT i.id, c.name, p.value, p.rank FROM explode({p}group_member_props.members) AS i(id)
        JOIN {p}grpmember m ON m.grpmember_id = i.id JOIN {p}grpmemberprop p ON p.grpmember_id = m.grpmember_id
        JOIN {p}cvterm c ON c.cvterm_id = p.type_id AND c.is_obsolete = 0 AND c.name RLIKE {p}similar_pattern({p}group_member_props.kind)"""),
    "ontology_terms": ("ids ARRAY<STRING>, aspect STRING",
                       "TABLE(id STRING, feature_cvterm_id BIGINT, feature_id BIGINT, cvterm_id BIGINT, is_not BOOLEAN)",
                       """SELECT i.id, a.feature_cvterm_id, a.feature_id, a.cvterm_id, a.is_not FROM explode({p}ontology_terms.ids) AS i(id)
        JOIN {p}feature f ON f.uniquename = i.id JOIN {p}feature_cvterm a ON a.feature_id = f.feature_id
        JOIN {p}cvterm c ON c.cvterm_id = a.cvterm_id AND c.is_obsolete = 0 JOIN {p}cv v ON v.cv_id = c.cv_id AND v.name = {p}ontology_terms.aspect"""),
}


def register(cat, prefix: str = "") -> list[str]:
    """Define the views and functions in the catalog's session, their names with
    ``prefix`` in front; returns the functions' names.  Calling it again puts
    the views of another catalog in their place."""
    spark = cat.spark
    for t in TABLES:
        cat[t].createOrReplaceTempView(prefix + t)
    synonym_links(cat).createOrReplaceTempView(f"{prefix}synonym_links")
    for name, (params, result, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {prefix}{name}({params}) RETURNS {result} RETURN {body.replace('{p}', prefix)}")
    return [prefix + n for n in FUNCTIONS]
