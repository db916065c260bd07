"""Adapter views: the annotation schema derived from the driver's tables.

The driver ships TPC-H-style parquet tables, not an annotation database.
Every base table the library works on (``feature``, ``feature_relationship``,
``synonym``, ``cvterm`` ...) is therefore defined here as a plain ``SELECT``
over those tables.  The SQL is written in the subset that Spark SQL and
DuckDB read the same way (integer ``+ * %``, ``CASE``, ``||``, ``lpad``,
``cast``, ``VALUES``), so that:

* Spark builds each view lazily as a DataFrame (``spark.sql`` with DataFrame
  arguments); Catalyst inlines the views into every query, so filters and
  column pruning reach the parquet scans;
* the DuckDB oracle prefixes the same text as CTEs and runs an
  independently written query on top.

Identifier scheme: a row built from source key ``k`` gets the id
``k * 32 + code`` where ``code`` names the kind of row, so ids never collide
and grow with the data.  Uniquenames keep at least 7 digits
(``FBgn0000042``) and never truncate larger keys.

Where a view uses another view it names it in braces (``{feature}``).
"""

from __future__ import annotations

BASE_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def pad(expr: str) -> str:
    """Decimal text of ``expr`` left-padded to 7 digits, never truncated."""
    s = f"cast({expr} as string)"
    return f"lpad({s}, cast(greatest(7, length({s})) as int), '0')"


def fbid(prefix: str, expr: str) -> str:
    return f"'{prefix}' || {pad(expr)}"


# ---------------------------------------------------------------------------
# Fixed vocabularies.  Names are the values the reference's queries test for
# (relationship, property, synonym and publication types; database names).
# ---------------------------------------------------------------------------

# fixed values: controlled vocabularies (cv_id, name)
CV_ROWS = [
    (1, "biological_process"),
    (2, "molecular_function"),
    (3, "cellular_component"),
    (4, "disease_ontology"),
    (5, "SO"),
    (6, "relationship type"),
    (7, "property type"),
    (8, "miscellaneous CV"),
    (9, "synonym type"),
    (10, "pub type"),
]

# fixed values: databases (db_id, name, urlprefix); the names are the ones
# the queries test for, the URL prefixes are placeholders
DB_ROWS = [
    (1, "Annobase", "https://example.org/reports/"),
    (2, "GO", "https://example.org/go/"),
    (3, "DOID", "https://example.org/doid/"),
    (4, "EC", "https://example.org/ec/"),
    (5, "HGNC", "https://example.org/hgnc/"),
    (6, "FBcv", "https://example.org/cv/"),
    (7, "DSHB", "https://example.org/dshb/"),
    (8, "SO", "https://example.org/so/"),
    (9, "UniProt/Swiss-Prot", "https://example.org/uniprot/"),
    (10, "InteractiveFly", "https://example.org/if/"),
    (11, "cst", "https://example.org/cst/"),
    (12, "internal", None),
    (13, "ClinVar", "https://example.org/clinvar/"),
]

# fixed values: type terms (cvterm_id, cv_id, name, is_obsolete)
TYPE_TERMS = [
    # feature types (SO)
    (1, 5, "gene", 0),
    (2, 5, "allele", 0),
    (3, 5, "transgenic_construct", 0),
    (4, 5, "transposable_element_insertion_site", 0),
    (5, 5, "mRNA", 0),
    (6, 5, "miRNA", 0),
    (7, 5, "ncRNA", 0),
    (8, 5, "golden_path", 0),
    (9, 5, "engineered_region", 0),
    (10, 5, "regulatory_region", 0),
    (11, 5, "split system combination", 0),
    (12, 5, "polypeptide", 0),
    (13, 5, "pseudogene", 0),
    (14, 5, "ortholog", 0),
    (15, 5, "disease implicated variant", 0),
    # relationship types
    (20, 6, "alleleof", 0),
    (21, 6, "has_reg_region", 0),
    (22, 6, "associated_with", 0),
    (23, 6, "attributed_as_expression_of", 0),
    (24, 6, "encodes_tool", 0),
    (25, 6, "orthologous_to", 0),
    (26, 6, "producedby", 0),
    (27, 6, "partof", 0),
    (28, 6, "has_variant", 0),
    (29, 6, "tagged_with", 0),
    (30, 6, "carries_tool", 0),
    # property types
    (40, 7, "derived_aka_synonyms", 0),
    (41, 7, "cyto_range", 0),
    (42, 7, "reported_antibod_gen", 0),
    (43, 7, "testis_specificity_index_score", 0),
    (44, 7, "derived_stock_Bloomington", 0),
    (45, 7, "derived_stock_Kyoto", 0),
    (46, 7, "gene_summary_text", 0),
    (47, 7, "evidence_code", 0),
    (48, 7, "qualifier", 0),
    (49, 7, "NOT", 0),
    (50, 7, "derived_grpmember_label", 0),
    (51, 7, "ec_description", 0),
    (52, 7, "uniprot_function_comment", 0),
    (53, 7, "IF_summary", 0),
    (54, 7, "grpmember_feature", 0),
    (55, 7, "grpmember_parent", 0),
    (56, 7, "transgenic_product_class", 0),
    (57, 7, "tool_uses", 0),
    (58, 7, "promoted_allele_class", 0),
    (59, 7, "internal_note", 1),
    (60, 7, "derived_stock_VDRC", 0),
    (61, 7, "propagate_transgenic_uses", 0),
    (62, 7, "known_lesion", 0),
    (63, 7, "linked_image", 0),
    (64, 7, "hh_ortholog_comment", 0),
    (65, 7, "ec_name", 0),
    (66, 7, "ec_reaction", 0),
    (67, 7, "comment", 0),
    (68, 7, "div_comment", 0),
    (69, 7, "disease_associated", 0),
    # synonym types
    (70, 9, "symbol", 0),
    (71, 9, "fullname", 0),
    # publication types
    (80, 10, "paper", 0),
    (81, 10, "review", 0),
    # single ontology terms the reference names by accession
    (90, 2, "protein binding", 0),
    (91, 8, "signaling pathway", 0),
]
# fixed values: accessions of the single ontology terms above
TERM_ACCESSIONS = {90: (2, "0005515"), 91: (6, "0007034")}

# fixed values: DIOPT method lists put on ortholog edges
DIOPT_VALUES = [
    "diopt methods: Ensembl_Compara, HGNC, Hieranoid",
    "diopt methods: Ensembl_Compara, HGNC, Hieranoid, Inparanoid, OMA"
    + "\nsome other line",
    "diopt methods: OrthoFinder",
    "Diopt methods: OMA, Panther",
    "diopt methods: Ensembl_Compara, OMA, Panther, PhylomeDB, RoundUp, TreeFam",
    "note; diopt methods: OMA, Panther, SonicParanoid",
]


def _values(rows, cols) -> str:
    def lit(v):
        if v is None:
            return "cast(NULL as string)"
        if isinstance(v, str):
            return "'" + v.replace("'", "''") + "'"
        return f"cast({v} as bigint)"

    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"SELECT * FROM (VALUES {body}) AS t({', '.join(cols)})"


def _nl_join(values) -> str:
    """SQL text for a string literal list, newlines as ``chr(10)``."""
    out = []
    for v in values:
        parts = v.split("\n")
        lits = ["'" + p.replace("'", "''") + "'" for p in parts]
        out.append(" || chr(10) || ".join(lits))
    return out


def _diopt_case(key: str) -> str:
    vals = _nl_join(DIOPT_VALUES)
    whens = " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(vals))
    return f"CASE {key} % {len(vals)} {whens} END"


# ---------------------------------------------------------------------------
# View definitions (name -> SQL).  Order matters only for readability.
# ---------------------------------------------------------------------------

GENE = "p_partkey * 32 + 1"
ALLELE = "o_orderkey * 32 + 2"
VIEWS: dict[str, str] = {}

VIEWS["organism"] = """
SELECT cast(n_nationkey + 202 as bigint) AS organism_id,
       CASE n_nationkey WHEN 0 THEN 'Drosophila' WHEN 24 THEN 'Homo' ELSE r_name END AS genus,
       CASE n_nationkey WHEN 0 THEN 'melanogaster' WHEN 24 THEN 'sapiens' ELSE lower(n_name) END AS species,
       n_name AS common_name
FROM {nation} JOIN {region} ON n_regionkey = r_regionkey
"""

VIEWS["cv"] = _values(CV_ROWS, ["cv_id", "name"])
VIEWS["db"] = _values(DB_ROWS, ["db_id", "name", "urlprefix"])
VIEWS["type_terms"] = _values(TYPE_TERMS, ["cvterm_id", "cv_id", "name", "is_obsolete"])

# Ontology terms: one per ten parts.  Every fifth term is in
# a different ontology; FBcv terms come in three families (in vitro
# construct, mutagen, allele class).
VIEWS["ontology_terms"] = """
SELECT cast(1000 + k as bigint) AS cvterm_id,
       cast(CASE k % 5 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 3 WHEN 3 THEN 4 ELSE 8 END as bigint) AS cv_id,
       CASE k % 5
         WHEN 0 THEN 'process ' || cast(k as string)
         WHEN 1 THEN 'function ' || cast(k as string)
         WHEN 2 THEN 'component ' || cast(k as string)
         WHEN 3 THEN 'disease ' || cast(k as string)
         ELSE CASE WHEN k % 20 = 4 THEN 'In vitro construct - class ' || cast(k as string)
                   WHEN k % 20 = 9 THEN 'ethyl methanesulfonate ' || cast(k as string)
                   ELSE 'allele class ' || cast(k as string) END
       END AS name,
       cast(CASE WHEN k % 23 = 0 THEN 1 ELSE 0 END as bigint) AS is_obsolete,
       k
FROM (SELECT DISTINCT cast(floor(p_partkey / 10) as bigint) AS k FROM {part}) AS terms
"""

# number of ontology terms: keys of other tables are mapped onto 0 .. n - 1
VIEWS["ontology_size"] = """
SELECT count(*) AS n FROM {ontology_terms}
"""

VIEWS["cvterm"] = """
SELECT cvterm_id, cv_id, name, is_obsolete, cvterm_id * 32 + 30 AS dbxref_id,
       cast(CASE WHEN cv_id = 6 THEN 1 ELSE 0 END as bigint) AS is_relationshiptype
FROM {type_terms}
UNION ALL
SELECT cvterm_id, cv_id, name, is_obsolete, k * 32 + 31 AS dbxref_id, cast(0 as bigint) AS is_relationshiptype
FROM {ontology_terms}
"""

VIEWS["cvtermprop"] = """
SELECT cvterm_id, cast(NULL as bigint) AS type_id, 'origin_of_mutation' AS value
FROM {ontology_terms} WHERE k % 20 IN (4, 9)
UNION ALL
SELECT cvterm_id, cast(NULL as bigint) AS type_id, 'definition' AS value
FROM {ontology_terms} WHERE k % 20 = 14
"""

# Enzyme (EC) numbers: one per four parts; every 50th is a
# class-level number ending in ``.-``.
VIEWS["ec_numbers_src"] = """
SELECT e,
       CASE WHEN e % 50 = 0
            THEN cast(e % 6 + 1 as string) || '.' || cast(e % 5 + 1 as string) || '.'
                 || cast(cast(floor(e / 50) as bigint) + 1 as string) || '.-'
            WHEN e % 50 = 25
            THEN cast(e % 6 + 1 as string) || '.' || cast(e % 5 + 1 as string) || '.'
                 || cast(cast(floor(e / 50) as bigint) + 1 as string)
            ELSE cast(e % 6 + 1 as string) || '.' || cast(e % 5 + 1 as string) || '.'
                 || cast(e % 3 + 1 as string) || '.' || cast(e + 1 as string)
       END AS accession
FROM (SELECT DISTINCT cast(floor(p_partkey / 4) as bigint) AS e FROM {part}) AS ecs
"""

VIEWS["ec_size"] = """
SELECT count(*) AS n FROM {ec_numbers_src}
"""

VIEWS["dbxref"] = f"""
SELECT cvterm_id * 32 + 30 AS dbxref_id,
       cast(CASE WHEN cvterm_id = 90 THEN 2 WHEN cvterm_id = 91 THEN 6 WHEN cv_id = 5 THEN 8 ELSE 12 END as bigint) AS db_id,
       CASE WHEN cvterm_id = 90 THEN '0005515' WHEN cvterm_id = 91 THEN '0007034' ELSE {pad('cvterm_id')} END AS accession,
       cast(NULL as string) AS description
FROM {{type_terms}}
UNION ALL
SELECT k * 32 + 31 AS dbxref_id,
       cast(CASE WHEN k % 5 < 3 THEN 2 WHEN k % 5 = 3 THEN 3 ELSE 6 END as bigint) AS db_id,
       {pad('k')} AS accession, cast(NULL as string) AS description
FROM {{ontology_terms}}
UNION ALL
SELECT p_partkey * 32 + 1, cast(1 as bigint), {fbid('FBgn', 'p_partkey')}, cast(NULL as string) FROM {{part}}
UNION ALL
SELECT g * 32 + 2, cast(1 as bigint), {fbid('FBgn9', 'g')}, cast(NULL as string)
FROM (SELECT DISTINCT cast(floor(p_partkey / 2) as bigint) AS g FROM {{part}}) AS secondary
UNION ALL
SELECT p_partkey * 32 + 3, cast(CASE WHEN p_partkey % 8 = 0 THEN 7 ELSE 11 END as bigint),
       'AB' || cast(p_partkey as string), cast(NULL as string)
FROM {{part}} WHERE p_partkey % 4 = 0
UNION ALL
SELECT p_partkey * 32 + 4, cast(9 as bigint), 'P' || {pad('p_partkey')}, cast(NULL as string)
FROM {{part}} WHERE p_partkey % 3 = 0
UNION ALL
SELECT p_partkey * 32 + 5, cast(10 as bigint), 'if' || cast(p_partkey as string), cast(NULL as string)
FROM {{part}} WHERE p_partkey % 5 = 0
UNION ALL
SELECT c_custkey * 32 + 6, cast(5 as bigint), 'HGNC:' || cast(c_custkey as string), 'HUMAN' || cast(c_custkey as string)
FROM {{customer}} WHERE c_custkey % 5 = 0
UNION ALL
SELECT e * 32 + 7, cast(4 as bigint), accession, cast(NULL as string) FROM {{ec_numbers_src}}
UNION ALL
SELECT o_orderkey * 32 + 9, cast(13 as bigint), cast(o_orderkey * 3 as string), 'variant ' || cast(o_orderkey as string)
FROM {{orders}} WHERE o_orderkey % 10 = 7
"""

VIEWS["dbxrefprop"] = """
SELECT p_partkey * 32 + 4 AS dbxref_id, cast(52 as bigint) AS type_id,
       'Function of protein ' || cast(p_partkey as string) AS value, cast(0 as bigint) AS rank
FROM {part} WHERE p_partkey % 6 = 0
UNION ALL
SELECT p_partkey * 32 + 5, cast(53 as bigint),
       CASE WHEN p_partkey % 10 = 5 THEN cast(NULL as string) ELSE 'Interactive summary ' || cast(p_partkey as string) END,
       cast(0 as bigint)
FROM {part} WHERE p_partkey % 5 = 0
UNION ALL
SELECT e * 32 + 7, cast(51 as bigint), 'Enzyme ' || accession, cast(0 as bigint)
FROM {ec_numbers_src} WHERE e % 7 <> 0
UNION ALL
SELECT e * 32 + 7, cast(51 as bigint), 'Also known as enzyme ' || cast(e as string), cast(1 as bigint)
FROM {ec_numbers_src} WHERE e % 11 = 0
UNION ALL
SELECT e * 32 + 7, cast(65 as bigint), 'Old name ' || cast(e as string), cast(0 as bigint)
FROM {ec_numbers_src} WHERE e % 4 = 1
"""

VIEWS["cvterm_dbxref"] = """
SELECT cvterm_id, (((k * 7) % n) * 32 + 7) AS dbxref_id
FROM {ontology_terms} CROSS JOIN {ec_size} WHERE k % 5 = 1
UNION ALL
SELECT cvterm_id, (((k * 25) % n) * 32 + 7) AS dbxref_id
FROM {ontology_terms} CROSS JOIN {ec_size} WHERE k % 5 = 1
"""

# Features.  Gene rows come from part, alleles from orders, constructs from
# supplier, insertions from customer, orthologs from every 5th customer,
# transcripts/polypeptides/surface features from part, tools from every
# other supplier, split-system combinations from pending orders and
# scaffolds from nation.
VIEWS["feature"] = f"""
SELECT {GENE} AS feature_id,
       CASE WHEN p_partkey % 37 = 36 THEN {fbid('FBgn', 'p_partkey')} || '-old'
            ELSE {fbid('FBgn', 'p_partkey')} END AS uniquename,
       p_name AS name,
       cast(CASE WHEN p_partkey % 31 = 30 THEN 13 ELSE 1 END as bigint) AS type_id,
       cast(CASE WHEN p_partkey % 10 = 9 THEN 202 + p_partkey % 25 ELSE 202 END as bigint) AS organism_id,
       p_partkey % 29 = 0 AS is_analysis,
       p_partkey % 17 = 0 AS is_obsolete
FROM {{part}}
UNION ALL
SELECT {ALLELE}, {fbid('FBal', 'o_orderkey')}, 'al' || cast(o_orderkey as string),
       cast(CASE WHEN o_orderkey % 19 = 0 THEN 1 ELSE 2 END as bigint), cast(202 as bigint),
       o_orderkey % 29 = 28, o_orderkey % 17 = 16
FROM {{orders}}
UNION ALL
SELECT s_suppkey * 32 + 3, {fbid('FBtp', 's_suppkey')}, 'P{{' || s_name || '}}', cast(3 as bigint), cast(202 as bigint),
       false, s_suppkey % 23 = 22
FROM {{supplier}}
UNION ALL
SELECT c_custkey * 32 + 4, {fbid('FBti', 'c_custkey')}, 'ti' || cast(c_custkey as string), cast(4 as bigint),
       cast(202 as bigint), false, c_custkey % 19 = 18
FROM {{customer}}
UNION ALL
SELECT c_custkey * 32 + 5, {fbid('FBog', 'c_custkey')}, 'og' || cast(c_custkey as string), cast(14 as bigint),
       cast(202 + c_nationkey as bigint), c_custkey % 45 = 40, c_custkey % 35 = 30
FROM {{customer}} WHERE c_custkey % 5 = 0
UNION ALL
SELECT p_partkey * 32 + 6, {fbid('FBtr', 'p_partkey')}, p_name || '-RA',
       cast(CASE WHEN p_type IN ('ECONOMY', 'SMALL') THEN 5 WHEN p_type = 'PROMO' THEN 6 ELSE 7 END as bigint),
       cast(202 as bigint), p_partkey % 41 = 40, p_partkey % 13 = 12
FROM {{part}}
UNION ALL
SELECT s_suppkey * 32 + 7, {fbid('FBto', 's_suppkey')}, 'tool' || cast(s_suppkey as string), cast(9 as bigint),
       cast(202 as bigint), false, s_suppkey % 26 = 24
FROM {{supplier}} WHERE s_suppkey % 2 = 0
UNION ALL
SELECT p_partkey * 32 + 8, {fbid('FBsf', 'p_partkey')}, 'sf' || cast(p_partkey as string), cast(10 as bigint),
       cast(202 as bigint), false, p_partkey % 49 = 42
FROM {{part}} WHERE p_partkey % 7 = 0
UNION ALL
SELECT o_orderkey * 32 + 9, {fbid('FBco', 'o_orderkey')}, 'co' || cast(o_orderkey as string),
       cast(CASE WHEN o_orderkey % 10 = 3 THEN 2 ELSE 11 END as bigint), cast(202 as bigint),
       false, o_orderkey % 23 = 5
FROM {{orders}} WHERE o_orderstatus = 'P'
UNION ALL
SELECT p_partkey * 32 + 10, {fbid('FBpp', 'p_partkey')}, p_name || '-PA', cast(12 as bigint),
       cast(202 as bigint), false, p_partkey % 27 = 21
FROM {{part}} WHERE p_partkey % 3 = 0
UNION ALL
SELECT cast(n_nationkey as bigint) * 32 + 11, 'scaffold_' || cast(n_nationkey as string), n_name, cast(8 as bigint),
       cast(202 as bigint), false, false
FROM {{nation}}
UNION ALL
SELECT o_orderkey * 32 + 12, {fbid('FBva', 'o_orderkey')}, 'div' || cast(o_orderkey as string),
       cast(CASE WHEN o_orderkey % 30 = 27 THEN 2 ELSE 15 END as bigint), cast(202 as bigint), false,
       o_orderkey % 23 = 7
FROM {{orders}} WHERE o_orderkey % 10 = 7
"""

# Typed edges subject -> object.  ids: (source row id) * 32 + edge code.
_LI = "(l_orderkey * 8 + l_linenumber)"
VIEWS["feature_relationship"] = f"""
SELECT {_LI} * 32 + 1 AS feature_relationship_id, {ALLELE.replace('o_orderkey', 'l_orderkey')} AS subject_id,
       l_partkey * 32 + 1 AS object_id, cast(20 as bigint) AS type_id, cast(l_linenumber as bigint) AS rank,
       cast(NULL as string) AS value
FROM {{lineitem}} WHERE l_returnflag = 'A'
UNION ALL
SELECT {_LI} * 32 + 2, l_orderkey * 32 + 2,
       CASE WHEN l_partkey % 7 = 0 THEN l_partkey * 32 + 8 ELSE l_partkey * 32 + 1 END,
       cast(21 as bigint), cast(l_linenumber as bigint), cast(NULL as string)
FROM {{lineitem}} WHERE l_returnflag = 'N'
UNION ALL
SELECT {_LI} * 32 + 3, l_orderkey * 32 + 2, l_suppkey * 32 + 3, cast(22 as bigint), cast(l_linenumber as bigint),
       cast(NULL as string)
FROM {{lineitem}} WHERE l_returnflag = 'R'
UNION ALL
SELECT {_LI} * 32 + 4, l_orderkey * 32 + 2, l_suppkey * 32 + 7, cast(24 as bigint), cast(l_linenumber as bigint),
       cast(NULL as string)
FROM {{lineitem}} WHERE l_returnflag = 'R' AND l_suppkey % 2 = 0
UNION ALL
SELECT {_LI} * 32 + 5, l_orderkey * 32 + 2, l_partkey * 32 + 1, cast(23 as bigint), cast(l_linenumber as bigint),
       cast(NULL as string)
FROM {{lineitem}} WHERE l_returnflag = 'R'
UNION ALL
SELECT {_LI} * 32 + 6,
       CASE WHEN l_partkey % 3 = 0 THEN l_partkey * 32 + 10 ELSE l_partkey * 32 + 6 END,
       l_orderkey * 32 + 2, cast(CASE WHEN l_linenumber <= 3 THEN 22 ELSE 27 END as bigint),
       cast(l_linenumber as bigint), cast(NULL as string)
FROM {{lineitem}} WHERE l_returnflag = 'R'
UNION ALL
SELECT p_partkey * 32 + 7, p_partkey * 32 + 6, p_partkey * 32 + 1, cast(23 as bigint), cast(0 as bigint),
       cast(NULL as string)
FROM {{part}} WHERE p_partkey % 4 = 0
UNION ALL
SELECT p_partkey * 32 + 8, p_partkey * 32 + 10, p_partkey * 32 + 1, cast(23 as bigint), cast(0 as bigint),
       cast(NULL as string)
FROM {{part}} WHERE p_partkey % 3 = 0
UNION ALL
SELECT p_partkey * 32 + 9, p_partkey * 32 + 8, p_partkey * 32 + 1, cast(22 as bigint), cast(0 as bigint),
       cast(NULL as string)
FROM {{part}} WHERE p_partkey % 7 = 0
UNION ALL
SELECT {_LI} * 32 + 10, o_custkey * 32 + 5, l_partkey * 32 + 1, cast(25 as bigint), cast(l_linenumber as bigint),
       {_diopt_case('l_orderkey')}
FROM {{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey
WHERE o_custkey % 5 = 0
UNION ALL
SELECT {_LI} * 32 + 11, o_custkey * 32 + 4, l_suppkey * 32 + 3,
       cast(CASE WHEN l_linenumber = 2 AND o_orderkey % 5 = 0 THEN 26 ELSE 27 END as bigint), cast(0 as bigint),
       cast(NULL as string)
FROM {{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey
UNION ALL
SELECT o_orderkey * 32 + 12, o_orderkey * 32 + 2, o_custkey * 32 + 4, cast(22 as bigint), cast(0 as bigint),
       cast(NULL as string)
FROM {{orders}} WHERE o_orderkey % 3 = 0
UNION ALL
SELECT {_LI} * 32 + 13, l_suppkey * 32 + 3,
       CASE WHEN l_suppkey % 2 = 0 THEN l_suppkey * 32 + 7 ELSE l_partkey * 32 + 1 END,
       cast(CASE WHEN l_linenumber <> 3 OR l_orderkey % 20 >= 3 THEN 27
                 WHEN l_orderkey % 3 = 0 THEN 29 WHEN l_orderkey % 3 = 1 THEN 30 ELSE 21 END as bigint),
       cast(0 as bigint), cast(NULL as string)
FROM {{lineitem}} WHERE l_returnflag = 'A'
UNION ALL
SELECT {_LI} * 32 + 14, l_orderkey * 32 + 2,
       CASE WHEN l_partkey % 7 = 0 THEN l_partkey * 32 + 8 ELSE l_partkey * 32 + 1 END,
       cast(CASE l_linenumber WHEN 6 THEN 29 WHEN 5 THEN 30 ELSE 27 END as bigint), cast(0 as bigint),
       cast(NULL as string)
FROM {{lineitem}} WHERE l_returnflag = 'N'
UNION ALL
SELECT o_orderkey * 32 + 15, o_orderkey * 32 + 9, o_orderkey * 32 + 2,
       cast(CASE WHEN o_orderkey % 2 = 0 THEN 27 ELSE 22 END as bigint), cast(0 as bigint), cast(NULL as string)
FROM {{orders}} WHERE o_orderstatus = 'P'
UNION ALL
SELECT o_orderkey * 32 + 16, o_orderkey * 32 + 9, (o_orderkey + 1) * 32 + 2, cast(27 as bigint), cast(1 as bigint),
       cast(NULL as string)
FROM {{orders}} WHERE o_orderstatus = 'P'
UNION ALL
SELECT o_orderkey * 32 + 17, o_orderkey * 32 + 2, o_orderkey * 32 + 12, cast(28 as bigint), cast(0 as bigint),
       cast(NULL as string)
FROM {{orders}} WHERE o_orderkey % 10 = 7
UNION ALL
SELECT o_orderkey * 32 + 18, (o_orderkey + 1) * 32 + 2, o_orderkey * 32 + 12, cast(28 as bigint), cast(0 as bigint),
       cast(NULL as string)
FROM {{orders}} WHERE o_orderkey % 20 = 7
"""

VIEWS["feature_relationshipprop"] = f"""
SELECT {_LI} * 32 + 10 AS feature_relationship_id,
       CASE WHEN l_linenumber < 7 THEN 'DIOPT' ELSE 'Compara' END AS value
FROM {{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey
WHERE o_custkey % 5 = 0
"""

# Locations: genes and transcripts on scaffold p % 25, insertions on the
# scaffold of their nation.
VIEWS["featureloc"] = """
SELECT p_partkey * 32 + 1 AS feature_id, (p_partkey % 25) * 32 + 11 AS srcfeature_id,
       p_partkey * 100 AS fmin, p_partkey * 100 + p_size * 10 AS fmax, cast(0 as bigint) AS locgroup
FROM {part}
UNION ALL
SELECT p_partkey * 32 + 1, ((p_partkey + 1) % 25) * 32 + 11, p_partkey * 100 + 5000,
       p_partkey * 100 + 5000 + p_size * 4, cast(1 as bigint)
FROM {part} WHERE p_partkey % 50 = 0
UNION ALL
SELECT p_partkey * 32 + 6, (p_partkey % 25) * 32 + 11, p_partkey * 100 + 20,
       p_partkey * 100 + 20 + p_size * 5, cast(0 as bigint)
FROM {part}
UNION ALL
SELECT c_custkey * 32 + 4, cast(c_nationkey as bigint) * 32 + 11, c_custkey * 133, c_custkey * 133 + 1,
       cast(0 as bigint)
FROM {customer}
"""

VIEWS["synonym"] = """
SELECT p_partkey * 32 + 1 AS synonym_id, replace(p_name, ' ', '-') || '-' || cast(p_partkey as string) AS name,
       replace(p_name, ' ', '-') || '<up>' || cast(p_size as string) || '</up>' AS synonym_sgml,
       cast(70 as bigint) AS type_id
FROM {part}
UNION ALL
SELECT p_partkey * 32 + 2, p_brand || ' ' || p_name, p_brand || ' ' || p_name || ' ' || lower(p_type), cast(71 as bigint)
FROM {part}
UNION ALL
SELECT p_partkey * 32 + 3, 'old-' || cast(p_partkey as string), 'old-' || cast(p_partkey as string), cast(70 as bigint)
FROM {part}
UNION ALL
SELECT p_partkey * 32 + 4, 'int-' || cast(p_partkey as string), 'int-' || cast(p_partkey as string), cast(70 as bigint)
FROM {part} WHERE p_partkey % 5 = 0
UNION ALL
SELECT o_orderkey * 32 + 5, 'al' || cast(o_orderkey as string) || '[' || o_orderstatus || ']',
       'al' || cast(o_orderkey as string) || '<up>' || o_orderstatus || '</up>', cast(70 as bigint)
FROM {orders}
UNION ALL
SELECT o_orderkey * 32 + 6, 'allele ' || o_orderpriority, 'allele ' || o_orderpriority, cast(71 as bigint)
FROM {orders}
UNION ALL
SELECT c_custkey * 32 + 7, 'ti{' || cast(c_custkey as string) || '}', 'ti{' || cast(c_custkey as string) || '}',
       cast(70 as bigint)
FROM {customer}
UNION ALL
SELECT c_custkey * 32 + 8, 'HUMAN' || cast(c_custkey as string), 'HUMAN' || cast(c_custkey as string), cast(70 as bigint)
FROM {customer} WHERE c_custkey % 5 = 0
UNION ALL
SELECT s_suppkey * 32 + 9, 'P{' || s_name || '}', 'P{' || s_name || '}', cast(70 as bigint) FROM {supplier}
UNION ALL
SELECT s_suppkey * 32 + 10, 'to' || cast(s_suppkey as string), 'to' || cast(s_suppkey as string), cast(70 as bigint)
FROM {supplier}
UNION ALL
SELECT p_partkey * 32 + 11, replace(p_name, ' ', '-') || '-RA', replace(p_name, ' ', '-') || '-RA', cast(70 as bigint)
FROM {part}
UNION ALL
SELECT s_suppkey * 32 + 12, 'GG' || cast(s_suppkey as string), 'GG<sub>' || cast(s_suppkey as string) || '</sub>',
       cast(70 as bigint)
FROM {supplier}
UNION ALL
SELECT s_suppkey * 32 + 13, 'Group of ' || s_name, 'Group of ' || s_name, cast(71 as bigint) FROM {supplier}
UNION ALL
SELECT o_orderkey * 32 + 14, 'co' || cast(o_orderkey as string), 'co' || cast(o_orderkey as string), cast(70 as bigint)
FROM {orders} WHERE o_orderstatus = 'P'
UNION ALL
SELECT cast(n_nationkey as bigint) * 32 + 15, 'HH' || n_name, 'HH<i>' || n_name || '</i>', cast(70 as bigint)
FROM {nation}
UNION ALL
SELECT cast(n_nationkey as bigint) * 32 + 16, 'Disease of ' || n_name, 'Disease of ' || n_name, cast(71 as bigint)
FROM {nation}
UNION ALL
SELECT cast(n_nationkey as bigint) * 32 + 17, 'LC' || n_name, 'LC' || n_name, cast(70 as bigint) FROM {nation}
UNION ALL
SELECT s_suppkey * 32 + 18, 'SN' || cast(s_suppkey as string), 'SN' || cast(s_suppkey as string), cast(70 as bigint)
FROM {supplier} WHERE s_suppkey % 4 = 0
UNION ALL
SELECT s_suppkey * 32 + 19, 'TC' || cast(s_suppkey as string), 'TC' || cast(s_suppkey as string), cast(70 as bigint)
FROM {supplier} WHERE s_suppkey % 5 = 0
UNION ALL
SELECT o_orderkey * 32 + 20, 'v.' || cast(o_orderkey as string) || 'A>G', 'v.' || cast(o_orderkey as string) || 'A&gt;G',
       cast(70 as bigint)
FROM {orders} WHERE o_orderkey % 10 = 7
UNION ALL
SELECT o_orderkey * 32 + 21, 'old variant ' || cast(o_orderkey as string), 'old variant ' || cast(o_orderkey as string),
       cast(71 as bigint)
FROM {orders} WHERE o_orderkey % 10 = 7
"""

VIEWS["feature_synonym"] = """
SELECT p_partkey * 32 + 1 AS feature_id, p_partkey * 32 + 1 AS synonym_id,
       p_partkey % 7 <> 0 AS is_current, false AS is_internal
FROM {part}
UNION ALL
SELECT p_partkey * 32 + 1, p_partkey * 32 + 2, p_partkey % 6 <> 0, false FROM {part}
UNION ALL
SELECT p_partkey * 32 + 1, p_partkey * 32 + 3, (p_partkey % 7 = 0 OR p_partkey % 11 = 0), false FROM {part}
UNION ALL
SELECT p_partkey * 32 + 1, p_partkey * 32 + 4, true, true FROM {part} WHERE p_partkey % 5 = 0
UNION ALL
SELECT o_orderkey * 32 + 2, o_orderkey * 32 + 5, o_orderkey % 7 <> 0, false FROM {orders}
UNION ALL
SELECT o_orderkey * 32 + 2, o_orderkey * 32 + 6, o_orderkey % 9 <> 0, o_orderkey % 13 = 0 FROM {orders}
UNION ALL
SELECT c_custkey * 32 + 4, c_custkey * 32 + 7, true, false FROM {customer}
UNION ALL
SELECT c_custkey * 32 + 5, c_custkey * 32 + 8, c_custkey % 15 <> 10, false FROM {customer} WHERE c_custkey % 5 = 0
UNION ALL
SELECT s_suppkey * 32 + 3, s_suppkey * 32 + 9, true, false FROM {supplier}
UNION ALL
SELECT s_suppkey * 32 + 7, s_suppkey * 32 + 10, true, false FROM {supplier} WHERE s_suppkey % 2 = 0
UNION ALL
SELECT p_partkey * 32 + 6, p_partkey * 32 + 11, p_partkey % 9 <> 4, false FROM {part}
UNION ALL
SELECT o_orderkey * 32 + 9, o_orderkey * 32 + 14, true, false FROM {orders} WHERE o_orderstatus = 'P'
UNION ALL
SELECT o_orderkey * 32 + 12, o_orderkey * 32 + 20, true, false FROM {orders} WHERE o_orderkey % 10 = 7
UNION ALL
SELECT o_orderkey * 32 + 12, o_orderkey * 32 + 21, false, o_orderkey % 40 = 37 FROM {orders} WHERE o_orderkey % 10 = 7
UNION ALL
SELECT o_orderkey * 32 + 12, o_orderkey * 32 + 5, false, false FROM {orders} WHERE o_orderkey % 20 = 7
"""

VIEWS["featureprop"] = f"""
SELECT p_partkey * 32 + 1 AS featureprop_id, {GENE} AS feature_id, cast(41 as bigint) AS type_id,
       cast(p_partkey % 3 + 1 as string) || CASE p_partkey % 4 WHEN 0 THEN 'A' WHEN 1 THEN 'B' WHEN 2 THEN 'C' ELSE 'D' END
         || cast(p_partkey % 9 + 1 as string) AS value, cast(0 as bigint) AS rank
FROM {{part}}
UNION ALL
SELECT p_partkey * 32 + 2, {GENE}, cast(41 as bigint),
       CASE WHEN p_partkey % 4 = 0 THEN cast(p_partkey % 3 + 1 as string) || 'A' || cast(p_partkey % 9 + 1 as string)
            ELSE cast(p_partkey % 5 + 1 as string) || 'E' || cast(p_partkey % 7 + 1 as string) END,
       cast(1 as bigint)
FROM {{part}} WHERE p_partkey % 2 = 0
UNION ALL
SELECT p_partkey * 32 + 3, {GENE}, cast(40 as bigint), p_brand, cast(0 as bigint) FROM {{part}} WHERE p_partkey % 2 = 1
UNION ALL
SELECT p_partkey * 32 + 4, {GENE}, cast(40 as bigint), 'aka' || cast(p_partkey % 10 as string), cast(1 as bigint)
FROM {{part}} WHERE p_partkey % 3 = 0
UNION ALL
SELECT p_partkey * 32 + 5, {GENE}, cast(40 as bigint), p_brand, cast(2 as bigint) FROM {{part}} WHERE p_partkey % 6 = 3
UNION ALL
SELECT p_partkey * 32 + 6, {GENE}, cast(42 as bigint), 'yes', cast(0 as bigint) FROM {{part}} WHERE p_partkey % 9 = 0
UNION ALL
SELECT p_partkey * 32 + 7, {GENE}, cast(46 as bigint), 'Snapshot of ' || p_name, cast(0 as bigint)
FROM {{part}} WHERE p_partkey % 4 = 0
UNION ALL
SELECT p_partkey * 32 + 8, {GENE}, cast(46 as bigint), 'Second snapshot', cast(1 as bigint)
FROM {{part}} WHERE p_partkey % 8 = 0
UNION ALL
SELECT p_partkey * 32 + 9, {GENE}, cast(59 as bigint), 'note', cast(0 as bigint) FROM {{part}} WHERE p_partkey % 2 = 1
UNION ALL
SELECT o_orderkey * 32 + 10, {ALLELE}, cast(44 as bigint),
       cast(o_orderkey * 10 as string) || chr(9) || '@' || {fbid('FBst', 'o_orderkey')} || ':w[' || cast(o_orderkey as string)
         || ']; al' || cast(o_orderkey as string) || '@'
         || CASE WHEN o_orderkey % 3 = 0
                 THEN chr(10) || cast(o_orderkey * 10 + 1 as string) || chr(9) || '@' || {fbid('FBst', 'o_orderkey + 1')}
                      || ':y[1] w[*]@'
                 ELSE '' END,
       cast(0 as bigint)
FROM {{orders}} WHERE o_orderkey % 2 = 0
UNION ALL
SELECT o_orderkey * 32 + 11, {ALLELE}, cast(CASE WHEN o_orderkey % 10 = 5 THEN 60 ELSE 45 END as bigint),
       'K' || cast(o_orderkey as string) || chr(9) || ' @' || {fbid('FBst', 'o_orderkey')}
         || ':Df(1)' || cast(o_orderkey as string) || ':extra@ ',
       cast(0 as bigint)
FROM {{orders}} WHERE o_orderkey % 5 = 0
UNION ALL
SELECT o_orderkey * 32 + 12, {ALLELE}, cast(58 as bigint),
       '@FBcv' || {pad('(o_orderkey % 40) * 5 + 4')} || ':allele class ' || cast((o_orderkey % 40) * 5 + 4 as string) || '@'
         || CASE WHEN o_orderkey % 8 = 0
                 THEN ', @FBcv' || {pad('((o_orderkey + 7) % 40) * 5 + 4')} || ':allele class '
                      || cast(((o_orderkey + 7) % 40) * 5 + 4 as string) || '@'
                 ELSE '' END
         || CASE WHEN o_orderkey % 16 = 0
                 THEN ',@FBcv' || {pad('(o_orderkey % 40) * 5 + 4')} || ':duplicate name@' ELSE '' END,
       cast(0 as bigint)
FROM {{orders}} WHERE o_orderkey % 4 = 0
UNION ALL
SELECT o_orderkey * 32 + 13, {ALLELE}, cast(61 as bigint), CASE WHEN o_orderkey % 12 = 0 THEN 'n' ELSE 'y' END,
       cast(0 as bigint)
FROM {{orders}} WHERE o_orderkey % 6 = 0
UNION ALL
SELECT o_orderkey * 32 + 14, {ALLELE}, cast(62 as bigint), 'lesion', cast(0 as bigint)
FROM {{orders}} WHERE o_orderkey % 5 = 1
UNION ALL
SELECT o_orderkey * 32 + 15, {ALLELE}, cast(63 as bigint), 'image', cast(0 as bigint)
FROM {{orders}} WHERE o_orderkey % 7 = 1
UNION ALL
SELECT c_custkey * 32 + 16, c_custkey * 32 + 4, cast(44 as bigint),
       cast(c_custkey as string) || chr(9) || '@' || {fbid('FBst', 'c_custkey * 3')} || ':ti' || cast(c_custkey as string) || '@',
       cast(0 as bigint)
FROM {{customer}} WHERE c_custkey % 4 = 0
UNION ALL
SELECT o_orderkey * 32 + 17, o_orderkey * 32 + 9, cast(44 as bigint),
       cast(o_orderkey as string) || chr(9) || '@' || {fbid('FBst', 'o_orderkey * 5')} || ':co' || cast(o_orderkey as string) || '@',
       cast(0 as bigint)
FROM {{orders}} WHERE o_orderstatus = 'P' AND o_orderkey % 3 = 1
UNION ALL
SELECT o_orderkey * 32 + 18, {ALLELE}, cast(67 as bigint), 'Comment on allele ' || cast(o_orderkey as string),
       cast(0 as bigint)
FROM {{orders}} WHERE o_orderkey % 10 IN (7, 8)
UNION ALL
SELECT o_orderkey * 32 + 19, {ALLELE}, cast(68 as bigint), 'Variant comment ' || cast(o_orderkey as string),
       cast(0 as bigint)
FROM {{orders}} WHERE o_orderkey % 20 = 7
UNION ALL
SELECT o_orderkey * 32 + 20, {ALLELE}, cast(69 as bigint), 'yes', cast(0 as bigint)
FROM {{orders}} WHERE o_orderkey % 10 IN (7, 8)
"""

VIEWS["featureprop_pub"] = """
SELECT o_orderkey * 32 + 13 AS featureprop_id, doc_id * 2 + 1 AS pub_id
FROM {orders} JOIN {documents} ON o_orderkey = doc_id
WHERE o_orderkey % 6 = 0
UNION ALL
SELECT o_orderkey * 32 + 20, doc_id * 2 + 1
FROM {orders} JOIN {documents} ON cast(floor(o_orderkey / 15) as bigint) = doc_id
WHERE o_orderkey % 10 IN (7, 8)
UNION ALL
SELECT o_orderkey * 32 + 20, doc_id * 2 + 1
FROM {orders} JOIN {documents} ON cast(floor(o_orderkey / 15) as bigint) + 1 = doc_id
WHERE o_orderkey % 20 = 7
"""

VIEWS["pub"] = f"""
SELECT doc_id * 2 + 1 AS pub_id,
       CASE WHEN doc_id % 13 = 12 THEN 'unattributed_' || cast(doc_id as string) ELSE {fbid('FBrf', 'doc_id')} END AS uniquename,
       CASE WHEN doc_id % 9 = 4 THEN cast(NULL as string)
            WHEN doc_id % 9 = 7 THEN 'Anonymous ' || cast(doc_id as string)
            ELSE 'Author' || cast(doc_id % 50 as string) || ' et al., ' || cast(1980 + doc_id % 40 as string)
                 || ', J. ' || source || ' ' || cast(doc_id % 100 as string) END AS miniref,
       cast(CASE WHEN doc_id % 3 = 0 THEN 81 ELSE 80 END as bigint) AS type_id,
       doc_id % 11 = 10 AS is_obsolete
FROM {{documents}}
"""

VIEWS["pubprop"] = """
SELECT doc_id * 2 + 1 AS pub_id, cast(CASE WHEN doc_id % 2 = 0 THEN 40 ELSE 59 END as bigint) AS type_id,
       lang AS value
FROM {documents}
"""

VIEWS["feature_pub"] = """
SELECT l_partkey * 32 + 1 AS feature_id, doc_id * 2 + 1 AS pub_id
FROM {lineitem} JOIN {documents} ON l_orderkey = doc_id
UNION ALL
SELECT o_orderkey * 32 + 2, doc_id * 2 + 1 FROM {orders} JOIN {documents} ON o_orderkey = doc_id
UNION ALL
SELECT o_orderkey * 32 + 2, doc_id * 2 + 1 FROM {orders} JOIN {documents} ON o_orderkey = doc_id + 1
UNION ALL
SELECT c_custkey * 32 + 4, doc_id * 2 + 1 FROM {customer} JOIN {documents} ON c_custkey = doc_id
UNION ALL
SELECT o_orderkey * 32 + 9, doc_id * 2 + 1 FROM {orders} JOIN {documents} ON o_orderkey = doc_id * 2
WHERE o_orderstatus = 'P'
"""

# Ontology annotations: one per line item.  Seventh lines annotate their
# construct, the first two 'A' lines their allele, all others their gene; a
# gene gets varying terms from every sixth order and its own term otherwise (so
# that some genes end up with few GO aspects).
_ANNOTATED = "CASE WHEN l_linenumber = 7 THEN 3 WHEN l_returnflag = 'A' AND l_linenumber <= 2 THEN 2 ELSE 1 END"
VIEWS["feature_cvterm"] = f"""
SELECT {_LI} * 4 AS feature_cvterm_id,
       CASE {_ANNOTATED} WHEN 3 THEN l_suppkey * 32 + 3 WHEN 2 THEN l_orderkey * 32 + 2 ELSE l_partkey * 32 + 1 END AS feature_id,
       1000 + CASE WHEN {_ANNOTATED} = 3 THEN l_suppkey * 5 + 4 WHEN {_ANNOTATED} = 2 THEN l_partkey * 3
                   WHEN l_orderkey % 6 = 0 THEN l_orderkey + l_partkey ELSE l_partkey * 7 END % n AS cvterm_id,
       {_ANNOTATED} = 1 AND l_orderkey % 13 = 0 AS is_not
FROM {{lineitem}} CROSS JOIN {{ontology_size}}
"""

_EVIDENCE = [
    "inferred from direct assay",
    "inferred from electronic annotation with InterPro:IPR000001",
    "CEA",
    "Inferred from mutant phenotype",
    "IEA",
    "CEC; inferred from high throughput direct assay",
    "inferred from physical interaction with ANNOBASE:x",
]


def _evidence_case(col: str) -> str:
    whens = " ".join(f"WHEN {i + 1} THEN '{v}'" for i, v in enumerate(_EVIDENCE))
    return f"CASE {col} {whens} END"


VIEWS["feature_cvtermprop"] = f"""
SELECT {_LI} * 4 AS feature_cvterm_id, cast(47 as bigint) AS type_id,
       CASE WHEN {_ANNOTATED} = 2 THEN {_evidence_case('(l_partkey % 7) + 1')} ELSE {_evidence_case('l_linenumber')} END AS value,
       cast(0 as bigint) AS rank
FROM {{lineitem}}
UNION ALL
SELECT {_LI} * 4,
       cast(CASE WHEN {_ANNOTATED} = 3 THEN 57 WHEN {_ANNOTATED} = 2 THEN CASE l_linenumber WHEN 1 THEN 56 ELSE 57 END
                 WHEN l_orderkey % 11 = 0 THEN 49 WHEN l_orderkey % 2 = 0 THEN 48 ELSE 59 END as bigint),
       CASE WHEN {_ANNOTATED} > 1 THEN 'yes' WHEN l_orderkey % 11 = 0 THEN ''
            ELSE CASE l_linenumber % 3 WHEN 0 THEN 'model of' WHEN 1 THEN 'is not model of' ELSE 'DOES NOT model' END END,
       cast(0 as bigint)
FROM {{lineitem}}
"""

VIEWS["feature_dbxref"] = """
SELECT p_partkey * 32 + 1 AS feature_id, p_partkey * 32 + 1 AS dbxref_id, true AS is_current FROM {part}
UNION ALL
SELECT p_partkey * 32 + 1, cast(floor(p_partkey / 2) as bigint) * 32 + 2, false FROM {part} WHERE p_partkey % 3 <> 2
UNION ALL
SELECT o_orderkey * 32 + 2, cast(floor(o_orderkey / 2) as bigint) * 32 + 2, false
FROM {orders} WHERE o_orderkey % 10 = 0
UNION ALL
SELECT p_partkey * 32 + 1, p_partkey * 32 + 3, p_partkey % 16 <> 12 FROM {part} WHERE p_partkey % 4 = 0
UNION ALL
SELECT p_partkey * 32 + 1, p_partkey * 32 + 4, true FROM {part} WHERE p_partkey % 3 = 0
UNION ALL
SELECT p_partkey * 32 + 1, p_partkey * 32 + 5, true FROM {part} WHERE p_partkey % 5 = 0
UNION ALL
SELECT c_custkey * 32 + 5, c_custkey * 32 + 6, c_custkey % 25 <> 15 FROM {customer} WHERE c_custkey % 5 = 0
UNION ALL
SELECT o_orderkey * 32 + 12, o_orderkey * 32 + 9, o_orderkey % 40 <> 27 FROM {orders} WHERE o_orderkey % 10 = 7
UNION ALL
SELECT o_orderkey * 32 + 12, cast(floor(o_orderkey / 2) as bigint) * 32 + 2, true FROM {orders} WHERE o_orderkey % 20 = 17
"""

# Gene groups from supplier.
VIEWS["grp"] = f"""
SELECT s_suppkey AS grp_id,
       CASE WHEN s_suppkey % 31 = 30 THEN {fbid('FBgg', 's_suppkey')} || 'x' ELSE {fbid('FBgg', 's_suppkey')} END AS uniquename,
       s_name AS name, s_suppkey % 29 = 28 AS is_analysis, s_suppkey % 17 = 16 AS is_obsolete
FROM {{supplier}}
"""

VIEWS["grp_cvterm"] = """
SELECT s_suppkey AS grp_id,
       CASE WHEN s_suppkey % 3 = 0 THEN cast(91 as bigint) ELSE 1000 + (s_suppkey * 5 + 4) % n END AS cvterm_id
FROM {supplier} CROSS JOIN {ontology_size}
UNION ALL
SELECT s_suppkey, 1000 + (s_suppkey * 5 + 9) % n FROM {supplier} CROSS JOIN {ontology_size}
WHERE s_suppkey % 6 = 0
"""

VIEWS["grp_synonym"] = """
SELECT s_suppkey AS grp_id, s_suppkey * 32 + 12 AS synonym_id, s_suppkey % 10 <> 3 AS is_current, false AS is_internal
FROM {supplier}
UNION ALL
SELECT s_suppkey, s_suppkey * 32 + 13, s_suppkey % 10 <> 7, false FROM {supplier}
"""

VIEWS["grp_pub"] = """
SELECT s_suppkey AS grp_id, doc_id * 2 + 1 AS pub_id FROM {supplier} JOIN {documents} ON doc_id = s_suppkey * 3
"""

VIEWS["grpmember"] = """
SELECT s_suppkey * 2 AS grpmember_id, s_suppkey AS grp_id, cast(54 as bigint) AS type_id FROM {supplier}
UNION ALL
SELECT s_suppkey * 2 + 1, s_suppkey, cast(55 as bigint) FROM {supplier}
"""

VIEWS["grpmemberprop"] = f"""
SELECT s_suppkey * 2 AS grpmember_id, cast(50 as bigint) AS type_id,
       CASE WHEN s_suppkey % 4 = 0 THEN '@' || {fbid('FBgg', 's_suppkey + 1')} || ':Subgroup ' || cast(s_suppkey + 1 as string) || '@'
            WHEN s_suppkey % 4 = 2 THEN '@' || {fbid('FBgg', 's_suppkey + 2')} || ':Other ' || cast(s_suppkey as string) || '@'
            ELSE 'Plain label ' || cast(s_suppkey as string) END AS value,
       cast(0 as bigint) AS rank
FROM {{supplier}} WHERE s_suppkey % 4 <> 3
UNION ALL
SELECT s_suppkey * 2, cast(59 as bigint), 'internal ' || cast(s_suppkey as string), cast(0 as bigint)
FROM {{supplier}} WHERE s_suppkey % 3 = 0
"""

VIEWS["feature_grpmember"] = f"""
SELECT {_LI} AS feature_grpmember_id, l_partkey * 32 + 1 AS feature_id, 
       l_suppkey * 2 + CASE WHEN l_linenumber = 1 THEN 0 ELSE 1 END AS grpmember_id
FROM {{lineitem}}
"""

VIEWS["feature_grpmember_pub"] = f"""
SELECT {_LI} AS feature_grpmember_id, doc_id * 2 + 1 AS pub_id
FROM {{lineitem}} JOIN {{documents}} ON doc_id = l_orderkey
UNION ALL
SELECT {_LI}, doc_id * 2 + 1
FROM {{lineitem}} JOIN {{documents}} ON doc_id = l_orderkey + 1 WHERE l_orderkey % 2 = 0
"""

VIEWS["library"] = f"""
SELECT cast(n_nationkey as bigint) AS library_id, {fbid('FBlc', 'n_nationkey')} AS uniquename,
       n_nationkey % 6 = 5 AS is_obsolete
FROM {{nation}}
"""

VIEWS["library_feature"] = """
SELECT p_partkey AS library_feature_id, p_partkey % 25 AS library_id, p_partkey * 32 + 1 AS feature_id
FROM {part} WHERE p_partkey % 6 = 0
"""

VIEWS["library_featureprop"] = """
SELECT p_partkey AS library_feature_id, cast(CASE WHEN p_partkey % 12 = 6 THEN 59 ELSE 43 END as bigint) AS type_id,
       '0.' || lpad(cast(p_partkey % 1000 as string), 3, '0') AS value
FROM {part} WHERE p_partkey % 6 = 0
"""

VIEWS["library_synonym"] = """
SELECT cast(n_nationkey as bigint) AS library_id, cast(n_nationkey as bigint) * 32 + 17 AS synonym_id,
       true AS is_current, false AS is_internal
FROM {nation}
"""

VIEWS["library_pub"] = """
SELECT cast(n_nationkey as bigint) AS library_id, doc_id * 2 + 1 AS pub_id
FROM {nation} JOIN {documents} ON doc_id = n_nationkey * 7
"""

VIEWS["stock"] = f"""
SELECT o_orderkey AS stock_id, {fbid('FBst', 'o_orderkey')} AS uniquename, o_orderkey % 17 = 3 AS is_obsolete
FROM {{orders}} WHERE o_orderkey % 2 = 0
"""

VIEWS["stock_genotype"] = """
SELECT o_orderkey AS stock_id, o_orderkey AS genotype_id FROM {orders} WHERE o_orderkey % 2 = 0
"""

VIEWS["genotype"] = """
SELECT o_orderkey AS genotype_id, 'w[' || cast(o_orderkey as string) || ']; al' || cast(o_orderkey as string) AS uniquename
FROM {orders} WHERE o_orderkey % 2 = 0
"""

VIEWS["strain"] = f"""
SELECT s_suppkey AS strain_id, {fbid('FBsn', 's_suppkey')} AS uniquename, s_suppkey % 8 = 4 AS is_obsolete
FROM {{supplier}} WHERE s_suppkey % 4 = 0
"""

VIEWS["strain_synonym"] = """
SELECT s_suppkey AS strain_id, s_suppkey * 32 + 18 AS synonym_id, true AS is_current, false AS is_internal
FROM {supplier} WHERE s_suppkey % 4 = 0
"""

VIEWS["strain_pub"] = """
SELECT s_suppkey AS strain_id, doc_id * 2 + 1 AS pub_id FROM {supplier} JOIN {documents} ON doc_id = s_suppkey * 2
WHERE s_suppkey % 4 = 0
"""

# cell_line is deliberately built without ``is_obsolete`` (the column some
# releases lack; see ``ensure_column``).
VIEWS["cell_line"] = f"""
SELECT s_suppkey AS cell_line_id, {fbid('FBtc', 's_suppkey')} AS uniquename
FROM {{supplier}} WHERE s_suppkey % 5 = 0
"""

VIEWS["cell_line_synonym"] = """
SELECT s_suppkey AS cell_line_id, s_suppkey * 32 + 19 AS synonym_id, true AS is_current, false AS is_internal
FROM {supplier} WHERE s_suppkey % 5 = 0
"""

VIEWS["cell_line_pub"] = """
SELECT s_suppkey AS cell_line_id, doc_id * 2 + 1 AS pub_id FROM {supplier} JOIN {documents} ON doc_id = s_suppkey + 1
WHERE s_suppkey % 5 = 0
"""

VIEWS["humanhealth"] = f"""
SELECT cast(n_nationkey as bigint) AS humanhealth_id, {fbid('FBhh', 'n_nationkey')} AS uniquename,
       n_nationkey % 7 = 6 AS is_obsolete
FROM {{nation}}
"""

VIEWS["humanhealth_synonym"] = """
SELECT cast(n_nationkey as bigint) AS humanhealth_id, cast(n_nationkey as bigint) * 32 + 15 AS synonym_id,
       true AS is_current, false AS is_internal
FROM {nation}
UNION ALL
SELECT cast(n_nationkey as bigint), cast(n_nationkey as bigint) * 32 + 16, n_nationkey % 4 <> 1, false FROM {nation}
"""

VIEWS["humanhealth_pub"] = """
SELECT cast(n_nationkey as bigint) AS humanhealth_id, doc_id * 2 + 1 AS pub_id
FROM {nation} JOIN {documents} ON doc_id % 25 = n_nationkey
"""

VIEWS["interaction_group"] = f"""
SELECT {fbid('FBig', 'r_regionkey')} AS uniquename, r_regionkey = 4 AS is_obsolete FROM {{region}}
UNION ALL
SELECT {fbid('FBig', 'n_nationkey + 100')}, n_nationkey % 9 = 8 FROM {{nation}}
"""

# ---------------------------------------------------------------------------
# Flat-file inputs rendered as text lines (one row = one line), so the file
# parsers run on data that grows with the tables.
# ---------------------------------------------------------------------------

# Submitted id list.  Kinds: live gene id, secondary id, allele id,
# unknown id; repeated ids are kept.
VIEWS["submitted_ids"] = f"""
SELECT CASE l_orderkey % 5
         WHEN 0 THEN {fbid('FBgn', 'l_partkey')}
         WHEN 1 THEN {fbid('FBgn', 'l_partkey')}
         WHEN 2 THEN {fbid('FBgn9', 'cast(floor(l_partkey / 2) as bigint)')}
         WHEN 3 THEN {fbid('FBal', 'l_orderkey')}
         ELSE {fbid('FBgn8', 'l_orderkey')} END AS value
FROM {{lineitem}}
"""

# S3: locations ``scaffold:min..max``; thousands separators on some; a few
# malformed lines; some lines repeat.
VIEWS["location_lines"] = """
SELECT CASE WHEN c_custkey % 97 = 96 THEN 'junk line ' || cast(c_custkey as string)
            WHEN c_custkey % 4 = 0 AND c_custkey * 70 + 5 >= 1000
              THEN n_name || ':' || left(cast(c_custkey * 70 + 5 as string), length(cast(c_custkey * 70 + 5 as string)) - 3)
                   || ',' || right(cast(c_custkey * 70 + 5 as string), 3)
                   || '..' || cast(c_custkey * 70 + 5 + c_custkey % 500 as string)
            ELSE n_name || ':' || cast(c_custkey * 70 + 5 as string) || '..' || cast(c_custkey * 70 + 5 + c_custkey % 500 as string)
       END AS value
FROM {customer} JOIN {nation} ON n_nationkey = c_custkey % 25
UNION ALL
SELECT n_name || ':' || cast(c_custkey * 70 + 5 as string) || '..' || cast(c_custkey * 70 + 5 + c_custkey % 500 as string)
FROM {customer} JOIN {nation} ON n_nationkey = c_custkey % 25
WHERE c_custkey % 5 = 1
"""

# Web-log hit CSV; column 0 sometimes holds a surface-feature id.
VIEWS["hit_lines"] = f"""
SELECT CASE WHEN event_id % 10 = 0 THEN ''
            WHEN event_type IN ('click', 'view')
              THEN '/reports/' || {fbid('FBsf', 'user_id * 7')} || '.html,' || cast(event_id as string)
            ELSE '/search?q=' || event_type || ',' || cast(event_id as string) END AS value
FROM {{events}}
"""

# Summary TSV lines (``#`` comments, ``FB:``-prefixed ids).
VIEWS["summary_lines"] = f"""
SELECT '#comment ' || r_name AS value FROM {{region}}
UNION ALL
SELECT 'FB:' || {fbid('FBgn', 'p_partkey')} || chr(9) || replace(p_name, ' ', '-') || chr(9)
       || CASE WHEN p_partkey % 8 = 1 THEN 'No description available'
               WHEN p_partkey % 8 = 5 THEN 'no Description Available'
               ELSE 'Summary of ' || p_name END
FROM {{part}} WHERE p_partkey % 3 <> 2
"""


# Enzyme records, one record per row (what ``lineSep='//\n'`` gives on
# the flat file).  Some are transferred or deleted, some missing, some have
# multi-line DE / CA fields.
VIEWS["enzyme_records"] = """
SELECT 'ID   ' || accession || chr(10)
       || 'DE   ' || CASE WHEN e % 13 = 0 THEN 'Transferred entry: 1.1.1.' || cast(e as string) || '.'
                          WHEN e % 17 = 0 THEN 'Deleted entry.'
                          ELSE 'Enzyme number ' || cast(e as string) || '.' END || chr(10)
       || CASE WHEN e % 3 = 0 THEN 'DE   Second name of ' || cast(e as string) || '.' || chr(10) ELSE '' END
       || 'CA   Substrate ' || cast(e as string) || ' + H(2)O =' || chr(10)
       || 'CA   product 2.7.1.' || cast(e % 9 as string) || '.' || chr(10)
       || CASE WHEN e % 4 = 0 THEN 'CA   (2) ATP + water = ADP.  Second reaction.' || chr(10) ELSE '' END
       || 'CC   -!- Comment line ' || cast(e as string) || '.' || chr(10)
       || 'DR   P00001, X_HUMAN;' || chr(10) AS value
FROM {ec_numbers_src} WHERE e % 50 NOT IN (0, 25) AND e % 19 <> 7
"""

# Enzyme class lines (``1. 1. 1.-    Name``) with a line number; a class
# id may repeat (the last line wins); header lines do not match.
VIEWS["enzyme_class_lines"] = """
SELECT cast(0 as bigint) AS line_no, 'ENZYME nomenclature database' AS value
UNION ALL
SELECT e * 4 + 1, replace(replace(CASE WHEN e % 50 = 0 THEN accession ELSE accession || '.-' END, '.', '. '), '. -', '.-')
       || '    Class name ' || cast(e as string)
FROM {ec_numbers_src} WHERE e % 50 IN (0, 25)
UNION ALL
SELECT e * 4 + 2, replace(replace(CASE WHEN e % 50 = 0 THEN accession ELSE accession || '.-' END, '.', '. '), '. -', '.-')
       || '  Renamed class ' || cast(e as string)
FROM {ec_numbers_src} WHERE e % 100 = 0
UNION ALL
SELECT e * 4 + 3, cast(e % 6 + 1 as string) || '. ' || cast(e % 5 + 1 as string) || '. '
       || cast(e % 3 + 1 as string) || '. ' || cast(e + 1 as string) || '.-  Leaf class ' || cast(e as string)
FROM {ec_numbers_src} WHERE e % 19 = 7 AND e % 2 = 1
"""

VIEWS["humanhealth_feature"] = """
SELECT cast(o_orderkey % 25 as bigint) AS humanhealth_id, o_orderkey * 32 + 12 AS feature_id
FROM {orders} WHERE o_orderkey % 10 = 7
UNION ALL
SELECT cast((o_orderkey + 3) % 25 as bigint), o_orderkey * 32 + 12 FROM {orders} WHERE o_orderkey % 20 = 17
"""
