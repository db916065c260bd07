"""Explicit schemas of the annotation tables (S1): long keys, text, boolean.

``COLUMNS`` names every table and column that a plan reads; a catalog over real
tables (``tables.annotation_catalog``) knows these and nothing else."""

from __future__ import annotations

from pyspark.sql import types as T

# fixed values: columns by table; a column is text unless its name or the sets below say otherwise
COLUMNS = {
    "feature": "feature_id uniquename name type_id organism_id is_analysis is_obsolete",
    "feature_relationship": "feature_relationship_id subject_id object_id type_id rank value",
    "feature_relationshipprop": "feature_relationship_id value",
    "featureprop": "featureprop_id feature_id type_id value rank",
    "featureprop_pub": "featureprop_id pub_id",
    "feature_cvterm": "feature_cvterm_id feature_id cvterm_id is_not",
    "feature_cvtermprop": "feature_cvterm_id type_id value rank",
    "feature_dbxref": "feature_id dbxref_id is_current",
    "feature_pub": "feature_id pub_id",
    "feature_synonym": "feature_id synonym_id is_current is_internal",
    "featureloc": "feature_id srcfeature_id fmin fmax locgroup",
    "synonym": "synonym_id name synonym_sgml type_id",
    "cv": "cv_id name",
    "cvterm": "cvterm_id cv_id name is_obsolete dbxref_id is_relationshiptype",
    "cvtermprop": "cvterm_id type_id value",
    "cvterm_dbxref": "cvterm_id dbxref_id",
    "db": "db_id name urlprefix",
    "dbxref": "dbxref_id db_id accession description",
    "dbxrefprop": "dbxref_id type_id value rank",
    "organism": "organism_id genus species common_name",
    "pub": "pub_id uniquename miniref type_id is_obsolete",
    "pubprop": "pub_id type_id value",
    "grp": "grp_id uniquename name is_analysis is_obsolete",
    "grpmember": "grpmember_id grp_id type_id",
    "grpmemberprop": "grpmember_id type_id value rank",
    "feature_grpmember": "feature_grpmember_id feature_id grpmember_id",
    "feature_grpmember_pub": "feature_grpmember_id pub_id",
    "grp_cvterm": "grp_id cvterm_id",
    "stock": "stock_id uniquename is_obsolete",
    "stock_genotype": "stock_id genotype_id",
    "genotype": "genotype_id uniquename",
    "strain": "strain_id uniquename is_obsolete",
    "cell_line": "cell_line_id uniquename is_obsolete",
    "humanhealth": "humanhealth_id uniquename is_obsolete",
    "humanhealth_feature": "humanhealth_id feature_id",
    "library": "library_id uniquename is_obsolete",
    "library_feature": "library_feature_id library_id feature_id",
    "library_featureprop": "library_feature_id type_id value",
    "interaction_group": "uniquename is_obsolete",
}
# the objects that are named and published like features: their link tables
for _t in ("grp", "strain", "cell_line", "humanhealth", "library"):
    COLUMNS[f"{_t}_synonym"] = f"{_t}_id synonym_id is_current is_internal"
    COLUMNS[f"{_t}_pub"] = f"{_t}_id pub_id"
#: columns that older tables lack; R13 gives them their default
OPTIONAL = {("cell_line", "is_obsolete")}
NUMBERS = {"rank", "fmin", "fmax", "locgroup", "is_relationshiptype"}


def table_schema(name: str, without: set[str] = frozenset()) -> T.StructType:
    """Schema of an annotation table, less the columns ``without``.  ``cvterm.is_obsolete`` is a number."""
    def kind(c: str):
        if c.endswith("_id") or c in NUMBERS or (name, c) == ("cvterm", "is_obsolete"):
            return T.LongType()
        return T.BooleanType() if c.startswith("is_") else T.StringType()

    return T.StructType([T.StructField(c, kind(c)) for c in COLUMNS[name].split() if c not in without])
