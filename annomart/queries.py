"""Registered queries: ``name -> fn(spark, sf_dir) -> DataFrame``.

Every query reads the given tables (through the adapter views) in full and
returns scalar columns (arrays joined, structs flattened) so results can be
compared with the DuckDB formulations in :mod:`annomart.oracle_sql`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .plans import dataclass as dc
from .session import flatten
from .sources.tables import Catalog

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


_CATALOGS: dict = {}


def cat(spark: SparkSession, sf_dir: str) -> Catalog:
    """One catalog per (session, source folder): staged tables are opened
    once and their DataFrames reused by every query of the session."""
    key = (id(spark), sf_dir)
    c = _CATALOGS.get(key)
    if c is None or c.spark is not spark:
        c = _CATALOGS[key] = Catalog(spark, sf_dir)
    return c


@query("dataclass_gene")
def q_dataclass_gene(spark, sf_dir):
    return flatten(dc.gene(cat(spark, sf_dir)))


# --------------------------------------------------------------------------
# inputs shared by the lookup queries
# --------------------------------------------------------------------------

def all_entity_ids(c: Catalog) -> DataFrame:
    """Every uniquename of every entity table (feature, groups, stocks,
    strains, cell lines, disease reports, libraries) - duplicates kept."""
    from pyspark.sql import functions as F
    tables = ["feature", "grp", "stock", "strain", "cell_line", "humanhealth", "library"]
    out = None
    for t in tables:
        d = c[t].select(F.col("uniquename").alias("id"))
        out = d if out is None else out.unionByName(d)
    return out


def feature_ids(c: Catalog) -> DataFrame:
    return c["feature"].select(c["feature"]["uniquename"].alias("id"))


# --------------------------------------------------------------------------
# U1-U11
# --------------------------------------------------------------------------

@query("update_ids")
def q_update_ids(spark, sf_dir):
    from .operators.ids import clean_id_lines, update_ids
    c = cat(spark, sf_dir)
    return update_ids(c, clean_id_lines(c["submitted_ids"]))


@query("current_symbol")
def q_current_symbol(spark, sf_dir):
    from .operators.lookups import current_synonym
    c = cat(spark, sf_dir)
    return current_synonym(c, all_entity_ids(c), "id", "symbol")


@query("current_fullname")
def q_current_fullname(spark, sf_dir):
    from .operators.lookups import current_synonym
    c = cat(spark, sf_dir)
    return current_synonym(c, all_entity_ids(c), "id", "fullname")


@query("related_features_subject")
def q_related_subject(spark, sf_dir):
    from .operators.lookups import related_features
    c = cat(spark, sf_dir)
    return related_features(c, feature_ids(c), "id", "alleleof", "FBal", "subject")


@query("related_features_object")
def q_related_object(spark, sf_dir):
    from .operators.lookups import related_features
    c = cat(spark, sf_dir)
    return related_features(c, feature_ids(c), "id", "associated_with|encodes_tool", "FBtp|FBto|FBti", "object")


@query("related_features_pattern")
def q_related_pattern(spark, sf_dir):
    from .operators.lookups import related_features
    c = cat(spark, sf_dir)
    return related_features(c, feature_ids(c), "id", "has_reg%|tagged_wit_", None, "object")


@query("feature_props")
def q_feature_props(spark, sf_dir):
    from .operators.lookups import feature_props
    c = cat(spark, sf_dir)
    return feature_props(c, feature_ids(c), "id", "%").drop("feature_id")


@query("pub_props")
def q_pub_props(spark, sf_dir):
    from .operators.lookups import pub_props
    c = cat(spark, sf_dir)
    return pub_props(c, c["pub"].select("uniquename"), "uniquename", "%")


@query("group_member_props")
def q_group_member_props(spark, sf_dir):
    from .operators.lookups import group_member_props
    c = cat(spark, sf_dir)
    return group_member_props(c, c["grpmember"].select("grpmember_id"), "grpmember_id", "derived%|internal_note")


@query("ontology_terms_mf")
def q_ontology_terms(spark, sf_dir):
    from .operators.lookups import ontology_terms
    c = cat(spark, sf_dir)
    return ontology_terms(c, feature_ids(c), "id", "molecular_function")


@query("stocks")
def q_stocks(spark, sf_dir):
    from .operators.lookups import stocks
    c = cat(spark, sf_dir)
    return stocks(c, feature_ids(c), "id")


@query("pub_count")
def q_pub_count(spark, sf_dir):
    from .operators.lookups import pub_count
    c = cat(spark, sf_dir)
    return pub_count(c, all_entity_ids(c), "id")


@query("paper_count")
def q_paper_count(spark, sf_dir):
    from .operators.lookups import pub_count
    c = cat(spark, sf_dir)
    return pub_count(c, all_entity_ids(c), "id", pub_type="paper")


@query("pathways")
def q_pathways(spark, sf_dir):
    from .plans import groups
    return groups.pathway(cat(spark, sf_dir)).select("grp_id", "uniquename", "name", "fullname")


# --------------------------------------------------------------------------
# T21-T25
# --------------------------------------------------------------------------

@query("dataclass_allele")
def q_dataclass_allele(spark, sf_dir):
    return dc.allele(cat(spark, sf_dir))


@query("dataclass_disease")
def q_dataclass_disease(spark, sf_dir):
    return dc.disease(cat(spark, sf_dir))


@query("dataclass_enzyme")
def q_dataclass_enzyme(spark, sf_dir):
    return dc.enzyme(cat(spark, sf_dir))


@query("dataclass_gene_group")
def q_dataclass_gene_group(spark, sf_dir):
    return dc.gene_group(cat(spark, sf_dir))


@query("dataclass_ortholog")
def q_dataclass_ortholog(spark, sf_dir):
    return dc.ortholog(cat(spark, sf_dir))


# --------------------------------------------------------------------------
# T14, T26-T30
# --------------------------------------------------------------------------

@query("gene_allele")
def q_gene_allele(spark, sf_dir):
    from .plans import relationships as r
    return r.gene_allele(cat(spark, sf_dir))


@query("gene_disease")
def q_gene_disease(spark, sf_dir):
    from .plans import relationships as r
    return r.gene_disease(cat(spark, sf_dir))


@query("gene_enzyme")
def q_gene_enzyme(spark, sf_dir):
    from .plans import relationships as r
    return r.gene_enzyme(cat(spark, sf_dir))


@query("gene_go_molecular_function")
def q_gene_go_mf(spark, sf_dir):
    from .plans import relationships as r
    return r.gene_go_molecular_function(cat(spark, sf_dir))


@query("gene_group_member")
def q_gene_group_member(spark, sf_dir):
    from pyspark.sql import functions as F
    from .plans import relationships as r
    df = r.gene_group_member(cat(spark, sf_dir))
    pubs = F.transform("gene_group_pubs", lambda p: F.concat_ws("|", p["id"], F.coalesce(p["name"], F.lit(""))))
    return df.select("gene_id", "gene_group_id", "subgroup_id", "group_member_label",
                     F.size("gene_group_pubs").alias("n_pubs"), F.array_join(pubs, ",").alias("pubs"))


@query("gene_human_ortholog")
def q_gene_human_ortholog(spark, sf_dir):
    from .plans import relationships as r
    return r.gene_human_ortholog(cat(spark, sf_dir))


# --------------------------------------------------------------------------
# interval joins and reports
# --------------------------------------------------------------------------

@query("gene_insertion_overlaps")
def q_gene_insertion_overlaps(spark, sf_dir):
    """Every (live gene, insertion) pair whose locations overlap."""
    from pyspark.sql import functions as F
    from .functions import exprs as X
    from .operators.overlap import feature_overlaps
    c = cat(spark, sf_dir)
    genes = c["feature"].filter(X.live("FBgn")).select("feature_id", F.col("uniquename").alias("gene_id"))
    ti = c["feature"].filter(F.col("uniquename").startswith("FBti")).select(
        F.col("feature_id").alias("other_id"), F.col("uniquename").alias("fbti_id"))
    ov = feature_overlaps(c["featureloc"], genes, ti.select(F.col("other_id").alias("feature_id")))
    return ov.join(genes, "feature_id").join(ti, "other_id").select("gene_id", "fbti_id")


@query("class_counts_two_releases")
def q_class_counts_two_releases(spark, sf_dir):
    """R1 over two releases: this one, and one from before any feature became obsolete."""
    from pyspark.sql import functions as F
    from .plans import reports as rp
    from .sources.tables import Catalog
    c = cat(spark, sf_dir)
    earlier = Catalog(spark, sf_dir).override("feature", c["feature"].withColumn("is_obsolete", F.lit(False)))
    return rp.data_class_counts({"release_a": c, "release_b": earlier})


@query("overlapping_transcripts")
def q_overlapping_transcripts(spark, sf_dir):
    from .plans import reports as rp
    c = cat(spark, sf_dir)
    return rp.overlapping_transcripts(c, rp.parse_locations(c["location_lines"]))


@query("class_counts")
def q_class_counts(spark, sf_dir):
    from .plans import reports as rp
    return rp.data_class_counts({"release_a": cat(spark, sf_dir)})


@query("gene_summary_stats")
def q_gene_summary_stats(spark, sf_dir):
    from .plans import reports as rp
    return rp.gene_summary_stats(cat(spark, sf_dir))


@query("gene_summary_selected")
def q_gene_summary_selected(spark, sf_dir):
    from .plans import reports as rp
    c = cat(spark, sf_dir)
    with_summary = rp.genes_with_summaries(rp.parse_summary_lines(c["summary_lines"]))
    return rp.merge_summary_stats(rp.gene_summary_stats(c), with_summary)


@query("known_id_hits")
def q_known_id_hits(spark, sf_dir):
    from pyspark.sql import functions as F
    from .functions import exprs as X
    from .plans import reports as rp
    c = cat(spark, sf_dir)
    known = c["feature"].filter(X.data_class("uniquename") == "FBsf").select(F.col("uniquename").alias("id"))
    return rp.known_id_hits(rp.parse_hit_lines(c["hit_lines"]), known)


@query("go_counts")
def q_go_counts(spark, sf_dir):
    from .plans import reports as rp
    return rp.go_counts(cat(spark, sf_dir))


@query("few_go_aspects")
def q_few_go_aspects(spark, sf_dir):
    from .plans import reports as rp
    return rp.few_go_aspects(rp.go_counts(cat(spark, sf_dir)))


@query("ortholog_species_counts")
def q_ortholog_species_counts(spark, sf_dir):
    from .plans import reports as rp
    return rp.ortholog_species_counts(cat(spark, sf_dir))


@query("conserved_darkened")
def q_conserved_darkened(spark, sf_dir):
    from .plans import reports as rp
    c = cat(spark, sf_dir)
    return rp.conserved_darkened(rp.go_counts(c), rp.ortholog_species_counts(c))


# --------------------------------------------------------------------------
# T1-T13 (generation-1 gene marts)
# --------------------------------------------------------------------------

def _gen1(spark, sf_dir):
    """Catalog, mart module and the staged ``gene.allele`` rows (later marts
    read them several times, as the reference reads its allele table)."""
    from .plans import gene_marts as gm
    c = cat(spark, sf_dir)
    c.stage_all(gm.ALLELE_TABLES)
    return c, gm, c.derived("gene_allele_rows", lambda: gm.allele(c, counters=False))


def _combinations(c, gm):
    """The combinations, written once per catalog: their components read them too."""
    return c.derived("mart1:split_system_combination", lambda: gm.split_system_combination(c))


@query("gene_alleles_v1")
def q_gene_alleles_v1(spark, sf_dir):
    from .plans import gene_marts as gm
    return gm.allele(cat(spark, sf_dir))


@query("allele_transgenic_product_class")
def q_allele_tpc(spark, sf_dir):
    c, gm, al = _gen1(spark, sf_dir)
    return gm.transgenic_product_class(c, al)


@query("split_system_combinations")
def q_ssc(spark, sf_dir):
    from .plans import gene_marts as gm
    return gm.split_system_combination(cat(spark, sf_dir))


@query("split_system_combination_alleles")
def q_ssc_alleles(spark, sf_dir):
    c, gm, al = _gen1(spark, sf_dir)
    return gm.split_system_combination_component_allele(c, _combinations(c, gm), al)


@query("allele_classes")
def q_allele_classes(spark, sf_dir):
    c, gm, al = _gen1(spark, sf_dir)
    return gm.allele_class(c, al)


@query("allele_stocks")
def q_allele_stocks(spark, sf_dir):
    c, gm, al = _gen1(spark, sf_dir)
    return gm.allele_stock(c, al)


@query("allele_mutagens")
def q_allele_mutagens(spark, sf_dir):
    c, gm, al = _gen1(spark, sf_dir)
    return gm.allele_mutagen(c, al)


@query("insertions")
def q_insertions(spark, sf_dir):
    c, gm, al = _gen1(spark, sf_dir)
    return gm.insertion(c, al)


def _chain(c, gm, al):
    """Constructs and tools by ``how`` of the catalog: ``derived``, each written
    once per catalog, or ``result``; insertions and what tools read are written."""
    ins = c.derived("insertion", lambda: gm.insertion(c, al))

    def construct(how=c.derived):
        return how("construct", lambda: gm.construct(c, ins, al))

    def tool(how=c.derived):
        return how("tool", lambda: gm.tool(c, construct(), al))

    return construct, tool


@query("constructs")
def q_constructs(spark, sf_dir):
    c, gm, al = _gen1(spark, sf_dir)
    return _chain(c, gm, al)[0](c.result)


@query("tools")
def q_tools(spark, sf_dir):
    c, gm, al = _gen1(spark, sf_dir)
    return _chain(c, gm, al)[1](c.result)


@query("tool_uses")
def q_tool_uses(spark, sf_dir):
    c, gm, al = _gen1(spark, sf_dir)
    construct, tool = _chain(c, gm, al)
    return gm.tool_use(c, al, construct(), tool())


# --------------------------------------------------------------------------
# T16-T19 (pathway marts)
# --------------------------------------------------------------------------

def flat(df):
    """Arrays of structs -> 'f1|f2,...' text; arrays of scalars -> 'a,b'."""
    from pyspark.sql import functions as F
    from pyspark.sql import types as T
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.ArrayType):
            et = f.dataType.elementType
            if isinstance(et, T.StructType):
                names = [x.name for x in et.fields]
                c = F.array_join(F.transform(c, lambda s: F.concat_ws(
                    "|", *[F.coalesce(s[n].cast("string"), F.lit("")) for n in names])), ",")
            else:
                c = F.array_join(c.cast("array<string>"), ",")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def _members(c, how=Catalog.derived):
    from .plans import gene_marts as gm
    from .plans import groups
    c.stage_all(gm.ALLELE_TABLES + groups.MEMBER_TABLES)
    alleles = c.derived("gene_allele_rows", lambda: gm.allele(c, counters=False))
    return how(c, "pathway_member", lambda: groups.pathway_member(c, alleles))


@query("pathway_members")
def q_pathway_members(spark, sf_dir):
    return flat(_members(cat(spark, sf_dir), Catalog.result))


@query("gene_group_membership")
def q_gene_group_membership(spark, sf_dir):
    from .plans import groups
    c = cat(spark, sf_dir)
    return flat(groups.gene_group_membership(c, _members(c)))


@query("pathway_disease")
def q_pathway_disease(spark, sf_dir):
    from .plans import groups
    c = cat(spark, sf_dir)
    return groups.pathway_disease(c, _members(c))


# --------------------------------------------------------------------------
# R5-R8 enzyme enrichment
# --------------------------------------------------------------------------

def _ec_inputs(spark, sf_dir):
    from .plans import enzyme as ez
    c = cat(spark, sf_dir)
    recs = ez.parse_enzyme_records(c["enzyme_records"])
    classes = ez.parse_enzyme_classes(c["enzyme_class_lines"], order_col="line_no")
    return c, ez, ez.ec_numbers(c), recs, classes


@query("ec_numbers")
def q_ec_numbers(spark, sf_dir):
    from .plans import enzyme as ez
    return ez.ec_numbers(cat(spark, sf_dir))


@query("ec_extended")
def q_ec_extended(spark, sf_dir):
    c, ez, ecs, recs, classes = _ec_inputs(spark, sf_dir)
    return ez.extend_ec(ecs, recs, classes)


@query("ec_misses")
def q_ec_misses(spark, sf_dir):
    c, ez, ecs, recs, classes = _ec_inputs(spark, sf_dir)
    return ez.ec_misses(ecs, recs, classes).select("ec", "dbxref_id")


@query("ec_dbxrefprops")
def q_ec_dbxrefprops(spark, sf_dir):
    from pyspark.sql import functions as F
    c, ez, ecs, recs, classes = _ec_inputs(spark, sf_dir)
    types = ez.ensure_terms(c, list(ez.EC_PROPTYPES.values()), cv_name="property type")
    table = ez.replace_props(c, ez.extend_ec(ecs, recs, classes), types)
    names = c["cvterm"].select(F.col("cvterm_id").alias("type_id"), F.col("name").alias("type")).unionByName(
        types.select(F.col("cvterm_id").alias("type_id"), F.col("name").alias("type"))).distinct()
    return table.join(names, "type_id").select("dbxref_id", "type", "value", "rank")


@query("key_checks")
def q_key_checks(spark, sf_dir):
    from .plans import relationships as r
    return r.key_checks(cat(spark, sf_dir))


@query("key_checks_generation1")
def q_key_checks_generation1(spark, sf_dir):
    """T31 for the generation-1 marts, each written once per catalog, several at a time."""
    from .plans import build
    from .plans import gene_marts as gm
    from .plans import groups
    c = cat(spark, sf_dir)
    c.stage_all(gm.ALLELE_TABLES + groups.MEMBER_TABLES)
    shared = {"allele": "gene_allele_rows", "insertion": "insertion", "construct": "construct", "tool": "tool",
              "pathway_member": "pathway_member"}
    makers = {n: (shared.get(n, f"mart1:{n}"), make) for n, make in build.generation1(c)}

    class Marts(dict):
        """A mart that another one reads is derived when it is asked for."""
        def __missing__(self, name):
            key, make = makers[name]
            return c.derived(key, lambda: make(self))

    # those that others wait for begin first
    order = sorted(makers, key=lambda n: n not in ("allele", "insertion", "construct", "tool", "pathway_member"))
    found = c.derived_all({makers[n][0]: lambda make=makers[n][1]: make(Marts()) for n in order})
    return build.generation1_key_checks({n: found[key] for n, (key, _) in makers.items()})


@query("allele_disease_variants")
def q_allele_disease_variants(spark, sf_dir):
    from .plans import disease
    return flat(disease.allele_disease_variant(cat(spark, sf_dir)))


@query("disease_variants_by_gene")
def q_disease_variants_by_gene(spark, sf_dir):
    """U15 over every live gene id."""
    from pyspark.sql import functions as F
    from .functions import exprs as X
    from .plans import disease
    c = cat(spark, sf_dir)
    genes = c["feature"].filter(X.live("FBgn")).select(F.col("uniquename").alias("fbgn_id"))
    return flat(disease.disease_variants_by_gene(disease.allele_disease_variant(c), genes))


@query("disease_variants_by_disease")
def q_disease_variants_by_disease(spark, sf_dir):
    """U15 over every live disease report."""
    from pyspark.sql import functions as F
    from .plans import disease
    c = cat(spark, sf_dir)
    reports = c["humanhealth"].filter(~F.col("is_obsolete")).select(F.col("uniquename").alias("fbhh_id"))
    return flat(disease.disease_variants_by_disease(disease.allele_disease_variant(c), reports))


# --------------------------------------------------------------------------
# T1, U12-U14
# --------------------------------------------------------------------------

@query("genes")
def q_genes(spark, sf_dir):
    from .plans import gene_marts as gm
    return gm.gene(cat(spark, sf_dir)).select("feature_id", "uniquename", "name", "type_id", "organism_id")


@query("alleles_by_id")
def q_alleles_by_id(spark, sf_dir):
    from pyspark.sql import functions as F
    from .functions import exprs as X
    c, gm, al = _gen1(spark, sf_dir)
    ids = c["feature"].filter(X.data_class("uniquename") == "FBal").select(F.col("uniquename").alias("fbal_id"))
    return gm.alleles_by_id(al, ids)


@query("split_combinations_by_allele")
def q_split_combinations_by_allele(spark, sf_dir):
    from pyspark.sql import functions as F
    from .functions import exprs as X
    c, gm, al = _gen1(spark, sf_dir)
    combos = _combinations(c, gm)
    comps = gm.split_system_combination_component_allele(c, combos, al)
    ids = c["feature"].filter(X.data_class("uniquename") == "FBal").select(F.col("uniquename").alias("fbal_id"))
    return gm.split_combinations_by_allele(combos, comps, al, ids)


@query("gene_group_members")
def q_gene_group_members(spark, sf_dir):
    """U12 for every pathway with every subgroup named in its labels, and
    with no subgroup (the unlabelled members)."""
    from pyspark.sql import functions as F
    from .plans import groups
    c = cat(spark, sf_dir)
    members = _members(c)
    sub = F.regexp_extract("group_member_label", r"^@(FBgg[0-9]+):", 1)
    pairs = (members.select("fbgg_id", sub.alias("subgroup"))
             .unionByName(members.select("fbgg_id", F.lit("").alias("subgroup"))).distinct())
    out = groups.gene_group_members(members, pairs)
    return flat(out.select("subgroup", "fbgg_id", "fbgn_id", "symbol", "group_member_label", "id"))


# these read the most tables: they come when the others have staged them
for _name in ("current_symbol", "current_fullname", "feature_props", "stocks"):
    QUERIES[_name] = QUERIES.pop(_name)
