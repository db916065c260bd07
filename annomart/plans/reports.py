"""Reports: class counts (R1), gene summary statistics (R2/R3), known-id
hits (R4), overlapping transcripts (R9) and GO / orthology counts (R10-R12)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..operators import dims
from ..operators.lookups import edges, feature_symbols, symbols_by_name
from ..operators.locations import location_slice
from ..operators.overlap import DEFAULT_BIN
from ..session import stage

# --------------------------------------------------------------------------
# R1 data class counts
# --------------------------------------------------------------------------

# fixed values: feature-id prefixes left out of the feature class counts
EXCLUDED_PREFIXES = "^FB(og|bs|ri|X0|XO)"


def class_counts(cat) -> DataFrame:
    """Counts of one release: ``(data_class, n)``.

    Feature classes come from one aggregation over ``feature`` (the 4-char
    prefix of live ids, some prefixes excluded); dedicated counts for
    located genes and the non-feature tables replace a feature count of the
    same name (the reference overwrites it).  One aggregate per table.
    """
    f = cat["feature"]
    live = ~F.col("is_obsolete")

    def counts(df, **conds):
        row = df.agg(*[F.count_if(c).alias(n) for n, c in conds.items()])
        return row.select(F.stack(F.lit(len(conds)), *[x for n in conds for x in (F.lit(n), F.col(n))]).alias("data_class", "n"))

    def named(prefix):
        return F.col("uniquename").rlike(rf"^{prefix}\d+\z")

    feat = (f.filter(F.col("uniquename").rlike(r"^FB\w{2}[0-9]+\z") & ~F.col("uniquename").rlike(EXCLUDED_PREFIXES)
                     & live & ~F.col("is_analysis"))
            .groupBy(F.substring("uniquename", 1, 4).alias("data_class")).agg(F.count(F.lit(1)).alias("n")))
    live_gene = f.filter(F.col("uniquename").startswith("FBgn") & named("FBgn") & live & ~F.col("is_analysis"))
    rf = named("FBrf") & live
    ded = [
        counts(live_gene.join(cat["featureloc"], "feature_id"), FBgn_loc=F.lit(True)),
        counts(cat["strain"], FBsn=named("FBsn") & live),
        counts(cat["cell_line"], FBtc=named("FBtc")),
        counts(cat["grp"], FBgg=named("FBgg") & ~F.col("is_analysis") & live),
        counts(cat["interaction_group"], FBig=named("FBig") & live),
        counts(cat["library"], FBlc=named("FBlc") & live),
        counts(cat["stock"], FBst=named("FBst") & live),
        counts(cat["pub"], FBrf=rf, FBrf_papers=rf & dims.is_type(cat, "paper")),
        counts(cat["humanhealth"], FBhh=named("FBhh") & live),
    ]
    dedicated = ded[0]
    for d in ded[1:]:
        dedicated = dedicated.unionByName(d)
    names = ["FBgn_loc", "FBsn", "FBtc", "FBgg", "FBig", "FBlc", "FBst", "FBrf", "FBrf_papers", "FBhh"]
    return feat.filter(~F.col("data_class").isin(names)).unionByName(dedicated)


def data_class_counts(releases: dict) -> DataFrame:
    """Class x release pivot (``A13``); 0 where a class is absent from a
    release.  ``releases`` maps a release name to its catalog."""
    parts = None
    for rel, cat in releases.items():
        c = class_counts(cat).withColumn("release", F.lit(rel))
        parts = c if parts is None else parts.unionByName(c)
    names = list(releases)
    return parts.groupBy("data_class").pivot("release", names).agg(F.sum("n")).fillna(0, subset=names)


# --------------------------------------------------------------------------
# R2 / R3 gene summary statistics
# --------------------------------------------------------------------------

def _per_feature_count(df: DataFrame, name: str) -> DataFrame:
    return df.groupBy("feature_id").agg(F.count(F.lit(1)).alias(name))


def gene_summary_stats(cat) -> DataFrame:
    """R2: per live gene its symbol and five summary-source counts (zero kept).

    The reference runs five lateral ``count(*)`` subqueries per gene; here
    each source is counted once per ``feature_id`` (partial aggregation
    before the shuffle) and left-joined, with ``coalesce(0)`` (J10).
    """
    genes = cat["feature"].filter(~F.col("is_obsolete") & ~F.col("is_analysis")
                                  & F.col("uniquename").rlike(r"^FBgn\d+\z"))
    # gene_summary_text props of live features with a live prop type (U4)
    t = dims.is_type(cat, "gene_summary_text", live_only=True, similar=True)
    snap_rows = cat["featureprop"].filter(t)
    by_name = cat["feature"].filter(~F.col("is_obsolete")).select("feature_id", "uniquename")
    snap = (snap_rows.join(by_name, "feature_id").groupBy("uniquename")
            .agg(F.count(F.lit(1)).alias("gene_snapshot")))

    def xref_count(prop_type, db_name, name, need_value=False):
        tt = cat["cvterm"].filter(F.lower("name") == prop_type).select(F.col("cvterm_id").alias("type_id"))
        db = dims.db_ids(cat, [db_name], case="lower").select("db_id")
        props = cat["dbxrefprop"].join(tt, "type_id")
        if need_value:
            props = props.filter(F.col("value").isNotNull())
        dbx = cat["dbxref"].join(db, "db_id", "left_semi").select("dbxref_id")
        rows = cat["feature_dbxref"].select("feature_id", "dbxref_id").join(dbx, "dbxref_id").join(
            props.select("dbxref_id"), "dbxref_id")
        return _per_feature_count(rows, name)

    uniprot = xref_count("uniprot_function_comment", "uniprot/swiss-prot", "uniprot_function")
    ifly = xref_count("if_summary", "interactivefly", "interactive_fly", need_value=True)

    gmt = dims.is_type(cat, "grpmember_feature")
    fbcv = dims.db_ids(cat, ["FBcv"]).select("db_id")
    grp_terms = (cat["grp_cvterm"].join(cat["cvterm"].select("cvterm_id", "dbxref_id"), "cvterm_id")
                 .join(cat["dbxref"].join(fbcv, "db_id", "left_semi").select("dbxref_id", "accession"), "dbxref_id")
                 .join(cat["grp"].select("grp_id"), "grp_id")
                 .select("grp_id", (F.col("accession") == "0007034").alias("is_path")))
    members = (cat["feature_grpmember"].select("feature_id", "grpmember_id")
               .join(cat["grpmember"].filter(gmt)
                     .select("grpmember_id", "grp_id"), "grpmember_id")
               .join(grp_terms, "grp_id"))
    grp_counts = members.groupBy("feature_id").agg(
        F.count(F.when(F.col("is_path"), 1)).alias("pathway_count"),
        F.count(F.when(~F.col("is_path"), 1)).alias("gene_group_count"))

    sym = feature_symbols(cat).groupBy("uniquename").agg(
        F.min_by("synonym_sgml", "object_id").alias("symbol"))
    out = (genes.select("feature_id", "uniquename")
           .join(snap, "uniquename", "left").join(uniprot, "feature_id", "left")
           .join(grp_counts, "feature_id", "left").join(ifly, "feature_id", "left")
           .join(sym, "uniquename", "left"))
    cnt = ["gene_snapshot", "uniprot_function", "pathway_count", "gene_group_count", "interactive_fly"]
    return out.select("uniquename", "symbol", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in cnt])


def parse_summary_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    """Summary TSV lines -> ``(fbgn, symbol, summary)``; ``#`` lines
    skipped, the first ``FB:`` of the id removed."""
    body = lines.filter(~F.col(col).startswith("#"))
    parts = F.split(F.col(col), "\t")
    return body.select(X.replace_first(F.get(parts, 0), "FB:").alias("fbgn"), F.get(parts, 1).alias("symbol"),
                       F.get(parts, 2).alias("summary"))


def genes_with_summaries(summaries: DataFrame) -> DataFrame:
    """Ids whose summary is a real description."""
    return (summaries.filter(F.lower("summary") != "no description available")
            .select(F.col("fbgn").alias("uniquename")).distinct())


def merge_summary_stats(stats: DataFrame, with_summary: DataFrame) -> DataFrame:
    """Add the external-summary flag (J17) and the selected summary."""
    flag = with_summary.withColumn("_has", F.lit(1))
    out = stats.join(flag, "uniquename", "left")
    alliance = F.when(F.col("uniquename").startswith("FBgn") & F.col("_has").isNotNull(), 1).otherwise(0)
    out = out.withColumn("external_summary", alliance).drop("_has")
    return out.withColumn("selected", X.selected_summary("gene_snapshot", "uniprot_function", "pathway_count",
                                                           "gene_group_count", "interactive_fly",
                                                           "external_summary"))


# --------------------------------------------------------------------------
# R4 known id hits
# --------------------------------------------------------------------------

def parse_hit_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    """CSV log lines -> column 0 (quotes handled); blank lines dropped."""
    first = F.from_csv(F.col(col), "c0 STRING")["c0"]
    return lines.filter(F.trim(F.col(col)) != "").select(first.alias("path"))


def known_id_hits(hits: DataFrame, known: DataFrame, known_col: str = "id") -> DataFrame:
    """Per known FBsf id the number of log rows whose column 0 contains it
    (first ``FBsf\\d+`` match); only ids with hits."""
    ids = hits.select(X.regex_substr("path", r"FBsf\d+").alias("id")).filter(F.col("id").isNotNull())
    k = known.select(F.col(known_col).alias("id")).distinct()
    return ids.join(k, "id").groupBy("id").agg(F.count(F.lit(1)).alias("n"))


# --------------------------------------------------------------------------
# R9 overlapping transcripts
# --------------------------------------------------------------------------

def parse_locations(lines: DataFrame, col: str = "value") -> DataFrame:
    """``scaffold:min..max`` lines -> ``(line_id, location, scaffold,
    fmin, fmax)``; malformed lines are dropped (the reference stops on them).
    ``line_id`` keeps repeated identical lines apart."""
    scaffold, fmin, fmax = X.parse_location(col)
    return (lines.withColumn("line_id", F.monotonically_increasing_id())
            .select("line_id", F.trim(F.col(col)).alias("location"), scaffold.alias("scaffold"),
                    fmin.alias("fmin"), fmax.alias("fmax"))
            .filter(F.col("scaffold").isNotNull()))


def scaffold_ids(cat, genus: str = "Drosophila", species: str = "melanogaster",
                 scaffold_type: str = "golden_path") -> DataFrame:
    """Scaffold name -> feature id (live golden path of the organism);
    lowest id when a name repeats."""
    org = (cat["organism"].filter((F.col("genus") == genus) & (F.col("species") == species))
                      .select("organism_id"))
    f = (cat["feature"].filter(~F.col("is_obsolete") & ~F.col("is_analysis"))
         .filter(dims.is_type(cat, scaffold_type))
         .join(org, "organism_id", "left_semi"))
    return f.groupBy(F.col("name").alias("scaffold")).agg(F.min("feature_id").alias("srcfeature_id"))


def overlapping_transcripts(cat, locations: DataFrame, bin_size: int = DEFAULT_BIN,
                            types=("miRNA", "mRNA")) -> DataFrame:
    """Live FBtr of the given types overlapping each location:
    ``(location, id, symbol, type)``, one row per (location line, transcript)."""
    q = stage(locations.join(scaffold_ids(cat), "scaffold"))            # read for the files, the bounds and the join
    tr = (cat["feature"].filter(F.col("uniquename").startswith("FBtr") & F.col("uniquename").rlike(r"^FBtr\d+\z")
                                & ~F.col("is_obsolete") & ~F.col("is_analysis") & dims.is_type(cat, list(types)))
          .select("feature_id", F.col("uniquename").alias("id"), dims.type_name(cat, list(types)).alias("type")))
    # only files that a location can meet are read, and only the wanted transcripts' locations are binned
    hits = location_slice(cat.spark, cat.location_table(), q, wanted=tr, bin_size=bin_size)
    rows = hits.select("line_id", "location", "feature_id").join(tr, "feature_id")
    sym = feature_symbols(cat).select(F.col("object_id").alias("feature_id"),
                                                  F.col("synonym_sgml").alias("symbol"))
    rows = rows.join(sym, "feature_id", "left")
    return rows.dropDuplicates(["line_id", "id"]).select("location", "id", "symbol", "type")


# --------------------------------------------------------------------------
# R10-R12 GO aspects and orthology
# --------------------------------------------------------------------------

ASPECTS = ("biological_process", "molecular_function", "cellular_component")


def located_model_genes(cat, genus="Drosophila", species="melanogaster") -> DataFrame:
    """Live FBgn of type gene of the model organism, one row per location."""
    org = (cat["organism"].filter((F.col("genus") == genus) & (F.col("species") == species))
                      .select("organism_id"))
    g = (cat["feature"].filter(F.col("uniquename").rlike("^FBgn[0-9]+\\z") & ~F.col("is_obsolete")
                               & ~F.col("is_analysis"))
         .filter(dims.is_type(cat, "gene"))
         .join(org, "organism_id", "left_semi"))
    return g.join(cat["featureloc"].select("feature_id"), "feature_id").select("feature_id", "uniquename")


def experimental_go_counts(cat, genes: DataFrame | None = None) -> DataFrame:
    """U16: per feature name the number of distinct experimental, non-NOT term
    names in each GO aspect, one pass pivoted over the three aspects; of all
    features, or of the names in ``genes`` (column ``uniquename``), whose
    annotations alone are then joined with their properties and terms.

    Evidence must match case-sensitively (the report's copy of the test)."""
    cv = dims.cv_ids(cat, list(ASPECTS))
    terms = cat["cvterm"].join(cv, "cv_id").select("cvterm_id", "name", "cv_name")
    ev_t = dims.is_type(cat, "evidence_code")
    not_t = dims.is_type(cat, "NOT")
    props = cat["feature_cvtermprop"]
    negated = props.filter(not_t).select("feature_cvterm_id")
    ev = (props.filter(ev_t)
          .filter(X.is_evidence_experimental("value", case_sensitive=True)).select("feature_cvterm_id"))
    feats = cat["feature"].select("feature_id", "uniquename")
    fc = cat["feature_cvterm"].select("feature_cvterm_id", "feature_id", "cvterm_id")
    if genes is not None:
        feats = feats.join(genes.select("uniquename").distinct(), "uniquename", "left_semi")
    fc = fc.join(feats, "feature_id").join(negated, "feature_cvterm_id", "left_anti").join(ev, "feature_cvterm_id")
    rows = fc.join(terms, "cvterm_id")
    # the reference looks the gene up by uniquename: count per name
    return rows.groupBy("uniquename").pivot("cv_name", list(ASPECTS)).agg(F.count_distinct("name"))


def go_counts(cat) -> DataFrame:
    """Located model genes with symbol, per-aspect experimental term
    counts and the number of aspects with any term (one row per location)."""
    genes = located_model_genes(cat)
    by_name = experimental_go_counts(cat, genes)
    sym = symbols_by_name(cat, ["FBgn"])
    out = genes.join(by_name, "uniquename", "left").join(sym, "uniquename", "left")
    cols = [F.coalesce(a, F.lit(0)).cast("long").alias(a) for a in ASPECTS]
    out = out.select(F.col("uniquename").alias("fbid"), "symbol", *cols)
    n = sum((F.col(a) > 0).cast("int") for a in ASPECTS)
    return out.withColumn("num_aspects", n.cast("long"))


def ortholog_species_counts(cat) -> DataFrame:
    """Per located model gene, distinct organisms of live orthologs
    reported by DIOPT."""
    genes = located_model_genes(cat).select(F.col("feature_id").alias("object_id"), "uniquename")
    e = edges(cat, "orthologous_to", object_classes="FBgn", subject_live=True, object_live=False)
    frp = cat["feature_relationshipprop"].filter(F.col("value") == "DIOPT").select("feature_relationship_id")
    e = e.join(frp, "feature_relationship_id", "left_semi")
    og = cat["feature"].select(F.col("feature_id").alias("subject_id"), "organism_id")
    rows = genes.join(e, "object_id").join(og, "subject_id")
    return rows.groupBy(F.col("uniquename").alias("fbid")).agg(
        F.count_distinct("organism_id").alias("num_ortho_species"))


def few_go_aspects(go: DataFrame, max_aspects: int = 1) -> DataFrame:
    """R12 first list: genes with at most ``max_aspects`` GO aspects."""
    return go.filter(F.col("num_aspects") <= max_aspects)


def conserved_darkened(go: DataFrame, orthologs: DataFrame, max_aspects: int = 1,
                       n_species: int = 9) -> DataFrame:
    """Few-aspect genes (D6 intersection, J15) conserved in exactly
    ``n_species`` species."""
    return (few_go_aspects(go, max_aspects).join(orthologs, "fbid")
            .filter(F.col("num_ortho_species") == n_species))
