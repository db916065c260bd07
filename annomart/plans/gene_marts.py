"""Generation-1 gene marts (T1-T13): genes, alleles and their counters,
transgenic product classes, split-system combinations, allele classes /
stocks / mutagens, insertions, constructs, tools and tool uses.

Row ids.  The reference numbers rows with ``SERIAL`` and later marts point at
those numbers.  Here a mart's ``id`` is its natural key rendered as text
(``concat_ws('|', ...)``): deterministic, computed in parallel, stable across
re-runs and executor loss, and equal wherever the same row is rebuilt.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..operators import dims
from ..operators.keys import first_per_key
from ..operators.lookups import pub_counts, stocks, symbols_by_name
from ..operators.overlap import DEFAULT_BIN, feature_overlaps
from ..operators.reduction import reduced
from ..session import stage


def row_key(*cols: str) -> Column:
    """Natural key as text; NULL parts become empty."""
    return F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols])


def hop(cat, near: DataFrame, near_col: str, rel_types: list[str], classes: list[str] | None,
        direction: str = "subject", with_symbol: bool = False) -> DataFrame:
    """One typed edge hop from ``near`` rows (feature id in ``near_col``).

    Same rule as U3: the far end must not be obsolete and must be of one of
    ``classes``; ``direction='subject'`` walks to edge subjects (the near
    feature is the object).  Adds ``far_id``, ``far`` (uniquename),
    ``rel_type`` and optionally ``far_symbol``.
    """
    n_key, f_key = ("object_id", "subject_id") if direction == "subject" else ("subject_id", "object_id")
    fr = (cat.edges_by(n_key).filter(dims.is_type(cat, rel_types))
          .select(F.col(n_key).alias(near_col), F.col(f_key).alias("far_id"),
                  dims.type_name(cat, rel_types).alias("rel_type")))
    far = cat["feature"].filter(~F.col("is_obsolete"))
    if classes is not None:
        far = far.filter(X.data_class("uniquename").isin(classes))
    far = far.select(F.col("feature_id").alias("far_id"), F.col("uniquename").alias("far"))
    out = near.join(fr, near_col).join(far, "far_id")
    if with_symbol:
        out = _with_far_symbol(cat, out, classes)
    return out


def _with_far_symbol(cat, rows: DataFrame, classes: list[str] | None) -> DataFrame:
    sym = symbols_by_name(cat, classes).withColumnsRenamed({"uniquename": "far", "symbol": "far_symbol"})
    return rows.join(sym, "far", "left")


def _named(cat, classes: list[str], id_col: str, name_col: str) -> DataFrame:
    """Features of some data classes (any liveness)."""
    return (cat["feature"].filter(X.data_class("uniquename").isin(classes))
            .select(F.col("feature_id").alias(id_col), F.col("uniquename").alias(name_col)))


def _by_name(cat, df: DataFrame, name_col: str, classes: list[str]) -> DataFrame:
    """Features whose uniquename equals ``df[name_col]`` (any liveness); the
    names are of ``classes``."""
    return df.join(_named(cat, classes, "_nid", name_col), name_col)


def _links(cat, name_col: str, classes: list[str], rel_types: list[str], far_classes: list[str]) -> DataFrame:
    """Distinct ``(name, far, far_symbol, rel_type)`` of the edges that start at
    a feature of ``classes``.  Mart rows join them by name, last: parallel edges
    are one link before they meet a row, and rows are not carried along a hop."""
    near = _named(cat, classes, "n", name_col)
    far = hop(cat, near, "n", rel_types, far_classes, direction="object").select(name_col, "far", "rel_type").distinct()
    return _with_far_symbol(cat, far, far_classes)


# --------------------------------------------------------------------------
# T1 / T2 / T3
# --------------------------------------------------------------------------

def gene(cat) -> DataFrame:
    """T1 ``gene.gene``: live FBgn features of type ``gene`` (all columns)."""
    return (cat["feature"].filter(X.live("FBgn"))
            .filter(dims.is_type(cat, "gene")))


def _construct_flag_names(cat) -> DataFrame:
    """Allele uniquenames counted as construct alleles by the gen-1 rule."""
    a = cat["feature"].filter(F.col("uniquename").startswith("FBal")).select(
        F.col("feature_id").alias("a"), F.col("uniquename").alias("fbal_id"))
    via = hop(cat, a, "a", ["associated_with"], ["FBtp", "FBmc", "FBms"], direction="object").select("fbal_id")
    mut = (cat["cvterm"].filter(F.lower("name").startswith("in vitro construct"))
           .join(cat["cvtermprop"].filter(F.col("value") == "origin_of_mutation"), "cvterm_id", "left_semi")
           .select("cvterm_id"))
    ann = (cat["feature_cvterm"].join(mut, "cvterm_id", "left_semi")
           .join(_named(cat, ["FBal"], "feature_id", "fbal_id"), "feature_id")
           .select("fbal_id"))
    return via.unionByName(ann)


def _prop_names(cat, type_name: str, value: str | None = None, classes: list[str] | None = None) -> DataFrame:
    """Uniquenames of live features, or those of some data classes, with a
    prop of a live type (U4)."""
    t = dims.is_type(cat, type_name, live_only=True, similar=True)
    fp = cat["featureprop"].filter(t)
    if value is not None:
        fp = fp.filter(F.col("value") == value)
    live = cat["feature"].filter(~F.col("is_obsolete"))
    if classes is not None:
        live = live.filter(X.data_class("uniquename").isin(classes))
    return (fp.select("feature_id").join(live.select("feature_id", "uniquename"), "feature_id")
            .select(F.col("uniquename").alias("name")).distinct())


def _flag_by_name(df: DataFrame, names: DataFrame, col: str, flag: str) -> DataFrame:
    k = names.select(F.col(names.columns[0]).alias(col)).distinct().withColumn(flag, F.lit(True))
    return df.join(k, col, "left").withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))


# what ``allele`` reads, so that it can be staged ahead
ALLELE_TABLES = ["feature", "feature_relationship", "cvterm", "cvtermprop", "feature_cvterm", "featureprop",
                 "feature_synonym", "synonym"]

ALLELE_KEY = ("fbal_id", "gene_id", "is_alleleof", "is_construct", "propagate_transgenic_uses",
              "gene_is_regulatory_region")


def allele(cat, counters: bool = True, genes: DataFrame | None = None) -> DataFrame:
    """T2 ``gene.allele`` (+T3 counters when ``counters``).

    Four branches, as in the reference: ``alleleof`` alleles (flags
    computed), ``has_reg_region`` alleles, alleles reached through an
    expressed transcript/polypeptide with a construct and a tool, and the
    surface-feature branch.  The last one joins the gene id with the surface
    feature id (``fbsf.object_id = fbal.object_id``) and so never matches;
    it is kept literally.  Branch 3 uses existence tests for the construct
    and the tool (only the allele and gene are output, so the product of
    their matches would be discarded by the UNION anyway).

    ``genes`` (optional, column ``feature_id``) restricts the mart to those
    genes: every branch starts from the gene, so this yields exactly the
    mart's rows for them (used by marts that need a few genes' alleles).
    """
    g = gene(cat).select(F.col("feature_id").alias("gene_id"))
    if genes is not None:
        g = g.join(genes.select(F.col("feature_id").alias("gene_id")).distinct(), "gene_id", "left_semi")

    b1 = hop(cat, g, "gene_id", ["alleleof"], ["FBal"])
    b1 = b1.select(F.col("far").alias("fbal_id"), "gene_id")
    b1 = _flag_by_name(b1, _construct_flag_names(cat), "fbal_id", "is_construct")
    not_prop = _prop_names(cat, "propagate_transgenic_uses", "n", ["FBal"])
    b1 = _flag_by_name(b1, not_prop, "fbal_id", "_np")
    b1 = b1.select("fbal_id", "gene_id", F.lit(True).alias("is_alleleof"), "is_construct",
                   (~F.col("_np")).alias("propagate_transgenic_uses"),
                   F.lit(False).alias("gene_is_regulatory_region"))

    def constructish(df):
        return df.select(F.col("far").alias("fbal_id"), "gene_id",
                         F.lit(False).alias("is_alleleof"), F.lit(True).alias("is_construct"),
                         F.lit(True).alias("propagate_transgenic_uses"),
                         F.lit(True).alias("gene_is_regulatory_region"))

    b2 = constructish(hop(cat, g, "gene_id", ["has_reg_region"], ["FBal"]))

    # hops carry feature ids: the next edge must start at the very same feature
    tr = hop(cat, g, "gene_id", ["attributed_as_expression_of"], ["FBtr", "FBpp"]).select("gene_id", F.col("far_id").alias("tr_id"))
    al = hop(cat, tr, "tr_id", ["associated_with"], ["FBal"], direction="object").select("gene_id", F.col("far_id").alias("a"), "far")
    al_ids = al.select("a").distinct()
    with_tp = hop(cat, al_ids, "a", ["associated_with"], ["FBtp"], direction="object").select("a")
    with_to = hop(cat, al_ids, "a", ["encodes_tool"], ["FBto"], direction="object").select("a")
    b3 = constructish(al.join(with_tp, "a", "left_semi").join(with_to, "a", "left_semi"))

    sf = hop(cat, g, "gene_id", ["associated_with"], ["FBsf"]).select("gene_id", F.col("far_id").alias("sf_id"))
    sfa = hop(cat, sf, "sf_id", ["has_reg_region"], ["FBal"])
    # literal reference condition: the gene id must equal the surface feature id
    b4 = constructish(sfa.filter(F.col("gene_id") == F.col("sf_id")))

    out = b1.unionByName(b2).unionByName(b3).unionByName(b4).distinct()
    # the symbol is a function of the allele id (current_symbol(uniquename)):
    # looked up once for the union instead of once per branch
    out = out.join(symbols_by_name(cat, ["FBal"]).withColumnRenamed("uniquename", "fbal_id"), "fbal_id", "left")
    out = out.select("fbal_id", "symbol", "gene_id", "is_alleleof", "is_construct", "propagate_transgenic_uses",
                     "gene_is_regulatory_region").withColumn("id", row_key(*ALLELE_KEY))
    if not counters:
        return out
    # the counters read the allele rows several times: stage them once
    return allele_counters(cat, stage(out))


def allele_counters(cat, alleles: DataFrame) -> DataFrame:
    """Stocks, publication and paper counts, lesion and image flags,
    computed per distinct allele id and joined back."""
    names = alleles.select(F.col("fbal_id")).distinct()
    st = stocks(cat, names, "fbal_id", short=False).groupBy("fbid").agg(F.count(F.lit(1)).alias("stocks_count")) \
        .withColumnRenamed("fbid", "fbal_id")
    # publications and papers in one pass; allele ids only need the feature branch
    pc = pub_counts(cat, names, "fbal_id", ["paper"], classes=["FBal"]).select(
        "fbal_id", F.col("n").alias("pub_count"), F.col("n_paper").alias("paper_count"))
    # both flags from one scan of the live props of the two types
    kinds = ["known_lesion", "linked_image"]
    lesion = dims.is_type(cat, "known_lesion", live_only=True, similar=True)
    image = dims.is_type(cat, "linked_image", live_only=True, similar=True)
    fp = (cat["featureprop"].filter(dims.is_type(cat, kinds, live_only=True, similar=True))
          .select("feature_id", lesion.alias("_l"), image.alias("_i"))
          .join(cat["feature"].filter(~F.col("is_obsolete")).select("feature_id", F.col("uniquename").alias("fbal_id")),
                "feature_id")
          .groupBy("fbal_id").agg(F.max(F.col("_l").cast("int")).alias("_kl"),
                                  F.max(F.col("_i").cast("int")).alias("_im")))
    out = (alleles.join(st, "fbal_id", "left").join(pc, "fbal_id", "left").join(fp, "fbal_id", "left")
           .withColumn("stocks_count", F.coalesce("stocks_count", F.lit(0)).cast("long")))
    return (out.withColumn("known_lesion", F.coalesce(F.col("_kl") == 1, F.lit(False)))
            .withColumn("has_image", F.coalesce(F.col("_im") == 1, F.lit(False))).drop("_kl", "_im"))


# --------------------------------------------------------------------------
# T4-T9
# --------------------------------------------------------------------------

def _allele_rows(alleles: DataFrame) -> DataFrame:
    return alleles.select(F.col("id").alias("allele_id"), "fbal_id")


def _once(rows: DataFrame, name_col: str) -> DataFrame:
    """Distinct rows that a join by name follows: dealt by the name, so that
    both take one shuffle."""
    return rows.repartition(name_col).distinct()


def transgenic_product_class(cat, alleles: DataFrame) -> DataFrame:
    """T4: distinct (allele row, SO id, class name) from annotations that
    carry a ``transgenic_product_class`` prop."""
    t = dims.is_type(cat, "transgenic_product_class")
    fc = (cat["feature_cvterm"].join(
        cat["feature_cvtermprop"].filter(t)
        .select("feature_cvterm_id"), "feature_cvterm_id")
        .select("feature_id", "cvterm_id"))
    terms = (cat["cvterm"].select("cvterm_id", "dbxref_id", F.col("name").alias("transgenic_product_class"))
             .join(cat["dbxref"].select("dbxref_id", "accession"), "dbxref_id"))
    a = _by_name(cat, _allele_rows(alleles), "fbal_id", ["FBal"]).withColumnRenamed("_nid", "feature_id")
    return (a.join(fc, "feature_id").join(terms, "cvterm_id")
            .select("allele_id", "fbal_id", F.concat(F.lit("SO:"), "accession").alias("so_id"),
                    "transgenic_product_class").distinct())


def split_system_combination(cat) -> DataFrame:
    """T5: live FBco of type 'split system combination' with stock and pub counts."""
    t = dims.is_type(cat, "split system combination")
    co = (cat["feature"].filter(X.live("FBco")).filter(t)
          .select(F.col("uniquename").alias("fbco_id"), F.col("name").alias("symbol")))
    names = co.select("fbco_id").distinct()
    st = stocks(cat, names, "fbco_id", short=False).groupBy(F.col("fbid").alias("fbco_id")).agg(
        F.count(F.lit(1)).alias("stocks_count"))
    pc = pub_counts(cat, names, "fbco_id", classes=["FBco"]).withColumnRenamed("n", "pub_count")
    return (co.join(st, "fbco_id", "left").join(pc, "fbco_id", "left")
            .withColumn("stocks_count", F.coalesce("stocks_count", F.lit(0)).cast("long"))
            .withColumn("id", row_key("fbco_id", "symbol")))


def split_system_combination_component_allele(cat, combos: DataFrame, alleles: DataFrame) -> DataFrame:
    """Combination x allele row through any edge combination -> FBal
    (relation type not restricted; every allele row of that FBal)."""
    t = dims.is_type(cat, "split system combination")
    co = (cat["feature"].filter(X.live("FBco")).filter(t)
          .select(F.col("feature_id").alias("subject_id"), F.col("uniquename").alias("fbco_id")))
    al = cat["feature"].filter(X.is_id_of("uniquename", "FBal")).select(
        F.col("feature_id").alias("object_id"), F.col("uniquename").alias("fbal_id"))
    pairs = co.join(cat.edges_by("subject_id").select("subject_id", "object_id"), "subject_id").join(al, "object_id")
    return (pairs.join(combos.select(F.col("id").alias("split_system_combination_id"), "fbco_id"), "fbco_id")
            .join(_allele_rows(alleles), "fbal_id")
            .select("split_system_combination_id", "allele_id"))


def allele_class(cat, alleles: DataFrame) -> DataFrame:
    """``promoted_allele_class`` props split into ``(fbcv_id, name)``;
    one row per (allele row, fbcv id), lowest name first."""
    t = dims.is_type(cat, "promoted_allele_class")
    fp = (cat["featureprop"].filter(t).select("feature_id", "value")
          .join(_named(cat, ["FBal"], "feature_id", "fbal_id"), "feature_id")
          .select("fbal_id", F.explode(F.split("value", ",")).alias("cls")))
    parts = F.split(F.expr("trim(BOTH ' @' FROM cls)"), ":")
    rows = fp.select("fbal_id", F.get(parts, 0).alias("fbcv_id"), F.get(parts, 1).alias("name"))
    # an allele row is of one name: the first of a name is the first of its rows
    best = first_per_key(rows, ["fbal_id", "fbcv_id"], ["name"])
    return best.join(_allele_rows(alleles).distinct(), "fbal_id").select("allele_id", "fbcv_id", "name")


def allele_stock(cat, alleles: DataFrame) -> DataFrame:
    """One stock per (allele row, FBst), first by (center, number, genotype)."""
    st = stocks(cat, alleles.select("fbal_id").distinct(), "fbal_id", short=False).withColumnRenamed("fbid", "fbal_id")
    # an allele row is of one name: the first of a name is the first of its rows
    best = first_per_key(st.withColumnRenamed("fbst", "fbst_id"), ["fbal_id", "fbst_id"], ["center", "stock_number", "genotype"])
    return (best.join(_allele_rows(alleles).distinct(), "fbal_id")
            .select("allele_id", "fbst_id", "center", "stock_number", "genotype"))


def allele_mutagen(cat, alleles: DataFrame) -> DataFrame:
    """Annotation terms marked ``origin_of_mutation``; one per (allele
    row, accession), lowest (fbcv_id, name) first."""
    mut = cat["cvtermprop"].filter(F.col("value") == "origin_of_mutation").select("cvterm_id")
    terms = (cat["cvterm"].join(mut, "cvterm_id", "left_semi").select("cvterm_id", "dbxref_id", "name")
             .join(cat["dbxref"].select("dbxref_id", "db_id", "accession"), "dbxref_id")
             .join(cat["db"].select("db_id", F.col("name").alias("db_name")), "db_id"))
    # annotations of these terms first (others are not shuffled), then their alleles, then the allele rows
    rows = (reduced(cat["feature_cvterm"].select("feature_id", "cvterm_id"), mut, "cvterm_id").join(terms, "cvterm_id")
            .join(_named(cat, ["FBal"], "feature_id", "fbal_id"), "feature_id")
            .select("fbal_id", "accession", F.concat("db_name", F.lit(":"), "accession").alias("fbcv_id"), "name"))
    # an allele row is of one name: the first of a name is the first of its rows
    best = first_per_key(rows, ["fbal_id", "accession"], ["fbcv_id", "name"])
    return best.join(_allele_rows(alleles).distinct(), "fbal_id").select("allele_id", "fbcv_id", "name")


# --------------------------------------------------------------------------
# T10-T13
# --------------------------------------------------------------------------

def _insertions_with_own_allele(cat) -> DataFrame:
    """(fbti feature name, gene feature id) pairs where the insertion has an
    allele of that gene (FBal -associated_with-> FBti, FBal -alleleof-> FBgn)."""
    ti = cat["feature"].filter(F.col("uniquename").startswith("FBti")).select(
        F.col("feature_id").alias("ti"), F.col("uniquename").alias("fbti"))
    a2 = hop(cat, ti, "ti", ["associated_with"], ["FBal"]).select("fbti", F.col("far_id").alias("a2_id"))
    g2 = hop(cat, a2, "a2_id", ["alleleof"], ["FBgn"], direction="object")
    return g2.select("fbti", F.col("far_id").alias("gene_id")).distinct()


def insertion(cat, alleles: DataFrame, bin_size: int = DEFAULT_BIN) -> DataFrame:
    """T10 ``gene.insertion``: insertions linked to an allele row, insertions
    expressed in a gene's pattern without an allele of that gene, and
    insertions overlapping the gene span without an allele of that gene
    (interval join J13).  Plus stock and pub counts."""
    links = _links(cat, "fbal_id", ["FBal"], ["associated_with"], ["FBti"])
    b1 = _allele_rows(alleles).distinct().join(links, "fbal_id").select(
        F.col("far").alias("fbti_id"), F.col("far_symbol").alias("symbol"), "allele_id", F.lit(None).cast("long").alias("gene_id"))

    own = _insertions_with_own_allele(cat)
    g = gene(cat).select(F.col("feature_id").alias("gene_id"))
    tr = hop(cat, g, "gene_id", ["attributed_as_expression_of"], ["FBtr", "FBpp"]).select("gene_id", F.col("far_id").alias("tr_id"))
    al = hop(cat, tr, "tr_id", ["associated_with"], ["FBal"], direction="object").select("gene_id", F.col("far_id").alias("al_id"))
    b2 = hop(cat, al.distinct(), "al_id", ["associated_with"], ["FBti"], direction="object").select("gene_id", F.col("far").alias("fbti_id"))

    tis = cat["feature"].filter(X.data_class("uniquename") == "FBti").select(
        F.col("feature_id").alias("other_id"), F.col("uniquename").alias("fbti_id"))
    ov = feature_overlaps(cat["featureloc"], g.withColumnRenamed("gene_id", "feature_id"),
                          tis.select(F.col("other_id").alias("feature_id")), bin_size=bin_size)
    b3 = ov.join(tis, "other_id").select(F.col("feature_id").alias("gene_id"), "fbti_id")
    # the pairs of both branches once, then their symbols
    pairs = b2.unionByName(b3).distinct().join(own.select(F.col("fbti").alias("fbti_id"), "gene_id"), ["fbti_id", "gene_id"], "left_anti")
    sym = symbols_by_name(cat, ["FBti"]).withColumnRenamed("uniquename", "fbti_id")
    b23 = pairs.join(sym, "fbti_id", "left").select("fbti_id", "symbol", F.lit(None).cast("string").alias("allele_id"), "gene_id")

    # rows of alleles have no gene, the others no allele: no row is in both
    out = b1.unionByName(b23).withColumn("id", row_key("fbti_id", "allele_id", "gene_id"))
    # counted for every insertion, so the rows themselves are computed once
    names = tis.select("fbti_id").distinct()
    st = stocks(cat, names, "fbti_id", short=False).groupBy(F.col("fbid").alias("fbti_id")).agg(
        F.count(F.lit(1)).alias("stocks_count"))
    pc = pub_counts(cat, names, "fbti_id", classes=["FBti"]).withColumnRenamed("n", "pub_count")
    return (out.join(st, "fbti_id", "left").join(pc, "fbti_id", "left")
            .withColumn("stocks_count", F.coalesce("stocks_count", F.lit(0)).cast("long")))


CONSTRUCT_CLASSES = ["FBtp", "FBmc", "FBms"]


def construct(cat, insertions: DataFrame, alleles: DataFrame) -> DataFrame:
    """Constructs produced by an insertion row or associated with an
    allele row."""
    ins = insertions.select(F.col("id").alias("insertion_id"), "fbti_id").distinct()
    b1 = ins.join(_links(cat, "fbti_id", ["FBti"], ["producedby"], CONSTRUCT_CLASSES), "fbti_id").select(
        F.col("far").alias("fbtp_id"), F.col("far_symbol").alias("symbol"), "insertion_id",
        F.lit(None).cast("string").alias("allele_id"))
    al = _allele_rows(alleles).distinct()
    b2 = al.join(_links(cat, "fbal_id", ["FBal"], ["associated_with"], CONSTRUCT_CLASSES), "fbal_id").select(
        F.col("far").alias("fbtp_id"), F.col("far_symbol").alias("symbol"),
        F.lit(None).cast("string").alias("insertion_id"), "allele_id")
    # distinct rows meet distinct links, and no row is in both branches
    return b1.unionByName(b2).withColumn("id", row_key("fbtp_id", "insertion_id", "allele_id"))


TOOL_RELS = ["has_reg_region", "encodes_tool", "carries_tool", "tagged_with"]
TOOL_CLASSES = ["FBto", "FBgn", "FBsf"]


def tool(cat, constructs: DataFrame, alleles: DataFrame) -> DataFrame:
    """Tools / genes related to a construct row or an allele row by one
    of four relation types."""
    c = _once(constructs.select(F.col("id").alias("construct_id"), "fbtp_id"), "fbtp_id")
    b1 = c.join(_links(cat, "fbtp_id", CONSTRUCT_CLASSES, TOOL_RELS, ["FBto", "FBgn"]), "fbtp_id").select(
        F.col("far").alias("fbid"), F.col("far_symbol").alias("symbol"), "rel_type", "construct_id",
        F.lit(None).cast("string").alias("allele_id"))
    al = _once(_allele_rows(alleles), "fbal_id")
    b2 = al.join(_links(cat, "fbal_id", ["FBal"], TOOL_RELS, TOOL_CLASSES), "fbal_id").select(
        F.col("far").alias("fbid"), F.col("far_symbol").alias("symbol"), "rel_type",
        F.lit(None).cast("string").alias("construct_id"), "allele_id")
    # distinct rows meet distinct links, and no row is in both branches
    return b1.unionByName(b2).withColumn("id", row_key("fbid", "rel_type", "construct_id", "allele_id"))


def tool_use(cat, alleles: DataFrame, constructs: DataFrame, tools: DataFrame) -> DataFrame:
    """Terms of annotations that carry a ``tool_uses`` prop, for allele,
    construct and tool rows."""
    t = dims.is_type(cat, "tool_uses")
    fc = (cat["feature_cvterm"].join(
        cat["feature_cvtermprop"].filter(t)
        .select("feature_cvterm_id"), "feature_cvterm_id").select("feature_id", "cvterm_id"))
    terms = (cat["cvterm"].select("cvterm_id", "dbxref_id", "name")
             .join(cat["dbxref"].select("dbxref_id", "db_id", "accession"), "dbxref_id")
             .join(cat["db"].select("db_id", F.col("name").alias("db_name")), "db_id")
             .select("cvterm_id", "name", F.concat("db_name", F.lit(":"), "accession").alias("fbcv_id")))
    ann = fc.join(terms, "cvterm_id").select("feature_id", "name", "fbcv_id").distinct()

    def branch(rows: DataFrame, name_col: str, id_col: str, classes: list[str]) -> DataFrame:
        # the terms of a name once, then its rows: these are not carried to the annotations
        used = _named(cat, classes, "feature_id", name_col).join(ann, "feature_id").select(name_col, "name", "fbcv_id").distinct()
        # a row is of one name: distinct rows meet distinct terms
        return _once(rows, name_col).join(used, name_col).select("name", "fbcv_id", id_col)

    none = F.lit(None).cast("string")
    b1 = branch(_allele_rows(alleles), "fbal_id", "allele_id", ["FBal"]).select(
        "name", "fbcv_id", "allele_id", none.alias("construct_id"), none.alias("tool_id"))
    b2 = branch(constructs.select(F.col("id").alias("construct_id"), "fbtp_id"), "fbtp_id", "construct_id", CONSTRUCT_CLASSES).select(
        "name", "fbcv_id", none.alias("allele_id"), "construct_id", none.alias("tool_id"))
    b3 = branch(tools.select(F.col("id").alias("tool_id"), "fbid"), "fbid", "tool_id", TOOL_CLASSES).select(
        "name", "fbcv_id", none.alias("allele_id"), none.alias("construct_id"), "tool_id")
    return b1.unionByName(b2).unionByName(b3)


def alleles_by_id(alleles: DataFrame, ids: DataFrame, id_col: str = "fbal_id") -> DataFrame:
    """``alleleof`` rows of the given allele ids (semi join)."""
    k = ids.select(F.col(id_col).alias("fbal_id")).distinct()
    return alleles.filter(F.col("is_alleleof")).join(k, "fbal_id", "left_semi")


def split_combinations_by_allele(combos: DataFrame, components: DataFrame, alleles: DataFrame,
                                 ids: DataFrame, id_col: str = "fbal_id") -> DataFrame:
    """Distinct combinations that contain one of the given alleles
    (through ``alleleof`` allele rows)."""
    sel = alleles_by_id(alleles, ids, id_col).select(F.col("id").alias("allele_id"))
    cid = components.join(sel, "allele_id", "left_semi").select(
        F.col("split_system_combination_id").alias("id")).distinct()
    return combos.join(cid, "id", "left_semi")
