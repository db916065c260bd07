"""Set-based forms of the reference's lookup functions.

The reference resolves one id per call (a dynamic query per id, and another
per result row for symbols).  Here each operator takes a DataFrame of ids and
resolves all of them with joins: one plan, no per-row lookups, duplicates in
the input kept (the array overloads return one result set per input id).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..session import stage
from . import dims
from .reduction import few_objects, reduced, short_list

# Which table holds the objects of a data class, for class-polymorphic
# lookups (everything else lives in ``feature``).
# fixed values: class -> (object table, synonym link, pub link, key)
ENTITY_TABLES = {
    "FBgg": ("grp", "grp_synonym", "grp_pub", "grp_id"),
    "FBsn": ("strain", "strain_synonym", "strain_pub", "strain_id"),
    "FBtc": ("cell_line", "cell_line_synonym", "cell_line_pub", "cell_line_id"),
    "FBhh": ("humanhealth", "humanhealth_synonym", "humanhealth_pub", "humanhealth_id"),
    "FBlc": ("library", "library_synonym", "library_pub", "library_id"),
}
FEATURE_ENTITY = ("feature", "feature_synonym", "feature_pub", "feature_id")


def _objects(cat, table: str) -> DataFrame:
    return dims.ensure_column(cat[table], "is_obsolete", False, "boolean")


def _ids(ids: DataFrame, id_col: str) -> DataFrame:
    return ids.select(F.col(id_col).alias("id"))


# --------------------------------------------------------------------------
# U2 current synonyms
# --------------------------------------------------------------------------

def current_synonyms(cat, synonym_type: str, entity=FEATURE_ENTITY, objects: DataFrame | None = None) -> DataFrame:
    """Current, non-internal synonym of each live object: one row per object.

    Output ``(object_id, uniquename, name, synonym_sgml)``.  The winner among
    several current synonyms is the lowest ``synonym_id`` (the reference
    takes whichever row comes first).  ``min_by`` is a hash aggregate with
    map-side partial aggregation: a hot object costs one row per map task.
    """
    table, link, _, key = entity
    obj = objects if objects is not None else _objects(cat, table).filter(~F.col("is_obsolete"))
    obj = obj.select(F.col(key).alias("object_id"), "uniquename")
    lnk = (cat[link].filter(F.col("is_current") & ~F.col("is_internal"))
           .select(F.col(key).alias("object_id"), "synonym_id"))
    syn = (cat["synonym"].filter(dims.is_type(cat, synonym_type))
           .select("synonym_id", "name", "synonym_sgml"))
    rows = obj.join(lnk, "object_id").join(syn, "synonym_id")
    # grouped on the object id alone (the uniquename depends on it), so the
    # result stays partitioned by object id for the joins that follow
    best = rows.groupBy("object_id").agg(
        F.min_by(F.struct("uniquename", "name", "synonym_sgml"), F.col("synonym_id")).alias("s"))
    return best.select("object_id", F.col("s.uniquename").alias("uniquename"), F.col("s.name").alias("name"),
                       F.col("s.synonym_sgml").alias("synonym_sgml"))


def feature_symbols(cat) -> DataFrame:
    """Current symbol of every live feature, ``(object_id, uniquename, name,
    synonym_sgml)`` - the set-based ``current_symbol`` (the reference calls it
    per row).  Kept inline: each query reads it once or twice, so staging it
    costs more than it saves; identical subplans share their exchanges."""
    return current_synonyms(cat, "symbol")


def names_of_few(cat, synonym_type: str, names: DataFrame, entity=FEATURE_ENTITY) -> DataFrame:
    """``(uniquename, synonym_sgml)``: current synonym of each uniquename in
    ``names``, a small table; of several live objects of a name the lowest
    counts.  Links and synonyms are reduced to the names before they are joined."""
    table, link, _, key = entity
    obj = stage(reduced(_objects(cat, table).filter(~F.col("is_obsolete")), names, "uniquename").select(key, "uniquename"))
    lnk = reduced(cat[link].filter(F.col("is_current") & ~F.col("is_internal")), obj, key)
    lnk = stage(lnk.select(F.col(key).alias("object_id"), "synonym_id"))
    syn = reduced(cat["synonym"].filter(dims.is_type(cat, synonym_type)), lnk, "synonym_id").select("synonym_id", "synonym_sgml")
    rows = obj.withColumnRenamed(key, "object_id").join(lnk, "object_id").join(syn, "synonym_id")
    return rows.groupBy("uniquename").agg(F.min_by("synonym_sgml", F.struct("object_id", "synonym_id")).alias("synonym_sgml"))


def symbols_by_name(cat, classes: list[str] | None = None) -> DataFrame:
    """``current_symbol(uniquename)`` for every name, or those of some data
    classes: ``(uniquename, symbol)``.  Grouped once, by the name, and with no
    more than the symbol: the lowest object of a name, then its lowest synonym."""
    obj = cat["feature"].filter(~F.col("is_obsolete"))
    if classes is not None:
        obj = obj.filter(X.data_class("uniquename").isin(classes))
    lnk = (cat["feature_synonym"].filter(F.col("is_current") & ~F.col("is_internal"))
           .select(F.col("feature_id").alias("object_id"), "synonym_id"))
    syn = cat["synonym"].filter(dims.is_type(cat, "symbol")).select("synonym_id", "synonym_sgml")
    rows = obj.select(F.col("feature_id").alias("object_id"), "uniquename").join(lnk, "object_id").join(syn, "synonym_id")
    return rows.groupBy("uniquename").agg(F.min_by("synonym_sgml", F.struct("object_id", "synonym_id")).alias("symbol"))


def stock_genotypes(cat, names: DataFrame | None = None) -> DataFrame:
    """FBst symbols: live stock -> genotype uniquename, lowest genotype id; of
    all stocks, or of the few in ``names`` (column ``uniquename``)."""
    st = reduced(cat["stock"].filter(~F.col("is_obsolete")), names, "uniquename").select("stock_id", "uniquename")
    links = cat["stock_genotype"]
    if names is not None:
        st = stage(st)
        links = reduced(links, st, "stock_id")
    rows = (st.join(links, "stock_id")
            .join(cat["genotype"].select("genotype_id", F.col("uniquename").alias("g")), "genotype_id"))
    return rows.groupBy("uniquename").agg(F.min_by("g", "genotype_id").alias("synonym_sgml"))


def _synonyms_of_few(cat, names: list[str], synonym_type: str) -> DataFrame:
    """``(id, synonym_sgml)`` of a short list, class by class."""
    tables = {c.upper(): e for c, e in ENTITY_TABLES.items()}
    by_table: dict = {}
    for n in names:
        cls = n[:4].upper()
        stock = cls == "FBST" and synonym_type.lower() == "symbol"
        by_table.setdefault("stock" if stock else tables.get(cls, FEATURE_ENTITY), []).append((n,))
    out = cat.spark.createDataFrame([], "id string, synonym_sgml string")
    for entity, rows in by_table.items():
        few = cat.spark.createDataFrame(rows, "uniquename string")
        found = stock_genotypes(cat, few) if entity == "stock" else names_of_few(cat, synonym_type, few, entity)
        out = out.unionAll(found.select(F.col("uniquename").alias("id"), "synonym_sgml"))
    return out


def current_synonym(cat, ids: DataFrame, id_col: str, synonym_type: str) -> DataFrame:
    """U2 ``current_synonym(ids, type)``: ``(id, synonym)`` per input row.

    Class-polymorphic: the data class of the id picks the object table; FBst
    symbols come from genotypes.  Each branch resolves only the distinct ids
    of its class, then one left join puts the value back on every input row
    (NULL when none).  Returns the ``synonym_sgml`` like the reference.  A
    short list plans only the classes that occur in it, each reduced first.
    """
    inp = _ids(ids, id_col)
    few = short_list(ids, id_col)
    if few is not None:
        res = _synonyms_of_few(cat, few, synonym_type)
        return inp.join(F.broadcast(res), "id", "left").select(F.col("id").alias(id_col), F.col("synonym_sgml").alias(synonym_type))
    d = inp.select("id").distinct().withColumn("cls", F.upper(X.data_class("id")))
    branches = []
    special = [c.upper() for c in ENTITY_TABLES]
    if synonym_type.lower() == "symbol":
        special.append("FBST")
        st = stock_genotypes(cat).withColumnRenamed("uniquename", "id")
        branches.append(d.filter(F.col("cls") == "FBST").join(st, "id").select("id", "synonym_sgml"))
    for cls, ent in ENTITY_TABLES.items():
        objs = _objects(cat, ent[0]).filter(~F.col("is_obsolete")).join(
            d.filter(F.col("cls") == cls.upper()).select(F.col("id").alias("uniquename")), "uniquename", "left_semi")
        s = current_synonyms(cat, synonym_type, ent, objects=objs)
        branches.append(s.select(F.col("uniquename").alias("id"), "synonym_sgml"))
    feat = (cat["feature"].filter(~F.col("is_obsolete"))
            .join(d.filter(~F.col("cls").isin(special)).select(F.col("id").alias("uniquename")), "uniquename",
                  "left_semi"))
    s = current_synonyms(cat, synonym_type, FEATURE_ENTITY, objects=feat)
    # several live features may share a uniquename: keep one value per id
    branches.append(s.groupBy(F.col("uniquename").alias("id"))
                    .agg(F.min_by("synonym_sgml", "object_id").alias("synonym_sgml")))
    res = branches[0]
    for b in branches[1:]:
        res = res.unionByName(b)
    return inp.join(res, "id", "left").select(F.col("id").alias(id_col), F.col("synonym_sgml").alias(synonym_type))


# --------------------------------------------------------------------------
# U3 related features (typed edge hop)
# --------------------------------------------------------------------------

def related_features(cat, ids: DataFrame, id_col: str, rel_types: str, data_classes: str | None = "%",
                     direction: str = "subject", with_symbol: bool = True) -> DataFrame:
    """U3 ``get_feature_relationship``.

    ``direction='subject'`` returns the *subjects* of edges whose object is
    the given feature; ``'object'`` the reverse.  Target must be live
    (not obsolete); the source's liveness is not tested.  ``rel_types`` and
    ``data_classes`` are ``SIMILAR TO`` patterns (``NULL`` class = all).
    Output ``(id, feature_relationship_id, object_id, subject_id, uniquename,
    symbol, rank, value, type)`` - one row per matching edge per input row;
    the symbol is that of the uniquename.  For a short list of ids the edges,
    targets, links and synonyms are reduced to it first (``reduction``).
    """
    data_classes = data_classes or "%"
    near, far = ("object_id", "subject_id") if direction != "object" else ("subject_id", "object_id")
    few = few_objects(cat, short_list(ids, id_col), live=False)
    src = few.select(F.col("feature_id").alias(near), "id") if few is not None else \
        cat["feature"].select(F.col("feature_id").alias(near), F.col("uniquename").alias("id"))
    src = _ids(ids, id_col).join(src, "id")
    types = dims.terms(cat, pattern=rel_types, cols=("cvterm_id", "name"))
    fr = (reduced(cat.edges_by(near), few, near, "feature_id")
          .join(types, F.col("type_id") == F.col("cvterm_id"))
          .select("feature_relationship_id", "subject_id", "object_id", "rank", "value", F.col("name").alias("type")))
    tgt = (cat["feature"].filter(~F.col("is_obsolete"))
           .filter(X.similar_to(X.data_class("uniquename"), data_classes))
           .select(F.col("feature_id").alias(far), "uniquename"))
    hops = src.join(fr, near)
    if few is not None:
        hops = stage(hops)
        tgt = stage(reduced(tgt, hops, far))
    out = hops.join(tgt, far)
    if with_symbol:
        sym = symbols_by_name(cat) if few is None else names_of_few(cat, "symbol", tgt).withColumnRenamed("synonym_sgml", "symbol")
        out = out.join(sym, "uniquename", "left")
    else:
        out = out.withColumn("symbol", F.lit(None).cast("string"))
    return out.select(F.col("id").alias(id_col), "feature_relationship_id", "object_id", "subject_id",
                      "uniquename", "symbol", "rank", "value", "type")


def edges(cat, rel_type: str | list[str], subject_classes=None, object_classes=None,
          subject_live: bool = True, object_live: bool = True) -> DataFrame:
    """Typed edges with both ends resolved: ``(subject_id, object_id, subj, obj,
    type, rank, value, feature_relationship_id)``; ends optionally restricted
    to live features of given classes (P1).  The building block of the marts.
    """
    names = [rel_type] if isinstance(rel_type, str) else rel_type
    fr = (cat.edges_by("subject_id").filter(dims.is_type(cat, names))
          .select("feature_relationship_id", "subject_id", "object_id", "rank", "value",
                  dims.type_name(cat, names).alias("type")))

    def end(classes, live, key, name):
        f = cat["feature"]
        if classes is not None:
            f = f.filter(X.is_id_of("uniquename", classes))
        if live:
            f = f.filter(~F.col("is_obsolete") & ~F.col("is_analysis"))
        return f.select(F.col("feature_id").alias(key), F.col("uniquename").alias(name))

    return (fr.join(end(subject_classes, subject_live, "subject_id", "subj"), "subject_id")
              .join(end(object_classes, object_live, "object_id", "obj"), "object_id"))


# --------------------------------------------------------------------------
# U4-U6 properties
# --------------------------------------------------------------------------

def feature_props(cat, ids: DataFrame, id_col: str, type_pattern: str) -> DataFrame:
    """U4 ``get_featureprop``: props of live features, live prop types."""
    few = few_objects(cat, short_list(ids, id_col))
    f = few if few is not None else cat["feature"].filter(~F.col("is_obsolete")).select("feature_id", F.col("uniquename").alias("id"))
    f = _ids(ids, id_col).join(f, "id")
    t = dims.terms(cat, pattern=type_pattern, live_only=True, cols=("cvterm_id", "name"))
    fp = reduced(cat["featureprop"], few, "feature_id").join(t, F.col("type_id") == F.col("cvterm_id"))
    return (f.join(fp, "feature_id")
            .select(F.col("id").alias(id_col), "featureprop_id", "feature_id", F.col("name").alias("type"),
                    "value", "rank"))


def pub_props(cat, ids: DataFrame, id_col: str, type_pattern: str) -> DataFrame:
    """U5 ``get_pubprop``: same rule over publications."""
    few = few_objects(cat, short_list(ids, id_col), "pub", "pub_id")
    p = few if few is not None else cat["pub"].filter(~F.col("is_obsolete")).select("pub_id", F.col("uniquename").alias("id"))
    p = _ids(ids, id_col).join(p, "id")
    t = dims.terms(cat, pattern=type_pattern, live_only=True, cols=("cvterm_id", "name"))
    pp = reduced(cat["pubprop"], few, "pub_id").join(t, F.col("type_id") == F.col("cvterm_id"))
    return p.join(pp, "pub_id").select(F.col("id").alias(id_col), "pub_id", F.col("name").alias("type"), "value")


def group_member_props(cat, members: DataFrame, member_col: str, type_pattern: str) -> DataFrame:
    """U6 ``get_grpmemberprop``: no liveness test on the member."""
    t = dims.terms(cat, pattern=type_pattern, live_only=True, cols=("cvterm_id", "name"))
    gmp = cat["grpmemberprop"].join(t, F.col("type_id") == F.col("cvterm_id"))
    m = members.select(F.col(member_col).alias("grpmember_id")).join(cat["grpmember"].select("grpmember_id"),
                                                                     "grpmember_id")
    return m.join(gmp, "grpmember_id").select(F.col("grpmember_id").alias(member_col), F.col("name").alias("type"),
                                              "value", "rank")


# --------------------------------------------------------------------------
# U7 ontology terms of genes
# --------------------------------------------------------------------------

def ontology_terms(cat, ids: DataFrame, id_col: str, aspect: str) -> DataFrame:
    """U7 ``get_gene_ontology_terms``: annotations in one cv, live terms only
    (gene liveness not tested)."""
    few = few_objects(cat, short_list(ids, id_col), live=False)
    f = few if few is not None else cat["feature"].select("feature_id", F.col("uniquename").alias("id"))
    f = _ids(ids, id_col).join(f, "id")
    t = dims.terms(cat, live_only=True, cv=aspect, cols=("cvterm_id",))
    return (f.join(reduced(cat["feature_cvterm"], few, "feature_id"), "feature_id").join(t, "cvterm_id")
            .select(F.col("id").alias(id_col), "feature_cvterm_id", "feature_id", "cvterm_id", "is_not"))


# --------------------------------------------------------------------------
# U8 stocks
# --------------------------------------------------------------------------

def stocks(cat, ids: DataFrame, id_col: str, short: bool = True) -> DataFrame:
    """U8 ``get_stocks``: parse ``derived_stock_<center>`` props.

    Each prop value is a list of lines ``number<TAB>@FBst:genotype@``; lines
    become rows (``explode``), a line splits on TAB, the entry is trimmed of
    blanks and ``@`` and split on ``:``; only pieces 1 and 2 are kept (so a
    second ``:`` truncates the genotype).  Feature liveness is not tested.
    ``short=False`` spares the look for a short list (marts pass all ids).
    """
    # stock props first (a small slice of featureprop), then their features'
    # names, then the requested ids: the large joins see only stock rows
    t = cat["cvterm"].filter(F.col("name").rlike("^derived_stock_")).select("cvterm_id", "name")
    few = few_objects(cat, short_list(ids, id_col), live=False) if short else None
    fp = reduced(cat["featureprop"], few, "feature_id").join(t, F.col("type_id") == F.col("cvterm_id")).select("feature_id", "name", "value")
    named = fp.join(few if few is not None else cat["feature"].select("feature_id", F.col("uniquename").alias("id")), "feature_id")
    rows = _ids(ids, id_col).join(named, "id").select(
        "id", F.replace(F.col("name"), F.lit("derived_stock_"), F.lit("")).alias("center"),
        F.explode(F.split(F.col("value"), "\n")).alias("line"))
    num_geno = F.split(F.col("line"), "\t")
    entry = F.get(num_geno, 1)
    id_geno = F.split(F.expr("trim(BOTH ' @' FROM get(split(line, '\\t'), 1))"), ":")
    return rows.select(
        F.col("id").alias("fbid"), F.get(id_geno, 0).alias("fbst"), "center",
        F.get(num_geno, 0).alias("stock_number"), F.get(id_geno, 1).alias("genotype"))


# --------------------------------------------------------------------------
# U9 / U10 publication counts
# --------------------------------------------------------------------------

def _pub_links(cat, entity, classes: set[str] | None = None) -> DataFrame:
    table, _, link, key = entity
    obj = _objects(cat, table).filter(~F.col("is_obsolete")).select(key, F.col("uniquename").alias("id"))
    if classes is not None:
        obj = obj.filter(F.upper(X.data_class("id")).isin(sorted(classes)))
    return obj.join(cat[link].select(key, "pub_id"), key).select("id", "pub_id")


def pub_counts(cat, ids: DataFrame, id_col: str, pub_types: list[str] = (), classes: list[str] | None = None
               ) -> DataFrame:
    """U9 and U10 in one pass: ``(id, n, n_<type>...)`` per input row - the
    rows that link the live object to live FBrf publications, all and of each
    given type; zero when none.  Counted per distinct id (partial aggregation
    before the shuffle) and joined back.  Class-polymorphic like U2.  ``classes`` (optional)
    tells which data classes the ids can have, so branches for other entity
    tables are not planned (T3 counts FBal ids only)."""
    inp = _ids(ids, id_col)
    d = inp.select("id").distinct().withColumn("cls", F.upper(X.data_class("id")))
    pubs = cat["pub"].filter(~F.col("is_obsolete") & (F.upper(X.data_class("uniquename")) == "FBRF"))
    pubs = pubs.select("pub_id", *[dims.is_type(cat, t).alias(f"_is_{i}") for i, t in enumerate(pub_types)])
    wanted = None if classes is None else {c.upper() for c in classes}
    links = []
    for cls, ent in ENTITY_TABLES.items():
        if wanted is not None and cls.upper() not in wanted:
            continue
        ids_c = d.filter(F.col("cls") == cls.upper()).select("id")
        links.append(_pub_links(cat, ent).join(ids_c, "id", "left_semi"))
    if wanted is None or wanted - {c.upper() for c in ENTITY_TABLES}:
        ids_f = d.filter(~F.col("cls").isin([c.upper() for c in ENTITY_TABLES])).select("id")
        links.append(_pub_links(cat, FEATURE_ENTITY, wanted).join(ids_f, "id", "left_semi"))
    allk = links[0]
    for l in links[1:]:
        allk = allk.unionByName(l)
    aggs = [F.count(F.lit(1)).alias("n")] + [F.count(F.when(F.col(f"_is_{i}"), 1)).alias(f"n_{t}")
                                             for i, t in enumerate(pub_types)]
    counts = allk.join(pubs, "pub_id").groupBy("id").agg(*aggs)
    cols = ["n"] + [f"n_{t}" for t in pub_types]
    return (inp.join(counts, "id", "left")
            .select(F.col("id").alias(id_col), *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in cols]))


def pub_count(cat, ids: DataFrame, id_col: str, pub_type: str | None = None) -> DataFrame:
    """U9 ``pub_count`` / U10 ``pub_count_by_type``: ``(id, n)`` per input row,
    all publications or those of one type (see :func:`pub_counts`)."""
    counts = pub_counts(cat, ids, id_col, [pub_type] if pub_type else [])
    return counts.select(id_col, F.col(f"n_{pub_type}" if pub_type else "n").alias("n"))


# --------------------------------------------------------------------------
# U11 pathway flag
# --------------------------------------------------------------------------

def pathway_groups(cat, accession: str = "0007034") -> DataFrame:
    """U11 ``is_pathway`` as a key set: ``grp_id`` of groups annotated with
    the FBcv pathway term (the reference ignores its second argument and
    always uses this accession)."""
    db = dims.db_ids(cat, ["FBCV"], case="upper").select("db_id")
    dbx = cat["dbxref"].filter(F.col("accession") == accession).join(db, "db_id", "left_semi").select("dbxref_id")
    t = cat["cvterm"].join(dbx, "dbxref_id", "left_semi").select("cvterm_id")
    return cat["grp_cvterm"].join(t, "cvterm_id", "left_semi").select("grp_id").distinct()


def with_flag(df: DataFrame, keys: DataFrame, on: str | list[str], name: str) -> DataFrame:
    """Add a boolean ``EXISTS`` column: ``keys`` reduced to distinct keys,
    left-joined, ``isNotNull``."""
    on = [on] if isinstance(on, str) else on
    k = keys.select(*on).distinct().withColumn(name, F.lit(True))
    return df.join(k, on, "left").withColumn(name, F.coalesce(F.col(name), F.lit(False)))
