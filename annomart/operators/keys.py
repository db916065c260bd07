"""Keys: first-per-key (D2/D3), surrogate keys (F22), key checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: list[str], order: list[str], nulls_last: bool = True) -> DataFrame:
    """D2 ``DISTINCT ON (keys)``: one row per key, the first by ``order``.

    The reference leaves the winner to row order; here it is the first row
    by ``order`` (ascending, NULLs last unless ``nulls_last=False``), then
    by the remaining columns, so the choice is a total order and
    reproducible.  Implemented as an aggregate (``min_by`` over a struct; a
    sort aggregate in the plan) rather than a window: partial aggregation keeps one
    candidate per key per task, so a key holding a third of all rows is
    never sorted or gathered in one task.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]

    def rank(c):
        # (is NULL, value): non-NULL values sort first when nulls_last
        return [F.col(c).isNull().alias(f"_n_{c}"), F.col(c).alias(f"_v_{c}")] if nulls_last else \
            [F.col(c).alias(f"_v_{c}")]

    ordering = F.struct(*[x for c in order + rest for x in rank(c)])
    payload = F.struct(*[F.col(c) for c in order + rest])
    best = df.groupBy(*keys).agg(F.min_by(payload, ordering).alias("_w"))
    return best.select(*keys, *[F.col(f"_w.{c}").alias(c) for c in order + rest]).select(*df.columns)


def surrogate_key(*cols: Column | str) -> Column:
    """stable, distributed surrogate id from the natural key (replaces
    ``SERIAL``; no single-task numbering)."""
    return F.xxhash64(*cols)


def check_unique(df: DataFrame, keys: list[str], table: str, primary: bool = True) -> DataFrame:
    """T31 primary key / unique check: one row per violating key.

    Output ``(table, key, n_violations)``: ``key`` is the key rendered as
    text.  For a primary key (``primary=True``) NULL key parts are
    violations too; for a UNIQUE constraint rows with a NULL part are exempt
    (SQL semantics).  Partial aggregation before the shuffle keeps hot keys
    cheap.
    """
    key_txt = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("<null>")) for k in keys])
    any_null = F.lit(False)
    for k in keys:
        any_null = any_null | F.col(k).isNull()
    rows = df.select(key_txt.alias("key"), any_null.cast("int").alias("_null"))
    if not primary:
        rows = rows.filter(F.col("_null") == 0)
    g = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("_null").alias("_null"))
    return (g.filter((F.col("n") > 1) | (F.col("_null") == 1))
             .select(F.lit(table).alias("table"), "key", F.col("n").alias("n_violations")))


def check_fk(child: DataFrame, child_cols: list[str], parent: DataFrame, parent_cols: list[str],
             table: str) -> DataFrame:
    """T31 foreign key check: child keys (no part NULL) with no parent row.

    ``left_anti`` join; the parent side is reduced to distinct keys first.
    Output ``(table, key, n_violations)`` with the number of child rows.
    """
    p = parent.select(*[F.col(a).alias(f"_p{i}") for i, a in enumerate(parent_cols)]).distinct()
    c = child.select(*[F.col(a).alias(f"_c{i}") for i, a in enumerate(child_cols)])
    c = c.dropna("any")
    cond = [F.col(f"_c{i}") == F.col(f"_p{i}") for i in range(len(child_cols))]
    orphans = c.join(p, cond, "left_anti")
    key_txt = F.concat_ws("|", *[F.col(f"_c{i}").cast("string") for i in range(len(child_cols))])
    return (orphans.groupBy(key_txt.alias("key")).agg(F.count(F.lit(1)).alias("n_violations"))
            .select(F.lit(table).alias("table"), "key", "n_violations"))


def check_all(marts: dict[str, DataFrame], unique, unique_or_null, foreign) -> DataFrame:
    """T31 over written marts: all violations of the given constraints, as
    ``(table, key, n_violations)`` like the single checks above.
    ``unique``: (mart, key columns); ``unique_or_null``: the same, rows with a
    NULL part exempt; ``foreign``: (mart, column, parent mart, parent column).

    Every mart is scanned once: a row becomes one tagged key for each
    constraint that it takes part in, ``(constraint, key, as parent, has null)``,
    and one aggregate over all marts counts rows and parents by key.  Keys are
    compared part by part, so no two keys are taken for one."""
    rules = [(t, keys, True) for t, keys in unique] + [(t, keys, False) for t, keys in unique_or_null]
    names = [t for t, _, _ in rules] + [f"{t}.{c}" for t, c, _, _ in foreign]
    tags: dict[str, list] = {}

    def tag(mart, rule, cols, parent):
        parts = [F.col(c).cast("string") for c in cols]
        null = F.lit(False)
        for p in parts:
            null = null | p.isNull()
        tags.setdefault(mart, []).append(F.struct(F.lit(rule).alias("rule"), F.array(*parts).alias("parts"), F.lit(parent).alias("parent"),
                                                  null.alias("null")))

    for i, (t, keys, _) in enumerate(rules):
        tag(t, i, keys, False)
    for i, (t, c, p, pc) in enumerate(foreign, len(rules)):
        tag(t, i, [c], False)
        tag(p, i, [pc], True)
    primary = [i for i, (_, _, is_primary) in enumerate(rules) if is_primary]
    stream = None
    for mart, cols in tags.items():
        rows = marts[mart].select(F.explode(F.array(*cols)).alias("t")).select("t.*")
        stream = rows if stream is None else stream.unionAll(rows)
    stream = stream.filter(~F.col("null") | F.col("rule").isin(primary))
    g = stream.groupBy("rule", "parts").agg(F.count_if(~F.col("parent")).alias("n"), F.count_if("parent").alias("parents"),
                                            F.max("null").alias("null"))
    is_fk = F.col("rule") >= len(rules)
    bad = F.when(is_fk, (F.col("n") > 0) & (F.col("parents") == 0)).otherwise((F.col("n") > 1) | F.col("null"))
    text = F.concat_ws("|", F.transform("parts", lambda p: F.coalesce(p, F.lit("<null>"))))
    return g.filter(bad).select(F.get(F.array(*[F.lit(n) for n in names]), F.col("rule")).alias("table"), text.alias("key"),
                                F.col("n").alias("n_violations"))
