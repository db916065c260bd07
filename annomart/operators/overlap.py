"""Interval overlap join (J13) and interval slice.

Spark has no range-join strategy; a plain theta join on ``src`` with an
overlap predicate is quadratic per scaffold.  Here both sides are cut into
bins on their coordinate axis and joined by an ordinary shuffled equi-join.

Bins come in ``LEVELS`` sizes, each ``FACTOR`` times the one below.  An
interval's *own* level is the smallest whose bins are at least as long as the
interval, so it touches at most two of them.  A pair belongs to the larger of
its two levels and that interval *owns* it: on its own level an interval meets
what the other side places there, and an interval is placed on another level
only to meet owners.  The owner's side is part of the join key, so two
intervals that are merely placed never meet, however many share a bin; the
candidates of an owner lie within its two bins, and it is itself longer than a
quarter of one.  Work grows with the intervals and with the true pairs, not with
the square of a scaffold.

Each side is first asked which levels its intervals own (a one-row aggregate,
read as a scalar subquery), and nothing is placed on a level without owners: a
table of short intervals makes a row or two an interval.  Of the bins that both
touch, the first emits the pair, so no ``distinct`` is needed.  Results are exact.

A level whose bins hold a whole scaffold is one key of the equi-join; AQE's
skew-join handling (on by default) splits its placed intervals over tasks,
beside the few intervals that are long enough to own pairs there.  Null or
reversed coordinates: a null interval meets nothing; of a reversed one (``hi``
below ``lo``) only the overlap test decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_BIN = 1_000             # bins of the lowest level
LEVELS = 12
FACTOR = 4


def bin_sizes(bin_size: int = DEFAULT_BIN) -> list[int]:
    return [bin_size * FACTOR ** i for i in range(LEVELS)]


def own_level(lo: Column, hi: Column, bin_size: int = DEFAULT_BIN) -> Column:
    """The smallest level whose bins are at least as long as the interval (the last for longer ones)."""
    sizes = bin_sizes(bin_size)
    own = F.lit(LEVELS - 1)
    for i in range(LEVELS - 2, -1, -1):
        own = F.when(hi - lo <= sizes[i], i).otherwise(own)
    return own


def owned_levels(df: DataFrame, own: str) -> Column:
    """The levels that ``df`` has intervals of, as bits; a scalar subquery."""
    return F.coalesce(df.agg(F.bit_or(F.expr(f"shiftleft(1, {own})")).alias("bits")).scalar(), F.lit(0))


def _rows(df: DataFrame, lo: str, hi: str, p: str, owner: Column, placed: Column, bin_size: int) -> DataFrame:
    """``df`` once per bin: ``<p>level``, ``<p>bin``, ``<p>first`` (the first bin
    that the interval touches) and ``<p>owns`` (whether as owner).  ``owner``
    and ``placed`` tell, by a level ``i``, in which role the interval goes there."""
    size = F.array(*[F.lit(s).cast("long") for s in bin_sizes(bin_size)])
    every = F.array(*[F.lit(i) for i in range(LEVELS)])

    def bins(i: Column, owns: bool) -> Column:
        at = lambda c: F.floor(c / F.get(size, i)).cast("long")
        return F.transform(F.sequence(at(F.col(lo)), at(F.greatest(F.col(hi), F.col(lo)))),
                           lambda b: F.struct(i.alias("level"), b.alias("bin"), at(F.col(lo)).alias("first"), F.lit(owns).alias("owns")))

    def role(test, owns: bool) -> Column:
        return F.flatten(F.transform(F.filter(every, test), lambda i: bins(i, owns)))

    known = df.filter(F.col(lo).isNotNull() & F.col(hi).isNotNull())
    rows = known.withColumn("_b", F.explode(F.concat(role(owner, True), role(placed, False))))
    return rows.withColumns({f"{p}{c}": F.col(f"_b.{c}") for c in ("level", "bin", "first", "owns")}).drop("_b")


def _bit(bits: Column, i: Column) -> Column:
    return F.call_function("shiftright", bits, i).bitwiseAND(F.lit(1)) == 1


def candidates(L: DataFrame, R: DataFrame, bin_size: int = DEFAULT_BIN) -> DataFrame:
    """All pairs of rows (``l_src, l_lo, l_hi`` and ``r_...``) that share a bin in
    which one of them owns the pair: a superset of the overlapping pairs."""
    L = L.withColumn("_lown", own_level(F.col("l_lo"), F.col("l_hi"), bin_size))
    R = R.withColumn("_rown", own_level(F.col("r_lo"), F.col("r_hi"), bin_size))
    in_l, in_r = owned_levels(L, "_lown"), owned_levels(R, "_rown")
    L, R = L.withColumn("_other", in_r), R.withColumn("_other", in_l)
    other, l, r = F.col("_other"), F.col("_lown"), F.col("_rown")
    # equal levels: the left one owns the pair
    smaller = lambda i: other.bitwiseAND(F.call_function("shiftleft", F.lit(1), i) - 1) != 0
    Lb = _rows(L, "l_lo", "l_hi", "_l", lambda i: i == l, lambda i: (i > l) & _bit(other, i), bin_size).drop("_other")
    Rb = _rows(R, "r_lo", "r_hi", "_r", lambda i: (i == r) & smaller(i), lambda i: (i >= r) & _bit(other, i), bin_size).drop("_other")
    return Lb.join(Rb, (F.col("l_src") == F.col("r_src")) & (F.col("_llevel") == F.col("_rlevel")) & (F.col("_lbin") == F.col("_rbin"))
                   & (F.col("_lowns") == ~F.col("_rowns")), "inner")


def overlap_join(left: DataFrame, right: DataFrame, *, left_cols=("srcfeature_id", "fmin", "fmax"),
                 right_cols=("srcfeature_id", "fmin", "fmax"), bin_size: int = DEFAULT_BIN,
                 inclusive: bool = True) -> DataFrame:
    """All (left, right) row pairs on the same source whose intervals overlap.

    ``inclusive=True``: closed intervals, touching ends overlap
    (``l.lo <= r.hi and r.lo <= l.hi``); ``False``: half-open.  Column names
    of the two sides must not clash except for the coordinate columns, which
    are returned as ``l_<name>`` / ``r_<name>``.  ``bin_size`` is the length of
    the lowest bins; the typical length of a short interval is best.
    """
    ls, llo, lhi = left_cols
    rs, rlo, rhi = right_cols
    L = left.withColumnRenamed(ls, "l_src").withColumnRenamed(llo, "l_lo").withColumnRenamed(lhi, "l_hi")
    R = right.withColumnRenamed(rs, "r_src").withColumnRenamed(rlo, "r_lo").withColumnRenamed(rhi, "r_hi")
    if inclusive:
        ov = (F.col("l_lo") <= F.col("r_hi")) & (F.col("r_lo") <= F.col("l_hi"))
    else:
        ov = (F.col("l_lo") < F.col("r_hi")) & (F.col("r_lo") < F.col("l_hi"))
    out = candidates(L, R, bin_size).filter(ov & (F.col("_lbin") == F.greatest("_lfirst", "_rfirst")))
    out = out.drop(*[f"_{x}{c}" for x in "lr" for c in ("own", "owns", "level", "bin", "first")])
    return (out.withColumnRenamed("l_src", f"l_{ls}").withColumnRenamed("l_lo", f"l_{llo}")
               .withColumnRenamed("l_hi", f"l_{lhi}").withColumnRenamed("r_src", f"r_{rs}")
               .withColumnRenamed("r_lo", f"r_{rlo}").withColumnRenamed("r_hi", f"r_{rhi}"))


def feature_overlaps(featureloc: DataFrame, features: DataFrame, others: DataFrame | None = None, *,
                     bin_size: int = DEFAULT_BIN) -> DataFrame:
    """J13 ``feature_overlaps``: for each feature in ``features`` (column
    ``feature_id``), every feature of ``others`` (column ``feature_id``; all
    located features if absent) with a location overlapping one of its
    locations on the same source: ``(feature_id, other_id)``.  Both sides are
    restricted before they are binned."""
    loc = featureloc.select("feature_id", "srcfeature_id", "fmin", "fmax")
    mine = loc.join(features.select("feature_id"), "feature_id", "left_semi")
    if others is not None:
        loc = loc.join(others.select("feature_id"), "feature_id", "left_semi")
    return overlap_join(mine, loc.withColumnRenamed("feature_id", "other_id"), bin_size=bin_size).select("feature_id", "other_id")


def featureloc_slice(queries: DataFrame, featureloc: DataFrame, *, query_cols=("srcfeature_id", "fmin", "fmax"),
                     wanted: DataFrame | None = None, bin_size: int = DEFAULT_BIN, inclusive: bool = True) -> DataFrame:
    """For every query range, the featureloc rows on the same source that
    overlap it (the set-based ``featureloc_slice(src, min, max)``).  ``wanted``
    (column ``feature_id``) restricts the locations before they are binned."""
    loc = featureloc.select("feature_id", "srcfeature_id", "fmin", "fmax")
    if wanted is not None:
        loc = loc.join(wanted.select("feature_id"), "feature_id", "left_semi")
    return overlap_join(queries, loc, left_cols=query_cols, bin_size=bin_size, inclusive=inclusive)
