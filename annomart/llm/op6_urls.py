"""Op 6 - URL filters: temporal list join (native).

A filter list is a log of dated edits (key, list, add or remove, time).  The
log becomes validity intervals of key and list: within a day from each addition to
the next edit, across days from the last edit of a day to the first edit of the
next day with one, or for good.  An interval across days becomes pieces, the
aligned blocks of 1, 16, 256 ... days that make it up: a logarithmic number,
however long it is, and none depends on the dates of the captures.  Every
capture then meets the pieces of its day on each level through an equi-join on
(key, level, block) and the condition ``valid_from <= fetched < valid_to``, so
it sees the list as it stood when it was fetched.  Windows never order more
than one key's edits of one day, or one row per day and key; a hot host's
captures of a coarse block are split by AQE's skew join.

Keys of a capture: its host, each parent domain of two labels or more, and
host + "/" + first path segment.  An active ``allow`` entry overrides ``block``.

Edge cases: a null or unparsable URL has no key and a null time meets no entry
(both kept); of edits of one key and list at the same instant an addition wins;
edits with null key, list or time are void; repeated captures are judged row
by row; other columns are not read; an empty list keeps everything.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

BASE, LEVELS = 16, 7            # blocks of BASE ** level days
ORIGIN = 1 << 27                # day number of 1970-01-01: all of Spark's timestamps lie in 0 .. BASE ** LEVELS

HOST = r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)"
SEGMENT = r"^[a-z][a-z0-9+.-]*://[^/?#]+/([^/?#]+)"


def host(url: Column) -> Column:
    return F.nullif(F.regexp_extract(F.lower(url), HOST, 1), F.lit(""))


def url_keys(url: Column) -> Column:
    """Keys under which a URL may be listed."""
    h, seg = host(url), F.regexp_extract(F.lower(url), SEGMENT, 1)
    n = F.size(F.split(h, r"\."))
    parents = F.when(n >= 2, F.transform(F.sequence(F.lit(2), F.greatest(n, F.lit(2))),
                                         lambda k: F.call_function("substring_index", h, F.lit("."), -k)))
    path = F.when(seg != "", F.array(F.concat_ws("/", h, seg)))
    none = F.array().cast("array<string>")
    return F.when(h.isNotNull(), F.array_distinct(F.concat(F.array(h), F.coalesce(parents, none), F.coalesce(path, none)))
                  ).otherwise(none)


def day_number(day: Column) -> Column:
    """Days, never negative: ``ORIGIN`` is 1970-01-01."""
    return F.datediff(day, F.lit("1970-01-01").cast("date")).cast("bigint") + ORIGIN


def day_blocks(first: Column, end: Column) -> Column:
    """The days ``first`` to ``end`` (exclusive) as aligned blocks ``(level,
    block)`` of ``BASE ** level`` days: at most ``2 (BASE - 1)`` a level."""
    none = F.array().cast("array<bigint>")
    span = lambda x, y: F.when(x < y, F.sequence(x, F.greatest(y - 1, x))).otherwise(none)
    up = lambda k: F.ceil(first / BASE ** k).cast("bigint")
    down = lambda k: F.floor(end / BASE ** k).cast("bigint")
    at = lambda k: lambda x: F.struct(F.lit(k).alias("level"), x.alias("block"))
    out = []
    for k in range(LEVELS):
        a, b, a2, b2 = up(k), down(k), up(k + 1), down(k + 1)
        blocks = span(a, b) if k == LEVELS - 1 else F.when(a2 >= b2, span(a, b)).otherwise(F.concat(span(a, a2 * BASE), span(b2 * BASE, b)))
        out.append(F.transform(blocks, at(k)))
    return F.concat(*out)


def validity_pieces(edits: DataFrame) -> DataFrame:
    """(key, list, level, block, valid_from, valid_to): what is active on some
    day of the block, and from when to when.  ``edits``: key, list, added
    (boolean), ts."""
    e = (edits.filter("key is not null and list is not null and ts is not null")
         .groupBy("key", "list", "ts").agg(F.max(F.coalesce("added", F.lit(False))).alias("added"))
         .withColumn("day", F.to_date("ts")))
    end = F.date_add("day", 1).cast(edits.schema["ts"].dataType)
    inside = (e.withColumn("valid_to", F.coalesce(
        F.lead("ts").over(Window.partitionBy("key", "list", "day").orderBy("ts")), end))
        .filter("added").select("key", "list", F.lit(0).alias("level"), day_number(F.col("day")).alias("block"),
                                F.col("ts").alias("valid_from"), "valid_to"))
    days = (e.groupBy("key", "list", "day").agg(F.min("ts").alias("first"), F.max_by("added", "ts").alias("added"))
            .withColumn("next", F.lead("first").over(Window.partitionBy("key", "list").orderBy("day"))))
    # from the next day on, up to and including the day of the next edit; for good when there is none
    last = F.coalesce(day_number(F.to_date("next")) + 1, F.lit(BASE ** LEVELS))
    across = (days.filter("added").withColumn("valid_from", end).filter(F.col("next").isNull() | (F.col("valid_from") < F.col("next")))
              .select("key", "list", F.explode(day_blocks(day_number(F.date_add("day", 1)), last)).alias("b"), "valid_from",
                      F.col("next").alias("valid_to"))
              .select("key", "list", "b.level", "b.block", "valid_from", "valid_to"))
    return inside.unionByName(across)


def url_filter(captures: DataFrame, edits: DataFrame, url_col: str = "url", time_col: str = "fetched") -> DataFrame:
    """All columns of ``captures`` with ``n_block``, ``n_allow`` (keys listed at
    fetch time) and ``kept``, which replace input columns of these names."""
    captures = captures.drop("n_block", "n_allow", "kept")
    names = captures.columns
    c = captures.select(F.struct(*names).alias("__c"), F.monotonically_increasing_id().alias("__row"),
                        F.col(time_col).alias("__at"), day_number(F.to_date(time_col)).alias("__day"), url_keys(F.col(url_col)).alias("__keys"))
    level = F.explode(F.array(*[F.struct(F.lit(k).alias("level"), F.floor(F.col("__day") / BASE ** k).cast("bigint").alias("block"))
                                for k in range(LEVELS)])).alias("b")
    probes = (c.filter("__day is not null").select("__row", "__at", "__day", F.explode("__keys").alias("key"))
              .select("__row", "__at", "key", level).select("__row", "__at", "key", "b.level", "b.block"))
    hits = (probes.join(validity_pieces(edits), ["key", "level", "block"])
            .filter((F.col("valid_from") <= F.col("__at")) & (F.col("valid_to").isNull() | (F.col("__at") < F.col("valid_to"))))
            .groupBy("__row").agg(F.count_if(F.col("list") == "block").alias("n_block"),
                                  F.count_if(F.col("list") == "allow").alias("n_allow")))
    out = c.join(hits, "__row", "left").select(
        "__c.*", F.coalesce("n_block", F.lit(0)).cast("bigint").alias("n_block"),
        F.coalesce("n_allow", F.lit(0)).cast("bigint").alias("n_allow"))
    return out.withColumn("kept", (F.col("n_allow") > 0) | (F.col("n_block") == 0))


# The tables hold no list and no fetch times: the edits come from the events
# (whose user is the page that the edit names), the times from the page ids.

def captures_of(pages: DataFrame) -> DataFrame:
    at = F.timestamp_seconds(F.unix_timestamp(F.lit("2024-01-01 00:00:00")) + F.col("page_id") * 7919 % (31 * 86400))
    return pages.select("page_id", "url", at.cast("timestamp").alias("fetched"))


def edits_of(events: DataFrame, pages: DataFrame) -> DataFrame:
    e = events.join(pages.select(F.col("page_id").alias("user_id"), "url"), "user_id")
    h, seg = host(F.col("url")), F.regexp_extract(F.lower("url"), SEGMENT, 1)
    kind = F.col("event_type")
    return e.select(
        F.when(kind.isin("error", "signup"), h).when(kind == "purchase", F.substring_index(h, ".", -2))
        .when(seg != "", F.concat_ws("/", h, seg)).otherwise(h).alias("key"),
        F.when(kind == "purchase", "allow").otherwise("block").alias("list"),
        F.when(kind == "purchase", F.col("value") >= 100).otherwise(kind.isin("error", "click")).alias("added"),
        F.col("ts").cast("timestamp").alias("ts"))


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    out = url_filter(captures_of(pages), edits_of(events, pages))
    return out.select("page_id", host(F.col("url")).alias("host"), F.unix_seconds("fetched").alias("fetched_s"),
                      "n_block", "n_allow", "kept")


OP6_SQL = r"""
WITH p AS (
  SELECT page_id, lower(url) AS url,
         nullif(regexp_extract(lower(url), '^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)', 1), '') AS host,
         regexp_extract(lower(url), '^[a-z][a-z0-9+.-]*://[^/?#]+/([^/?#]+)', 1) AS seg,
         1704067200 + page_id * 7919 % 2678400 AS fetched_s,
         row_number() OVER () AS r
  FROM pages),
edits AS (
  SELECT CASE WHEN event_type IN ('error', 'signup') THEN host
              WHEN event_type = 'purchase' THEN array_to_string(list_slice(string_split(host, '.'), -2, -1), '.')
              WHEN seg <> '' THEN host || '/' || seg ELSE host END AS key,
         CASE WHEN event_type = 'purchase' THEN 'allow' ELSE 'block' END AS list,
         CASE WHEN event_type = 'purchase' THEN value >= 100 ELSE event_type IN ('error', 'click') END AS added,
         epoch_us(ts) AS us
  FROM events JOIN p ON p.page_id = events.user_id),
state AS (
  SELECT key, list, us, bool_or(added) AS added FROM edits
  WHERE key IS NOT NULL AND us IS NOT NULL GROUP BY ALL),
keys AS (
  SELECT DISTINCT r, fetched_s * 1000000 AS us, unnest(list_concat(
           list_transform(range(2, greatest(len(string_split(host, '.')), 2) + 1),
                          lambda k: array_to_string(list_slice(string_split(host, '.'), -k, -1), '.')),
           CASE WHEN seg <> '' THEN [host, host || '/' || seg] ELSE [host] END)) AS key
  FROM p WHERE host IS NOT NULL),
hits AS (
  SELECT r, count(*) FILTER (WHERE list = 'block') AS n_block, count(*) FILTER (WHERE list = 'allow') AS n_allow
  FROM (SELECT k.r, l.list, s.added
        FROM keys k CROSS JOIN (VALUES ('block'), ('allow')) l(list)
        ASOF JOIN state s ON k.key = s.key AND l.list = s.list AND k.us >= s.us) WHERE added GROUP BY r)
SELECT page_id, host, fetched_s, coalesce(n_block, 0) AS n_block, coalesce(n_allow, 0) AS n_allow,
       coalesce(n_allow, 0) > 0 OR coalesce(n_block, 0) = 0 AS kept
FROM p LEFT JOIN hits USING (r)
"""
