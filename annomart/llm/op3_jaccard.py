"""Op 3 - n-gram Jaccard join by parity sketches.

A text's set is its distinct 3-word shingles (ASCII lower case).  The set is
split by hash into ``k`` blocks; each shingle flips one bit of its block's
64-bit word, so that the Hamming distance of two sketches is at most the
symmetric difference of the sets.  Sets are grouped into size bands; in a band
no linked pair differs in more than ``d`` shingles, so with more than ``d``
blocks some block is untouched by the difference (pigeonhole) and both sets
produce the same key for it: (band, block, parity word, XOR of the block's
hashes).  Sets whose size lets them meet larger bands produce their keys too.

1. one pass over the texts writes (id, size, set fingerprint);
2. further passes make the block keys, a part of them each, so that a part's
   shuffle is gone before the next; sets with an equal key are tied to the
   first of them after a shuffle by key, never paired; the weakest keys (blocks
   of few shingles, which unrelated texts can share) are spared as far as
   linked sets share others; components of the ties are candidate clusters (a
   superset of the link graph);
3. texts that share no more than a passage are tied too, and chains of them grow
   faster than the input: clusters are cut by the size and a short sketch of
   each set, a few bits an element, which all linked pairs pass;
4. one text of each set that is left is fetched; each cluster is verified in
   tiles of bounded bytes: sizes, then sketch distance, then the exact
   intersection; pairs already connected are skipped and only links that join
   two parts leave the task;
5. components of these links, with the smallest id over all copies.

Equal sets share one fingerprint; they make keys once per task at most and are
verified once, however many copies there are.  Shingles and sets are compared by 64-bit
hash.  The threshold is exact: ``100 * |A and B| >= percent * |A or B|``.

An empty block cannot tell unrelated sets apart.  A pair can depend on one
only if all its untouched blocks are empty, so a set produces keys of empty
blocks only if it has as many of them as its size leaves untouched.

Edge cases: null and blank texts have the empty set and link to nothing (their
component is their own id); with fewer than 3 words the whole word sequence is
the only element; repeated ids are separate rows; a null id never is a
component's id unless all its rows have null ids; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annomart.llm import arrays as A
from annomart.llm.graph import components
from annomart.llm.scratch import materialise

SHINGLE = 3
PERCENT = 90
TILE_BYTES = 2 << 20
SEEN = 1 << 20                 # fingerprints a task remembers to pass copies over
PARTS = 2                      # passes that make block keys
BITS = 1 << 25                 # of the bitmap that spares the shuffle of rows which are not wanted
MOST_WORDS = 256               # of a short sketch at most
FEW_WORDS = 1 << 21            # words of an exact bitmap that every task may get (134 million rows)


class Bands:
    """Size bands and the number of blocks in each, for one threshold."""

    def __init__(self, percent: int):
        if not 50 < percent <= 100:
            raise ValueError("percent must be in 51..100")
        self.percent = percent
        self.lo = [1]
        while self.lo[-1] < 1 << 40:
            self.lo.append(max(self.lo[-1] + 1, -(-self.lo[-1] * 3 // 2)))
        self.lo = np.array(self.lo, np.int64)

    def differ(self, sizes_sum: int) -> int:
        """Largest symmetric difference of a linked pair with this sum of sizes."""
        return (100 - self.percent) * sizes_sum // (100 + self.percent)

    def blocks(self, band: int) -> int:
        """Blocks in a band: a quarter more than pigeonhole needs, so that
        linked sets share several keys; none where only equal sets link."""
        d = self.differ(2 * (int(self.lo[band + 1]) - 1))
        return d + 2 + d // 4 if d else 0

    def of(self, n: int) -> list[int]:
        """Bands whose keys a set of ``n`` produces."""
        t = int(np.searchsorted(self.lo, n, "right")) - 1
        return list(range(t, int(np.searchsorted(self.lo, n * 100 // self.percent, "right"))))

    def keys(self, u: np.ndarray) -> np.ndarray:
        """Block keys of a set.  Linked sets share at least ``shared`` of them;
        with the keys in one order for all sets, strongest (most shingles in the
        block) first, the last ``shared - 1`` can be spared: the first key that
        a linked pair shares is never among them (prefix filter)."""
        n, out = len(u), [np.zeros(0, A.U)]
        second = A.mix(u + A.U(0x9E3779B97F4A7C15))
        for t in self.of(n):
            k = self.blocks(t)
            if not k:
                continue
            block = ((u >> A.U(6)) % A.U(k)).astype(np.int64)
            word, total = parity_words(u, block, k), np.zeros(k, A.U)
            np.bitwise_xor.at(total, block, second)
            size = np.bincount(block, minlength=k)
            b = np.flatnonzero(size)
            shared = k - self.differ(n + n * 100 // self.percent) - (k - len(b))
            if shared < 1:                                      # it may depend on an empty block
                b, shared = np.arange(k), 1
            key = A.mix(A.mix(total[b] ^ A.mix(word[b])) ^ A.mix((b + (t << 40)).astype(A.U)))
            out.append(key[np.lexsort((key, -size[b]))[:len(b) - shared + 1]])
        return np.concatenate(out)


def parity_words(u: np.ndarray, block: np.ndarray, k: int) -> np.ndarray:
    """The bit sketch: one 64-bit word per block, one bit flipped per element."""
    word = np.zeros(k, A.U)
    np.bitwise_xor.at(word, block, A.U(1) << (u & A.U(63)))
    return word


def shingle_sets(texts: pa.Array, width: int):
    """(row, sorted distinct 64-bit shingle hashes) of every text."""
    buf, offs = A.text_buffer(texts)
    for i, j in A.slices(offs):
        part, o = A.LOWER[buf[offs[i]:offs[j]]], offs[i:j + 1] - offs[i]
        s, e, row = A.word_spans(part, o)
        h = A.span_hashes(part, s, e)
        cut = np.searchsorted(row, np.arange(j - i + 1))
        grams = A.gram_hashes(h, width)
        for r in range(j - i):
            a, b = cut[r], cut[r + 1]
            if b - a >= width:
                yield i + r, np.unique(grams[a:b - width + 1])
            else:
                yield i + r, A.gram_hashes(h[a:b], b - a) if b > a else h[:0]


def fingerprint(u: np.ndarray) -> int:
    """Signed 64-bit fingerprint of a set."""
    x = np.array([u.sum(dtype=A.U), np.bitwise_xor.reduce(A.mix(u)), len(u)], A.U)
    return int(A.gram_hashes(A.mix(x), 3).view(np.int64)[0])


def set_table(docs: DataFrame, text_col: str, width: int, whole: bool) -> DataFrame:
    """``docs`` with ``__n`` (set size), ``__f`` (fingerprint, null for the empty
    set) and ``__first`` (the task has not just seen the same set); the text is
    kept in all rows (``whole``) or in these only."""
    at = docs.columns.index(text_col)

    def run(batches):
        seen = set()
        for b in batches:
            n, f, first = [], [], []
            for _, u in shingle_sets(b.column(at), width):
                n.append(len(u))
                f.append(fingerprint(u) if len(u) else None)
                first.append(len(u) > 0 and f[-1] not in seen)
                if first[-1]:
                    if len(seen) >= SEEN:
                        seen.clear()
                    seen.add(f[-1])
            cols = list(b.columns)
            if not whole:
                cols[at] = pc.if_else(pa.array(first), cols[at], pa.scalar(None, cols[at].type))
            yield pa.RecordBatch.from_arrays([*cols, pa.array(n, pa.int64()), pa.array(f, pa.int64()), pa.array(first, pa.bool_())],
                                             [*b.schema.names, "__n", "__f", "__first"])

    ddl = "".join(f"`{x.name}` {x.dataType.simpleString()}, " for x in docs.schema.fields)
    return docs.mapInArrow(A.trimmed(run), ddl + "__n bigint, __f bigint, __first boolean")


def block_keys(width: int, percent: int, part: int = 0, parts: int = 1):
    """Rows (text, f) to rows (key, f), of one part of the keys."""
    def run(batches):
        bands = Bands(percent)
        for b in batches:
            f = b.column(1).to_numpy()
            keys, of, held = [], [], 0
            for r, u in shingle_sets(b.column(0), width):
                k = bands.keys(u)
                keys.append(k[k % A.U(parts) == A.U(part)])
                of.append(np.full(len(keys[-1]), f[r]))
                held += len(of[-1])
                if held > 1 << 18 or r == b.num_rows - 1:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(of))], ["key", "f"])
                    keys, of, held = [], [], 0
    return A.trimmed(run)


def tied(batches):
    """A partition sorted by (key, f): each set of a key with the key's first one."""
    key = hub = None
    for batch in batches:
        k, s = (c.to_numpy() for c in batch.columns)
        if not len(k):
            continue
        first = A.run_starts(k)
        hubs = s[first].copy()
        if key is not None and k[0] == key:
            hubs[0] = hub
        key, hub = k[-1], hubs[-1]
        a = np.repeat(hubs, np.diff(np.r_[first, len(k)]))
        yield pa.RecordBatch.from_arrays([pa.array(a[a != s]), pa.array(s[a != s])], ["a", "b"])


class Forest:
    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = i = self.up[self.up[i]]
        return i


def short_sketch(u: np.ndarray) -> np.ndarray:
    """Two bits or more an element up to ``MOST_WORDS``; a power of two words, so
    that the sketches of two sizes are compared as the smaller one's."""
    w = min(MOST_WORDS, 1 << max(1, (max(len(u), 1) * 2 - 1 >> 6).bit_length()))
    return parity_words(u, ((u >> A.U(6)) & A.U(w - 1)).astype(np.int64), w)


def short_sketches(width: int):
    """Rows (text, row) to rows (row, n, sketch)."""
    def run(batches):
        for b in batches:
            n, sketch = [], []
            for _, u in shingle_sets(b.column(0), width):
                n.append(len(u))
                sketch.append(short_sketch(u).tobytes())
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array(n, pa.int64()), pa.array(sketch, pa.binary())], ["row", "n", "sketch"])
    return A.trimmed(run)


def alike(table: pa.Table, percent: int) -> tuple[list[int], list[int]]:
    """Pairs of a tile (f, tile, n, sketch), or between two, whose sizes and
    sketches allow a link; only those that join two parts."""
    f, first = np.unique(table.column("f").to_numpy(), return_index=True)
    size = table.column("n").to_numpy()[first]
    o = np.argsort(size, kind="stable")
    f, size, first = f[o], size[o], first[o]
    side = table.column("tile").to_numpy()[first]
    sketch = [np.frombuffer(x, A.U) for x in table.column("sketch").combine_chunks().take(pa.array(first)).to_pylist()]
    words = np.array([len(x) for x in sketch])                  # in the order of the sizes
    ends = {int(w): int(np.searchsorted(words, w, "right")) for w in np.unique(words)}
    stacks = {w: np.stack(sketch[int(np.searchsorted(words, w)):end]) for w, end in ends.items()}
    cross = len(np.unique(side)) > 1
    forest, out, label, idle = Forest(len(f)), ([], []), np.arange(len(f)), 0
    for j in range(1, len(f)):
        at = int(np.searchsorted(size, -(-percent * int(size[j]) // 100)))
        while at < j:
            w = int(words[at])
            end, begin = min(j, ends[w]), ends[w] - len(stacks[w])
            far = np.bitwise_count(stacks[w][at - begin:end - begin] ^ np.bitwise_xor.reduce(sketch[j].reshape(-1, w))).sum(axis=1, dtype=np.int64)
            hit = at + np.flatnonzero(far <= (100 - percent) * (size[at:end] + size[j]) // (100 + percent))
            if cross:
                hit = hit[side[hit] != side[j]]
            for x in hit[np.unique(label[hit], return_index=True)[1]]:
                a, b = forest.root(int(x)), forest.root(j)
                if a == b:
                    idle += 1
                    continue
                forest.up[max(a, b)] = min(a, b)
                out[0].append(int(f[x]))
                out[1].append(int(f[j]))
            at = end
        if idle >= len(f):
            label, idle = np.array([forest.root(x) for x in range(len(f))]), 0
    return out


def linked(table: pa.Table, width: int, percent: int) -> tuple[list[int], list[int]]:
    """Links that join two parts of a tile (f, tile, text columns): all pairs
    of one tile, or between two tiles, that are not yet connected."""
    f, first = np.unique(table.column("f").to_numpy(), return_index=True)
    side = table.column("tile").to_numpy()[first]
    sets = [u for _, u in shingle_sets(table.column("text").combine_chunks().take(pa.array(first)), width)]
    size = np.array([len(u) for u in sets], np.int64)
    o = np.argsort(size, kind="stable")
    f, side, size, sets = f[o], side[o], size[o], [sets[i] for i in o]
    cross = len(np.unique(side)) > 1
    k = int(size[-1]) // 8 + 1
    sketch = np.stack([parity_words(u, ((u >> A.U(6)) % A.U(k)).astype(np.int64), k) for u in sets])
    forest, out = Forest(len(f)), ([], [])
    label = np.arange(len(f))
    for j in range(1, len(f)):
        lo = int(np.searchsorted(size, -(-percent * int(size[j]) // 100)))
        if lo >= j:
            continue
        i = np.arange(lo, j)
        if cross:
            i = i[side[i] != side[j]]
        i = i[label[i] != label[j]]
        for at in range(0, len(i), 256):
            c = i[at:at + 256]
            far = np.bitwise_count(sketch[c] ^ sketch[j]).sum(axis=1, dtype=np.int64)
            for x in c[far <= (100 - percent) * (size[c] + size[j]) // (100 + percent)]:
                a, b = forest.root(int(x)), forest.root(j)
                if a == b:
                    continue
                both = np.isin(sets[x], sets[j], assume_unique=True, kind="sort").sum()
                if 100 * both >= percent * (size[x] + size[j] - both):
                    forest.up[max(a, b)] = min(a, b)
                    out[0].append(int(f[x]))
                    out[1].append(int(f[j]))
        if j % 64 == 0:
            label = np.array([forest.root(x) for x in range(len(f))])
    return out


def wanted(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """``rows`` without nearly all of those whose ``row`` is not in ``keys``: a
    bitmap of hashes (64 bits a word) of bounded size goes to every task."""
    bit = F.pmod(F.xxhash64("row"), F.lit(BITS))
    mask = F.expr("shiftleft(1L, cast(pmod(xxhash64(row), 64) as int))")
    words = keys.select(F.shiftright(bit, 6).alias("w"), mask.alias("m")).groupBy("w").agg(F.bit_or("m").alias("bits"))
    return (rows.withColumns({"w": F.shiftright(bit, 6), "m": mask})
            .join(F.broadcast(words.withColumnRenamed("w", "v")), F.expr("w = v and (m & bits) <> 0"), "left_semi").drop("w", "m"))


def with_row(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """``rows`` whose ``__row`` is in ``keys`` (column ``__row``).  The keys are
    written as a bitmap in the order of the row numbers; every task gets it, so
    that no row is shuffled, unless it is larger than ``FEW_WORDS``."""
    mask = lambda: F.expr("shiftleft(1L, cast(__row & 63 as int))")
    words = materialise(keys.select(F.shiftright("__row", 6).alias("__w"), mask().alias("__m")).groupBy("__w").agg(F.bit_or("__m").alias("__bits")), "op3-rows")
    if words.count() <= FEW_WORDS:
        words = F.broadcast(words)
    return rows.join(words, (F.shiftright("__row", 6) == F.col("__w")) & (mask().bitwiseAND(F.col("__bits")) != 0), "left_semi")


def tiled(member: DataFrame, weight, tile_bytes: int) -> DataFrame:
    """The sets of each cluster dealt to tiles of about ``tile_bytes`` of
    ``weight``, and every two tiles (t, u) of a cluster put together."""
    tiles = member.groupBy("cluster").agg((F.sum(weight) / tile_bytes).cast("int").alias("m")).withColumn("m", F.col("m") + 1)
    return (member.join(tiles, "cluster").withColumn("tile", F.pmod(F.xxhash64("f"), "m").cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("m") - 1)))
            .select(F.least("tile", "other").alias("t"), F.greatest("tile", "other").alias("u"), "tile", *member.columns)
            # the joins leave whole clusters together; their tiles are spread
            .repartition("cluster", "t", "u"))


def labelled(sets: DataFrame, text_col: str, width: int, percent: int, tile_bytes: int) -> DataFrame:
    """(f, label) of every set that is linked to another one; ``sets`` is a
    written set table with the number ``__row`` of each row."""
    first = sets.filter("__first").select(F.col(text_col).alias("text"), F.col("__f").alias("f"), F.col("__row").alias("row"))
    ties = []
    for part in range(PARTS):
        rows = first.select("text", "f").mapInArrow(block_keys(width, percent, part, PARTS), "key bigint, f bigint")
        ties.append(materialise(rows.repartition("key").sortWithinPartitions("key", "f").mapInArrow(tied, "a bigint, b bigint").distinct(), "op3-ties"))
    cluster = components(reduce(DataFrame.unionAll, ties)).withColumnsRenamed({"node": "f", "label": "cluster"})

    # one row of each set of a cluster
    one = materialise(first.groupBy("f").agg(F.min("row").alias("row")).join(cluster, "f"), "op3-chosen")
    sketch = wanted(first.select("text", "row"), one).mapInArrow(short_sketches(width), "row bigint, n bigint, sketch binary")
    sketch = materialise(sketch.join(one, "row"), "op3-sketches")

    def cut(table: pa.Table) -> pa.Table:
        a, b = alike(table, percent)
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    tiles = tiled(sketch.select("cluster", "f", "n", "sketch"), F.octet_length("sketch") + 16, max(1, tile_bytes // 8))
    cluster = components(tiles.groupBy("cluster", "t", "u").applyInArrow(cut, "a bigint, b bigint")).withColumnsRenamed({"node": "f", "label": "cluster"})

    # only the texts of these are shuffled, whatever the size of the cluster table
    one = materialise(one.drop("cluster").join(cluster, "f"), "op3-chosen")
    texts = wanted(first.select("text", "row"), one)
    member = materialise(texts.join(one.hint("shuffle_hash"), "row").drop("row"), "op3-members")

    def verify(table: pa.Table) -> pa.Table:
        a, b = linked(table, width, percent)
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    links = tiled(member, F.octet_length("text"), tile_bytes).groupBy("cluster", "t", "u").applyInArrow(verify, "a bigint, b bigint")
    return components(links).withColumnsRenamed({"node": "f"})


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE,
                       percent: int = PERCENT, tile_bytes: int = TILE_BYTES) -> DataFrame:
    """(id, n_shingles, component_id) per row of ``docs``."""
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.monotonically_increasing_id().alias("__row"))
    sets = materialise(set_table(src, "text", width, False), "op3-sets", batch_rows=2000)
    label = labelled(sets, "text", width, percent, tile_bytes)
    named = sets.select("id", "__n", F.col("__f").alias("f")).join(label, "f", "left").withColumn("label", F.coalesce("label", "f"))
    least = named.filter("f is not null").groupBy("label").agg(F.min("id").alias("component"))
    return named.join(least, "label", "left").select(
        F.col("id").alias(id_col), F.col("__n").alias("n_shingles"),
        F.when(F.col("f").isNull(), F.col("id")).otherwise(F.col("component")).alias("component_id"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5,
                         percent: int = 80, tile_bytes: int = TILE_BYTES) -> DataFrame:
    """The rows of ``docs`` (all columns) of which each component keeps one: the
    smallest id, of equal ids the first row.  Rows with the empty set all stay."""
    cols = docs.columns
    sets = materialise(set_table(docs.withColumn("__row", F.monotonically_increasing_id()), text_col, width, True), "op3-docs", batch_rows=2000)
    label = labelled(sets, text_col, width, percent, tile_bytes)
    named = sets.filter("__f is not null").select(F.col("__f").alias("f"), F.struct(
        F.col(id_col).isNull(), F.col(id_col), F.col("__row")).alias("who")).join(label, "f", "left")
    stay = named.groupBy(F.coalesce("label", "f")).agg(F.min("who")["__row"].alias("__row")).select("__row")
    return with_row(sets, stay.unionAll(sets.filter("__f is null").select("__row"))).select(*cols)


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return jaccard_components(docs)


OP3_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, row_number() OVER () AS r,
         list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS MATERIALIZED (
  SELECT doc_id, r, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s
  FROM w),
one AS MATERIALIZED (SELECT r, len(s) AS n, unnest(s) AS x FROM s),
pair AS (SELECT a.r AS a, b.r AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS i
         FROM one a JOIN one b ON a.x = b.x AND a.r < b.r AND 10 * least(a.n, b.n) >= 9 * greatest(a.n, b.n) GROUP BY 1, 2),
link AS MATERIALIZED (SELECT a, b FROM pair WHERE 100 * i >= 90 * (na + nb - i)
                      UNION ALL SELECT b, a FROM pair WHERE 100 * i >= 90 * (na + nb - i)),
reach AS (SELECT r AS a, r AS b FROM s UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a)
SELECT s.doc_id, len(s.s) AS n_shingles, c.component_id FROM s
JOIN (SELECT a, min(o.doc_id) AS component_id FROM reach JOIN s o ON o.r = reach.b GROUP BY a) c ON c.a = s.r
"""
