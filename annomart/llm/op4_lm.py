"""Op 4 - language-model scores from Elias-Fano n-gram tries.

A word n-gram model (order 3 in the query) is trained on all documents but the
held-out ones and scores every document.  Words get nearly dense numbers from their
hash buckets (which also give their counts); n-grams are counted in shards by
context.  Each shard writes its n-grams as a compact trie
(:mod:`annomart.llm.eliasfano`): a level per order from 2 on, in which the
context of an n-gram is the place of its first n - 1 words in the level above,
with 16-bit codes of the counts ``c``.  The tries are a table in the shared
folder; scoring opens each and answers all n-grams that the chunks ask for by
successor search relative to the context.  With ``p1`` the add-one unigram
estimate and h' the context h without its first word,

    p(w | h) = (c(h w) + weight * p(w | h')) / (c(h) + weight)

which sums to 1 over the vocabulary but for the rounding of the codes (counts
below 2,000 are exact).  A context ends at the begin of its text.

An n-gram lives with its context.  A context so frequent that one shard should
not hold it is split by successor: by its count (order 2) or by the count of its
rarest word, which bounds it (higher orders; the words that lead to it are then
repeated in each shard, with no count of their own).  So shards stay bounded,
however frequent a word is.  Both exchanges send each distinct word or n-gram of
a chunk once.

Tokens are ASCII lower-cased words and one end per text.  Edge cases: a null
id has the empty text as its text (so it trains); null text is empty (one
end); repeated rows count as often as they occur; without training documents
nothing is known and p1 is 1; words are compared by 64-bit hash.
"""

from __future__ import annotations

import zlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annomart.llm import arrays as A
from annomart.llm.eliasfano import Trie
from annomart.llm.passages import blob, chunk_table, cuts, rows, squeeze, unsqueeze
from annomart.llm.scratch import mark, materialise, sweep

U = A.U
ORDER = 3
WEIGHT = 20.0                   # pseudo-count of the lower order's estimate in a context
FOLDS, HELD_OUT = 7, 2
CHUNK_BYTES = 3 << 20
BUCKET_BYTES = 24 << 20         # text per bucket of words
SHARD_BYTES = 4 << 20           # text per shard of n-grams
ROUNDS = 4                      # shards and chunks are dealt out a quarter at a time
SPLIT = 1 << 18                 # occurrences of a context per part
END = U(0x00E4D)                # stands for the end among word hashes
CODES, SPREAD = 65535, 14.0     # codes 1..CODES cover log10 of a count in [0, SPREAD]


def encode(count: np.ndarray) -> np.ndarray:
    x = np.clip(np.log10(np.maximum(count, 1)) / SPREAD, 0, 1)
    return np.where(count > 0, 1 + np.round(x * (CODES - 1)), 0).astype(np.uint16)


def decode(code: np.ndarray) -> np.ndarray:
    count = np.rint(10.0 ** ((code.astype(np.float64) - 1) / (CODES - 1) * SPREAD))
    return np.where(code == 0, 0.0, count)


def id_text(x) -> bytes:
    return b"" if x is None else str(x).encode()


class Tokens:
    """A chunk's tokens: distinct hashes and, per token, its place among them."""

    def __init__(self, row: dict, folds: int, held_out: int):
        buf = A.LOWER[np.frombuffer(pa.decompress(row["data"], decompressed_size=row["n_bytes"], codec="zstd", asbytes=True), np.uint8)]
        offs = np.frombuffer(row["offs"], "<i8")
        self.id, self.rest = row["chunk"], pa.ipc.open_stream(row["rest"]).read_next_batch()
        first, last, of = A.word_spans(buf, offs)
        self.n = np.bincount(of, minlength=len(offs) - 1) + 1  # with the end
        self.cut = np.r_[0, np.cumsum(self.n)]
        h = np.full(int(self.cut[-1]), END, U)
        h[np.arange(len(of)) + of] = A.span_hashes(buf, first, last)
        self.hash, self.at = A.distinct_hashes(h)
        self.text_of = np.repeat(np.arange(len(self.n)), self.n)
        self.held = np.array([zlib.crc32(id_text(x)) % folds == held_out for x in self.rest.column(0).to_pylist()], bool)
        self.train = ~self.held[self.text_of]

    def counts(self) -> np.ndarray:
        return np.bincount(self.at[self.train], minlength=len(self.hash))

    def numbered(self, row: dict, parts: int) -> tuple[np.ndarray, np.ndarray]:
        """(number or -1, training count) of each distinct hash, from the buckets' answers."""
        part = (A.mix(self.hash) % U(parts)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        got = sorted(row["answers"], key=lambda a: a["bucket"])
        num, cnt = np.empty(len(order), np.int64), np.empty(len(order), np.int64)
        local = np.concatenate([unsqueeze(a["num"], "<i4") for a in got]).astype(np.int64)
        num[order] = np.where(local < 0, -1, local * parts + part[order])   # buckets are even, so hardly a number is left out
        cnt[order] = np.concatenate([unsqueeze(a["n"], "<i8") for a in got])
        return num, cnt


class Grams:
    """A chunk's distinct n-grams as a forest by shard.

    Level 1 has (shard, first word), level k the distinct (entry of level k - 1,
    word); so the entries of every level are sorted by shard."""

    def __init__(self, t: Tokens, num: np.ndarray, cnt: np.ndarray, unknown: int, texts: int, order: int, shards: int, split: int):
        word, count = np.where(num < 0, unknown, num)[t.at], cnt[t.at]      # unknown + 1: begin
        before, self.c_before = np.r_[unknown + 1, word[:-1]], np.r_[0, count[:-1]]
        before[t.cut[:-1]], self.c_before[t.cut[:-1]] = unknown + 1, texts
        n, self.levels = len(word), range(2, order + 1)
        place = np.arange(n) - np.repeat(t.cut[:-1], t.n)
        self.ends = {k: np.flatnonzero(place >= k - 2) for k in self.levels}    # tokens at which an n-gram of order k ends
        # shard of each n-gram, a function of its words; only those of split contexts leave their context's shard
        route, least, left = np.zeros(n, U), self.c_before, {}
        shard = {}
        for k in self.levels:
            i = self.ends[k]
            r = np.zeros(n, U)
            if k == 2:
                r, far = before.astype(U) << U(20), np.flatnonzero(least >= split)
                r[far] |= A.mix(word[far].astype(U)) % (least[far] // split + 1).astype(U)
            else:
                r[i], rarest = route[i - 1], np.zeros(n, np.int64)
                rarest[i] = np.minimum(least[i - 1], count[i - 1])
                least = rarest
                i = left[k] = np.flatnonzero(least >= split)
                r[i] = A.mix(r[i]) ^ A.mix(word[i].astype(U)) % (least[i] // split + 1).astype(U)
            route, shard[k] = r, np.zeros(n, np.int64)
            shard[k][i] = (A.mix(r[i]) % U(shards)).astype(np.int64)
        self.words, self.parent, self.train, self.shard, self.at = {}, {}, {}, {}, {}
        above: dict[int, np.ndarray] = shard                   # by order: entry of the first words of the n-gram ending at a token
        for k in range(1, order + 1):
            low = max(k, 2)
            own = {o: self.ends[o] if o == low else left[o] for o in range(low, order + 1)}
            key = np.concatenate([above[o][i].astype(U) << U(32) | (before[i - o + 2] if k == 1 else word[i - o + k]).astype(U)
                                  for o, i in own.items()])
            key, back = A.distinct(key)
            here, end = {}, 0
            for o, i in own.items():
                here[o] = np.zeros(n, np.int64)
                if o > low:
                    here[o][self.ends[o]] = here[o - 1][self.ends[o] - 1]
                here[o][i] = back[end:end + len(i)]
                end += len(i)
            self.words[k], up = key & U(0xFFFFFFFF), (key >> U(32)).astype(np.int64)
            self.shard[k] = up if k == 1 else self.shard[k - 1][up]
            if k > 1:
                i = self.ends[k]
                self.parent[k], self.at[k] = up, here[k][i]
                self.train[k] = np.bincount(self.at[k][t.train[i]], minlength=len(key))
            above = here

    def parts(self) -> list[tuple[int, dict[int, slice]]]:
        """(shard, its entries of each level)."""
        shards = self.shard[1][A.run_starts(self.shard[1])]
        cut = {k: np.r_[np.searchsorted(s, shards), len(s)] for k, s in self.shard.items()}
        return [(int(q), {k: slice(c[j], c[j + 1]) for k, c in cut.items()}) for j, q in enumerate(shards)]


class Sent:
    """The n-grams that chunks sent to one shard, one forest after the other."""

    def __init__(self, t: pa.Table, order: int):
        cat = lambda col, k, kind: np.concatenate([unsqueeze(x[k], kind) for x in t.column(col).to_pylist()])
        self.words, self.parent = {1: cat("words", 0, "<u4").astype(U)}, {}
        self.sizes = {1: np.array([int.from_bytes(x[0][:4], "little") for x in t.column("words").to_pylist()], np.int64)}
        for k in range(2, order + 1):
            self.parent[k] = np.repeat(np.arange(len(self.words[k - 1])), cat("children", k - 2, "<u4").astype(np.int64))
            self.words[k] = cat("words", k - 1, "<u4").astype(U)
            self.sizes[k] = np.array([int.from_bytes(x[k - 1][:4], "little") for x in t.column("words").to_pylist()], np.int64)
        self.counts = lambda k: cat("n", k - 2, "<u4").astype(np.int64)

    def trie(self, order: int) -> np.ndarray:
        """Words of the trie: the levels from 2 on, one after the other."""
        top, at = A.distinct(self.words[1])
        key, up, count = {1: top}, {}, {}
        for k in range(2, order + 1):
            u, back = A.distinct(at[self.parent[k]].astype(U) << U(32) | self.words[k])
            count[k] = np.bincount(back, self.counts(k), len(u)).astype(np.int64)
            key[k], up[k], at = u & U(0xFFFFFFFF), (u >> U(32)).astype(np.int64), back
        keep = {order: count[order] > 0}                       # words that only lead to kept ones stay, without a code
        for k in range(order, 2, -1):
            keep[k - 1] = count[k - 1] > 0
            keep[k - 1][up[k][keep[k]]] = True
        out, name = [], top
        for k in range(2, order + 1):
            x = keep[k]
            out.append(Trie.build(name[up[k][x]], key[k][x], encode(count[k][x])))
            name = (np.cumsum(x) - 1).astype(U)
        return np.concatenate(out)

    def codes(self, trie: Trie, order: int) -> dict[int, np.ndarray]:
        """The code of every n-gram, by order.  Each distinct n-gram of the shard is
        sought once, in the order of its context's place and its word."""
        out, name = {}, self.words[1].astype(np.int64)
        for k in range(2, order + 1):
            known, place = name[self.parent[k]], np.full(len(self.words[k]), -1, np.int64)
            i = np.flatnonzero(known >= 0)
            u, back = A.distinct(known[i].astype(U) << U(32) | self.words[k][i])
            place[i] = trie.find(u >> U(32), u & U(0xFFFFFFFF))[back]
            out[k], name, trie = trie.code_at(place), place, trie.below
        return out


def train_and_score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", weight: float = WEIGHT,
                    folds: int = FOLDS, held_out: int = HELD_OUT, split: int = SPLIT, chunk_bytes: int = CHUNK_BYTES,
                    bucket_bytes: int = BUCKET_BYTES, shard_bytes: int = SHARD_BYTES,
                    order: int = 2) -> tuple[DataFrame, DataFrame]:
    """(scores, model).  Scores: id, held_out, n_tokens, n_known, train_tokens,
    base_score, score per row.  Model: (shard, trie binary), the written tries
    that scoring read; ``order`` is 2 or more."""
    if order < 2:
        raise ValueError("order must be 2 or more")
    kind = docs.schema[id_col].dataType.simpleString()
    chunks = chunk_table(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), "text", ["id"], "op4-chunks", chunk_bytes)
    total = chunks.agg(F.sum("n_bytes")).first()[0] or 0
    buckets, shards = max(8, -(-total // bucket_bytes)), max(8, -(-total // shard_bytes))

    def over(f):
        def run(batches):
            for b in batches:
                for i in range(b.num_rows):
                    row = b.slice(i, 1).to_pylist()[0]
                    yield from f(Tokens(row, folds, held_out), row)
        return A.trimmed(run)

    # 1. words: counts and numbers
    word_schema = pa.schema([("bucket", pa.int32()), ("chunk", pa.int64()), ("words", pa.binary()), ("n", pa.binary()), ("texts", pa.int64())])

    def send_words(t: Tokens, _row):
        part = (A.mix(t.hash) % U(buckets)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        h, n, texts = t.hash[order], t.counts()[order], int((~t.held).sum())
        p = cuts(part[order])
        yield rows({"bucket": [q for q, _, _ in p], "chunk": [t.id] * len(p), "words": [blob(h[a:b], "<u8") for _, a, b in p],
                    "n": [squeeze(n[a:b], "<i4") for _, a, b in p], "texts": [texts * (i == 0) for i in range(len(p))]}, word_schema)

    def number(t: pa.Table) -> pa.Table:
        size = np.array([len(x.as_py()) // 8 for x in t.column("words")], np.int64)
        h = np.frombuffer(b"".join(x.as_py() for x in t.column("words")), "<u8")
        n = np.concatenate([unsqueeze(x.as_py(), "<i4") for x in t.column("n")]).astype(np.int64)
        words, back = np.unique(h, return_inverse=True)
        count = np.zeros(len(words), np.int64)
        np.add.at(count, back, n)
        num = np.where(count > 0, np.cumsum(count > 0) - 1, -1)
        end = np.cumsum(size)
        known, tokens = int((count > 0).sum()), int(count.sum())
        m = len(size)
        return pa.table({"chunk": t.column("chunk"), "bucket": t.column("bucket"),
                         "num": pa.array([squeeze(num[back[b - k:b]], "<i4") for k, b in zip(size, end)], pa.binary()),
                         "n": pa.array([squeeze(count[back[b - k:b]], "<i8") for k, b in zip(size, end)], pa.binary()),
                         "known": pa.array([known] + [0] * (m - 1)), "tokens": pa.array([tokens] + [0] * (m - 1)),
                         "texts": t.column("texts")})

    numbers = materialise(
        chunks.mapInArrow(over(send_words), "bucket int, chunk bigint, words binary, n binary, texts bigint").groupBy("bucket")
        .applyInArrow(number, "chunk bigint, bucket int, num binary, n binary, known bigint, tokens bigint, texts bigint"),
        "op4-words", batch_rows=1)
    v, tokens, texts, most = (x or 0 for x in numbers.groupBy("bucket").agg(
        F.sum("known").alias("v"), F.sum("tokens").alias("n"), F.sum("texts").alias("d"))
        .agg(F.sum("v"), F.sum("n"), F.sum("d"), F.max("v")).first())
    unknown = most * buckets                                   # above every number
    numbered = chunks.join(numbers.groupBy("chunk").agg(F.collect_list(F.struct("bucket", "num", "n")).alias("answers"))
                           .hint("shuffle_hash"), "chunk")

    # 2. n-grams: one trie per shard, which answers the shard's n-grams
    def grams_of(t: Tokens, row):
        num, cnt = t.numbered(row, buckets)
        return Grams(t, num, cnt, unknown, texts, order, shards, split), cnt

    gram_schema = pa.schema([("shard", pa.int32()), ("chunk", pa.int64()), *((k, pa.list_(pa.binary())) for k in ("words", "children", "n"))])

    def send_grams(t: Tokens, row):
        g, _ = grams_of(t, row)
        children = {k: np.bincount(g.parent[k], minlength=len(g.words[k - 1])) for k in g.levels}
        parts = g.parts()
        yield rows({"shard": [q for q, _ in parts], "chunk": [t.id] * len(parts),
                    "words": [[squeeze(g.words[k][at[k]], "<u4") for k in at] for _, at in parts],
                    "children": [[squeeze(children[k][at[k - 1]], "<u4") for k in g.levels] for _, at in parts],
                    "n": [[squeeze(g.train[k][at[k]], "<u4") for k in g.levels] for _, at in parts]}, gram_schema)

    def build(t: pa.Table) -> pa.Table:
        return pa.table({"shard": t.column("shard").slice(0, 1), "trie": pa.array([Sent(t, order).trie(order).tobytes()], pa.binary())})

    def answer(t: pa.Table, model: pa.Table) -> pa.Table:
        sent = Sent(t, order)
        codes, out = sent.codes(Trie(np.frombuffer(model.column("trie")[0].as_buffer(), U)), order), []
        end = {k: np.cumsum(sent.sizes[k]) for k in codes}
        for i in range(t.num_rows):
            out.append([squeeze(c[end[k][i] - sent.sizes[k][i]:end[k][i]], "<u2") for k, c in codes.items()])
        return pa.table({"chunk": t.column("chunk"), "shard": t.column("shard"), "codes": pa.array(out, pa.list_(pa.binary()))})

    # written before they are dealt out, so that the shuffled texts can go first; what a round has answered goes as well
    spark, written = docs.sparkSession, mark()
    sent = materialise(numbered.mapInArrow(over(send_grams), "shard int, chunk bigint, words array<binary>, children array<binary>, "
                                           "n array<binary>").withColumn("round", F.col("shard") % ROUNDS),
                       "op4-grams", batch_rows=1, by="round", parts=ROUNDS)
    models, answers = [], []
    for i in range(ROUNDS):
        own = sent.filter(F.col("round") == i).drop("round")
        models.append(materialise(own.groupBy("shard").applyInArrow(build, "shard int, trie binary"), "op4-model"))
        answers.append(materialise(own.groupBy("shard").cogroup(models[i].groupBy("shard"))
                                   .applyInArrow(answer, "chunk bigint, shard int, codes array<binary>"), "op4-served"))
        sweep(spark, written + i, written + i + 1)
    model, served = reduce(DataFrame.union, models), reduce(DataFrame.union, answers)

    # 3. scores
    schema = f"`{id_col}` {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"

    def score(t: Tokens, row):
        g, cnt = grams_of(t, row)
        p1 = ((cnt + 1) / (tokens + v + 1))[t.at]
        prob, context, got = p1.copy(), g.c_before, sorted(row["served"], key=lambda a: a["shard"])
        for k in g.levels:
            i, count = g.ends[k], np.zeros(len(prob))
            count[i] = decode(np.concatenate([unsqueeze(a["codes"][k - 2], "<u2") for a in got]))[g.at[k]]
            if k > 2:
                context = np.r_[0, below[:-1]]                 # an n-gram's context ends at the token before
            prob[i] = (count[i] + weight * prob[i]) / (context[i] + weight)
            below = count
        m = len(t.n)
        add = lambda x: np.bincount(t.text_of, x, m)
        yield pa.RecordBatch.from_arrays(
            [t.rest.column(0), pa.array(t.held), pa.array(t.n), pa.array(add(cnt[t.at] > 0).astype(np.int64)),
             pa.array(np.full(m, tokens, np.int64)), pa.array(add(np.log10(p1))), pa.array(add(np.log10(prob)))],
            [id_col, "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    scored = []
    for i in range(ROUNDS):
        own = F.pmod(F.xxhash64("chunk"), F.lit(ROUNDS)) == i
        replies = served.filter(own).groupBy("chunk").agg(F.collect_list(F.struct("shard", "codes")).alias("served"))
        scored.append(materialise(numbered.filter(own).join(replies.hint("shuffle_hash"), "chunk").mapInArrow(over(score), schema),
                                  "op4-scores", batch_rows=1))
    scored = reduce(DataFrame.union, scored)
    return scored, model


def op4_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return train_and_score(docs, order=ORDER)[0]
