"""Op 2 - substring dedup with repeated-phrase automata.

A window of ``window`` words is repeated if its word sequence starts anywhere
else, in the same text or another.  Every word that a repeated window covers
is removed; windows are judged on the input.

The routing of :mod:`annomart.llm.passages` brings all windows that can be
equal to one shard.  There the recurring windows are confirmed by their counts
and compiled, a bounded number at a time, into Aho-Corasick automata over word
numbers; the shard's texts are streamed through the automaton, which locates
every occurrence.  So every document's windows pass an automaton that knows
all phrases that they can contain, and no automaton grows with the corpus.

Words ``[^\\x20\\x09-\\x0D]+`` are compared by 64-bit hash.

Edge cases: null text is empty and stays null; texts shorter than a window
lose nothing; texts that lose nothing keep their bytes; repeated rows are
texts like any other (they remove each other); ids play no part.
"""

from __future__ import annotations

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annomart.llm import arrays as A
from annomart.llm.op7_quality import words
from annomart.llm.passages import Chunk, covered, repeated_windows

WINDOW = 35
GRAM = 12
PHRASES = 40_000               # windows compiled into one automaton


def block_size(window: int) -> int:
    """Words per automaton symbol: a divisor of the window."""
    return next(d for d in (7, 5, 4, 3, 2, 1) if window % d == 0)


def digits(most: int):
    """(letters per symbol, symbols to text) for symbols 0..``most``: 64 letters
    of its own for each place; 0 is spelt in a letter that no other uses."""
    width = 1
    while 64 ** width <= most:
        width += 1

    def text(symbols: np.ndarray) -> str:
        code = symbols[:, None] >> 6 * np.arange(width) & 63
        code += 1 + 64 * np.arange(width)
        code[symbols == 0] = 0
        return code.astype("<u4").tobytes().decode("utf-32-le")

    return width, text


def locate(ids: np.ndarray, cut: np.ndarray, count: np.ndarray, weight: np.ndarray, hashes: np.ndarray,
           window: int) -> np.ndarray:
    """Which windows of some segments recur.  Segment ``j`` holds the word
    numbers ``ids[cut[j]:cut[j + 1]]``, ``count[j]`` windows and occurs
    ``weight[j]`` times; ``hashes`` are those of its windows in order.

    The automaton's symbols are blocks of words: a phrase is the run of its
    ``window / block`` blocks, and a text is streamed once per phase, as its
    blocks at every ``block``-th word from the first, second, ... word.  A
    block's number is spelt in digits, because a state finds its next one by
    trying its letters in turn."""
    hit = np.zeros(len(hashes), bool)
    _, first, back = np.unique(hashes, return_index=True, return_inverse=True)
    total = np.bincount(back, np.repeat(weight, count), len(first))
    at = A.ragged(cut[:-1], count)                             # first word of every window
    confirmed = first[total >= 2]
    if not len(confirmed):
        return hit
    d = block_size(window)
    n = window // d
    blocks = len(ids) - d + 1                                  # those across segments are never streamed
    _, symbol = np.unique(A.gram_hashes(A.mix(ids.astype(A.U)), d), return_inverse=True)
    phrase = symbol[at[confirmed][:, None] + np.arange(0, window, d)]
    used = np.zeros(blocks, np.int64)
    used[phrase.ravel()] = 1
    symbol = (np.cumsum(used) * used)[symbol]                  # blocks of no phrase become 0
    phrase = symbol[at[confirmed][:, None] + np.arange(0, window, d)]
    width, text = digits(int(used.sum()))
    automaton = ahocorasick.Automaton()
    keys = text(phrase.ravel())
    for k in range(len(phrase)):
        automaton.add_word(keys[k * n * width:(k + 1) * n * width], k)
    automaton.make_automaton()
    # one stream of all segments and phases, each ended by a symbol that no block has
    size = np.diff(cut)
    begin = (cut[:-1][:, None] + np.arange(d)).ravel()
    long = np.maximum((np.repeat(size, d) - np.tile(np.arange(d), len(size))) // d, 0)
    place = np.cumsum(long + 1) - (long + 1)
    stream = np.zeros(int((long + 1).sum()), np.int64)
    word = np.repeat(begin, long) + d * A.ragged(np.zeros(len(long), np.int64), long)
    spot = A.ragged(place, long)
    stream[spot] = symbol[np.minimum(word, blocks - 1)]
    origin = np.zeros(len(stream), np.int64)
    origin[spot] = word
    found = np.array(list(automaton.iter(text(stream))), np.int64).reshape(-1, 2)
    start = origin[found[:, 0] // width - n + 1]               # first word of every occurrence
    seg = np.searchsorted(cut, start, "right") - 1
    times = np.bincount(found[:, 1], weight[seg], len(confirmed))
    keep = times[found[:, 1]] >= 2
    hit[(np.cumsum(count) - count)[seg[keep]] + start[keep] - cut[seg[keep]]] = True
    return hit


def shard_bits(s: dict, window: int = WINDOW, phrases: int = PHRASES) -> np.ndarray:
    """One bit per window of a shard's segments: does it recur?"""
    offs = np.r_[0, np.cumsum(s["size"])]
    lo, hi, row = A.word_spans(s["data"], offs)
    _, ids = np.unique(A.span_hashes(s["data"], lo, hi), return_inverse=True)
    ids = ids.astype(np.int64) + 1
    cut = np.searchsorted(row, np.arange(len(offs)))
    run = np.zeros(len(ids) + 1, A.U)
    np.cumsum(A.mix(ids.astype(A.U)) * A.powers(len(ids)), out=run[1:])
    back_power = A.powers(len(ids) + 1, A._Q)
    of = lambda a, b: A.mix((run[b] - run[a]) * back_power[a] ^ (b - a).astype(A.U))
    # the same segment from several chunks counts once, with its occurrences summed
    _, first, back = np.unique(of(cut[:-1], cut[1:]), return_index=True, return_inverse=True)
    weight = np.bincount(back, s["value"], len(first))
    order = np.argsort(s["key"][first], kind="stable")
    count, key = s["count"][first[order]], s["key"][first[order]]
    edge = np.r_[A.run_starts(key), len(key)]                  # batches never split a key
    upto = np.r_[0, np.cumsum(count)]
    bits, done = np.zeros(int(upto[-1]), bool), 0
    while done < len(edge) - 1:
        stop = max(done + 1, int(np.searchsorted(upto[edge], upto[edge[done]] + phrases, "right")) - 1)
        a, b = edge[done], edge[stop]
        seg = first[order[a:b]]
        size = cut[seg + 1] - cut[seg]
        at = A.ragged(cut[seg], count[a:b])
        bits[upto[a]:upto[b]] = locate(ids[A.ragged(cut[seg], size)], np.r_[0, np.cumsum(size)], count[a:b],
                                       weight[order[a:b]], of(at, at + window), window)
        done = stop
    place = np.empty(len(first), np.int64)
    place[order] = upto[:-1]
    return bits[A.ragged(place[back], s["count"])]


def remove_repeats(docs: DataFrame, text_col: str = "text", cols: list[str] | None = None, window: int = WINDOW,
                   gram: int = GRAM, phrases: int = PHRASES, **sizes: int) -> DataFrame:
    """The columns ``cols`` with ``kept_text`` (the removed words cut out, each
    with the white space after it), ``n_words`` and ``n_removed``, which replace
    input columns of these names.  ``sizes``: see
    :func:`annomart.llm.passages.repeated_windows`."""
    cols = [c for c in (docs.columns if cols is None else cols) if c not in ("kept_text", "n_words", "n_removed")]

    def value(c: Chunk, start: np.ndarray, slot: np.ndarray, n: int) -> np.ndarray:
        return np.bincount(slot, minlength=n)

    def finish(c: Chunk, hit: np.ndarray):
        gone = covered(len(c.values), hit, window)
        n = len(c.offs) - 1
        text_of = np.repeat(np.arange(n), np.diff(c.cut))
        # a removed word goes with the white space up to the next word of its text
        nxt = np.r_[c.first[1:], 0]
        last = c.cut[1:][np.diff(c.cut) > 0] - 1
        nxt[last] = c.offs[text_of[last] + 1]
        edge = np.zeros(len(c.buf) + 1, np.int8)
        np.add.at(edge, c.first[gone], 1)
        np.add.at(edge, nxt[gone], -1)
        keep = np.cumsum(edge[:-1], dtype=np.int8) == 0
        upto = np.r_[0, np.cumsum(keep)][c.offs]
        data = c.buf[keep].tobytes()
        text = pa.StringArray.from_buffers(n, pa.py_buffer(upto.astype(np.int32).tobytes()), pa.py_buffer(data))
        removed = np.r_[0, np.cumsum(gone)][c.cut]
        was_null = c.rest.column("__null").to_numpy(zero_copy_only=False)
        if was_null.any():
            text = pa.array([None if z else t for z, t in zip(was_null, text.to_pylist())], pa.string())
        kept = [x for x in c.rest.schema.names if x != "__null"]
        yield pa.RecordBatch.from_arrays([*(c.rest.column(x) for x in kept), text, pa.array(np.diff(c.cut)),
                                          pa.array(np.diff(removed))], [*kept, "kept_text", "n_words", "n_removed"])

    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.select(*cols).schema.fields)
    return repeated_windows(
        docs.withColumn("__null", F.col(text_col).isNull()), text_col, [*cols, "__null"], True, window, gram, value,
        lambda s: shard_bits(s, window, phrases), True, finish,
        schema + "kept_text string, n_words bigint, n_removed bigint", "op2", **sizes)


def op2_repeated_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = remove_repeats(docs, cols=["doc_id"])
    return out.select("doc_id", "n_words", "n_removed",
                      F.sha2(F.array_join(words(F.col("kept_text")), " "), 256).alias("kept_sha256"))


OP2_SQL = r"""
WITH w AS (
  SELECT doc_id, row_number() OVER () AS r,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
win AS MATERIALIZED (
  SELECT r, i, md5(array_to_string(list_slice(w, i, i + 34), ' ')) AS h
  FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS i FROM w WHERE len(w) >= 35)),
hit AS MATERIALIZED (SELECT r, i FROM win WHERE h IN (SELECT h FROM win GROUP BY h HAVING count(*) > 1)),
gone AS (SELECT DISTINCT r, i + unnest(range(35)) AS i FROM hit),
lost AS (SELECT r, list(i) AS g, count(*) AS n FROM gone GROUP BY r),
word AS (SELECT r, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS x FROM w),
kept AS (SELECT word.r, string_agg(x, ' ' ORDER BY word.i) AS t FROM word ANTI JOIN gone ON word.r = gone.r AND word.i = gone.i GROUP BY word.r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(lost.n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN lost USING (r) LEFT JOIN kept USING (r)
"""
