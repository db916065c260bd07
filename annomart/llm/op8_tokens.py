"""Op 8 - token counts by rank-synchronous array merging.

The tokenizer file gives the normaliser, the pre-tokeniser and the merge
ranks.  Pre-tokens of a batch are held as one ragged array of symbol ids; in
each round every sequence finds its own lowest-rank neighbouring pair and all
sequences apply theirs at once (every occurrence, left to right), until no
sequence has a known pair.  The surviving symbols are counted.

A text's count is the sum over its words ``[^\\x20\\x09-\\x0D]+``, because the
pre-tokeniser never crosses white space; a batch merges each distinct word
once and keeps a bounded table of counts for the next batches of the task.

Edge cases: null text counts as empty (0 bytes, 0 tokens); one result row per
input row, whatever the ids; extra columns are ignored; special strings inside
a text count as one token, as in the tokenizer's own default.
"""

from __future__ import annotations

import json
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annomart.llm import arrays as A

LIMIT = 2048
KNOWN_WORDS = 200_000          # entries of a task's table of word counts before it is emptied


def byte_symbols() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return [chr(b) if b in plain else chr(256 + rest.index(b)) for b in range(256)]


class MergeTable:
    """Merge ranks of a byte-level BPE file with word ends, as sorted arrays."""

    def __init__(self, path: str):
        import unicodedata

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, self.nfc = spec["model"], unicodedata.normalize
        kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
        split = spec["pre_tokenizer"]["pretokenizers"][0]
        if kinds != ["NFC", "Replace", "Lowercase"] or split["type"] != "Split" or not split["invert"]:
            raise ValueError(f"unsupported tokenizer layout: {kinds}, {split['type']}")
        self.pattern = regex.compile(split["pattern"]["Regex"])
        self.special = regex.compile("(" + "|".join(regex.escape(t["content"]) for t in spec["added_tokens"]) + ")")
        vocab, sym = model["vocab"], byte_symbols()
        self.inner = np.array([vocab[s] for s in sym], np.int64)
        self.final = np.array([vocab[s + model["end_of_word_suffix"]] for s in sym], np.int64)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        keys = left << 32 | right
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank = keys[order], order
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int64)

    def pretokens(self, word: str) -> tuple[int, list[bytes]]:
        """(special strings, pre-tokens) of a text."""
        n, out = 0, []
        for i, part in enumerate(self.special.split(word)):
            if i % 2:
                n += 1
            elif part:
                out += [p.encode() for p in self.pattern.findall(lower(self.nfc("NFC", part)))]
        return n, out

    def count(self, tokens: list[bytes]) -> np.ndarray:
        """Surviving symbols of each pre-token (none is empty)."""
        size = np.fromiter(map(len, tokens), np.int64, len(tokens))
        flat = np.frombuffer(b"".join(tokens), np.uint8)
        sym = self.inner[flat]
        last = np.cumsum(size) - 1
        sym[last] = self.final[flat[last]]
        row = np.repeat(np.arange(len(tokens)), size)
        out = size.copy()
        none = len(self.rank)
        while len(sym):
            key = sym[:-1] << 32 | sym[1:]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            rank = np.where((self.keys[at] == key) & (row[:-1] == row[1:]), self.rank[at], none)
            first = A.run_starts(row)
            lowest = np.minimum.reduceat(np.r_[rank, none], first)        # of each sequence still open
            live = lowest < none
            size = np.diff(np.r_[first, len(row)])
            hit = (rank < none) & (rank == np.repeat(lowest, size)[:-1])
            # of a run of overlapping hits (equal symbols) every second one applies
            p = np.flatnonzero(hit)
            begin = np.r_[True, np.diff(p) != 1] if len(p) else np.zeros(0, bool)
            nth = np.arange(len(p)) - np.maximum.accumulate(np.where(begin, np.arange(len(p)), 0)) if len(p) else p
            p = p[nth % 2 == 0]
            sym[p] = self.made[rank[p]]
            keep = np.ones(len(sym), bool)
            keep[p + 1] = False
            out[row[first]] = size - np.bincount(np.searchsorted(first, p, "right") - 1, minlength=len(first))
            keep &= np.repeat(live, size)                                  # finished sequences leave
            sym, row = sym[keep], row[keep]
        return out


def lower(s: str) -> str:
    """Lower case letter by letter (no final-sigma rule, as the tokenizer does it)."""
    return s.lower() if s.isascii() else "".join(map(str.lower, s))


@cache
def merge_table(path: str) -> MergeTable:
    return MergeTable(path)


class WordCounts:
    """Token counts of words by hash, filled batch by batch; bounded in size."""

    def __init__(self, table: MergeTable, limit: int = KNOWN_WORDS):
        self.table, self.limit = table, limit
        self.hash, self.n = np.zeros(0, A.U), np.zeros(0, np.int64)

    def __call__(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        h, first, back = np.unique(A.span_hashes(buf, starts, ends), return_index=True, return_inverse=True)
        n = np.zeros(len(h), np.int64)
        if len(self.hash):
            at = np.minimum(np.searchsorted(self.hash, h), len(self.hash) - 1)
            old = self.hash[at] == h
            n[old] = self.n[at[old]]
        else:
            old = np.zeros(len(h), bool)
        new = np.flatnonzero(~old)
        if len(new):
            tokens, of = [], []
            for j, i in enumerate(first[new]):
                special, pre = self.table.pretokens(buf[starts[i]:ends[i]].tobytes().decode("utf-8", "replace"))
                n[new[j]] = special
                tokens += pre
                of += [j] * len(pre)
            if tokens:
                n[new] += np.bincount(np.array(of), self.table.count(tokens), len(new)).astype(np.int64)
            if len(self.hash) + len(new) > self.limit:
                self.hash, self.n = h, n
            else:
                both, cnt = np.r_[self.hash, h[new]], np.r_[self.n, n[new]]
                o = np.argsort(both, kind="stable")
                self.hash, self.n = both[o], cnt[o]
        return n[back]


def token_counts(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = LIMIT) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) per row.  ``vocabulary`` is a path
    that every executor can open (the tokenizer file is installed there)."""
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches):
        count = WordCounts(merge_table(vocabulary))
        for b in batches:
            buf, offs = A.text_buffer(b.column(1))
            tokens = np.zeros(b.num_rows, np.int64)
            for i, j in A.slices(offs):
                part, o = buf[offs[i]:offs[j]], offs[i:j + 1] - offs[i]
                s, e, row = A.word_spans(part, o)
                tokens[i:j] = A.sum_by(count(part, s, e), row, j - i) if len(s) else 0
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.diff(offs)), pa.array(tokens),
                                              pa.array(tokens > limit)], ["id", "n_bytes", "n_tokens", "over_limit"])

    kind = src.schema["id"].dataType.simpleString()
    out = src.mapInArrow(A.trimmed(run), f"id {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean")
    return out.withColumnRenamed("id", id_col)


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return token_counts(docs, str(public_tokenizers.path("word_bpe_49k.json")))
