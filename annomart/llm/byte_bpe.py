"""A byte-level BPE tokenizer file as a fast encoder of plain text.

The vocabulary and merges come from the tokenizer's JSON file.  Where every
merge makes the next id (as in files that were trained in one go), the ids are
also the merge ranks, and tiktoken encodes with them; its ids are those of the
tokenizers library (tests compare them).  Special strings are plain text.
"""

from __future__ import annotations

import json
from functools import cache

import numpy as np

from annomart.llm import arrays as A
from annomart.llm.op8_tokens import byte_symbols

#: fixed value: the public pre-tokeniser pattern of byte-level BPE files
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class ByteBPE:
    """``encode(text) -> ids`` and ``token_bytes[id]``."""

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec["pre_tokenizer"]
        if spec["normalizer"] or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or not pre["use_regex"]:
            raise ValueError(f"unsupported tokenizer layout: {spec['normalizer']}, {pre}")
        vocab, added = spec["model"]["vocab"], {t["content"] for t in spec["added_tokens"]}
        merged = [vocab["".join(m) if isinstance(m, list) else m.replace(" ", "")] for m in spec["model"]["merges"]]
        if merged != sorted(merged):
            raise ValueError("ids do not follow the order of the merges")
        byte = {s: b for b, s in enumerate(byte_symbols())}
        ranks = {bytes(byte[c] for c in t): i for t, i in vocab.items() if t not in added}
        self.token_bytes = [b""] * (1 + max(ranks.values()))
        for t, i in ranks.items():
            self.token_bytes[i] = t
        self.token_size = np.array([len(t) for t in self.token_bytes])
        self.encode = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def encode_units(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all units, ids of each).  Units that start with white space
        and end with a visible character are encoded as one text, which cuts
        into the same ids; the others one by one."""
        n = np.zeros(len(units), np.int64)
        plain = [i for i, u in enumerate(units) if u[0] in " \n\t\r\x0b\x0c" and u[-1] != " " and u[-1].isprintable()]
        ids = np.array(self.encode("".join([units[i] for i in plain])), np.int64)
        end = np.cumsum([len(units[i].encode()) for i in plain]) if plain else n[:0]
        n[plain] = np.bincount(np.searchsorted(end, np.cumsum(self.token_size[ids])), minlength=len(plain))
        rest = np.setdiff1d(np.arange(len(units)), plain)
        if not len(rest):
            return ids, n
        own = [self.encode(units[i]) for i in rest]
        n[rest] = list(map(len, own))
        out, at = np.empty(int(n.sum()), np.int64), np.cumsum(n) - n
        out[A.ragged(at[plain], n[plain])] = ids
        out[A.ragged(at[rest], n[rest])] = [i for x in own for i in x]
        return out, n


@cache
def byte_bpe(path: str) -> ByteBPE:
    return ByteBPE(path)
