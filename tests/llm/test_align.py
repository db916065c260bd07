"""Op 13 against whole-text encodings and a brute-force alignment."""
import collections
import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest

from annomart.llm import op13_align as T
from annomart.llm.byte_bpe import byte_bpe

from .data import awkward, frame

PATH_A, PATH_B = str(P.path("byte_bpe_50k.json")), str(P.path("piece_bpe_32k.model"))
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    import sentencepiece
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_file(PATH_A), sentencepiece.SentencePieceProcessor(model_file=PATH_B)
    a.encode_special_tokens = True
    from annomart.llm.op8_tokens import byte_symbols
    byte = {s: i for i, s in enumerate(byte_symbols())}

    def tokens(text):
        """[(id, end)] of both tokenizers, or None."""
        if not text:
            return None
        full = (" " + text).encode()
        ia = a.encode(" " + text, add_special_tokens=False).ids
        ib = b.encode(text)
        ba = [bytes(byte[c] for c in a.id_to_token(i)) for i in ia]
        bb = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ib]
        if b"".join(ba) != full or b"".join(bb) != full:
            return None
        return [list(zip(i, np.cumsum(list(map(len, x))).tolist())) for i, x in ((ia, ba), (ib, bb))]

    return tokens


def groups_of(tokens):
    a, b = tokens
    cuts = sorted({e for _, e in a} & {e for _, e in b})
    out, lo = [], 0
    for c in cuts:
        out.append(([i for i, e in a if lo < e <= c], [i for i, e in b if lo < e <= c]))
        lo = c
    return out


def brute(rows, tokens):
    every = [groups_of(t) if (t := tokens(x)) else [] for _, x in rows]
    links = [collections.Counter((i, j) for a, b in g for i in a for j in b) for g in every]
    count = collections.Counter(p for x in links for p in x)
    best = collections.defaultdict(int)
    for (i, _), n in count.items():
        best[i] = max(best[i], n)
    out = []
    for (d, _), g, x in zip(rows, every, links):
        text = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in g)
        out.append((d, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), sum(x.values()),
                    sum(n for p, n in x.items() if count[p] == best[p[0]]), sum(n * count[p] for p, n in x.items()),
                    hashlib.sha256(text.encode()).hexdigest() if g else ""))
    return out, count, best


EXTRA = ["a  b\n c  ", " lead", "tab\there \t x", "no break space  here", "wide　 gap   x  y", "▁ x", "a▁b", "x\x00y z",
         "<|endoftext|> <s> </s> <unk>", "\x1c \x1f a", "😀😀 😀a 中文字 中 文", "don't we'll 12,345.67", "\n\n \n", " ", "   ", "\r\n};\r\n x();\r", "é ́x", "​ z"]
RANK = lambda r: (r[0] is None, r[0] or 0, r[1:])


@pytest.mark.parametrize("part_bytes, chunk_bytes", [(1 << 16, 1 << 20), (64, 3000), (300, 1)])
def test_equals_brute_force(spark, library, part_bytes, chunk_bytes):
    rows = awkward(5, n=30, long=150) + [(300 + i, t) for i, t in enumerate(EXTRA)] + [(400, "abc" * 3000), (401, "ein wort " * 2000 + "中文" * 400)]
    out, pairs = T.align(frame(spark, rows), PATH_A, PATH_B, part_bytes=part_bytes, slack=40, chunk_bytes=chunk_bytes)
    want, count, best = brute(rows, library)
    assert sorted(map(tuple, out.collect()), key=RANK) == sorted(want, key=RANK)
    assert sorted(map(tuple, pairs.collect())) == sorted((a, b, n, n == best[a]) for (a, b), n in count.items())


def test_empty_table(spark):
    out, pairs = T.align(frame(spark, []).limit(0), PATH_A, PATH_B)
    assert out.count() == 0 and pairs.count() == 0
    assert [r.groups_sha256 for r in T.align(frame(spark, [(1, None)]), PATH_A, PATH_B)[0].collect()] == [""]


def test_monoid(library):
    """Fragments of any byte ranges, composed in any order, give the whole document."""
    r = random.Random(3)
    texts = ["The quick brown föx jumps 中文字 over 1234567 dogs; don't stop! " * 3, "😀 a  b\n\nxx" * 9, "abcabc" * 40]
    for text in texts:
        a, b = library(text)
        want = groups_of((a, b))
        ia, ea, ib, eb = (np.array(x) for x in (*zip(*a), *zip(*b)))
        for _ in range(30):
            end = int(ea[-1])
            cuts = sorted({0, end, *r.sample(range(1, end), r.randint(0, min(20, end - 1)))})
            parts = []
            for lo, hi in zip(cuts, cuts[1:]):
                ka, kb = (ea > lo) & (ea <= hi), (eb > lo) & (eb <= hi)
                parts.append(T.fragment(ia[ka], ea[ka], ib[kb], eb[kb]))
            while len(parts) > 1:                                # any neighbours first
                i = r.randrange(len(parts) - 1)
                parts[i:i + 2] = [T.compose(*parts[i:i + 2])]
            f = T.whole(parts[0])
            assert f.text == "".join(f"{','.join(map(str, x))}|{','.join(map(str, y))};" for x, y in want).encode()
            assert (f.n_a, f.n_b, f.n_groups, f.n_links) == (len(a), len(b), len(want), sum(len(x) * len(y) for x, y in want))
            assert not len(f.tail[0]) and not len(f.tail[1]) and not len(f.head[0])
            pairs = collections.Counter(i << 32 | j for x, y in want for i in x for j in y)
            assert dict(zip(f.keys.tolist(), f.times.tolist())) == pairs


def test_byte_bpe_is_the_library(library):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(PATH_A)
    t.encode_special_tokens = True
    enc = byte_bpe(PATH_A)
    for s in [x for _, x in awkward(2) if x] + EXTRA:
        assert enc.encode(s) == t.encode(s, add_special_tokens=False).ids


def test_query(spark, library):
    got = sorted(map(tuple, T.op13_align_tokenizers(spark, SF).collect()), key=RANK)
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert got == sorted(brute(rows, library)[0], key=RANK)
