"""Ops 6, 9 and 10 against brute force."""
import datetime as dt
import random
import textwrap

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from annomart.llm import arrays as A
from annomart.llm import op9_decontam
from annomart.llm.op6_urls import BASE, LEVELS, day_blocks, url_filter, validity_pieces
from annomart.llm.op9_decontam import KEEP, Index, contamination, decontaminate
from annomart.llm.op10_licenses import RULES, SENTENCES, license_scan, op10_sql

from .data import EXTRA, awkward, frame

T0 = dt.datetime(2024, 3, 1)


def keys_of(url):
    if url is None or "://" not in url:
        return []
    rest = url.lower().split("://", 1)[1]
    host, _, path = rest.partition("/")
    parts = host.split(".")
    seg = path.split("?")[0].split("#")[0].split("/")[0]
    return list({host, *(".".join(parts[-k:]) for k in range(2, len(parts) + 1)), *([f"{host}/{seg}"] if seg else [])})


def test_url_filter(spark):
    r = random.Random(4)
    hosts = ["a.example.org", "b.example.org", "example.org", "x.y.example.com", "solo"]
    urls = [f"https://{h}{p}" for h in hosts for p in ("", "/en/1", "/fr?x=1", "/")] + [None, "no url", ""]
    listed = ["a.example.org", "example.org", "example.com", "b.example.org/en", "solo", "x.y.example.com", None]
    at = lambda: T0 + dt.timedelta(hours=r.randrange(0, 24 * 12))
    edits = [(r.choice(listed), r.choice(["block", "block", "allow"]), r.random() < .6, at() if r.random() < .97 else None) for _ in range(150)]
    caps = [(i, r.choice(urls), at() if r.random() < .95 else None, 7) for i in range(400)] + [(5, urls[0], T0, 7)] * 3
    e = spark.createDataFrame(edits, "key string, list string, added boolean, ts timestamp")
    c = spark.createDataFrame(caps, "page_id bigint, url string, fetched timestamp, kept bigint")
    state = {}
    for k, l, added, ts in edits:
        if k is not None and ts is not None:
            state[k, l, ts] = state.get((k, l, ts), False) or added
    want = []
    for i, u, ts, _ in caps:
        n = {"block": 0, "allow": 0}
        for k in keys_of(u) if ts else []:
            for l in n:
                past = [(t, a) for (kk, ll, t), a in state.items() if (kk, ll) == (k, l) and t <= ts]
                n[l] += bool(past) and max(past)[1]
        want.append((i, u or "", n["block"], n["allow"], n["allow"] > 0 or n["block"] == 0))
    out = url_filter(c, e)
    got = [(x.page_id, x.url or "", x.n_block, x.n_allow, x.kept) for x in out.collect()]
    assert sorted(got) == sorted(want) and len({w[4] for w in want}) == 2
    assert out.columns == ["page_id", "url", "fetched", "n_block", "n_allow", "kept"]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Cartesian" not in plan
    assert url_filter(c.limit(0), e).count() == 0
    assert all(x.kept for x in url_filter(c, e.limit(0)).collect())
    # pieces of a key and list never overlap
    p = validity_pieces(e).collect()
    for a in p:
        assert sum((b.key, b.list, b.level, b.block) == (a.key, a.list, a.level, a.block) and b.valid_from <= a.valid_from and
                   (b.valid_to is None or a.valid_from < b.valid_to) for b in p) == 1


def distance(a, b):
    """Edits between ``a`` and its best place in ``b``."""
    row = [0] * (len(b) + 1)
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j - 1] + (x != y), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def reduced(t):
    return bytes(A.LOWER[b] for b in (t or "").encode() if KEEP[b])


def test_q_gram_lemma_misses_nothing():
    r = random.Random(7)
    letters = "abcdefghij"
    items = [(i, "".join(r.choice(letters) for _ in range(r.choice([10, 40, 90, 160, 240])))) for i in range(12)]
    index, found, near = Index(items), 0, 0
    for n in range(150):
        i, t = r.choice(items)
        s, k = list(t), int(index.edits[index.ids.index(i)])
        for _ in range(r.randint(0, 2 * k + 1)):
            p = r.randrange(len(s))
            s[p:p + r.randint(0, 1)] = r.choice(["", "z", "y"])
        doc = "".join(r.choice(letters) for _ in range(r.randint(0, 200))) + "".join(s) + "".join(r.choice(letters) for _ in range(r.randint(0, 200)))
        got = {index.ids[h[1]]: h for h in index.scan(*A.text_buffer(pa.array(["", doc, "x"])))}
        d = distance(t, doc)
        assert (i in got) == (d <= k)
        if i in got:
            _, _, edits, start, end = got[i]
            assert edits == d and distance(doc[start:end], t) <= d <= k
            found += 1
        near += d > k
    assert found > 50 and near > 20


def test_contamination(spark):
    r = random.Random(9)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(r.randint(2, 8)))
    bench = [(i, " ".join(word() for _ in range(30)).capitalize() + ".") for i in range(5)] + [(5, None), (6, ""), (7, "..."), (None, "null id here too"), (8, "tiny")]
    rows = awkward(9, n=30)
    rows += [(300, "Before. " + bench[0][1].upper() + " after"), (301, bench[1][1].replace(" ", "\n  ") + " x " + bench[2][1]),
             (302, bench[3][1][:100]), (None, "y " + bench[4][1]), (303, "T.i-n y")]
    b = spark.createDataFrame(bench, "item_id bigint, text string")
    df = frame(spark, rows)
    got = {(x.doc_id, x.item_id, x.n_edits) for x in contamination(df, b).collect()}
    assert got == {(300, 0, 0), (301, 1, 0), (301, 2, 0), (None, 4, 0), (303, 8, 0)}
    spans = contamination(df, b).filter("doc_id = 300").first()
    assert rows[-5][1].encode()[spans.start_byte:spans.end_byte].decode().lower() == bench[0][1].rstrip(".").lower()
    # the same in many blocks of items
    many = {(x.doc_id, x.item_id, x.n_edits) for x in contamination(df, b, block_bytes=400).collect()}
    assert many == got
    clean = decontaminate(df, b)
    assert clean.columns == df.columns and clean.count() == len(rows) - 4
    assert contamination(df, b.limit(0)).count() == 0 and decontaminate(df.limit(0), b).count() == 0


def test_license_scan(spark):
    cap = lambda k: SENTENCES[k].capitalize()
    wrapped = cap("MitGrant").replace(" ", "\n", 3)
    cases = [
        (1, "Some text.\nReleased under the MIT License.\nMore", "MitRef", "MIT", 0),
        (2, f"Copyright (c) 2020 X\n\n{wrapped}:\n\n{cap('MitNotice')}.\n\n{cap('MitAsIs')}.", "MitGrant,MitNotice,MitAsIs", "MIT", 0),
        (3, f"{cap('BsdGrant')}: {cap('BsdSource')}. {cap('BsdBinary')}.", "BsdGrant,BsdSource,BsdBinary", "BSD-2-Clause", 0),
        (4, "Licensed under the Apache License, Version 2.0. Released under the MIT license.", "ApacheRef,MitRef", "MIT,Apache-2.0", 0),
        (5, f"{cap('GplSeeCopy')}.", "GplSeeCopy", "", 1),
        (6, "This is not licensed under the MIT license at all.", "", "", 0),
        (7, None, "", "", 0), (8, "", "", "", 0), (None, "Licensed under CC BY-NC 4.0.", "CcByNc4", "CC-BY-NC-4.0", 0),
        (9, "word " * 20000 + "end.\n" + "ALL RIGHTS RESERVED!", "AllRights", "All-Rights-Reserved", 0),
    ]
    out = license_scan(frame(spark, [(d, t) for d, t, *_ in cases]))
    got = sorted(((r.doc_id or 0, ",".join(r.sentence_ids), ",".join(r.licenses), r.n_unmatched) for r in out.collect()))
    assert got == sorted((d or 0, s, l, n) for d, _, s, l, n in cases)
    assert license_scan(frame(spark, []).limit(0)).count() == 0 and len(EXTRA) == 11


def test_license_scan_of_narrow_lines(spark):
    wrap = lambda k, width, lead="": "\n".join(lead + x for x in textwrap.wrap(SENTENCES[k].capitalize(), width, break_long_words=False))
    mit = ("MitGrant", "MitNotice", "MitAsIs")
    rows = [(i, ".\n\n".join(wrap(k, width, lead) for k in mit) + ".")
            for i, (width, lead) in enumerate([(72, ""), (60, " * "), (50, "# "), (20, "// "), (1, "")])]
    assert wrap("MitGrant", 50).count("\n") > 6
    out = license_scan(frame(spark, rows)).collect()
    assert sorted((r.doc_id, tuple(r.sentence_ids), tuple(r.licenses), r.n_unmatched) for r in out) == [(i, mit, ("MIT",), 0) for i, _ in rows]


def test_pieces_do_not_grow_with_dates(spark):
    """One edit that stays, and captures at outlier dates: a logarithmic number of pieces."""
    e = spark.createDataFrame([("h.org", "block", True, dt.datetime(2024, 3, 1, 12))], "key string, list string, added boolean, ts timestamp")
    assert validity_pieces(e).count() <= 2 * (BASE - 1) * LEVELS
    days = [dt.datetime(2024, 3, 1, 11), dt.datetime(2024, 3, 1, 13), dt.datetime(2024, 3, 2), dt.datetime(9999, 12, 30), dt.datetime(1, 1, 2),
            dt.datetime(2031, 7, 5, 3), dt.datetime(1969, 12, 31)]
    c = spark.createDataFrame([(i, "https://h.org/x", d) for i, d in enumerate(days)], "page_id bigint, url string, fetched timestamp")
    assert {r.page_id: r.n_block for r in url_filter(c, e).collect()} == {0: 0, 1: 1, 2: 1, 3: 1, 4: 0, 5: 1, 6: 0}


def test_day_blocks_cover_exactly(spark):
    r = random.Random(2)
    spans = [(a, a + r.choice([0, 1, 2, 15, 16, 17, 300, 5000, 70000])) for a in (r.randrange(1 << 20) for _ in range(60))] + [(0, 1 << 12), (16, 32)]
    df = spark.createDataFrame(spans, "a bigint, b bigint")
    for x in df.select("a", "b", day_blocks(F.col("a"), F.col("b")).alias("p")).collect():
        days = sorted(d for k, n in x.p for d in range(n * BASE ** k, (n + 1) * BASE ** k))
        assert days == list(range(x.a, x.b)) and len(x.p) <= 2 * (BASE - 1) * LEVELS


def test_repetitive_texts_in_bounded_memory():
    import tracemalloc

    item = "a" * 400
    index = Index([(1, item), (2, "ab" * 90), (3, "xyz")])
    text = lambda t: (np.frombuffer(t.encode(), np.uint8), np.array([0, len(t)]))
    found = {}
    for n in (1 << 13, 1 << 15):
        tracemalloc.start()
        hits = index.scan(*text("a" * n))
        found[n] = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert hits and {h[1] for h in hits} == {0}
    assert found[1 << 15] < 400e6 and found[1 << 15] < 3 * found[1 << 13] + 1e8


def test_expanding_in_steps_changes_nothing(monkeypatch):
    r = random.Random(3)
    items = [(i, "".join(r.choice("abc ") for _ in range(r.randint(20, 300)))) for i in range(12)]
    texts = ["".join(r.choice("abc ") for _ in range(500)) + r.choice(items)[1] * r.randint(0, 3) + "zz" for _ in range(25)] + ["", "aaaa" * 300]
    buf = np.frombuffer("".join(texts).encode(), np.uint8)
    offs = np.cumsum([0] + [len(t) for t in texts])
    want = Index(items).scan(buf, offs)
    assert want
    for pairs in (1, 100, 5000):
        monkeypatch.setattr(op9_decontam, "PAIRS", pairs)
        assert Index(items).scan(buf, offs) == want


def test_nested_sentences_and_more_licenses(spark):
    cap = lambda k: SENTENCES[k].capitalize()
    cases = [
        (1, "This work is\nlicensed under the GNU General Public License version 3", "Gpl3Work", "GPL-3.0-only"),
        (2, "Licensed under the GNU Lesser General Public License version 2.1", "TagLGPL21only1", "LGPL-2.1-only"),
        (3, "// SPDX-License-Identifier: MIT", "", "MIT"), (4, "# SPDX-License-Identifier: LGPL-3.0-or-later\nx", "", "LGPL-3.0-or-later"),
        (5, f"{cap('MplForm')}. {cap('MplCopy')}.", "MplForm,MplCopy", "MPL-2.0"),
        (6, f"{cap('IscGrant')}.\n\n{cap('IscAsIs')}.", "IscGrant,IscAsIs", "ISC"),
        (7, f"{cap('BsdGrant')}: {cap('BsdSource')}. {cap('BsdBinary')}. {cap('BsdEndorse')}.\n{cap('BsdAsIs')}.",
         "BsdGrant,BsdSource,BsdBinary,BsdEndorse,BsdAsIs", "BSD-3-Clause"),
        (8, f"{cap('Gpl2Free')}.\n{cap('GplNoWarranty')}.\n{cap('GplSeeCopy')}.", "Gpl2Free,GplNoWarranty,GplSeeCopy", "GPL-2.0-or-later"),
        (9, "Licensed under the Apache License, Version 2.0 (the \"License\");", "ApacheHead", "Apache-2.0"),
        (10, "Released under the\nMIT License. Licensed under the MIT License", "MitRef,MitRef2", "MIT"),
    ]
    for r in license_scan(frame(spark, [(d, t) for d, t, *_ in cases])).collect():
        _, _, ids, lic = cases[r.doc_id - 1]
        assert ",".join(r.licenses) == lic and r.n_unmatched == 0 and (not ids or ",".join(r.sentence_ids) == ids), r
    assert len(SENTENCES) > 100 and len(set(SENTENCES.values())) == len(SENTENCES) and {x for _, run in RULES for x in run} <= set(SENTENCES)


def test_license_sql_agrees_on_wrapped_and_nested_sentences(spark):
    import duckdb

    wrap = lambda k, w: "\n".join(textwrap.wrap(SENTENCES[k].capitalize(), w))
    rows = [(i, f"{wrap('MitGrant', w)}:\n{wrap('MitNotice', w)}.\n{wrap('Gpl3Work', w)}. x") for i, w in enumerate((200, 72, 50, 20, 8))]
    rows += [(20, None), (21, ""), (22, "licensed under\nthis work is\nlicensed under the GNU General Public License version 3\nlicensed under cc by\n4 0")]
    docs = duckdb.connect()
    docs.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    docs.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    want = sorted(docs.execute(op10_sql()).fetchall())
    out = license_scan(frame(spark, rows))
    got = sorted((r.doc_id, ",".join(r.sentence_ids), ",".join(r.licenses), bool(r.licenses), r.n_unmatched) for r in out.collect())
    assert got == want
