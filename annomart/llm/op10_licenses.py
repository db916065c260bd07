"""Op 10 - license scans by sentence rules.

A text is cut into units at line ends and at sentence punctuation followed by
white space; a unit is normalised to its ASCII letters and digits.  Units, or
runs of consecutive units (a sentence wrapped over any number of lines), that
equal a known sentence become that sentence's identifier; the longest run wins,
and the units it took start no other sentence.  The identifiers in
order form the text's sequence, on which the ordered rules work: a rule names
a run of identifiers, takes every occurrence out of the sequence and adds its
licence, so that longer grants come before the short notices they contain.

Edge cases: null or empty text has no unit and no licence; one row per input
row whatever the ids; very long texts are read whole, line by line.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Normalised sentences of public licence texts and notices.
SENTENCES = {
    "MitGrant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "MitNotice": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "MitAsIs": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "MitRef": "released under the mit license",
    "MitRef2": "licensed under the mit license",
    "MitName": "the mit license",
    "ApacheRef": "licensed under the apache license version 2 0",
    "ApacheHead": "licensed under the apache license version 2 0 the license",
    "ApacheNoUse": "you may not use this file except in compliance with the license",
    "ApacheCopyAt": "you may obtain a copy of the license at http www apache org licenses license 2 0",
    "ApacheAsIs": "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "Gpl3Work": "this work is licensed under the gnu general public license version 3",
    "Gpl3Ref": "licensed under the gnu general public license version 3",
    "GplFree": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "GplNoWarranty": "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "GplSeeCopy": "see the gnu general public license for more details",
    "BsdGrant": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "BsdSource": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "BsdBinary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "BsdEndorse": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "CcByNc4": "licensed under cc by nc 4 0",
    "CcBy4": "licensed under cc by 4 0",
    "CcBySa4": "licensed under cc by sa 4 0",
    "Cc0": "licensed under cc0 1 0 universal",
    "PublicDomain": "this work is in the public domain",
    "AllRights": "all rights reserved",
    "BsdAsIs": "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed",
    "Gpl2Free": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    "Gpl2Only": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license version 2 as published by the free software foundation",
    "Lgpl21Free": "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version",
    "Lgpl3Free": "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "LgplNoWarranty": "this library is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "LgplSeeCopy": "see the gnu lesser general public license for more details",
    "AgplFree": "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "AgplSeeCopy": "see the gnu affero general public license for more details",
    "MplForm": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "MplCopy": "if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0",
    "MplCopyS": "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org mpl 2 0",
    "IscGrant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "ZeroBsdGrant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
    "IscAsIs": "the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness",
    "Unlicense": "this is free and unencumbered software released into the public domain",
    "BoostRef": "distributed under the boost software license version 1 0",
    "ZlibAsIs": "this software is provided as is without any express or implied warranty",
    "ZlibGrant": "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions",
    "ApacheText": "subject to the terms and conditions of this license each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable copyright license to reproduce prepare derivative works of publicly display publicly perform sublicense and distribute the work and such derivative works in source or object form",
}
# SPDX identifiers of licences, and how notices name them.
NAMES = {
    "MIT": ["mit license"], "Apache-2.0": ["apache license 2 0", "apache license v2 0"], "ISC": ["isc license"], "0BSD": [],
    "BSD-2-Clause": ["bsd 2 clause license", "simplified bsd license"], "BSD-3-Clause": ["bsd 3 clause license", "new bsd license"],
    "GPL-2.0-only": ["gnu general public license version 2", "gpl version 2"], "GPL-2.0-or-later": [],
    "GPL-3.0-only": ["gpl version 3"], "GPL-3.0-or-later": [],
    "LGPL-2.1-only": ["gnu lesser general public license version 2 1"], "LGPL-2.1-or-later": [],
    "LGPL-3.0-only": ["gnu lesser general public license version 3"], "LGPL-3.0-or-later": [],
    "AGPL-3.0-only": ["gnu affero general public license version 3"], "AGPL-3.0-or-later": [],
    "MPL-2.0": ["mozilla public license version 2 0", "mozilla public license 2 0"], "EPL-2.0": ["eclipse public license 2 0"],
    "BSL-1.0": ["boost software license version 1 0"], "Zlib": ["zlib license"], "Unlicense": ["unlicense"], "CC0-1.0": [],
    "CC-BY-3.0": ["cc by 3 0"], "CC-BY-4.0": ["creative commons attribution 4 0 international license"],
    "CC-BY-SA-3.0": ["cc by sa 3 0"], "CC-BY-SA-4.0": ["creative commons attribution sharealike 4 0 international license"],
    "CC-BY-NC-4.0": ["creative commons attribution noncommercial 4 0 international license"],
    "CC-BY-ND-4.0": ["cc by nd 4 0"], "CC-BY-NC-SA-4.0": ["cc by nc sa 4 0"], "CC-BY-NC-ND-4.0": ["cc by nc nd 4 0"],
}
# Rules in order of application.
RULES = [
    ("MIT", ("MitGrant", "MitNotice", "MitAsIs")),
    ("MIT", ("MitGrant", "MitNotice")),
    ("Apache-2.0", ("ApacheHead", "ApacheNoUse", "ApacheCopyAt", "ApacheAsIs")),
    ("Apache-2.0", ("ApacheHead", "ApacheNoUse")),
    ("GPL-3.0-or-later", ("GplFree", "GplNoWarranty", "GplSeeCopy")),
    ("GPL-3.0-or-later", ("GplFree",)),
    ("GPL-2.0-or-later", ("Gpl2Free", "GplNoWarranty", "GplSeeCopy")),
    ("GPL-2.0-or-later", ("Gpl2Free",)),
    ("GPL-2.0-only", ("Gpl2Only", "GplNoWarranty", "GplSeeCopy")),
    ("GPL-2.0-only", ("Gpl2Only",)),
    ("LGPL-2.1-or-later", ("Lgpl21Free", "LgplNoWarranty", "LgplSeeCopy")),
    ("LGPL-2.1-or-later", ("Lgpl21Free",)),
    ("LGPL-3.0-or-later", ("Lgpl3Free", "LgplNoWarranty", "LgplSeeCopy")),
    ("LGPL-3.0-or-later", ("Lgpl3Free",)),
    ("AGPL-3.0-or-later", ("AgplFree", "GplNoWarranty", "AgplSeeCopy")),
    ("AGPL-3.0-or-later", ("AgplFree",)),
    ("MPL-2.0", ("MplForm", "MplCopy")), ("MPL-2.0", ("MplForm", "MplCopyS")), ("MPL-2.0", ("MplForm",)),
    ("ISC", ("IscGrant", "IscAsIs")), ("ISC", ("IscGrant",)),
    ("0BSD", ("ZeroBsdGrant", "IscAsIs")), ("0BSD", ("ZeroBsdGrant",)),
    ("Zlib", ("ZlibAsIs", "ZlibGrant")), ("Zlib", ("ZlibGrant",)),
    ("BSD-3-Clause", ("BsdGrant", "BsdSource", "BsdBinary", "BsdEndorse", "BsdAsIs")),
    ("BSD-3-Clause", ("BsdGrant", "BsdSource", "BsdBinary", "BsdEndorse")),
    ("BSD-2-Clause", ("BsdGrant", "BsdSource", "BsdBinary", "BsdAsIs")),
    ("BSD-2-Clause", ("BsdGrant", "BsdSource", "BsdBinary")),
    ("Unlicense", ("Unlicense",)), ("BSL-1.0", ("BoostRef",)), ("Apache-2.0", ("ApacheText",)),
    ("MIT", ("MitRef",)), ("MIT", ("MitRef2",)), ("MIT", ("MitName",)),
    ("Apache-2.0", ("ApacheRef",)), ("Apache-2.0", ("ApacheHead",)),
    ("GPL-3.0-only", ("Gpl3Work",)), ("GPL-3.0-only", ("Gpl3Ref",)),
    ("CC-BY-NC-4.0", ("CcByNc4",)), ("CC-BY-4.0", ("CcBy4",)), ("CC-BY-SA-4.0", ("CcBySa4",)),
    ("CC0-1.0", ("Cc0",)), ("Public-Domain", ("PublicDomain",)), ("All-Rights-Reserved", ("AllRights",)),
]

# the tag of each identifier, and its names after the usual verbs
for _id, _names in NAMES.items():
    _tag = re.sub("[^a-z0-9]+", " ", _id.lower())
    for _i, _text in enumerate([f"spdx license identifier {_tag}", *(f"{v} the {n}" for n in _names for v in ("licensed under", "released under",
                                                                                                         "distributed under")),
                                *(f"licensed under {n}" for n in _names if n.startswith("cc "))]):
        if _text not in SENTENCES.values():
            _key = f"Tag{re.sub('[^A-Za-z0-9]', '', _id)}{_i or ''}"
            SENTENCES[_key] = _text
            RULES.append((_id, (_key,)))

CUT = re.compile(r"[.!?;:]+[ \t\r]+|\n")
JUNK = re.compile(r"[^a-z0-9]+")


class Recogniser:
    def __init__(self, sentences: dict[str, str] = SENTENCES, rules=RULES):
        self.known = {v: k for k, v in sentences.items()}
        words = [v.split(" ") for v in self.known]
        self.prefixes = {" ".join(w[:i]) for w in words for i in range(1, len(w) + 1)}
        self.rules = rules

    def sentences(self, text: str) -> list[str]:
        """Identifiers in order; a unit belongs to one sentence at most, the longest that starts first."""
        units = [u for u in (JUNK.sub(" ", x.lower()).strip(" ") for x in CUT.split(text)) if u]
        out, free = [], 0
        for i, u in enumerate(units):
            if i < free or u not in self.prefixes:
                continue
            best, free = self.known.get(u), i + 1
            for j in range(i + 1, len(units)):                 # ends with the words of a known sentence
                u = f"{u} {units[j]}"
                if u not in self.prefixes:
                    break
                if u in self.known:
                    best, free = self.known[u], j + 1
            if best:
                out.append(best)
        return out

    def licenses(self, ids: list[str]) -> tuple[list[str], int]:
        """(licences by first rule, identifiers that no rule took)."""
        seq, found = "".join(f"<{x}>" for x in ids), []
        for name, run in self.rules:
            pattern = "".join(f"<{x}>" for x in run)
            if pattern in seq:
                seq = seq.replace(pattern, "")
                if name not in found:
                    found.append(name)
        return found, seq.count("<")


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 sentences: dict[str, str] = SENTENCES, rules=RULES) -> DataFrame:
    """(id, sentence_ids array<string>, licenses array<string>, n_unmatched bigint) per row."""
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches):
        r = Recogniser(sentences, rules)
        for b in batches:
            ids = [r.sentences(t or "") for t in b.column(1).to_pylist()]
            found = [r.licenses(x) for x in ids]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(ids, pa.list_(pa.string())), pa.array([f for f, _ in found], pa.list_(pa.string())),
                 pa.array([n for _, n in found], pa.int64())], ["id", "sentence_ids", "licenses", "n_unmatched"])

    kind = src.schema["id"].dataType.simpleString()
    return src.mapInArrow(run, f"id {kind}, sentence_ids array<string>, licenses array<string>, n_unmatched bigint"
                          ).withColumnRenamed("id", id_col)


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return license_scan(docs).select("doc_id", F.array_join("sentence_ids", ",").alias("sentence_ids"),
                                     F.array_join("licenses", ",").alias("licenses"),
                                     (F.size("licenses") > 0).alias("licensed"), "n_unmatched")


def op10_sql() -> str:
    """DuckDB SQL of the query, built from the same fixed values."""
    values = ", ".join(f"('{k}', '{v}')" for k, v in SENTENCES.items())
    units = "list_filter(list_transform(regexp_split_to_array(coalesce(text, ''), '[.!?;:]+[ \\t\\r]+|\\n'), " \
            "lambda x: trim(regexp_replace(lower(x), '[^a-z0-9]+', ' ', 'g'), ' ')), lambda x: x <> '')"
    # one level per rule keeps the text short
    steps, prev = [], "s0"
    for i, (name, run) in enumerate(RULES, 1):
        pattern = "".join(f"<{x}>" for x in run)
        steps.append(f"s{i} AS (SELECT doc_id, ids, CASE WHEN contains(seq, '{pattern}') AND NOT list_contains(found, '{name}') "
                     f"THEN list_append(found, '{name}') ELSE found END AS found, replace(seq, '{pattern}', '') AS seq FROM {prev})")
        prev = f"s{i}"
    longest = max(len(v.split(" ")) for v in SENTENCES.values())          # units of a sentence at most: each has a word
    return f"""
WITH RECURSIVE known(id, sentence) AS (VALUES {values}),
prefix AS (SELECT DISTINCT array_to_string(list_slice(w, 1, n), ' ') AS p FROM (SELECT string_split(sentence, ' ') AS w FROM known),
           range(1, {longest} + 1) t(n)),
u AS MATERIALIZED (SELECT doc_id, row_number() OVER () AS r, {units} AS u FROM documents),
starts AS (SELECT r, u, i FROM (SELECT r, u, unnest(range(1, len(u) + 1)) AS i FROM u) WHERE u[i] IN (SELECT p FROM prefix)),
runs AS (SELECT r, i, k, array_to_string(list_slice(u, i, i + k - 1), ' ') AS s
         FROM starts, range(1, {longest} + 1) n(k) WHERE i + k - 1 <= len(u)),
hit AS MATERIALIZED (SELECT r, i, arg_max(id, k) AS id, i + max(k) AS after FROM runs JOIN known ON s = sentence GROUP BY r, i),
taken AS (SELECT r, min(i) AS i, arg_min(id, i) AS id, arg_min(after, i) AS after FROM hit GROUP BY r
          UNION ALL SELECT h.r, min(h.i), arg_min(h.id, h.i), arg_min(h.after, h.i) FROM taken t JOIN hit h ON h.r = t.r AND h.i >= t.after GROUP BY h.r),
q AS (SELECT r, list(id ORDER BY i) AS ids FROM taken GROUP BY r),
s0 AS (SELECT doc_id, coalesce(ids, []) AS ids, CAST([] AS VARCHAR[]) AS found,
              coalesce(array_to_string(list_transform(ids, lambda x: '<' || x || '>'), ''), '') AS seq
       FROM u LEFT JOIN q USING (r)),
{', '.join(steps)}
SELECT doc_id, array_to_string(ids, ',') AS sentence_ids, array_to_string(found, ',') AS licenses, len(found) > 0 AS licensed,
       CAST(length(seq) - length(replace(seq, '<', '')) AS BIGINT) AS n_unmatched FROM {prev}
"""
