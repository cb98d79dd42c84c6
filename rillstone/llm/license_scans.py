"""License scans: MinHash bands retrieve templates for overlapping windows, exact shingle containment verifies them.

A text holds a template where a stretch of one and a half times its shingles, starting at any word, contains four fifths of
them. Windows are twice as long as the template and start every half of it, so every such stretch lies whole in a window. A
window around one has at least 0.36 of the union in common with the template; with ``BANDS`` bands of one value each it is
missed with probability below 0.64 ** 48, under one in 10 ** 9. In a window that agrees in a band every stretch is counted.

A window can agree with a template in a band only if it holds the very shingle that is the template's least in this band.
So only windows around such shingles are hashed; all others are known to agree in no band.

Templates may be alike, as versions of one notice are. Of stretches that overlap the one that holds the larger part of its
template counts, then the one with more shingles; what is equal in both counts together.

Only DataFrame functions are used, and nothing is shuffled. Templates are one literal table of at most ``MOST`` rows.
"""

from __future__ import annotations

import json
import re

import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rillstone.llm.common import table, with_fixed

SHINGLE = 5
BANDS = 48
CONTAINED = 80  # percent
MOST = 1000  # templates

# Notices by which texts name their license.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-or-later", "it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0-or-later", "it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-NC-SA-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License."),
    ("CC-BY-ND-4.0", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("Apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-2.1-or-later", "it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("LGPL-3.0-or-later", "it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("AGPL-3.0-or-later", "it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("BSL-1.0", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software"),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at"),
    ("CDDL-1.0", "The contents of this file are subject to the terms of the Common Development and Distribution License (the \"License\"). You may not use this file except in compliance with the License."),
    ("WTFPL", "Everyone is permitted to copy and distribute verbatim or modified copies of this license document, and changing it is allowed as long as the name is changed."),
    ("OFL-1.1", "This Font Software is licensed under the SIL Open Font License, Version 1.1."),
)

_SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def template_words(text: str) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.lower())


def shingles(words: list[str]) -> list[str]:
    return [" ".join(words[i : i + SHINGLE]) for i in range(len(words) - SHINGLE + 1)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def shingle_hash(shingle: str) -> int:
    return _signed(xxhash.xxh64_intdigest(shingle.encode(), seed=42))


def band_value(h: int, band: int) -> int:
    """The hash of a shingle hash for a band: Spark's xxhash64 of the long and the band as an int."""
    first = xxhash.xxh64_intdigest(h.to_bytes(8, "little", signed=True), seed=42)
    return _signed(xxhash.xxh64_intdigest(band.to_bytes(4, "little"), seed=first))


class Template:
    def __init__(self, name: str, text: str):
        self.name = name
        self.shingles = sorted(set(shingles(template_words(text))))
        if not self.shingles:
            raise ValueError(f"a template needs {SHINGLE} words: {text}")
        hashes = [shingle_hash(s) for s in self.shingles]
        least = [min((band_value(h, b), h) for h in hashes) for b in range(BANDS)]
        self.bands, self.keys = [v for v, _ in least], {h for _, h in least}
        self.first = {s.split(" ")[0] for s, h in zip(self.shingles, hashes) if h in self.keys}
        self.least = -(-CONTAINED * len(self.shingles) // 100)
        self.stretch = len(self.shingles) + len(self.shingles) // 2
        self.window, self.stride = window_of(len(self.shingles))

    def row(self) -> dict:
        return {
            "license": self.name, "n": len(self.shingles), "least": self.least, "stretch": self.stretch, "win": self.window,
            "stride": self.stride, "bands": self.bands, "keys": sorted(self.keys), "grams": self.shingles,
        }


_ROWS = (
    "array<struct<license: string, n: int, least: int, stretch: int, win: int, stride: int, bands: array<bigint>, keys: array<bigint>, "
    "grams: array<string>>>"
)


def window_of(n: int) -> tuple[int, int]:
    """(shingles of a window, shingles between starts) for a template of ``n`` shingles."""
    stride = max(1, n // 2)
    return n + n // 2 + stride, stride


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), _SEPARATOR), "")


def _shingle(words: Column, at: Column) -> Column:
    """The shingle that begins at a word, counted from 0; null where there are too few words."""
    return F.when(at + SHINGLE <= F.size(words), F.concat_ws(" ", *[F.get(words, at + k) for k in range(SHINGLE)]))


def _key_shingles(words: Column, keys: list[int], first: list[str]) -> Column:
    """Structs (at, h) of the shingles that are the least of some template in some band; others are not even hashed."""
    hashed = F.transform(words, lambda w, i: F.when(w.isin(first), F.struct(i.alias("at"), F.xxhash64(_shingle(words, i)).alias("h"))))
    return F.filter(hashed, lambda x: x["h"].isin(keys))


def _stretches(t: Column, words: Column, spots: Column) -> Column:
    """Structs of all stretches of a text that hold the template ``t``."""
    shingles_in = F.greatest(F.size(words) - SHINGLE + 1, F.lit(0))
    last = F.floor(F.greatest(shingles_in - t["win"] + t["stride"] - 1, F.lit(0)) / t["stride"]).cast("int")
    own = F.filter(spots, lambda x: F.array_contains(t["keys"], x["h"]))
    numbers = F.array_distinct(
        F.flatten(
            F.transform(
                own,
                lambda x: F.sequence(
                    F.least(F.greatest(F.ceil((x["at"] - t["win"] + 1) / t["stride"]).cast("int"), F.lit(0)), last),
                    F.least(F.floor(x["at"] / t["stride"]).cast("int"), last),
                ),
            )
        )
    )
    grams = F.transform(
        numbers,
        lambda k: F.transform(
            F.sequence(k * t["stride"], F.least(k * t["stride"] + t["win"], shingles_in) - 1),
            lambda i: F.struct(i.alias("at"), _shingle(words, i).alias("gram")),
        ),
    )

    def agrees(window: Column) -> Column:
        bands = F.arrays_zip(F.sequence(F.lit(0), F.lit(BANDS - 1)).alias("b"), t["bands"].alias("v"))
        return _let(
            F.transform(window, lambda x: F.xxhash64(x["gram"])),
            lambda hashes: F.exists(bands, lambda x: F.array_min(F.transform(hashes, lambda h: F.xxhash64(h, x["b"]))) == x["v"]),
        )

    def counted(window: Column) -> Column:
        def from_each(hits: Column) -> Column:
            return F.transform(
                hits,
                lambda p: _let(
                    F.filter(hits, lambda y: (y["at"] >= p["at"]) & (y["at"] < p["at"] + t["stretch"])),
                    lambda inside: F.struct(
                        p["at"].alias("first_word"), F.size(F.array_distinct(F.transform(inside, lambda y: y["gram"]))).alias("found"),
                        (F.array_max(F.transform(inside, lambda y: y["at"])) + SHINGLE).alias("stop"),
                    ),
                ),
            )

        return _let(F.filter(window, lambda x: F.array_contains(t["grams"], x["gram"])), from_each)

    every = F.flatten(F.transform(F.filter(grams, agrees), counted))
    enough = F.filter(every, lambda x: x["found"] >= t["least"])
    # A stretch that a window cuts off is counted whole in another window.
    whole = _let(
        enough,
        lambda e: F.filter(
            e, lambda x: ~F.exists(e, lambda y: (y["first_word"] == x["first_word"]) & (F.struct(y["found"], y["stop"]) > F.struct(x["found"], x["stop"])))
        ),
    )
    return F.transform(
        F.array_distinct(whole),
        lambda x: F.struct(
            t["license"].alias("license"), x["first_word"].alias("first_word"), (x["stop"] - x["first_word"]).alias("words"),
            F.floor(100 * x["found"] / t["n"]).cast("int").alias("percent"), x["found"].alias("found"), t["n"].alias("of"),
        ),
    )


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _unbeaten(found: Column) -> Column:
    """The stretches that no overlapping one of another license holds more of its template than."""

    def better(x: Column, y: Column) -> Column:
        overlap = (x["first_word"] < y["first_word"] + y["words"]) & (y["first_word"] < x["first_word"] + x["words"])
        own, other = x["found"] * y["of"], y["found"] * x["of"]
        return overlap & (x["license"] != y["license"]) & ((other > own) | (other == own) & (y["found"] > x["found"]))

    return _let(found, lambda f: F.filter(f, lambda x: ~F.exists(f, lambda y: better(x, y))))


MATCH = "array<struct<license: string, first_word: int, words: int, percent: int, found: int, of: int>>"


def find_licenses(docs: DataFrame, templates=TEMPLATES, text: str = "text") -> DataFrame:
    """``docs`` with ``n_words``, ``matches`` (stretches that hold a template), ``n_licenses`` and ``licenses`` (names, comma-joined).

    A template is held where one and a half times its length contains at least four fifths of its five-word shingles, and
    no other license that overlaps is held better; names that tie are all listed. Null and empty texts, and texts under
    five words, match nothing. Texts are read whole, repeated rows are treated alike, columns that already have one of the
    new names are replaced, and an empty table gives an empty one. More than ``MOST`` templates are refused.
    """
    known = [Template(name, notice) for name, notice in templates]
    if len(known) > MOST:
        raise ValueError(f"at most {MOST} templates")
    listed = F.from_json(F.lit(json.dumps([t.row() for t in known])), _ROWS)
    keys, first = (sorted(set().union(*(getattr(t, c) for t in known))) for c in ("keys", "first"))
    out = with_fixed(docs.drop("_words", "_spots"), "_words", words_of(F.col(text)))
    out = with_fixed(out, "_spots", _key_shingles(F.col("_words"), keys, first))
    words, spots = F.col("_words"), F.col("_spots")
    near = F.filter(listed, lambda t: F.exists(spots, lambda x: F.array_contains(t["keys"], x["h"])))
    found = F.flatten(F.transform(near, lambda t: _stretches(t, words, spots)))
    matches = F.when(F.size(spots) > 0, F.array_sort(_unbeaten(found))).otherwise(F.array().cast(MATCH))
    out = out.withColumn("matches", matches)
    names = F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["license"])))
    out = out.withColumns({"n_words": F.size(words).cast("bigint"), "n_licenses": F.size(names).cast("bigint"), "licenses": F.array_join(names, ",")})
    return out.drop("_words", "_spots")


def op10_minhash_licenses(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return find_licenses(docs).select("doc_id", "n_words", "n_licenses", "licenses")


def _sql() -> str:
    """Every stretch from every shingle of a template on; there are no windows."""
    rows = []
    for k, (name, notice) in enumerate(TEMPLATES):
        own = sorted(set(shingles(template_words(notice))))
        listed = ", ".join(f"'{s}'" for s in own)
        rows.append(f"({k}, '{name}', {len(own)}, {len(own) + len(own) // 2}, {-(-CONTAINED * len(own) // 100)}, [{listed}])")
    return rf"""
WITH t(tid, license, size, wide, least, own) AS (VALUES {", ".join(rows)}),
parts AS (SELECT tid, license, size, wide, least, unnest(own) AS gram FROM t),
d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(lower(coalesce(text, '')), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
s AS (SELECT rid, unnest(range(1, len(w) - {SHINGLE - 2})) AS pos, unnest(list_transform(range(1, len(w) - {SHINGLE - 2}), lambda i: array_to_string(w[i:i + {SHINGLE - 1}], ' '))) AS gram FROM d),
hits AS MATERIALIZED (SELECT rid, pos, s.gram, tid, license, size, wide, least FROM s JOIN parts ON parts.gram = s.gram),
stretches AS MATERIALIZED (SELECT a.rid, a.tid, a.license, a.size, a.pos AS start, max(b.pos) + {SHINGLE} AS stop, count(DISTINCT b.gram) AS n
    FROM hits a JOIN hits b ON b.rid = a.rid AND b.tid = a.tid AND b.pos BETWEEN a.pos AND a.pos + a.wide - 1
    GROUP BY a.rid, a.tid, a.license, a.size, a.pos, a.least HAVING count(DISTINCT b.gram) >= a.least),
found AS (SELECT DISTINCT rid, license FROM stretches x WHERE NOT EXISTS (
    SELECT 1 FROM stretches y WHERE y.rid = x.rid AND y.license <> x.license AND x.start < y.stop AND y.start < x.stop
      AND (y.n * x.size > x.n * y.size OR y.n * x.size = x.n * y.size AND y.n > x.n))),
named AS (SELECT rid, count(*) AS n, string_agg(license, ',' ORDER BY license) AS names FROM found GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_licenses, coalesce(names, '') AS licenses FROM d LEFT JOIN named USING (rid)"""


QUERIES = {"op10_minhash_licenses": op10_minhash_licenses}
SQL = {"op10_minhash_licenses": _sql()}
