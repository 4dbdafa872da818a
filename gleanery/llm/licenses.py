"""License scans: MinHash bands over text windows find templates, exact shingles verify them."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import without

#: Templates, fixed values: short notices, and passages that open or make up licence texts.
TEMPLATES = {
    "mit-notice": "Released under the MIT License.",
    "mit-notice-licensed": "Licensed under the MIT License.",
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "gpl-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "cc-by-nc-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "cc-by-4.0-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "bsd-notice": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "mpl-2.0-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
                      "was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "apache-2.0-header": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
                         "compliance with the License. You may obtain a copy of the License at",
    "apache-2.0-disclaimer": "Unless required by applicable law or agreed to in writing, software distributed under the License is "
                             'distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or '
                             "implied. See the License for the specific language governing permissions and limitations under the "
                             "License.",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
                 'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
                 "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
                 "to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
                 "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "bsd-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
                 "following conditions are met:",
    "gpl-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                  "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
                  "option) any later version.",
    "unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, "
                 "use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any "
                 "purpose, commercial or non-commercial, and by any means.",
}

WORDS = 5  # words of a shingle
WINDOW = 8  # shingles of a window for long templates; a short template's window is one shingle
BANDS = 6  # MinHash bands of a window, of one row each
_LONG = 12  # a template with so many shingles is long
_HALF = WINDOW // 2
TOKEN = r"[\p{L}\p{N}]+(?:[.-][\p{L}\p{N}]+)*"


def tokens_of(text: str) -> list[str]:
    """A template's words, as TOKEN finds them (templates are ASCII)."""
    return re.findall(r"[A-Za-z0-9]+(?:[.-][A-Za-z0-9]+)*", text.lower())


def shingles_of(text: str) -> list[str]:
    words = tokens_of(text)
    return list(dict.fromkeys(" ".join(words[i:i + WORDS]) for i in range(max(0, len(words) - WORDS + 1))))


def _words(text: str) -> Column:
    return F.coalesce(F.regexp_extract_all(F.lower(F.col(text)), F.lit(TOKEN), F.lit(0)), F.array().cast("array<string>"))


def _places(n: Column, step: int = 1) -> Column:
    """1, 1 + step, ... up to n; empty where n is less than 1."""
    return F.when(n >= 1, F.sequence(F.lit(1), n, F.lit(step))).otherwise(F.array().cast("array<int>"))


def with_bands(docs: DataFrame, text: str) -> DataFrame:
    """docs, without the text, with _words, _h (a hash for each shingle) and _w0.._w5 (minima of each window).

    Windows of WINDOW shingles overlap by half: each is made of two neighbouring blocks, and its
    minimum is that of theirs, so that every shingle is hashed once for each band. The last
    windows are shorter. Steps are kept apart, so that arrays are made once.
    """
    kept = [F.col(c) for c in docs.columns if c != text]
    words = docs.select(*kept, _words(text).alias("_words"))
    places = _places(F.size("_words") - WORDS + 1)
    shingle = F.transform(places, lambda i: F.xxhash64(*[F.get("_words", i + k) for k in range(-1, WORDS - 1)]))
    hashed = words.select(*kept, "_words", shingle.alias("_h"))
    blocks = hashed.select(*kept, "_words", "_h", *[_blocks(b).alias(f"_b{b}") for b in range(BANDS)])
    return blocks.select(*kept, "_words", "_h", *[_windows(b).alias(f"_w{b}") for b in range(BANDS)])


def _windows(b: int) -> Column:
    """The smaller one of each two neighbouring blocks."""
    blocks = F.col(f"_b{b}")
    return F.zip_with(blocks, F.slice(blocks, 2, F.greatest(F.size(blocks), F.lit(1))), lambda x, y: F.least(x, y))


def _blocks(b: int) -> Column:
    """The smallest hash, in band b, of each block of half a window."""

    def block(start: Column) -> Column:
        return F.array_min(F.transform(F.slice("_h", start, _HALF), lambda x: F.xxhash64(x, F.lit(b))))

    return F.transform(_places(F.size("_h"), _HALF), block)


def template_bands(spark, templates: dict[str, str]) -> tuple[DataFrame, dict[int, list[str]], list[dict[int, list[str]]]]:
    """Templates as a table (license, shingles, n), and the hashes that lead to them.

    Short templates are found by the hash of any of their shingles, long ones by the minimum of
    any of their windows at any offset, in any band. All of this is as large as the templates.
    """
    rows = [(name, shingles_of(text)) for name, text in templates.items()]
    rows = [(name, s, len(s)) for name, s in rows if s]
    if not rows:
        raise ValueError("no template has as many words as a shingle")
    entries = [
        F.struct(F.lit(name).alias("license"), F.array(*map(F.lit, s)).alias("shingles"), F.lit(n).alias("n")) for name, s, n in rows
    ]
    table = spark.range(1).select(F.inline(F.array(*entries)))
    hashed = table.select(
        "license", "n", F.transform("shingles", lambda s: F.split(s, " ")).alias("w")
    ).withColumn("_h", F.transform("w", lambda w: F.xxhash64(*[F.get(w, F.lit(k)) for k in range(WORDS)])))

    def window(b: int) -> Column:
        def least(start: Column) -> Column:
            return F.array_min(F.transform(F.slice("_h", start, WINDOW), lambda x: F.xxhash64(x, F.lit(b))))

        return F.transform(F.sequence(F.lit(1), F.greatest(F.size("_h") - WINDOW + 1, F.lit(1))), least)

    short: dict[int, list[str]] = {}
    bands: list[dict[int, list[str]]] = [{} for _ in range(BANDS)]
    for row in hashed.select("license", "n", "_h", *[window(b).alias(f"_w{b}") for b in range(BANDS)]).collect():
        if row["n"] < _LONG:
            for h in row["_h"]:
                short.setdefault(h, []).append(row["license"])
            continue
        for b in range(BANDS):
            for h in set(row[f"_w{b}"]):
                bands[b].setdefault(h, []).append(row["license"])
    return table, short, bands


def _named(hashes: str, known: dict[int, list[str]]) -> Column:
    """Licences that any of the hashes of an array leads to."""
    none = F.array().cast("array<string>")
    if not known:
        return none
    names = F.create_map(*[F.lit(x) for h, v in known.items() for x in (h, F.array(*map(F.lit, v)))])
    hit = F.array_distinct(F.filter(hashes, lambda x: x.isin(*known)))
    return F.flatten(F.transform(hit, lambda x: F.try_element_at(names, x)))


def scan(docs: DataFrame, templates: dict[str, str] | None = None, least: float = 0.8, text: str = "text") -> DataFrame:
    """docs, without the text, with license, containment, n_found and n_shingles: a row per licence found.

    Every window of every document is looked up: short templates (fewer than 12 shingles) by each
    shingle, a window of five words, where a collision is certain; long ones by windows of 8
    shingles that overlap by half, in 6 bands of one row. A copy of a long template covers such a
    window whole, wherever it begins, and collides for certain; at a likeness of 0.6 between
    windows, all bands miss with a chance of 0.4 %, and a template has several windows. What is
    retrieved is verified by strings: containment is the share of the template's different
    shingles that occur in the document, and must be at least `least`.

    Words are letters and digits, lower case, joined by dots and hyphens; other signs and line
    breaks do not count. Null, empty and short texts have no shingles and give no row; repeated
    rows give repeated rows; long texts are scanned whole. Nothing is shuffled. Columns of docs
    with the names of the added ones are replaced.
    """
    table, short, bands = template_bands(docs.sparkSession, TEMPLATES if templates is None else templates)
    docs = without(docs, ("license", "containment", "n_found", "n_shingles"))
    kept = [c for c in docs.columns if c != text]
    names = F.array_distinct(F.concat(_named("_h", short), *[_named(f"_w{b}", bands[b]) for b in range(BANDS)]))
    # an outer explode: a plain one, or a filter, would be pushed down and make all arrays once more
    found = with_bands(docs, text).select(*kept, "_words", F.explode_outer(names).alias("license"))
    own = F.transform(_places(F.size("_words") - WORDS + 1), lambda i: F.array_join(F.slice("_words", i, WORDS), " "))
    shared = F.size(F.array_intersect(own, "shingles"))
    return (
        found.join(F.broadcast(table), "license")  # as large as the templates, whatever the data
        .withColumn("n_found", shared).withColumn("n_shingles", F.col("n"))
        .withColumn("containment", F.col("n_found") / F.col("n_shingles"))
        .filter(F.col("containment") >= least)
        .select(*kept, "license", "containment", "n_found", "n_shingles")
    )
