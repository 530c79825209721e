"""Operator 7, license scan by MinHash windows (DataFrame and SQL functions only).

Texts become lower-case words and hashed shingles of five words (the whole
sequence when there are fewer). Overlapping windows of ``WINDOW`` shingles,
one every ``STRIDE``, are sketched by ``BANDS`` MinHash values, each a band of
its own; a template is sketched at every offset. A window that lies inside an
unchanged stretch of a template therefore meets it with certainty, and one
that shares a part ``j`` of its shingles with probability ``1 - (1 - j) **
BANDS``. A template of containment 0.8 keeps several such windows, see
``collision_probability``. Templates of at most ``WINDOW`` shingles use
windows of one shingle, whose MinHash is the shingle itself: they are always
retrieved.

A retrieved template is then verified: it matches if the text holds at least
0.8 of its distinct shingles, compared as strings. Licences with nearly the same
words (GPL 2 and 3 headers, BSD 2 and 3) are told apart by what distinguishes
them: of the shingles that a template does not share with a rival (a template
that holds half of its shingles or more) the text must hold half as well, for
each rival. So a GPL 3 text gives GPL 3 only, and a text with both notices gives
both. Templates under five words (``SPDX-License-Identifier: MIT``) have no
shingle of their own; they match where their words stand in a row.

Scale: one map pass without any shuffle. Only texts that hold a shingle of some
template, without which none can match, are sketched. The templates are a fixed list of at
most ``MAX_TEMPLATE_SHINGLES`` shingles that goes into the plan as a literal.

Defined cases: null, empty and word-free texts match nothing. Every row is
scanned on its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import col, let
from .license_texts import NOTICES, OPENINGS, PHRASES

SHINGLE = 5
SIMILARITY = 0.8
WINDOW, STRIDE, BANDS = 16, 8, 4
MAX_TEMPLATE_SHINGLES = 20_000

#: License notices as they are commonly written.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        'software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR '
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License."
    ),
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
        "(at your option) any later version. This program is distributed in the hope that it will be useful, but "
        "WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR "
        "PURPOSE. See the GNU General Public License for more details."
    ),
    "MIT": "Released under the MIT License.",
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        'associated documentation files (the "Software"), to deal in the Software without restriction, including '
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions: The above copyright notice and this permission notice shall be included in all "
        "copies or substantial portions of the Software."
    ),
    **NOTICES,
    **OPENINGS,
    **PHRASES,
}

#: What the names of templates add to the identifier of their licence.
KINDS = ("deed", "header", "later", "notice", "preamble", "short", "spdx", "terms", "text", "v")


def licence_of(template: Column) -> Column:
    """The licence of a template, by its name."""
    return F.regexp_replace(template, f"-({'|'.join(KINDS)})$", "")


def collision_probability(shared: float, windows: int = 1) -> float:
    """Chance that a template is retrieved by ``windows`` windows of Jaccard similarity ``shared``."""
    return 1 - (1 - shared) ** (BANDS * windows)


def words_of(text: Column) -> Column:
    parts = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", -1)
    return F.filter(parts, lambda w: w != "")


def _starts(size: Column, reach: int, step: int) -> Column:
    """Window starts 1, 1 + step, ... so that the last window of ``reach`` ends at the end."""
    last = F.greatest(size - (reach - step), F.lit(1)) if step > 1 else F.greatest(size - (reach - 1), F.lit(1))
    return F.when(size > 0, F.sequence(F.lit(1), last, F.lit(step))).otherwise(F.array().cast("array<int>"))


def shingles(words: str) -> Column:
    return F.transform(
        _starts(F.size(words), SHINGLE, 1), lambda i: F.concat_ws(" ", F.slice(words, i, F.lit(SHINGLE)))
    )


def hashed_shingles(words: str) -> Column:
    return F.transform(
        _starts(F.size(words), SHINGLE, 1), lambda i: F.xxhash64(F.concat_ws(" ", F.slice(words, i, F.lit(SHINGLE))))
    )


def window_bands(hashes: str, step: int) -> Column:
    """Band keys of all windows of ``WINDOW`` hashes, one every ``step``."""

    def sketch(i: Column) -> Column:
        window = F.slice(hashes, i, F.lit(WINDOW))
        return F.transform(
            F.array(*[F.lit(j) for j in range(BANDS)]),
            lambda j: F.xxhash64(j, F.array_min(F.transform(window, lambda x: F.xxhash64(x, j)))),
        )

    return F.flatten(F.transform(_starts(F.size(hashes), WINDOW, step), sketch))


def _template_rows(spark, templates: dict[str, str]) -> list:
    df = spark.createDataFrame(sorted(templates.items()), "id string, text string")
    df = let(df, words=words_of(F.col("text")))
    df = let(df, hashes=hashed_shingles("words"), shingles=F.array_distinct(shingles("words")))
    bands = F.when(F.size("hashes") <= WINDOW, F.col("hashes")).otherwise(window_bands("hashes", 1))
    known = df.select("id", F.size("words").alias("n"), "shingles", "hashes", F.array_distinct(bands).alias("bands"))
    rows = known.filter("n > 0").collect()
    if sum(len(r["shingles"]) for r in rows) > MAX_TEMPLATE_SHINGLES:
        raise ValueError(f"templates hold more than {MAX_TEMPLATE_SHINGLES} shingles; scan with parts of the list")
    return rows


def _distinguishing(row, rows: list) -> list[tuple[str, ...]]:
    """For each rival of a template, the shingles that it does not share with it."""
    own, found = set(row["shingles"]), set()
    for other in rows:
        apart = own - set(other["shingles"])
        if apart and other["n"] >= SHINGLE and 2 * len(apart) <= len(own):
            found.add(tuple(sorted(apart)))
    return sorted(found)


def _literal(values: list, kind: str) -> Column:
    """A constant array (words hold no line end), folded once by the optimizer."""
    return F.split(F.lit("\n".join(map(str, values))), "\n").cast(f"array<{kind}>")


def licenses(
    docs: DataFrame, *, keep: list[str] | None = None, text_col: str = "text", templates: dict[str, str] | None = None
) -> DataFrame:
    """``row`` (struct of the columns ``keep``), n_words and ``matches`` per document.

    ``matches`` is an array of (template, containment), sorted by template.
    """
    known = _template_rows(docs.sparkSession, TEMPLATES if templates is None else templates)
    phrases, known = [r for r in known if r["n"] < SHINGLE], [r for r in known if r["n"] >= SHINGLE]
    df = docs.select(F.struct(*[col(c) for c in keep or docs.columns]).alias("row"), col(text_col).cast("string").alias("text"))
    df = let(df, words=words_of(F.col("text"))).drop("text")
    df = let(df, hashes=hashed_shingles("words"), line=F.concat(F.lit(" "), F.array_join("words", " "), F.lit(" ")))
    rough = F.exists("hashes", lambda x: x.isin(sorted({h for r in known for h in r["hashes"]})))
    all_bands = sorted({b for r in known for b in r["bands"]})
    hits = F.filter(F.concat("hashes", window_bands("hashes", STRIDE)), lambda x: x.isin(all_bands))
    df = let(df, hits=F.when(rough, hits).otherwise(F.array().cast("array<bigint>"))).drop("hashes")
    df = let(df, held=F.when(F.size("hits") > 0, shingles("words")))

    def holds(wanted) -> Column:
        return F.size(F.array_intersect(_literal(wanted, "string"), F.col("held")))

    def match(row, containment: Column) -> Column:
        return F.struct(F.lit(row["id"]).alias("template"), containment.alias("containment"))

    found = []
    for r in known:
        fits = F.arrays_overlap(F.col("hits"), _literal(r["bands"], "bigint"))
        fits &= holds(r["shingles"]) >= SIMILARITY * len(r["shingles"])
        for apart in _distinguishing(r, known):
            fits &= holds(apart) * 2 >= len(apart)
        found.append((r["id"], F.when((F.size("hits") > 0) & fits, match(r, holds(r["shingles"]) / len(r["shingles"])))))
    for r in phrases:
        sequence = r["shingles"][0]  # all its words
        found.append((r["id"], F.when(F.col("line").contains(f" {sequence} "), match(r, F.lit(1.0)))))
    none = F.array().cast("array<struct<template:string,containment:double>>")
    matches = F.filter(F.array(*[m for _, m in sorted(found, key=lambda x: x[0])]), lambda m: m.isNotNull()) if found else none
    return df.select("row", F.size("words").cast("long").alias("n_words"), matches.alias("matches"))
