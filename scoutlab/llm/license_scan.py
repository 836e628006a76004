"""License scan by MinHash bands over overlapping windows (operator 6).

Templates are notices and whole license texts.  A template of m shingles is looked for in windows
of w shingles, w the power of two from 2m to below 4m, at every w/2: one window
holds a whole occurrence.  Window and template then have a similarity of at
least 0.8 m / (w + 0.2 m) > 0.19 when the window contains 0.8 of the template,
and one of BANDS bands of one MinHash each agrees with probability above
1 - 0.81**96 > 1 - 2e-9.  Windows that agree in a band are verified: the exact
share of the template's shingles that they contain must be PERCENT or more.

A band can only agree where the window holds the template's least shingle of
that band.  Windows without any such shingle are passed over before signatures
are computed, first by a bit table and then exactly; this loses nothing.

Words are runs of characters other than ASCII white space, with A-Z lower-cased
and the characters of MARKS removed; shingles are five words (three for
templates of three or four words).  Everything is DataFrame functions; the
templates are a parameter of at most MAX_TEMPLATES notices, so what is made
from them is bounded and broadcast.

Null, empty and blank texts have no windows.  Rows that repeat a doc_id are
scanned separately and reported together.
"""

from __future__ import annotations

from pathlib import Path

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from scoutlab.llm.common import lower_ascii, settle, words

BANDS = 96
PERCENT = 80
MAX_SHINGLES = 32
MAX_TEMPLATES = 1000
MARKS = ".,;:()\"'"
_TABLE_BITS = 18
_CC = {"BY-SA": "Attribution-ShareAlike", "BY-NC": "Attribution-NonCommercial", "BY-NC-SA": "Attribution-NonCommercial-ShareAlike",
       "BY-ND": "Attribution-NoDerivatives", "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives"}
# Sentences of public license notices, and whole texts.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL", "You should have received a copy of the GNU General Public License along with this program."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("proprietary", "All rights reserved."),
    ("MIT", "Licensed under the MIT License."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL", "You should have received a copy of the GNU Lesser General Public License along with this program."),
    ("LGPL", "You should have received a copy of the GNU Lesser General Public License along with this library."),
    ("AGPL", "You should have received a copy of the GNU Affero General Public License along with this program."),
    ("EPL", "This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0"),
    ("EPL", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0"),
    ("EPL", "The accompanying program is provided under the terms of this Eclipse Public License (\"Agreement\"). Any use, reproduction or "
            "distribution of the program constitutes recipient's acceptance of this agreement."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
            "provided that the above copyright notice and this permission notice appear in all copies."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Zlib", "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it "
             "and redistribute it freely, subject to the following restrictions:"),
    ("BSL-1.0", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and "
                "accompanying documentation covered by this license"),
    ("CC0-1.0", "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to "
                "this software to the public domain worldwide."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-3.0", "This work is licensed under a Creative Commons Attribution 3.0 Unported License."),
    ("CC-BY-4.0", "agree to be bound by the terms and conditions of this Creative Commons Attribution 4.0 International Public License"),
    *((f"CC-{k}-4.0", f"Licensed under CC {k.replace('-', ' ', 1)} 4.0.") for k in _CC if k != "BY-NC"),
    *((f"CC-{k}-4.0", f"This work is licensed under a Creative Commons {v} 4.0 International License.") for k, v in _CC.items()),
    *((f"CC-{k}-3.0", f"This work is licensed under a Creative Commons {v.replace('Derivatives', 'Derivs')} 3.0 Unported License.") for k, v in _CC.items()),
    *((f"CC-{k}-4.0", f"agree to be bound by the terms and conditions of this Creative Commons {v} 4.0 International Public License") for k, v in _CC.items()),
    *((f.stem, f.read_text()) for f in sorted((Path(__file__).parent / "license_texts").glob("*.txt"))),
)


def _hashes(w: Column, width: int) -> Column:
    """Hashes of the shingles of ``width`` words, one per position."""
    at = F.when(F.size(w) >= width, F.sequence(F.lit(0), F.size(w) - width)).otherwise(F.array().cast("array<int>"))
    return F.element_at(F.transform(F.array(w), lambda a: F.transform(at, lambda i: F.xxhash64(*[F.get(a, i + k) for k in range(width)]))), 1)


def _normal_words(text: Column) -> Column:
    return words(F.translate(lower_ascii(F.coalesce(text, F.lit(""))), MARKS, ""))


def signature(shingles: Column) -> Column:
    """BANDS MinHashes of an array of shingle hashes."""
    return F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda j: F.array_min(F.transform(shingles, lambda x: F.xxhash64(x, j))))


def template_table(spark: SparkSession, templates=TEMPLATES) -> DataFrame:
    """template, license, width (words of a shingle), shingles, window, bands, least."""
    if len(templates) > MAX_TEMPLATES:
        raise ValueError(f"at most {MAX_TEMPLATES} templates")
    rows = spark.createDataFrame([(i, n, t) for i, (n, t) in enumerate(templates)], "template int, license string, text string")
    rows = rows.withColumn("w", _normal_words(F.col("text"))).withColumn("width", F.when(F.size("w") >= 5, 5).otherwise(3))
    rows = rows.select("template", "license", "width", F.when(F.col("width") == 5, _hashes(F.col("w"), 5)).otherwise(_hashes(F.col("w"), 3)).alias("shingles"))
    rows = rows.withColumn("shingles", F.array_distinct("shingles"))
    window = F.greatest(F.lit(4), F.pow(F.lit(2.0), F.ceil(F.log2(F.size("shingles") * 2.0))).cast("int"))
    rows = rows.withColumn("window", window).withColumn("bands", signature(F.col("shingles")))
    # The shingle that has the least hash of each band.
    least = F.filter("shingles", lambda x: F.exists(F.arrays_zip(F.sequence(F.lit(0), F.lit(BANDS - 1)).alias("j"), F.col("bands").alias("b")),
                                                    lambda z: F.xxhash64(x, z["j"]) == z["b"]))
    return settle(rows.withColumn("least", least), "license-templates")


def _bit_table(values: list[int]) -> Column:
    table = np.zeros(1 << (_TABLE_BITS - 6), np.uint64)
    for v in values:
        for half in (v, v >> 32):
            slot = half & ((1 << _TABLE_BITS) - 1)
            table[slot >> 6] |= np.uint64(1 << (slot & 63))
    return F.lit(table.view(np.int64))


def scan(docs: DataFrame, templates: DataFrame, longest: int | None = MAX_SHINGLES) -> DataFrame:
    """doc_id, license, template, start (word), contained (percent) of every window that
    contains a template of at most ``longest`` shingles (None: of any length)."""
    known = templates.select("width", "window", F.size("shingles").alias("size"), "least").collect()  # at most MAX_TEMPLATES rows
    if any(not t["size"] or longest is not None and t["size"] > longest for t in known):
        raise ValueError(f"a template has 1 to {longest or 'any number of'} shingles")
    rows = docs.select("doc_id", _normal_words(F.col("text")).alias("w"))
    widths = sorted({t["width"] for t in known})
    rows = rows.select("doc_id", *[_hashes(F.col("w"), k).alias(f"h{k}") for k in widths])

    def hits(k: int) -> Column:
        table = _bit_table([v for t in known if t["width"] == k for v in t["least"]])

        def marked(x: Column) -> Column:
            slot = x.bitwiseAND(F.lit((1 << _TABLE_BITS) - 1))
            word = F.get(table, F.shiftright(slot, 6).cast("int"))
            bit = F.call_function("shiftright", word, slot.bitwiseAND(F.lit(63)).cast("int"))
            return bit.bitwiseAND(F.lit(1)) == 1

        # Positions are tagged first, so that the filter looks each hash up once.
        tagged = F.transform(F.col(f"h{k}"), lambda x, i: F.when(marked(x) & marked(F.shiftright(x, 32)), i))
        return F.filter(tagged, lambda i: i.isNotNull())

    rows = rows.select("doc_id", *[f"h{k}" for k in widths], *[hits(k).alias(f"p{k}") for k in widths])

    def windows_of(k: int, w: int) -> Column:
        step = w // 2
        least = F.lit(np.array(sorted({v for t in known if (t["width"], t["window"]) == (k, w) for v in t["least"]}), np.int64))
        numbers = F.array_distinct(F.flatten(F.transform(f"p{k}", lambda i: F.array(
            F.floor(i / step).cast("int"), F.floor(i / step).cast("int") - 1))))
        cut = F.transform(F.filter(numbers, lambda q: q >= 0), lambda q: F.struct(
            F.lit(k).alias("width"), F.lit(w).alias("window"), (q * step).alias("start"), F.slice(F.col(f"h{k}"), q * step + 1, F.lit(w)).alias("items")))
        return F.filter(cut, lambda x: F.arrays_overlap(x["items"], least))

    parts = [windows_of(k, w) for k, w in sorted({(t["width"], t["window"]) for t in known})]
    windows = rows.select("doc_id", F.explode(F.concat(*parts)).alias("x")).select("doc_id", "x.*")
    drawn = windows.withColumn("drawn", signature(F.col("items"))).select("*", F.posexplode("drawn").alias("band", "value"))
    bands = templates.select("template", "width", "window", F.posexplode("bands").alias("band", "value"))
    texts = templates.select("template", "license", "shingles", "bands")
    found = drawn.join(F.broadcast(bands), ["width", "window", "band", "value"]).join(F.broadcast(texts), "template")
    # A window is verified in the first band in which it agrees with the template.
    agreed = F.array_position(F.zip_with("drawn", "bands", lambda x, y: x == y), True) == F.col("band") + 1
    inside = F.size(F.array_intersect("shingles", "items")) * 100
    return (found.filter(agreed).withColumn("contained", F.floor(inside / F.size("shingles")).cast("int"))
            .filter(inside >= F.size("shingles") * PERCENT).select("doc_id", "license", "template", "start", "contained"))


def licenses(docs: DataFrame, templates=TEMPLATES) -> DataFrame:
    """One row per document and license found: doc_id, license, first_word, contained."""
    found = scan(docs, template_table(docs.sparkSession, templates), longest=None)
    return found.groupBy("doc_id", "license").agg(F.min("start").cast("long").alias("first_word"), F.max("contained").cast("long").alias("contained"))
