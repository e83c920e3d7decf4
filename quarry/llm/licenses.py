"""License scans: a trained paragraph classifier (operator 1).

A text is cut into paragraphs (line breaks, and sentence ends, so that a notice inside a
line stands alone).  A notice may be wrapped at any width: where a sentence goes over several
lines (to a blank line at most), its runs of neighbouring lines are scored as paragraphs too;
a run counts if none of its lines is a notice by itself, and of runs that overlap the best
covered one counts.  A multinomial logistic regression over sparse word 2- and 3-grams
names the licence family of a paragraph or *unknown*.  It is trained here, on notices made
from the templates below and on prose that speaks of similar things; a third of the rows is
kept out to fit a temperature and the probability below which a paragraph counts as
unknown.  A family is confirmed by comparison with its templates: enough of the n-grams of
one template must stand in the paragraph.

The model is small by construction (n-grams of the templates only), so it becomes part of
the query: scoring is one map of column expressions over the texts, with no shuffle.

Defined cases: null and empty texts have no paragraphs and no family; repeated rows are
reported as they come; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import json
import math
import random
import re

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Short notices as the licences' stewards publish them.
TEMPLATES = {
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "mit": [
        "Released under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files, to deal in the Software without restriction.",
        "SPDX-License-Identifier: MIT",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or any later version.",
        "You should have received a copy of the GNU General Public License along with this program.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "lgpl": [
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "You can redistribute it and/or modify it under the terms of the GNU Lesser General Public License.",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
    ],
    "agpl": [
        "This program is licensed under the GNU Affero General Public License, version 3.",
        "SPDX-License-Identifier: AGPL-3.0-only",
    ],
    "bsd": [
        "Licensed under the 3-Clause BSD License.",
        "Released under the BSD license.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "mpl-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
    ],
    "cc-by-nc": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "cc-by-sa": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "cc-by": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "public-domain": [
        "This is free and unencumbered software released into the public domain.",
        "To the extent possible under law, the author has waived all copyright and related rights to this work.",
        "SPDX-License-Identifier: CC0-1.0",
    ],
    "proprietary": [
        "All rights reserved.",
        "Unauthorized copying of this file, via any medium, is strictly prohibited.",
    ],
}
# Prose that shares words with the notices but grants nothing.
OTHER = [
    "The driver's license expired last year and was renewed under the new rules.",
    "The public was granted free access to the source of the river.",
    "Version 2 of the film was released in May.", "The foundation published a general report on public health.",
    "This program is about free speech.", "You can use this file to sharpen the blade.", "A copy of the letter was obtained.",
    "The terms of the agreement were published under pressure.", "Work is licensed by the state board.",
    "The mit students released a new game.", "He modified the recipe without restriction.",
    "The apache helicopter was version two of the design.", "Permission to land was granted by the tower.",
    "This project is the work of many people.", "The rights of the people are reserved to the states.",
    "Common attribution errors and how to correct them.", "The software foundation met in the public library.",
    "The following conditions are met in most cases.", "They released the report under the title of the year.",
]
UNKNOWN = "unknown"
SPLIT = r"\n+|(?<=[.!?;])\s+"
SENTENCE = r"\n[^a-z0-9\n]*\n|(?<=[.!?;])\s+"
WORD = "[^a-z0-9]+"
COVER = 0.6


def words_of(text: str) -> list[str]:
    return [w for w in re.split(WORD, text.lower()) if w]


def grams_of(words: list[str]) -> list[str]:
    return [" ".join(words[k:k + n]) for n in (2, 3) for k in range(len(words) - n + 1)]


def examples(seed: int = 7, copies: int = 24) -> list[tuple[str, str]]:
    """(family, paragraph) training rows: templates with words lost, added or replaced, and
    unknown paragraphs of prose, of shuffled notices and of their loose words."""
    r = random.Random(seed)
    loose = [w for rows in TEMPLATES.values() for t in rows for w in t.split()] + [w for t in OTHER for w in t.split()]
    out = []
    for family, rows in TEMPLATES.items():
        for text in rows:
            for copy in range(copies):
                words = text.split()
                if copy:
                    words = [w for w in words if r.random() > 0.06] or words
                    if copy % 3 == 1:
                        words = [r.choice(loose).lower() for _ in range(r.randrange(1, 6))] + words
                    if copy % 3 == 2:
                        words = words + [r.choice(loose).lower() for _ in range(r.randrange(1, 10))]
                out.append((family, " ".join(words)))
    for _ in range(len(out) // 2):
        out.append((UNKNOWN, r.choice(OTHER)))
        text = r.choice(loose) if r.random() < 0.1 else " ".join(r.choice(loose) for _ in range(r.randrange(4, 40)))
        out.append((UNKNOWN, text))
        parts = [w for t in r.sample(OTHER, 2) for w in t.split()]
        out.append((UNKNOWN, " ".join(parts[r.randrange(5):][:r.randrange(5, 30)])))
    return out


def fit(spark: SparkSession, rows: list[tuple[str, str]] | None = None, regularisation: float = 1e-4) -> dict:
    """Weights per n-gram and class, biases, temperature and threshold.

    ``rows``: (family, paragraph); its number bounds what the driver and the fit hold.
    """
    rows = rows or examples()
    classes = sorted({f for f, _ in rows}, key=lambda f: (f != UNKNOWN, f))
    vocabulary = sorted({g for texts in TEMPLATES.values() for t in texts for g in grams_of(words_of(t))})
    place = {g: i for i, g in enumerate(vocabulary)}

    def vector(text):
        grams = grams_of(words_of(text))
        known = sorted({place[g] for g in grams if g in place})
        return Vectors.sparse(len(place), known, [1 / math.sqrt(max(len(grams), 1))] * len(known))

    data = [(classes.index(f), vector(t)) for f, t in rows]
    train = [d for i, d in enumerate(data) if i % 3 != 2]
    held = [d for i, d in enumerate(data) if i % 3 == 2]
    frame = spark.createDataFrame([(float(y), x) for y, x in train], ["label", "features"])
    model = LogisticRegression(family="multinomial", regParam=regularisation, maxIter=60).fit(frame.coalesce(1))
    weights = model.coefficientMatrix.toArray()
    bias = model.interceptVector.toArray()
    logit = np.stack([x.toArray() @ weights.T + bias for _, x in held])
    y = np.array([c for c, _ in held])

    def probabilities(t):
        z = logit / t
        e = np.exp(z - z.max(1, keepdims=True))
        return e / e.sum(1, keepdims=True)

    temperature = min((0.5, 0.75, 1.0, 1.5, 2.0, 3.0, 4.0),
                      key=lambda t: -np.log(probabilities(t)[np.arange(len(y)), y] + 1e-12).sum())
    p = probabilities(temperature)
    best = p[:, 1:].max(1)
    # the lowest probability at which at most 1 in 200 unknown paragraphs is named
    threshold = max(0.5, float(np.quantile(best[y == 0], 0.995))) if (y == 0).any() else 0.5
    return {"classes": classes, "vocabulary": vocabulary, "weights": weights, "bias": bias,
            "temperature": float(temperature), "threshold": min(threshold, 0.95)}


def _grams(words: Column, n: int) -> Column:
    out = words
    for k in range(1, n):
        size = F.greatest(F.size(words) - k, F.lit(0))
        out = F.zip_with(F.slice(out, F.lit(1), size), F.slice(words, F.lit(k + 1), size), lambda a, b: F.concat(a, F.lit(" "), b))
    return out


def paragraphs(text: Column) -> Column:
    """(number, lines) of each sentence, a line being its words; lines without words are left out."""
    def lines(sentence):
        words = F.transform(F.split(sentence, r"\n+"), lambda p: F.filter(F.split(p, WORD), lambda w: w != ""))
        return F.filter(words, lambda w: F.size(w) > 0)

    return F.transform(F.split(F.lower(text), SENTENCE, -1), lambda s, i: F.struct(i.alias("number"), lines(s).alias("lines")))


def _line_runs(p: Column, inner: int) -> Column:
    """(number, first, last, words) of a sentence's runs of 2 and more lines with at most
    ``inner`` words between the first and the last line, and of the whole sentence.  ``p.ends``
    counts the words before each line."""
    def run(i, j):
        return F.struct(p["number"].alias("number"), i.alias("first"), j.alias("last"),
                        F.flatten(F.slice(p["lines"], i + 1, j - i + 1)).alias("words"))

    last = F.size(p["lines"]) - 1
    some = F.transform(F.sequence(F.lit(0), last - 1), lambda i: F.transform(
        F.filter(F.sequence(i + 1, F.least(last, i + 1 + inner)), lambda j: F.get(p["ends"], j) - F.get(p["ends"], i + 1) <= inner),
        lambda j: run(i, j)))
    return F.concat(F.flatten(some), F.array(run(F.lit(0), last)))


def _apart(found: Column) -> Column:
    """Single lines, and of the line runs those without one of them, the best covered first,
    that do not overlap one taken before; in the order of the text."""
    def meet(a, b):
        return (a["number"] == b["number"]) & (a["first"] <= b["last"]) & (b["first"] <= a["last"])

    lines = F.filter(found, lambda p: p["first"] == p["last"])
    best = F.array_sort(F.transform(F.filter(found, lambda p: p["first"] < p["last"]), lambda p: F.struct(
        (-p["cover"]).alias("c"), (-p["probability"]).alias("q"), (p["last"] - p["first"]).alias("n"), p.alias("p"))))
    kept = F.aggregate(best, lines, lambda acc, b: F.when(F.exists(acc, lambda k: meet(k, b["p"])), acc).otherwise(F.concat(acc, F.array(b["p"]))))
    return F.array_sort(kept)


def scan(docs: DataFrame, model: dict | None = None, cover: float = COVER) -> DataFrame:
    """``docs`` rows as (doc_id, n_paragraphs, hits): hits are the confirmed paragraphs
    (number of the sentence, family, probability, cover) in order."""
    model = model or fit(docs.sparkSession)
    classes, places = model["classes"], {g: i for i, g in enumerate(model["vocabulary"])}
    pairs = [g for g in places if g.count(" ") == 1]
    scaled = model["weights"] / model["temperature"]
    bias = [float(b) / model["temperature"] for b in model["bias"]]
    # per n-gram its weights by class; a literal of the size of the templates
    table = F.from_json(F.lit(json.dumps({g: [float(v) for v in scaled[:, i]] for g, i in places.items()})), "map<string,array<double>>")
    known = F.from_json(F.lit(json.dumps({f: [sorted(set(grams_of(words_of(t)))) for t in texts]
                                          for f, texts in TEMPLATES.items()})), "map<string,array<array<string>>>")
    cut = docs.select("doc_id", paragraphs(F.col("text").cast("string")).alias("p"))
    # most paragraphs hold no pair of words of any template: they keep the bias, i.e. unknown
    some = cut.select("doc_id", F.coalesce(F.aggregate("p", F.lit(0), lambda n, p: n + F.size(p["lines"])), F.lit(0)).alias("n_paragraphs"),
                      F.filter("p", lambda p: F.exists(_grams(F.flatten(p["lines"]), 2), lambda g: g.isin(pairs))).alias("p"))
    # lines together can only be confirmed where the whole sentence covers some template
    templates = [sorted(set(grams_of(words_of(t)))) for texts in TEMPLATES.values() for t in texts]
    all_known = F.from_json(F.lit(json.dumps(templates)), "array<array<string>>")
    inner, least = 2 * max(len(words_of(t)) for texts in TEMPLATES.values() for t in texts), min(cover * len(t) for t in templates)
    wrapped = some.select("doc_id", "n_paragraphs", "p", F.transform(F.filter("p", lambda p: F.size(p["lines"]) > 1), lambda p: F.struct(
        p["number"].alias("number"), p["lines"].alias("lines"), F.array_distinct(F.filter(F.concat(
            _grams(F.flatten(p["lines"]), 2), _grams(F.flatten(p["lines"]), 3)), lambda g: g.isin(list(places)))).alias("known"))).alias("w"))
    enough = wrapped.select("doc_id", "n_paragraphs", "p", F.filter("w", lambda p: (F.size(p["known"]) >= least) & F.exists(
        all_known, lambda t: F.size(F.array_intersect(t, p["known"])) / F.size(t).cast("double") >= cover)).alias("w"))
    counted = enough.select("doc_id", "n_paragraphs", "p", F.transform("w", lambda p: F.struct(
        p["number"].alias("number"), p["lines"].alias("lines"), F.aggregate(p["lines"], F.array(F.lit(0)), lambda ends, w: F.concat(
            ends, F.array(F.element_at(ends, -1) + F.size(w)))).alias("ends"))).alias("w"))
    single = F.flatten(F.transform("p", lambda p: F.transform(p["lines"], lambda w, k: F.struct(
        p["number"].alias("number"), k.alias("first"), k.alias("last"), w.alias("words")))))
    pieces = counted.select("doc_id", "n_paragraphs", F.concat(
        F.filter(single, lambda p: F.exists(_grams(p["words"], 2), lambda g: g.isin(pairs))),
        F.flatten(F.transform("w", lambda p: _line_runs(p, inner)))).alias("p"))

    def place(p):
        return [p[name].alias(name) for name in ("number", "first", "last")]

    grams = pieces.select("doc_id", "n_paragraphs", F.transform("p", lambda p: F.struct(
        *place(p), F.concat(_grams(p["words"], 2), _grams(p["words"], 3)).alias("grams"))).alias("p"))
    vectors = grams.select("doc_id", "n_paragraphs", F.transform("p", lambda p: F.struct(
        *place(p), F.array_distinct(F.filter(p["grams"], lambda g: g.isin(list(places)))).alias("known"),
        (1 / F.sqrt(F.size(p["grams"]).cast("double"))).alias("value"))).alias("p"))
    zero = F.array(*[F.lit(b) for b in bias])

    def logits(p):
        return F.aggregate(p["known"], zero, lambda acc, g: F.zip_with(acc, F.try_element_at(table, g), lambda a, w: a + w * p["value"]))

    scored = vectors.select("doc_id", "n_paragraphs", F.transform("p", lambda p: F.struct(
        *place(p), p["known"].alias("known"), logits(p).alias("z"))).alias("p"))

    def named(p):
        top = F.array_max(p["z"])
        total = F.aggregate(p["z"], F.lit(0.0), lambda s, z: s + F.exp(z - top))
        return F.struct(*place(p), p["known"].alias("known"), (1 / total).alias("probability"),
                        F.element_at(F.array(*[F.lit(c) for c in classes]), F.array_position(p["z"], top).cast("int")).alias("family"))

    def cover_of(p):
        share = F.transform(F.try_element_at(known, p["family"]),
                            lambda t: F.size(F.array_intersect(t, p["known"])) / F.size(t).cast("double"))
        return F.coalesce(F.array_max(share), F.lit(0.0))

    families = scored.select("doc_id", "n_paragraphs", F.filter(F.transform("p", named), lambda p: (
        p["family"] != UNKNOWN) & (p["probability"] >= model["threshold"])).alias("p"))
    covered = families.select("doc_id", "n_paragraphs", F.transform("p", lambda p: F.struct(
        *place(p), p["family"].alias("family"), p["probability"].alias("probability"),
        cover_of(p).alias("cover"))).alias("p"))
    confirmed = covered.select("doc_id", "n_paragraphs", F.filter("p", lambda p: p["cover"] >= cover).alias("p"))
    apart = confirmed.select("doc_id", "n_paragraphs", _apart(F.col("p")).alias("p"))
    return apart.select("doc_id", "n_paragraphs", F.coalesce(F.transform("p", lambda p: F.struct(
        p["number"].alias("number"), p["family"].alias("family"), p["probability"].alias("probability"), p["cover"].alias("cover"))),
        F.expr("cast(array() as array<struct<number:int,family:string,probability:double,cover:double>>)")).alias("hits"))


def report(found: DataFrame) -> DataFrame:
    """doc_id, n_paragraphs, n_hits, families (sorted, comma-joined), family (the likeliest)."""
    best = F.element_at(F.array_sort(F.transform("hits", lambda h: F.struct((-h["probability"]).alias("p"), h["family"].alias("f")))), 1)
    return found.select("doc_id", "n_paragraphs", F.size("hits").alias("n_hits"),
                        F.array_join(F.array_sort(F.array_distinct(F.transform("hits", lambda h: h["family"]))), ",").alias("families"),
                        F.when(F.size("hits") > 0, best["f"]).otherwise(UNKNOWN).alias("family"),
                        F.when(F.size("hits") > 0, F.round(-best["p"], 6)).alias("probability"))
