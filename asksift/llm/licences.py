"""Licence scans by a trained paragraph classifier.

A sparse multinomial logistic regression over word n-grams names the licence
family of a paragraph: a line, or several lines up to an empty one, where a
statement is wrapped. It is fitted here from the statements below,
varied at random, against lines of the corpus and plain sentences. Its
probabilities are calibrated on variants it was not fitted on; a licence-like
paragraph of no sure family is ``unknown``. The predicted family's statements
then confirm the prediction by the share of their n-grams that are there.

Features are n-grams with at least one word of the model's vocabulary, so a
paragraph without such a word has no feature and its class is that of the
intercept, ``none``: only the others are scored, all in DataFrame operations.

Nulls and empty texts have no paragraphs. Repeated rows, and rows with equal or no
ids, are scanned one by one, and extra columns are ignored. Of families with the same
probability the first in the order of ``Model.classes`` counts, of statements with the
same overlap the first. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..sources.stages import require_columns
from .sampling import hash_sample

# Short public statements by which works name their licence.
STATEMENTS: dict[str, list[str]] = {
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "SPDX-License-Identifier: Apache-2.0",
        "This project is distributed under the Apache Software License 2.0.",
    ],
    "mit": [
        "Released under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "SPDX-License-Identifier: MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction.",
        "Distributed under the MIT/Expat license.",
    ],
    "gpl-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation.",
        "SPDX-License-Identifier: GPL-2.0-only",
        "Licensed under the GPL v2.",
    ],
    "gpl-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License version 3 as published by the Free Software Foundation.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "Licensed under the GPL v3.",
    ],
    "lgpl": [
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "You can redistribute this library under the terms of the GNU Lesser General Public License as published by the Free Software Foundation.",
        "SPDX-License-Identifier: LGPL-3.0-only",
        "Licensed under the LGPL v3.",
    ],
    "agpl-3.0": [
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "SPDX-License-Identifier: AGPL-3.0-only",
        "Licensed under the AGPL v3.",
    ],
    "bsd": [
        "Released under the BSD 3-Clause License.",
        "This software is licensed under the 2-clause BSD license.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "mpl-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, Version 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "cc-by": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Text is available under the Creative Commons Attribution License.",
    ],
    "cc-by-sa": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Text is available under the Creative Commons Attribution-ShareAlike License.",
    ],
    "cc-by-nc": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Content is available under the Creative Commons Attribution-NonCommercial License.",
    ],
    "cc0": [
        "Released under CC0 1.0 Universal.",
        "To the extent possible under law, the author has waived all copyright and related rights to this work.",
        "This is free and unencumbered software released into the public domain.",
        "Dedicated to the public domain under the Creative Commons Zero dedication.",
    ],
    "proprietary": [
        "All rights reserved.",
        "Copyright 2020 Example Corporation. All rights reserved.",
        "Unauthorized copying of this file is strictly prohibited. Proprietary and confidential.",
        "No part of this publication may be reproduced without prior written permission of the publisher.",
    ],
}
# Statements that speak of licences but of no family above.
OTHER_STATEMENTS = [
    "Licensed under the terms of the agreement below.",
    "See the license file for the license terms.",
    "This material is provided under a custom license.",
    "Use of this software is subject to the license agreement.",
    "Copyright by the authors.",
    "The license of this work is not stated.",
    "Released under the Example Community License.",
    "Permission to use this material must be requested.",
]
# Plain sentences that share words with licences.
PLAIN_SENTENCES = [
    "Her driving license expired in March and she had to renew it.",
    "The general public was free to visit the exhibition.",
    "He was granted permission to leave the room early.",
    "The new version of the film was released in two parts.",
    "All seats are reserved for members of the club.",
    "The work was distributed to any person without charge.",
    "The common people modified the source of the river.",
    "Creative writing and common sense are taught in this class.",
    "The institute published the conditions and terms of the contest.",
    "She left a copy of the book on the table, with a mit of wool.",
    "The public library has a free domain for the software course.",
    "International trade may be subject to modification by law.",
]
# Words too common to be of the vocabulary.
FUNCTION_WORDS = set(
    "a an and any are as at be below by can except for from has he her in into is it its may "
    "must no not of on or part possible prior she that the their this to two under use v was "
    "were which will with without you your".split()
)

NONE, UNKNOWN = "none", "unknown"
MAX_WORDS = 3
VARIANTS = 24
STEPS = 160
L1 = 4e-4
SEED = 5
#: Background lines of the corpus to learn from: about so many, each up to so
#: many characters.
BACKGROUND_LINES = 2_000
BACKGROUND_CHARS = 600
#: A family must reach the precision below on held-out variants.
PRECISION = 0.995
#: Share of a statement's n-grams that confirms a family.
CONFIRMED_FROM = 0.6

_WORD = re.compile(r"[a-z0-9]+")


class Model(NamedTuple):
    classes: list[str]
    vocabulary: list[str]
    grams: list[str]
    weights: np.ndarray
    intercept: np.ndarray
    temperature: float
    threshold: float


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def grams_of(words: list[str], vocabulary: set[str]) -> set[str]:
    """N-grams of up to three words with at least one of the vocabulary."""
    out = set()
    for size in range(1, MAX_WORDS + 1):
        for i in range(len(words) - size + 1):
            if any(w in vocabulary for w in words[i : i + size]):
                out.add(" ".join(words[i : i + size]))
    return out


def _variants(text: str, background: list[str], random: np.random.Generator) -> list[str]:
    """The text itself, and ones with words lost, doubled or embedded."""
    out = [text]
    for _ in range(VARIANTS - 1):
        words = text.split()
        kept = [w for w in words if random.random() > 0.06] or words
        if random.random() < 0.5 and background:
            around = background[random.integers(len(background))].split()[:30]
            cut = int(random.integers(0, len(around) + 1))
            kept = around[:cut] + kept + around[cut:]
        out.append(" ".join(kept))
    return out


def fit_licences(background: list[str]) -> Model:
    """Fit and calibrate the classifier; the same background gives the same model."""
    random = np.random.default_rng(SEED)
    classes = [NONE, UNKNOWN, *STATEMENTS]
    lines = sorted(set(background))
    seen = {w for line in lines for w in set(words_of(line))}
    every = [s for group in STATEMENTS.values() for s in group] + OTHER_STATEMENTS
    vocabulary = {w for s in every for w in words_of(s)} - FUNCTION_WORDS - (seen - _licence_words())
    rows: list[tuple[str, int]] = []
    for k, name in enumerate(classes):
        texts = {NONE: PLAIN_SENTENCES, UNKNOWN: OTHER_STATEMENTS}.get(name) or STATEMENTS[name]
        rows += [(v, k) for s in texts for v in _variants(s, lines or PLAIN_SENTENCES, random)]
    rows += [(line, 0) for line in lines]
    order = random.permutation(len(rows))
    sets = [(grams_of(words_of(rows[i][0]), vocabulary), rows[i][1]) for i in order]
    split = len(sets) * 3 // 4
    grams = sorted(set().union(*[g for g, _ in sets[:split]]))
    number = {g: i for i, g in enumerate(grams)}

    def matrix(part: list[tuple[set[str], int]]) -> tuple[np.ndarray, np.ndarray]:
        x = np.zeros((len(part), len(grams)), np.float32)
        for i, (found, _) in enumerate(part):
            x[i, [number[g] for g in found if g in number]] = 1
        return x, np.array([k for _, k in part])

    x, y = matrix(sets[:split])
    weights = np.zeros((len(grams), len(classes)), np.float32)
    intercept = np.zeros(len(classes), np.float32)
    intercept[0] = 4.0  # a paragraph without features is no licence
    target = np.eye(len(classes), dtype=np.float32)[y]
    moved, before = weights.copy(), weights.copy()
    rate = np.float32(2.0 / max(1.0, float((x**2).sum(1).mean()) / 4))
    for step in range(STEPS):
        error = (_softmax(x @ moved + intercept) - target) / len(x)
        before, weights = weights, moved - rate * (x.T @ error)
        weights = np.sign(weights) * np.maximum(np.abs(weights) - rate * L1, 0)
        moved = weights + np.float32(step / (step + 3)) * (weights - before)
    used = np.abs(weights).sum(1) > 0
    x, y = matrix(sets[split:])
    logits = x @ weights + intercept
    temperature = min(
        (0.25, 0.4, 0.6, 0.8, 1.0, 1.3, 1.7, 2.2),
        key=lambda t: -np.log(_softmax(logits / t)[np.arange(len(y)), y] + 1e-12).sum(),
    )
    chances = _softmax(logits / temperature)
    best, sure = chances.argmax(1), chances.max(1)
    threshold = 0.5
    for value in np.unique(sure[(best > 1) & (best != y)]):
        above = (best > 1) & (sure >= threshold)
        if not above.any() or (best[above] == y[above]).mean() >= PRECISION:
            break
        threshold = float(max(threshold, value + 1e-6))
    kept = [g for g, u in zip(grams, used) if u]
    words = sorted({w for g in kept for w in g.split() if w in vocabulary})
    return Model(classes, words, kept, weights[used].astype(float), intercept.astype(float), float(temperature), threshold)


def _licence_words() -> set[str]:
    """Words that stay in the vocabulary though the background may have them."""
    return {"license", "licensed", "copyright", "rights", "reserved", "permission"}


def _softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def background_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> list[str]:
    """A bounded sample of first lines, picked by hash."""
    head = F.substring_index(F.substring(F.col(text).cast("string"), 1, BACKGROUND_CHARS), "\n", 1)
    picked = hash_sample(docs, BACKGROUND_LINES, doc_id).select(head.alias("line"))
    licence = F.lower("line").rlike("licen[cs]e|copyright|rights reserved|public domain")
    return [r["line"] for r in picked.where((F.length("line") > 0) & ~licence).collect()]


def _native_words(line: Column) -> Column:
    return F.filter(F.split(F.lower(line), "[^a-z0-9]+"), lambda w: w != "")


def _native_grams(words: str) -> Column:
    """All n-grams of a word array; those unknown to the model match nothing."""
    w = F.col(words)

    def of(size: int) -> Column:
        places = F.when(F.size(w) >= size, F.sequence(F.lit(1), F.size(w) - (size - 1)))
        whole = F.transform(places, lambda i: F.array_join(F.slice(w, i, size), " "))
        return F.coalesce(whole, F.array().cast("array<string>"))

    return F.array_distinct(F.concat(w, *[of(n) for n in range(2, MAX_WORDS + 1)]))


def _weights_table(spark: SparkSession, model: Model) -> DataFrame:
    rows = [(g, *map(float, w)) for g, w in zip(model.grams, model.weights)]
    names = [f"w{k} double" for k in range(len(model.classes))]
    return spark.createDataFrame(rows, f"gram string, {', '.join(names)}")


def _statements_table(spark: SparkSession) -> DataFrame:
    rows = []
    for family, statements in STATEMENTS.items():
        for number, text in enumerate(statements):
            words = words_of(text)
            rows.append((family, number, sorted(grams_of(words, set(words)))))
    return spark.createDataFrame(rows, "family string, statement int, statement_grams array<string>")


def scan_licences(
    docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per licence paragraph: ``doc_id, paragraph, lines, text, family,
    probability, statement, overlap, confirmed``.

    ``paragraph`` is the number of its first line, from 0, and ``lines`` how many it
    has. Lines in a row are a paragraph of their own where they confirm a family by
    more than any line of theirs does. ``family`` is ``unknown`` where no family is
    sure enough; then nothing is compared or confirmed. Weights (at most as many
    rows as the fitted n-grams) and statements are broadcast; paragraphs meet by their
    own number, so no line that many documents share gathers anywhere.
    """
    require_columns(docs, doc_id, text)
    spark = docs.sparkSession
    paragraphs = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.monotonically_increasing_id().alias("doc"),
        F.split(F.col(text).cast("string"), "\n").alias("all"),
    ).select("doc_id", "doc", F.inline(_paragraphs("all")))
    paragraphs = paragraphs.withColumn("words", _native_words(F.col("text")))
    near = paragraphs.where(F.exists("words", lambda w: w.isin(model.vocabulary))).withColumn(
        "row", F.monotonically_increasing_id()
    )
    count = len(model.classes)
    grams = F.filter(_native_grams("words"), lambda g: g.isin(model.grams))
    keys = ["row", "doc_id", "doc", "paragraph", "lines", "text"]
    features = near.select(*keys, F.explode(grams).alias("gram"))
    summed = (
        features.join(F.broadcast(_weights_table(spark, model)), "gram")
        .groupBy(*keys)
        .agg(*[F.sum(f"w{k}").alias(f"w{k}") for k in range(count)])
    )
    logits = F.array(
        *[(F.col(f"w{k}") + float(model.intercept[k])) / model.temperature for k in range(count)]
    )
    raised = F.transform("logits", lambda x: F.exp(x - F.array_max("logits")))
    total = F.aggregate("raised", F.lit(0.0), lambda a, x: a + x)
    names = F.array(*[F.lit(c) for c in model.classes])
    best = F.col("best")
    judged = (
        summed.withColumn("logits", logits)
        .withColumn("raised", raised)
        .withColumn("probability", F.array_max("raised") / total)
        .withColumn("best", F.element_at(names, F.array_position("raised", F.array_max("raised")).cast("int")))
        .withColumn("family", F.when((best != UNKNOWN) & (F.col("probability") >= model.threshold), best).otherwise(F.lit(UNKNOWN)))
        .where((best != NONE) & ((F.col("lines") == 1) | (F.col("family") != UNKNOWN)))
        .select(*keys, "family", "probability")
    )
    own = _native_grams("own_words")
    compared = (
        judged.withColumn("own_words", _native_words(F.col("text")))
        .withColumn("own", own)
        .join(F.broadcast(_statements_table(spark)), "family", "left")
        .withColumn("overlap", F.size(F.array_intersect("own", "statement_grams")) / F.size("statement_grams"))
    )
    closest = F.max(F.struct(F.coalesce("overlap", F.lit(0.0)).alias("overlap"), (-F.col("statement")).alias("s")))
    confirmed = (
        compared.groupBy(*keys, "family", "probability")
        .agg(closest.alias("closest"))
        .withColumn("overlap", F.col("closest.overlap"))
        .withColumn("confirmed", F.col("overlap") >= CONFIRMED_FROM)
    )
    line = F.when(F.col("lines") == 1, F.struct("paragraph", "overlap"))
    of_document = F.collect_list(line).over(Window.partitionBy("doc", "family"))
    stop = F.col("paragraph") + F.col("lines")
    inside = F.filter("found", lambda x: (x["paragraph"] >= F.col("paragraph")) & (x["paragraph"] < stop))
    by_line = F.array_max(F.transform(inside, lambda x: x["overlap"]))
    more = F.col("confirmed") & (F.col("overlap") > F.coalesce(by_line, F.lit(0.0)))
    kept = confirmed.withColumn("found", of_document).where((F.col("lines") == 1) | more)
    return kept.select(
        "doc_id", "paragraph", "lines", "text", "family", "probability",
        (-F.col("closest.s")).alias("statement"), "overlap", "confirmed",
    )


def _paragraphs(lines: str) -> Column:
    """Every line of an array, and every run of two or more that are not blank:
    ``paragraph, lines, text``."""
    n = F.size(lines)

    def blank(i: Column) -> Column:
        return F.trim(F.get(F.col(lines), i)) == ""

    places = F.when(n > 0, F.sequence(F.lit(0), n - 1))
    begins = F.filter(places, lambda i: ~blank(i) & ((i == 0) | F.coalesce(blank(i - 1), F.lit(True))))
    ends = F.filter(places, lambda i: ~blank(i) & ((i == n - 1) | F.coalesce(blank(i + 1), F.lit(True))))
    runs = F.filter(F.arrays_zip(begins.alias("a"), ends.alias("b")), lambda r: r["b"] > r["a"])

    def entry(first: Column, count: Column, text: Column) -> Column:
        return F.struct(first.alias("paragraph"), count.alias("lines"), text.alias("text"))

    def joined(run: Column) -> Column:
        count = run["b"] - run["a"] + 1
        return entry(run["a"], count, F.array_join(F.slice(F.col(lines), run["a"] + 1, count), "\n"))

    single = F.transform(F.col(lines), lambda line, i: entry(i, F.lit(1), line))
    return F.concat(single, F.transform(runs, joined))
