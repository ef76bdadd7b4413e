"""Licence scans: a trained paragraph classifier with template confirmation.

Paragraphs are cut at blank lines. A paragraph is read by its lines, each alone and each joined with
the words around it (as many as the longest template has), so notices are found however they are
wrapped. Such a unit is a set of word n-grams (one to three words, lower case). A
multinomial logistic regression over the n-grams of known licence notices tells licence families
and an unknown class apart. It is fitted with Spark's machine-learning library on variants of the
notices (words dropped, ordinary text around them) and on a bounded sample of ordinary
paragraphs. A part kept back calibrates it: a temperature for the probabilities, and the family
probability that all but one in a thousand of the kept ordinary paragraphs stay below; what does
not reach it is unknown. A prediction is confirmed by the templates of its family: the paragraph
must hold at least SIMILARITY of the three-word shingles of one, and no notice of a kindred family
(the GPL family, Creative Commons) may be more alike around that line. Bare names ("MIT License")
count as whole lines only.

Scoring is DataFrame functions only. A paragraph without any distinctive word cannot hold enough
shingles of a template (``anchors`` are chosen so), so only the others are cut into n-grams.
Paragraphs are exploded, never gathered by family; every paragraph of every text is covered.

Null and empty texts have no licence. Repeated rows get the same result each, extra columns are
not read, an empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shiplabel.llm.common import hash_sample, text_or_empty, written

GRAMS = 3
SIMILARITY = 0.6
# Ordinary paragraphs of the training sample, variants of each template.
ORDINARY = 4_000
VARIANTS = 24
KEPT_BACK = 4
UNKNOWN = "unknown"

# Short public notices of licence families.
TEMPLATES = {
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
    ],
    "Apache": [
        "Licensed under the Apache License, Version 2.0.",
        "You may not use this file except in compliance with the License. You may obtain a copy of the License at",
    ],
    "GPL": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License",
        "Released under the GNU GPL.",
    ],
    "LGPL": ["Licensed under the GNU Lesser General Public License.", "under the terms of the GNU Lesser General Public License"],
    "AGPL": ["Licensed under the GNU Affero General Public License.", "under the terms of the GNU Affero General Public License"],
    "BSD": [
        "Released under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted",
    ],
    "MPL": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "CC-BY": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA": ["Licensed under CC BY-SA 4.0.", "Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC-BY-NC": ["Licensed under CC BY-NC 4.0.", "Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC0": ["Dedicated to the public domain under CC0 1.0 Universal.", "This is free and unencumbered software released into the public domain."],
    "Proprietary": ["All rights reserved.", "Copyright. All rights reserved. No part may be reproduced without permission."],
}
SPDX = {
    "MIT": ["MIT"], "Apache": ["Apache-2.0"], "GPL": ["GPL"], "LGPL": ["LGPL"], "AGPL": ["AGPL"], "BSD": ["BSD"], "MPL": ["MPL-2.0"],
    "CC-BY": ["CC-BY-4.0"], "CC-BY-SA": ["CC-BY-SA-4.0"], "CC-BY-NC": ["CC-BY-NC-4.0"], "CC0": ["CC0-1.0", "Unlicense"],
}
# Names that are a notice if a line holds nothing else: between the signs for its start and end.
BARE = {
    "MIT": ["MIT License", "The MIT License", "The MIT License (MIT)", "License: MIT"],
    "Apache": ["Apache License", "Apache License 2.0", "Apache License, Version 2.0", "License: Apache 2.0"],
    "GPL": ["GNU General Public License", "GNU GPL", "License: GPL"],
    "LGPL": ["GNU Lesser General Public License", "GNU LGPL", "License: LGPL"],
    "AGPL": ["GNU Affero General Public License", "GNU AGPL", "License: AGPL"],
    "BSD": ["BSD License", "BSD 2-Clause License", "BSD 3-Clause License", "License: BSD"],
    "MPL": ["Mozilla Public License", "Mozilla Public License 2.0", "License: MPL 2.0"],
    "CC-BY": ["CC BY 4.0", "License: CC BY 4.0"],
    "CC-BY-SA": ["CC BY-SA 4.0", "License: CC BY-SA 4.0"],
    "CC-BY-NC": ["CC BY-NC 4.0", "License: CC BY-NC 4.0"],
    "CC0": ["CC0 1.0", "CC0 1.0 Universal", "License: CC0"],
}
START, END = "^", "$"
# Families whose notices share most of their words.
KIN = {"LGPL": "GPL", "AGPL": "GPL", "CC-BY-SA": "CC-BY", "CC-BY-NC": "CC-BY"}
FAMILIES = [*TEMPLATES, UNKNOWN]
# Words that ordinary text holds as well; all other template words are anchors.
COMMON = set(
    "a all and any are at be by can charge except file for form free from in into is it may modify no not obtain of on "
    "or part person program the this to under universal use version with without work you".split()
)


def words_of(text: str) -> list[str]:
    """The words of a template, as ``words`` finds them in a column."""
    return [w for w in "".join(c if c.isalnum() else " " for c in text.lower()).split(" ") if w]


def grams_of(words: list[str], sizes: range = range(1, GRAMS + 1)) -> list[str]:
    return list(dict.fromkeys(" ".join(words[i : i + n]) for n in sizes for i in range(len(words) - n + 1)))


def notices() -> list[tuple[int, list[str], bool]]:
    """(family, words, whether all of them must be there) of every template."""
    out = []
    for k, (family, texts) in enumerate(TEMPLATES.items()):
        out += [(k, words_of(t), False) for t in texts]
        out += [(k, words_of(f"SPDX-License-Identifier: {name}"), False) for name in SPDX.get(family, [])]
        out += [(k, [START, *words_of(t), END], True) for t in BARE.get(family, [])]
    return out


def longest() -> int:
    return max(len(w) for _, w, _ in notices())


def anchors() -> list[str]:
    """Template words such that any SIMILARITY of a template's shingles holds one of them."""
    found = sorted(
        {w for _, ws, _ in notices() for w in ws if w not in COMMON and w not in (START, END) and not w.isdigit() and len(w) > 1}
    )
    for _, ws, _ in notices():
        shingles = grams_of(ws, range(GRAMS, GRAMS + 1))
        bare = sum(not set(s.split()) & set(found) for s in shingles)
        if bare >= SIMILARITY * len(shingles):
            raise ValueError(f"no anchors in {ws!r}")
    return found


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def grams(column: str) -> Column:
    """Distinct n-grams of an array of words."""
    parts = []
    for n in range(1, GRAMS + 1):
        starts = F.when(F.size(column) >= n, F.sequence(F.lit(1), F.size(column) - (n - 1))).otherwise(F.array().cast("array<int>"))
        parts.append(_joined(column, starts, n))
    return F.array_distinct(F.concat(*parts))


def _joined(column: str, starts: Column, n: int) -> Column:
    return F.transform(starts, lambda i: F.array_join(F.slice(column, i, n), " "))


def blocks(text: Column) -> Column:
    """The paragraphs of a text, cut at blank lines."""
    return F.split(text, r"\n(?:[^\S\n]*\n)+")


def candidates(docs: DataFrame) -> DataFrame:
    """doc_id, content, paragraph (number from 0), line, wide and its words, of lines with an anchor, alone and with the words around."""
    pattern = r"(?iu)(?<![\p{L}\p{N}])(?:" + "|".join(anchors()) + r")(?![\p{L}\p{N}])"
    text = text_or_empty()
    paragraphs_ = F.transform(blocks(text), lambda p, i: F.struct(i.alias("paragraph"), p.alias("block")))
    numbered = F.transform("lines", lambda p, i: F.struct(i.alias("line"), p.alias("text")))
    # A line has a word at least, so so many lines hold all words of a notice around this one.
    reach = longest()
    before = words(F.array_join(F.slice("lines", F.greatest(F.col("p.line") - reach, F.lit(0)) + 1, F.least(F.col("p.line"), F.lit(reach))), " "))
    after = words(F.array_join(F.slice("lines", F.col("p.line") + 2, F.lit(reach)), " "))
    alone = F.concat(F.array(F.lit(START)), words(F.col("p.text")), F.array(F.lit(END)))
    around = F.concat(
        F.slice("before", F.greatest(F.size("before") - reach, F.lit(0)) + 1, F.lit(reach)),
        words(F.col("p.text")),
        F.slice("after", 1, reach),
    )
    units = F.array(
        F.struct(F.lit(False).alias("wide"), alone.alias("words")),
        F.when(F.size("lines") > 1, F.struct(F.lit(True).alias("wide"), around.alias("words"))),
    )
    return (
        docs.select("doc_id", F.xxhash64(text).alias("content"), text.alias("text"))
        .where(F.col("text").rlike(pattern))
        .select("doc_id", "content", F.explode(F.filter(paragraphs_, lambda p: p.block.rlike(pattern))).alias("b"))
        .select("doc_id", "content", "b.paragraph", F.split("b.block", "\n").alias("lines"))
        .select("*", F.explode(F.filter(numbered, lambda p: p.text.rlike(pattern))).alias("p"))
        .select("*", before.alias("before"), after.alias("after"))
        .select("doc_id", "content", "paragraph", "p.line", F.explode(F.filter(units, lambda u: u.isNotNull())).alias("u"))
        .select("doc_id", "content", "paragraph", "line", "u.wide", "u.words")
        .distinct()
    )


def vocabulary() -> list[str]:
    return list(dict.fromkeys(g for _, ws, _ in notices() for g in grams_of(ws)))


def training_rows(docs: DataFrame) -> DataFrame:
    """(part, label, grams): variants of the templates in ordinary text, and ordinary paragraphs."""
    spark = docs.sparkSession
    some = hash_sample(docs.select("doc_id", text_or_empty().alias("text")), ["doc_id", "text"], ORDINARY, 13)
    lines = some.select(F.explode(F.split("text", "\n")).alias("line")).distinct()
    shingles = [g for g in vocabulary() if g.count(" ") == GRAMS - 1]
    cut = written(hash_sample(written(lines, "lines"), ["line"], ORDINARY, 17).select(words(F.col("line")).alias("words")), "words")
    number = F.pmod(F.xxhash64("words"), F.lit(VARIANTS * 50)).cast("int")
    # Written before they are filtered: a filter pushed below would cut the line anew for every n-gram.
    ordinary = written(cut.select("words", grams("words").alias("grams"), number.alias("number")), "ordinary")
    # A sampled paragraph that shows a notice is no ordinary one.
    ordinary = ordinary.where(~F.arrays_overlap("grams", F.array(*[F.lit(s) for s in shingles])))
    known = spark.createDataFrame([(k, ws) for k, ws, _ in notices()], "label int, notice array<string>")
    # Each variant drops a share of words of its own and stands in the ordinary words of its number, if any.
    around = ordinary.groupBy("number").agg(F.min("words").alias("around"))
    variants = (
        known.withColumn("variant", F.explode(F.sequence(F.lit(0), F.lit(VARIANTS - 1))))
        .withColumn("number", F.pmod(F.xxhash64("notice", "variant"), F.lit(VARIANTS * 50)).cast("int"))
        .withColumn(
            "notice",
            F.filter(
                "notice", lambda w, i: F.pmod(F.xxhash64(w, i, F.col("variant")), F.lit(100)) >= F.pmod(F.col("variant"), F.lit(6)) * 5
            ),
        )
        .join(around, "number", "left")
        .withColumn("words", F.concat("notice", F.coalesce("around", F.array().cast("array<string>"))))
        .select("label", F.pmod("variant", F.lit(KEPT_BACK)).alias("part"), grams("words").alias("grams"))
    )
    plain = ordinary.select(
        F.lit(len(TEMPLATES)).alias("label"), F.pmod(F.xxhash64("words", F.lit(1)), F.lit(KEPT_BACK)).cast("int").alias("part"), "grams"
    )
    return variants.select("label", "part", "grams").unionByName(plain)


class Model:
    """Weights of n-grams by family, the classes' intercepts, temperature and least family probability."""

    def __init__(self, weights: list[tuple[str, list[float]]], intercepts: list[float], temperature: float, least: float):
        self.weights, self.intercepts, self.temperature, self.least = weights, intercepts, temperature, least


def train(docs: DataFrame) -> Model:
    rows = written(training_rows(docs), "training").coalesce(2)
    known = vocabulary()
    vectors = CountVectorizerModel.from_vocabulary(known, "grams", "features")
    vectors = vectors.setBinary(True).setMinTF(1.0)
    data = vectors.transform(rows)
    # The unknown class always has rows, so that the classes are the same for any table.
    blank = vectors.transform(rows.sparkSession.createDataFrame([(len(TEMPLATES), p, ["-"]) for p in range(KEPT_BACK)], rows.schema))
    data = data.unionByName(blank).coalesce(2).cache()
    fitted = LogisticRegression(regParam=1e-3, maxIter=40, family="multinomial").fit(data.where("part <> 0"))
    kept = fitted.transform(data.where("part = 0")).select("label", vector_to_array("rawPrediction").alias("raw")).collect()
    data.unpersist()

    def chances(raw, temperature):
        top = max(raw)
        e = [math.exp((r - top) / temperature) for r in raw]
        return [x / sum(e) for x in e]

    temperature = min(
        (0.25, 0.35, 0.5, 0.7, 1.0, 1.4, 2.0, 2.8, 4.0),
        key=lambda t: sum(-math.log(max(chances(r["raw"], t)[r["label"]], 1e-12)) for r in kept),
    )
    ordinary = sorted(max(chances(r["raw"], temperature)[:-1]) for r in kept if r["label"] == len(TEMPLATES))
    least = max(0.5, ordinary[min(len(ordinary) - 1, int(0.999 * len(ordinary)))])
    matrix = fitted.coefficientMatrix.toArray()
    return Model(
        [(g, [float(x) for x in matrix[:, i]]) for i, g in enumerate(known)],
        [float(x) for x in fitted.interceptVector.toArray()],
        temperature,
        min(least, 0.99),
    )


def paragraphs(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, content, paragraph, family, probability, similarity of every paragraph that holds a licence."""
    spark: SparkSession = docs.sparkSession
    names = list(range(len(FAMILIES)))
    table = spark.createDataFrame(model.weights, "gram string, w array<double>")
    table = table.select("gram", *[F.col("w")[k].alias(f"w{k}") for k in names])
    shingles = spark.createDataFrame(
        [
            (k, list(TEMPLATES).index(KIN.get(FAMILIES[k], FAMILIES[k])), j, g, len(gs), 1.0 if whole else SIMILARITY)
            for j, (k, ws, whole) in enumerate(notices())
            for gs in [grams_of(ws, range(GRAMS, GRAMS + 1))]
            for g in gs
        ],
        "label int, kin int, template int, gram string, shingles int, least double",
    )
    line = ["doc_id", "content", "paragraph", "line"]
    key = [*line, "wide"]
    found = written(candidates(docs), "paragraphs")
    each = found.select(*key, F.explode(grams("words")).alias("gram"))
    # Vocabulary and templates are constants of this module: a bounded broadcast.
    sums = each.join(F.broadcast(table), "gram").groupBy(*key).agg(*[F.sum(f"w{k}").alias(f"s{k}") for k in names])
    raw = F.array(*[(F.col(f"s{k}") + model.intercepts[k]) / model.temperature for k in names])
    # One row for each candidate paragraph; written, so that later filters meet plain columns.
    marked = written(sums.select(*key, raw.alias("raw")), "scores")
    best = F.array_max(F.slice("raw", 1, len(TEMPLATES)))
    mass = F.aggregate("raw", F.lit(0.0), lambda total, r: total + F.exp(r - F.array_max("raw")))
    predicted = (
        marked.withColumn("label", (F.array_position("raw", best) - 1).cast("int"))
        .withColumn("probability", F.exp(best - F.array_max("raw")) / mass)
        .where(F.col("probability") >= model.least)
        .select(*key, "label", "probability")
    )
    alike = (
        each.join(F.broadcast(shingles), "gram")
        .groupBy(*key, "label", "kin", "template")
        .agg((F.count("*") / F.max("shingles")).alias("similarity"), F.max("least").alias("least"))
        .where(F.col("similarity") >= F.col("least"))
        .groupBy(*key, "label", "kin")
        .agg(F.max("similarity").alias("similarity"))
    )
    alike = written(alike, "alike")
    rivals = alike.groupBy(*line, "kin").agg(F.max("similarity").alias("top"))
    rivals = rivals.select(*[F.col(k).alias(f"{k}_") for k in [*line, "kin"]], "top")
    beside = [F.col(k).eqNullSafe(F.col(f"{k}_")) for k in [*line, "kin"]]
    alike = (
        alike.join(rivals, beside)
        .where(F.col("similarity") >= F.col("top"))
        .select(*[F.col(k).alias(f"{k}_") for k in key], F.col("label").alias("label_"), "similarity")
    )
    same = [F.col(k).eqNullSafe(F.col(f"{k}_")) for k in [*key, "label"]]
    spelt = F.array(*[F.lit(f) for f in FAMILIES])
    return (
        predicted.join(alike, same)
        .groupBy("doc_id", "content", "paragraph", spelt[F.col("label")].alias("family"))
        .agg(F.max("probability").alias("probability"), F.max("similarity").alias("similarity"))
    )


def licences(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """Per document: paragraphs, those with a confirmed licence, the families, the surest probability."""
    model = model or train(docs)
    text = text_or_empty()
    found = (
        paragraphs(docs, model)
        .groupBy("doc_id", "content")
        .agg(
            F.count_distinct("paragraph").alias("n_licensed"),
            F.array_join(F.array_sort(F.collect_set("family")), ",").alias("families"),
            F.max("probability").alias("probability"),
        )
        .withColumnRenamed("doc_id", "id_")
        .withColumnRenamed("content", "content_")
    )
    return (
        docs.select("doc_id", F.xxhash64(text).alias("content"), F.size(blocks(text)).cast("bigint").alias("n_paragraphs"))
        .join(found, F.col("doc_id").eqNullSafe(F.col("id_")) & (F.col("content") == F.col("content_")), "left")
        .select(
            "doc_id",
            "n_paragraphs",
            F.coalesce("n_licensed", F.lit(0).cast("bigint")).alias("n_licensed"),
            F.coalesce("families", F.lit("")).alias("families"),
            F.coalesce("probability", F.lit(0.0)).alias("probability"),
        )
    )
