"""Licence statements in documents, by DataFrame and SQL functions only.

A paragraph (a line, or neighbouring lines up to a blank one; overlapping windows of a long one) is classified by a multinomial logistic regression over the
presence of word 1- and 2-grams of known licence texts; one more class is for everything else. It is trained on altered
licence texts (words left out), on fragments that are too short to name a licence, and on ``SAMPLE_DOCS`` documents of
the corpus. A part of these rows calibrates the probabilities (one temperature) and the level below which a paragraph
counts as unknown. A family with some share of the probability holds only if the paragraph contains at least ``CONFIRM`` of the
word 3-grams of one of its texts and all word pairs that tell that text from others (names, versions); so documents without any such 3-gram need no classification, which is exact and spares the work.

Scoring is one pass over the documents without a shuffle; the model is a few hundred numbers in the plan. A null or
empty text has no paragraphs. Rows that repeat an id are scanned each; other columns are ignored; an empty table gives
no rows (and a model learned from the altered texts alone).
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weirgauge.llm.common import stored

#: Usual notices and first sentences of public licences.
TEXTS = {
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "you may not use this file except in compliance with the License",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License",
    ),
    "GPL-2.0": (
        "This work is licensed under the GNU General Public License, version 2.",
        "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 2 of the License",
    ),
    "LGPL-3.0": (
        "This work is licensed under the GNU Lesser General Public License, version 3.",
        "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License",
    ),
    "LGPL-2.1": (
        "This work is licensed under the GNU Lesser General Public License, version 2.1.",
        "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 2.1 of the License",
    ),
    "AGPL-3.0": (
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License",
    ),
    "BSD-3-Clause": (
        "Licensed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    ),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",),
    "CC-BY-NC-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "CC-BY-NC-ND-4.0": (
        "Licensed under CC BY-NC-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.",
    ),
    "CC-BY-NC-SA-4.0": (
        "Licensed under CC BY-NC-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
    ),
    "CC-BY-ND-4.0": ("Licensed under CC BY-ND 4.0.", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."),
    "BSD-2-Clause": ("Licensed under the BSD 2-Clause License.",),
    "ISC": (
        "Licensed under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    ),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
}
FAMILIES = tuple(TEXTS)
UNKNOWN = len(FAMILIES)
#: Altered copies of each text per class, documents of the corpus that the unknown class learns from, at most.
VARIANTS, SAMPLE_DOCS = 24, 200
#: Longer lines are read by windows of so many words, each beginning half a window after the last.
WINDOW = 48
CONFIRM = 0.6
LEAST_LEVEL = 0.5
#: A family is held against its texts if it has this share of the probability in a paragraph that names some licence.
LEAST_SHARE = 0.05
#: Words that tell licences apart, as do all with a digit; and words that say nothing beside one.
MARKS = {"affero", "apache", "attribution", "bsd", "by", "cc", "clause", "gnu", "isc", "lesser", "mit", "mozilla", "nc", "nd", "noderivatives", "noncommercial", "sa", "sharealike"}
SILENT = {"a", "as", "either", "of", "published", "the", "this", "under"}


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _constant(value: object, kind: str) -> Column:
    """A value of the given type; one literal, which the optimizer evaluates once."""
    return F.from_json(F.lit(json.dumps(value)), kind)


def _strings(values: list[str]) -> Column:
    return _constant(values, "array<string>")


def words(text: Column) -> Column:
    """Lower-cased runs of letters and digits; full stops between digits stay."""
    return F.filter(F.split(F.lower(text), r"(?:[^\p{L}\p{N}.]|(?<![0-9])\.|\.(?![0-9]))+"), lambda w: w != "")


def grams(found: Column, n: int) -> Column:
    """Word n-grams, joined by spaces; those that run over the end are left out."""

    def made(known: Column) -> Column:
        parts = lambda w, i: F.concat_ws(" ", w, *(F.get(known, i + j) for j in range(1, n)))
        return F.slice(F.transform(known, parts), F.lit(1), F.greatest(F.size(known) - n + 1, F.lit(0)))

    return _let(found, made)


def features(found: Column) -> Column:
    return _let(found, lambda known: F.array_distinct(F.concat(known, grams(known, 2))))


def windows(text: Column) -> Column:
    """Words of each paragraph of a text: of each line, and of the lines up to a blank one (or one of signs) together."""
    half = WINDOW // 2

    def cut(line: Column) -> Column:
        last = F.greatest(F.ceil((F.size(line) - half) / F.lit(half)).cast("int") - 1, F.lit(0))
        return F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(line, i * half + 1, F.lit(WINDOW)))

    blocks = F.filter(F.split(text, r"\r?\n[^\p{L}\p{N}\r\n]*\r?\n"), lambda b: F.contains(b, F.lit("\n")))
    parts = F.transform(F.concat(F.split(text, r"[\r\n]+"), blocks), words)
    return F.filter(F.flatten(F.transform(parts, cut)), lambda w: F.size(w) > 0)


@dataclass
class Model:
    vocabulary: list[str]
    weights: list[list[float]]
    bias: list[float]
    temperature: float
    level: float

    def probabilities(self, found: Column) -> Column:
        """Of each family and of the unknown class, for the words of a paragraph."""
        table = _constant(dict(zip(self.vocabulary, self.weights, strict=True)), "map<string, array<double>>")
        present = F.array_intersect(features(found), _strings(self.vocabulary))
        bias = _constant(self.bias, "array<double>")
        z = F.aggregate(present, bias, lambda s, g: F.zip_with(s, F.element_at(table, g), lambda a, b: a + b))

        def softmax(z: Column) -> Column:
            return _let(F.array_max(z), lambda top: F.transform(z, lambda a: F.exp((a - top) / F.lit(self.temperature))))

        def shares(e: Column) -> Column:
            return _let(F.aggregate(e, F.lit(0.0), lambda s, a: s + a), lambda total: F.transform(e, lambda a: a / total))

        return _let(_let(z, softmax), shares)


def _texts(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(i, t) for i, f in enumerate(FAMILIES) for t in TEXTS[f]], "label int, text string").select("label", words(F.col("text")).alias("w"))


def training_rows(docs: DataFrame, seed: int = 0) -> DataFrame:
    """label, w (words), split (a number under 4; rows of 0 calibrate)."""
    copies = _texts(docs.sparkSession).select("*", F.explode(F.sequence(F.lit(0), F.lit(2 * VARIANTS - 1))).alias("copy"))
    # even copies lose up to a sixth of their words; odd ones keep a third, which names no licence
    share = F.when(F.col("copy") % 2 == 0, F.lit(100) - F.col("copy") % 17).otherwise(F.lit(33))
    w = F.filter("w", lambda x, i: F.pmod(F.xxhash64(F.lit(seed), x, i, F.col("copy")), F.lit(100)) < share)
    label = F.when(F.col("copy") % 2 == 0, F.col("label")).otherwise(F.lit(UNKNOWN))
    altered = copies.select(label.alias("label"), w.alias("w"), (F.col("copy") % 8 < 2).alias("held"))
    sample = docs.select("doc_id", "text").orderBy(F.xxhash64(F.lit(seed), "doc_id"), "doc_id").limit(SAMPLE_DOCS)
    lines = sample.select(F.explode(windows(F.coalesce("text", F.lit("")))).alias("w"))
    three = _strings(sorted({g for f in _threes(docs.sparkSession) for t in f for g in t}))
    plain = lines.where(~F.arrays_overlap(grams(F.col("w"), 3), three)).select(F.lit(UNKNOWN).alias("label"), "w", (F.pmod(F.xxhash64("w"), F.lit(4)) == 0).alias("held"))
    return altered.where("size(w) > 0").unionByName(plain)


def _grams(spark: SparkSession, n: int) -> list[list[list[str]]]:
    """Word n-grams of each text of each family."""
    rows = spark.createDataFrame([(i, j, t) for i, f in enumerate(FAMILIES) for j, t in enumerate(TEXTS[f])], "f int, j int, text string")
    made = {(r.f, r.j): r.g for r in rows.select("f", "j", F.array_distinct(grams(words(F.col("text")), n)).alias("g")).collect()}
    return [[made[i, j] for j in range(len(TEXTS[f]))] for i, f in enumerate(FAMILIES)]


def _threes(spark: SparkSession) -> list[list[list[str]]]:
    return _grams(spark, 3)


def _telling(spark: SparkSession) -> list[list[list[str]]]:
    """Word pairs of each text that tell it from others: with a number or one of MARKS, without a silent word."""

    def tells(pair: str) -> bool:
        both = pair.split(" ")
        return not SILENT.intersection(both) and any(w in MARKS or any(map(str.isdigit, w)) for w in both)

    return [[[p for p in pairs if tells(p)] for pairs in texts] for texts in _grams(spark, 2)]


def fit(docs: DataFrame, seed: int = 0) -> Model:
    """Learns and calibrates; the rows are bounded by the constants above."""
    spark = docs.sparkSession
    rows = stored(training_rows(docs, seed), "licence-rows")
    vocabulary = [r.g for r in _texts(spark).select(F.explode(features(F.col("w"))).alias("g")).distinct().orderBy("g").collect()]
    vector = _let(features(F.col("w")), lambda have: F.transform(_strings(vocabulary), lambda v: F.array_contains(have, v).cast("double")))
    matrix = rows.where("not held").select("label", array_to_vector(vector).alias("features"))
    fitted = LogisticRegression(family="multinomial", regParam=1e-3, elasticNetParam=0.1, maxIter=60).fit(matrix)
    by_class = fitted.coefficientMatrix.toArray()
    model = Model(vocabulary, by_class.T.tolist(), fitted.interceptVector.toArray().tolist(), 1.0, LEAST_LEVEL)
    # the temperature with the least loss, then the level above nearly all that is unknown
    held = rows.where("held")
    choices = {t: Model(vocabulary, model.weights, model.bias, t, LEAST_LEVEL) for t in (0.5, 0.7, 1.0, 1.4, 2.0, 3.0)}
    loss = [F.avg(-F.log(F.greatest(F.get(m.probabilities(F.col("w")), F.col("label")), F.lit(1e-12)))).alias(str(i)) for i, m in enumerate(choices.values())]
    found = held.agg(*loss).first()
    best = min(choices, key=lambda t: found[list(choices).index(t)] if found[0] is not None else abs(math.log(t)))
    model.temperature = best
    top = 1 - F.get(model.probabilities(F.col("w")), F.lit(UNKNOWN))
    level = held.where(F.col("label") == UNKNOWN).agg(F.percentile(top, F.lit(0.99)).alias("p")).first().p
    model.level = min(max(LEAST_LEVEL, level or 0.0), 0.9)
    return model


def scan(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, families (confirmed, by name), family (the surest, else null), score (its probability, else 0),
    paragraphs (confirmed), unconfirmed (paragraphs that a licence was predicted for, without a text that confirms it)."""
    listed, telling = _threes(docs.sparkSession), _telling(docs.sparkSession)
    three = _strings(sorted({g for f in listed for t in f for g in t}))
    both = [[{"three": t, "pairs": p} for t, p in zip(*own, strict=True)] for own in zip(listed, telling, strict=True)]
    by_family = _constant(both, "array<array<struct<three: array<string>, pairs: array<string>>>>")

    def judged(w: Column) -> Column:
        return _let(model.probabilities(w), lambda p: F.struct(w.alias("w"), p.alias("p"), (1 - F.get(p, F.lit(UNKNOWN))).alias("some")))

    def confirmed(x: Column) -> Column:
        """The families of the paragraph that one of their texts confirms, with their probabilities."""

        def held(own: Column) -> Column:
            like = lambda t: (F.size(F.array_intersect(own["three"], t["three"])) >= F.lit(CONFIRM) * F.size(t["three"])) & (F.size(F.array_except(t["pairs"], own["pairs"])) == 0)
            likely = F.filter(F.sequence(F.lit(0), F.lit(UNKNOWN - 1)), lambda i: F.get(x["p"], i) >= F.lit(LEAST_SHARE))
            sure = F.filter(likely, lambda i: F.exists(F.get(by_family, i), like))
            return F.transform(sure, lambda i: F.struct(F.get(x["p"], i).alias("score"), F.get(names, i).alias("family")))

        return _let(F.struct(grams(x["w"], 3).alias("three"), grams(x["w"], 2).alias("pairs")), held)

    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", text.alias("_text"), F.arrays_overlap(grams(words(text), 3), three).alias("_some"))
    names = _strings(list(FAMILIES))
    found = F.when(F.col("_some"), F.filter(F.transform(windows(F.col("_text")), judged), lambda x: x["some"] >= F.lit(model.level)))
    nothing = F.array().cast("array<array<struct<score: double, family: string>>>")
    checked = rows.select("doc_id", F.coalesce(F.transform(found, confirmed), nothing).alias("_found"))
    checked = checked.select("*", F.flatten("_found").alias("_sure"))
    best = F.array_max("_sure")
    sure = F.size(F.filter("_found", lambda x: F.size(x) > 0))
    return checked.select(
        "doc_id",
        F.array_sort(F.array_distinct(F.transform("_sure", lambda x: x["family"]))).alias("families"),
        best["family"].alias("family"),
        F.coalesce(best["score"], F.lit(0.0)).alias("score"),
        sure.alias("paragraphs"),
        (F.size("_found") - sure).alias("unconfirmed"),
    )


def scanned(docs: DataFrame) -> DataFrame:
    return scan(docs, fit(docs))
