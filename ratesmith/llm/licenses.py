"""Licence notices: a sparse word n-gram classifier over paragraphs.

A paragraph is a line, or a window of consecutive lines without an empty one
between them, for notices that are wrapped.  Its features are the word pairs and triples that occur in
a list of licence templates.  A multinomial logistic regression is trained on
templates, whole and damaged, against an unknown class of paragraphs from the
documents; its temperature is fitted on samples left out, so that unknown is
calibrated.  A family that it predicts is confirmed by comparison with the
templates: enough of one of its own's n-grams must be there, and no smaller a
share than of any other family's, as sibling licences differ in a few words.

A paragraph without any template n-gram has the bias alone as its score, which
is unknown; so only the few with one are scored.  Everything runs inside the
row; the driver holds a bounded training sample.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratesmith.llm.spans import let, running_before
from ratesmith.session import cut_lineage

UNKNOWN = "unknown"
#: Licence families and notices that name them (fixed values).
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the "
                 "terms of the GNU Affero General Public License as published by the Free Software "
                 "Foundation, either version 3 of the License, or (at your option) any later version."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use "
                   "this file except in compliance with the License."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are "
            "permitted provided that the following conditions are met"),
    ("BSD", "Released under the BSD License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 "
                     "International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 "
                     "International License."),
    ("CC0-1.0", "This work is dedicated to the public domain under CC0 1.0 Universal."),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the "
                "Eclipse Public License 2.0"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the "
                "terms of the GNU General Public License as published by the Free Software Foundation; "
                "either version 2 of the License, or (at your option) any later version."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the "
                "terms of the GNU General Public License as published by the Free Software Foundation, "
                "either version 3 of the License, or (at your option) any later version."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
            "without fee is hereby granted"),
    ("LGPL", "This library is free software; you can redistribute it and/or modify it under the terms "
             "of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
            "software and associated documentation files, to deal in the Software without restriction"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("proprietary", "Copyright. All rights reserved. No part may be reproduced without permission."),
)
FAMILIES = tuple(sorted({family for family, _ in TEMPLATES}))
#: Unknown paragraphs in the training sample, and damaged copies of each
#: template, of which every third calibrates.
MAX_UNKNOWN, COPIES = 2_000, 24
STEPS, RATE, RIDGE = 400, 0.2, 1e-3
#: Calibrated probability, and share of a template's n-grams, that a family needs.
MIN_PROBABILITY, MIN_CONTAINED = 0.5, 0.6
#: Share of a template's n-grams that a window's lines must hold, each by
#: itself, before it is looked at: lines of two words keep about a quarter.
MIN_APART = 0.2


def _grams(words: Sequence[str]) -> set[str]:
    return {" ".join(words[i:i + n]) for n in (2, 3) for i in range(len(words) - n + 1)}


def _words(text: str) -> list[str]:
    lower = "".join(c.lower() if c.isascii() and c.isalnum() else " " for c in text)
    return lower.split()


#: n-grams of each template, and all of them: the model's features.
TEMPLATE_GRAMS = tuple((family, frozenset(_grams(_words(text)))) for family, text in TEMPLATES)
VOCABULARY = tuple(sorted(set().union(*[grams for _, grams in TEMPLATE_GRAMS])))
#: Words of the longest template: what a window holds after its first line.
LONGEST = max(len(_words(text)) for _, text in TEMPLATES)
_NOTICES = "array<struct<start:int,end:int,family:string,probability:double>>"


def _strings(values: Sequence[str]) -> Column:
    """Constant array of strings without commas."""
    return F.split(F.lit(",".join(values)), ",")


def line_grams(line: Column) -> Column:
    """The line's distinct word pairs and triples that are features; triples
    are looked for only behind a pair, of which every triple has one."""
    words = F.filter(F.split(F.lower(line), "[^a-z0-9]+"), lambda w: w != "")
    known = _strings(VOCABULARY)

    def joined(w: Column, n: int) -> Column:
        out = F.slice(w, F.lit(1), F.greatest(F.size(w) - n + 1, F.lit(0)))
        for k in range(1, n):
            out = F.zip_with(out, F.slice(w, F.lit(k + 1), F.greatest(F.size(w) - n + 1, F.lit(0))),
                             lambda a, b: F.concat(a, F.lit(" "), b))
        return out

    return let(words, lambda w: let(F.array_intersect(joined(w, 2), known), lambda pairs: F.when(
        F.size(pairs) == 0, pairs).otherwise(F.concat(pairs, F.array_intersect(joined(w, 3), known)))))


@dataclass
class LicenceModel:
    """Weights (feature x class), biases and temperature; the last class is unknown."""

    weights: np.ndarray
    bias: np.ndarray
    temperature: float


def _damaged(words: list[str], seed: int) -> list[str]:
    """A copy with some words lost or replaced, or cut short; the first whole."""
    rng = np.random.default_rng(seed)
    if seed % COPIES == 0:
        return words
    keep = [w if rng.random() > 0.06 else "x" for w in words if rng.random() > 0.06]
    return keep[:max(3, int(len(keep) * rng.uniform(0.75, 1.0)))]


def train(unknown: Sequence[Sequence[str]]) -> LicenceModel:
    """Fit on damaged templates and on unknown paragraphs' features."""
    index = {g: i for i, g in enumerate(VOCABULARY)}
    rows: list[tuple[list[int], int]] = []
    for t, (family, text) in enumerate(TEMPLATES):
        for copy in range(COPIES):
            grams = _grams(_damaged(_words(text), t * COPIES + copy))
            rows.append((sorted(index[g] for g in grams if g in index), FAMILIES.index(family)))
    rows += [([], len(FAMILIES))] * COPIES
    rows += [(sorted(index[g] for g in grams), len(FAMILIES)) for grams in unknown]
    x = np.zeros((len(rows), len(VOCABULARY)), np.float32)
    for r, (hits, _) in enumerate(rows):
        x[r, hits] = 1
    y = np.eye(len(FAMILIES) + 1, dtype=np.float32)[[label for _, label in rows]]
    left_out = np.arange(len(rows)) % 3 == 2
    w, b = np.zeros((x.shape[1], y.shape[1]), np.float32), np.zeros(y.shape[1], np.float32)
    fit_x, fit_y = x[~left_out], y[~left_out]
    for _ in range(STEPS):
        z = fit_x @ w + b
        p = np.exp(z - z.max(axis=1, keepdims=True))
        d = (p / p.sum(axis=1, keepdims=True) - fit_y) / len(fit_x)
        w -= RATE * 20 * (fit_x.T @ d + RIDGE * w / len(VOCABULARY))
        b -= RATE * d.sum(axis=0) * 5
    z = x[left_out] @ w + b

    def loss(t: float) -> float:
        s = z / t - (z / t).max(axis=1, keepdims=True)
        return float((np.log(np.exp(s).sum(axis=1)) - (s * y[left_out]).sum(axis=1)).mean())

    return LicenceModel(w, b, min((0.25 * 1.2 ** k for k in range(20)), key=loss))


def _best(grams: Column, model: LicenceModel) -> Column:
    """(family, probability) of a paragraph's features; unknown if that wins."""
    known = _strings(VOCABULARY)
    classes = (*FAMILIES, UNKNOWN)

    def score(hits: Column, c: int) -> Column:
        weights = _strings([f"{v:.5f}" for v in model.weights[:, c]]).cast("array<double>")
        z = F.aggregate(hits, F.lit(float(model.bias[c])), lambda t, i: t + F.get(weights, i))
        return z / model.temperature

    hits = F.transform(grams, lambda g: (F.array_position(known, g) - 1).cast("int"))
    return let(hits, lambda h: let(F.array(*[score(h, c) for c in range(len(classes))]), lambda z: let(
        F.aggregate(F.transform(z, lambda v: F.exp(v - F.array_max(z))), F.lit(0.0),
                    lambda a, v: a + v),
        lambda total: F.struct(
            F.get(F.array(*[F.lit(c) for c in classes]),
                  (F.array_position(z, F.array_max(z)) - 1).cast("int")).alias("family"),
            (1 / total).alias("probability")))))


def _contained(grams: Column, template: frozenset[str]) -> Column:
    return F.size(F.array_intersect(grams, _strings(sorted(template))))


def _confirmed(family: Column, grams: Column) -> Column:
    """How many n-grams of the family's best template the paragraph holds; null
    if they are too few, or a smaller share than of another family's."""
    shares = F.array(*[F.struct(
        (_contained(grams, template) / len(template)).alias("share"), F.lit(len(template)).alias("size"),
        F.lit(name).alias("family")) for name, template in TEMPLATE_GRAMS])
    return let(shares, lambda all_: let(
        F.array_max(F.filter(all_, lambda t: t["family"] == family)), lambda own: F.when(
            (own["share"] >= MIN_CONTAINED) & ~F.exists(all_, lambda t: t["share"] > own["share"]),
            F.round(own["share"] * own["size"]).cast("int"))))


def _windows(lines: Column, grams: Column, starts: Column, free: Column) -> Column:
    """(first line, lines, start, end, grams) of all windows of two lines or
    more that begin at a free line with features, hold free lines only (not
    empty, no notice) and whose lines between first and last are short of
    LONGEST words."""
    words = F.transform(lines, lambda t: F.size(F.filter(F.split(F.lower(t), "[^a-z0-9]+"), lambda w: w != "")))

    def promising(i: Column, k: Column) -> Column:
        held = F.array_distinct(F.flatten(F.slice(grams, i + 1, k)))
        return let(held, lambda g: F.when(F.size(g) < 2, False).otherwise(F.greatest(
            *[_contained(g, t) / len(t) for _, t in TEMPLATE_GRAMS]) >= MIN_APART))

    def of(i: Column, w: Column) -> Column:
        reach = F.aggregate(
            F.slice(w, i + 2, F.lit(LONGEST + 1)), F.struct(F.lit(0).alias("k"), F.lit(0).alias("n"), F.lit(True).alias("on")),
            lambda a, n: let(a["on"] & (a["n"] < LONGEST) & (n > 0) & F.get(free, i + 1 + a["k"]), lambda go: F.struct(
                F.when(go, a["k"] + 1).otherwise(a["k"]).alias("k"), (a["n"] + n).alias("n"), go.alias("on"))))["k"]
        return let(reach, lambda k: F.when((k < 1) | ~promising(i, k + 1), F.array().cast("array<int>")).otherwise(
            F.transform(F.sequence(F.lit(2), k + 1), lambda x: x.cast("int"))))

    firsts = F.filter(F.sequence(F.lit(0), F.size(lines) - 1),
                      lambda i: F.get(free, i) & (F.size(F.get(grams, i)) > 0))
    return let(words, lambda w: F.flatten(F.transform(firsts, lambda i: F.transform(of(i, w), lambda k: F.struct(
        i.alias("line"), k.alias("lines"), F.get(starts, i).alias("start"),
        (F.get(starts, i + k - 1) + F.length(F.get(lines, i + k - 1))).alias("end"),
        line_grams(F.array_join(F.slice(lines, i + 1, k), " ")).alias("grams"))))))


def scan_licences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Return doc_id and notices: an array of (start, end, family, probability).

    One entry per line, or window of other lines, that is a licence notice; of
    windows that overlap, the one with most of its template, then the shortest.
    Offsets are code points, the end exclusive.  Null texts count as empty; null ids and repeated rows are
    kept; other columns are ignored; an empty table gives an empty result.
    """
    lines = (docs.select(F.col(id_col).alias("doc_id"),
                         F.split(F.coalesce(F.col(text_col), F.lit("")), "\n", -1).alias("lines"))
             .withColumn("grams", F.transform("lines", line_grams))
             .withColumn("hit", F.exists("grams", lambda g: F.size(g) > 0)))
    # n-grams are looked for once: lines are kept of documents that have any
    lines = cut_lineage(lines.select("doc_id", F.when(F.col("hit"), F.col("lines")).alias("lines"),
                                     F.when(F.col("hit"), F.col("grams")).alias("grams")))
    # unknown paragraphs with some template n-gram, but not enough of any; the
    # cut keeps the comparison with templates behind the aggregate
    held = F.filter("grams", lambda g: F.size(g) > 0)
    some = cut_lineage(lines.filter(F.col("grams").isNotNull()).select(F.explode_outer(held).alias("grams"))
                       .groupBy("grams").agg(F.count(F.lit(1)).alias("n")))
    strange = F.lit(True)
    for _, template in TEMPLATE_GRAMS:
        strange = strange & (F.size(F.array_intersect("grams", _strings(sorted(template)))) < MIN_CONTAINED * len(template))
    unknown = [r["grams"] for r in some.filter(strange).orderBy(F.xxhash64("grams"), "grams")
               .limit(MAX_UNKNOWN).toLocalIterator()]
    model = train(unknown)

    def judge(s: Column) -> Column:
        best = F.when(F.size(s["grams"]) > 0, let(_best(s["grams"], model), lambda b: F.when(
            (b["family"] != UNKNOWN) & (b["probability"] >= MIN_PROBABILITY), b)))
        return let(best, lambda b: F.when(b.isNotNull(), let(_confirmed(b["family"], s["grams"]), lambda c: F.when(
            c.isNotNull(), F.struct(s["start"].alias("start"), s["end"].alias("end"), b["family"].alias("family"),
                                    b["probability"].alias("probability"), c.alias("shared"))))))

    def plain(found: Column) -> Column:
        return F.transform(found, lambda s: F.struct(
            s["start"].alias("start"), s["end"].alias("end"), s["family"].alias("family"),
            s["probability"].alias("probability")))

    def strongest(found: Column) -> Column:
        return F.filter(found, lambda s: ~F.exists(found, lambda o: (
            (o["start"] < s["end"]) & (s["start"] < o["end"])
            & ((o["shared"] > s["shared"]) | ((o["shared"] == s["shared"]) & (
                (o["end"] - o["start"] < s["end"] - s["start"])
                | ((o["end"] - o["start"] == s["end"] - s["start"]) & (o["start"] < s["start"]))))))))

    none = F.array().cast(_NOTICES)
    sizes = F.transform("lines", lambda p: F.length(p) + 1)
    any_hit = F.col("grams").isNotNull()
    alone = F.when(any_hit, F.zip_with(F.zip_with("starts", "lines", lambda a, t: F.struct(
        a.alias("start"), (a + F.length(t)).alias("end"))), F.col("grams"), lambda p, g: judge(F.struct(
            p["start"].alias("start"), p["end"].alias("end"), g.alias("grams")))))
    free = F.transform("alone", lambda a: a.isNull())
    apart = let(F.array_distinct(F.flatten(F.zip_with("grams", "alone", lambda g, a: F.when(
        a.isNull(), g).otherwise(F.slice(g, 1, 0))))), lambda g: F.greatest(
            *[_contained(g, t) / len(t) for _, t in TEMPLATE_GRAMS]) >= MIN_APART)
    wrapped = F.when(any_hit, F.when(apart, let(free, lambda f: let(
        F.filter(F.transform(_windows(F.col("lines"), F.col("grams"), F.col("starts"), f), judge),
                 lambda s: s.isNotNull()), lambda found: plain(strongest(found))))))
    return (lines.withColumn("starts", F.when(any_hit, running_before(sizes))).withColumn("alone", alone)
            .withColumn("wrapped", F.coalesce(wrapped, none))
            .select("doc_id", F.coalesce(F.array_sort(F.concat(plain(F.filter(
                "alone", lambda s: s.isNotNull())), "wrapped")), none).alias("notices")))
