"""Licence scan: a trained paragraph classifier, an unknown class, and templates that confirm.

Paragraphs are the lines of a text, and runs of neighbouring lines without a blank one between, since
notices are wrapped: from each line on as far as the longest template may reach. Word unigrams and bigrams of the templates below are the
features of a sparse multinomial logistic regression over licence families and ``unknown``. It is
trained on the driver from variations of the templates, on scrambled and single template words, and
on a bounded sample of the corpus's own lines as ``unknown``, of which the driver gets template words
and grams only; its probability cut is calibrated on variations it has not seen. A prediction stands only if enough of one template of that family occurs
in the paragraph. Of overlapping paragraphs the one that holds most of its template stands, of equal
ones the shortest; another stands beside it only with another family and template words of its own.

Scanning is one expression per text, without a shuffle. A line without any word that carries a
feature has the score of an empty line, which is ``unknown``, so only the other lines are scored; runs only in a text that has enough bigrams of some
template, and of those only what a shorter run cannot say as well: a run whose first or last line adds
no telling word and no template bigram has the same prediction and the same share of a template as the
run without that line, which would stand in its place. Comment marks are no words, and a line without
words is blank.

Edge cases: NULL and empty texts have no licences; repeated rows are scanned one by one; an empty
table gives no rows (and no corpus lines to train on, which is fine); other columns are not looked
at; lines of any length are scanned whole.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.common import let

# Usual wording of licence notices, by family.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Released under the BSD License.",
        "Use of this source code is governed by a BSD-style license",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "cc-by": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "cc-by-nc": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "cc-by-sa": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "cc0": (
        "To the extent possible under law, the author has waived all copyright and related rights to this work",
        "Released under CC0 1.0 Universal, dedicated to the public domain.",
    ),
    "gpl": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ),
    "lgpl": (
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
    ),
    "mit": (
        "Released under the MIT License.",
        "Licensed under the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "SPDX-License-Identifier: MIT",
    ),
    "mpl-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "proprietary": (
        "All rights reserved.",
        "Copyright the authors. All rights reserved.",
        "This document is confidential and proprietary; unauthorized copying is prohibited.",
    ),
}
UNKNOWN = "unknown"
STOP = frozenset("a all an and any are as at be by can for from in is it may not of on or that the this to under use with you".split())
CONFIRM = 0.6  # share of a template's bigrams that must occur
REACH = 2 * max(len(re.findall("[a-z0-9]+", t.lower())) for ts in TEMPLATES.values() for t in ts)  # words a wrapped notice may take
MAX_CORPUS_LINES = 2000  # bound of the corpus sample that is learnt as unknown
VARIATIONS = 24  # of each template; a quarter of them calibrates
HEAD = 12  # words of a corpus line that may stand beside a variation
OTHER = "~"
EPOCHS = 200
L1, STEP = 2e-4, 1.0


def words(text: str) -> list[str]:
    return [w for w in re.split("[^a-z0-9]+", text.lower()) if w]


def grams(ws: list[str]) -> set[str]:
    """Features of a line: telling words, and bigrams with one at least."""
    pairs = (f"{a} {b}" for a, b in zip(ws, ws[1:]) if a not in STOP or b not in STOP)
    return {w for w in ws if w not in STOP} | set(pairs)


def _all_pairs(template: str) -> list[str]:
    ws = words(template)
    return sorted({f"{a} {b}" for a, b in zip(ws, ws[1:])})


_TEMPLATE_LINES = [t for ts in TEMPLATES.values() for t in ts]
_TEMPLATE_WORDS = sorted({w for t in _TEMPLATE_LINES for w in words(t)})
_TEMPLATE_PAIRS = sorted({p for t in _TEMPLATE_LINES for p in _all_pairs(t)})
_TEMPLATE_GRAMS = sorted({g for t in _TEMPLATE_LINES for g in grams(words(t))})
_WHOLE = sorted({" ".join(words(t)) for t in _TEMPLATE_LINES})


@dataclass(frozen=True)
class Evidence:
    """What training uses of a line; its size does not depend on the line's.

    ``head`` are its first words, ``OTHER`` for those of no template; ``grams`` its template grams;
    ``notice`` says that it holds a template, or is mostly a part of one, as lines of wrapped notices are.
    """

    head: tuple[str, ...]
    grams: frozenset[str]
    notice: bool


@dataclass
class LicenseModel:
    families: list[str]
    weights: dict[str, list[float]]  # by feature, one per family and unknown; zero rows left out
    bias: list[float]
    cut: float

    @property
    def telling(self) -> list[str]:
        return sorted({w for g in self.weights for w in g.split(" ") if w not in STOP})


def train(corpus: list[Evidence], seed: int = 0) -> LicenseModel:
    """Proximal gradient descent on variations of the templates, and calibration of the cut."""
    random = np.random.default_rng(seed)
    families = [*TEMPLATES, UNKNOWN]
    corpus = corpus or [Evidence((OTHER,) * 4, frozenset(), False)]
    rows: list[tuple[set[str] | frozenset[str], int, bool]] = []
    for f, family in enumerate(TEMPLATES):
        for template in TEMPLATES[family]:
            ws = words(template)
            for v in range(VARIATIONS):
                cut = int(random.integers(0, len(ws) // 4 + 1)) if v and len(ws) > 6 else 0
                kept = ws[: len(ws) - cut]
                extra = list(corpus[int(random.integers(len(corpus)))].head[: int(random.integers(0, HEAD))]) if v % 3 == 1 else []
                rows.append((grams((extra + kept) if v % 2 else (kept + extra)), f, v % 4 == 3))
    telling = sorted({w for t in TEMPLATES.values() for x in t for w in words(x) if w not in STOP})
    none = len(families) - 1
    rows += [({w}, none, False) for w in telling] + [(set(), none, False)]
    for i in range(800):
        picked = [str(w) for w in random.choice(telling, int(random.integers(2, 6)))]
        rows.append((grams(picked), none, i % 4 == 3))
    rows += [(line.grams, none, i % 4 == 3) for i, line in enumerate(x for x in corpus if not x.notice)]

    names = _TEMPLATE_GRAMS
    at = {g: i for i, g in enumerate(names)}
    x = np.zeros((len(rows), len(names)), dtype=np.float32)
    for i, (own, _, _) in enumerate(rows):
        x[i, [at[g] for g in own if g in at]] = 1
    y = np.array([r[1] for r in rows])
    held = np.array([r[2] for r in rows])
    hot = np.eye(len(families), dtype=np.float32)[y]
    class_weight = (1 / np.maximum(1, np.bincount(y[~held], minlength=len(families))))[y].astype(np.float32)
    class_weight /= class_weight[~held].sum()
    w, b = np.zeros((len(names), len(families)), np.float32), np.zeros(len(families), np.float32)

    def probabilities(rows_x):
        z = rows_x @ w + b
        z = np.exp(z - z.max(1, keepdims=True))
        return z / z.sum(1, keepdims=True)

    xt, ht, ct = x[~held], hot[~held], class_weight[~held][:, None]
    for _ in range(EPOCHS):
        error = (probabilities(xt) - ht) * ct
        w -= STEP * len(families) * (xt.T @ error)
        b -= STEP * len(families) * error.sum(0)
        w = np.sign(w) * np.maximum(0, np.abs(w) - STEP * L1)  # what keeps the weights sparse
    p = probabilities(x[held])
    top = p[:, :none].max(1)
    right = (y[held] != none) & (p.argmax(1) == y[held])
    wrong = y[held] == none
    # Calibration: as low as lets one held-out unknown line in a thousand through, at most one half.
    ceiling = np.quantile(top[wrong], 0.999) if wrong.any() else 0.0
    floor = np.quantile(top[right], 0.01) if right.any() else 1.0
    cut = float(min(0.5, floor) if ceiling < floor else min(0.9, ceiling))
    weights = {g: [round(float(v), 6) for v in w[i]] for g, i in at.items() if np.abs(w[i]).max() > 1e-6}
    return LicenseModel(families, weights, [round(float(v), 6) for v in b], cut)


def _line_words(line: Column) -> Column:
    return F.array_remove(F.split(F.lower(line), "[^a-z0-9]+", -1), "")


def _pairs(ws: Column) -> Column:
    return F.zip_with(
        F.slice(ws, 1, F.greatest(F.size(ws) - 1, F.lit(0))),
        F.slice(ws, 2, F.greatest(F.size(ws) - 1, F.lit(0))),
        lambda a, b: F.concat_ws(" ", a, b),
    )


def licenses_of(text: Column, model: LicenseModel) -> Column:
    """Array of (line, family, probability, confirmed, notice) for lines with any telling word.

    ``family`` is ``unknown`` below the cut; ``notice`` says that some family is likelier than none. A
    wrapped notice is one entry, at its first line.
    """
    lines = F.split(F.coalesce(text, F.lit("")), "\n", -1)
    placed = F.transform(lines, lambda x, i: F.struct(i.alias("line"), _line_words(x).alias("ws")))
    telling = model.telling
    features = sorted(model.weights)
    table = F.from_json(F.lit(json.dumps(model.weights)), "map<string,array<double>>")
    bias = F.array(*[F.lit(v) for v in model.bias])
    names = F.array(*[F.lit(f) for f in model.families])
    pairs = {f: [_all_pairs(t) for t in ts] for f, ts in TEMPLATES.items()}
    templates = F.from_json(F.lit(json.dumps(pairs)), "map<string,array<array<string>>>")
    every = F.from_json(F.lit(json.dumps([t for ts in pairs.values() for t in ts])), "array<array<string>>")
    says = sorted({*telling, *_TEMPLATE_PAIRS})

    def fits(template: Column, content: Column) -> Column:
        return F.size(F.array_intersect(template, content)) >= CONFIRM * F.size(template)

    def content_of(ws: Column) -> Column:
        """The telling words and template bigrams of a sequence of words."""
        return F.array_distinct(F.filter(F.concat(ws, _pairs(ws)), lambda g: g.isin(says)))

    def scored(start: Column, content: Column) -> Column:
        hits = F.transform(F.filter(content, lambda g: g.isin(features)), lambda g: F.try_element_at(table, g))
        return F.aggregate(hits, start, lambda acc, v: F.zip_with(acc, v, lambda a, c: a + c))

    def judged(line: Column, last: Column, scores: Column, content: Column) -> Column:
        def decide(z: Column) -> Column:
            best = F.array_max(z)
            total = F.aggregate(z, F.lit(0.0), lambda acc, v: acc + F.exp(v - best))
            chance = F.lit(1.0) / total
            family = F.get(names, (F.array_position(z, best) - 1).cast("int"))
            sure = F.when(chance >= model.cut, family).otherwise(UNKNOWN)
            notice = family != UNKNOWN
            near = F.transform(
                F.coalesce(F.try_element_at(templates, sure), F.array().cast("array<array<string>>")),
                lambda t: let(
                    F.array_intersect(t, content),
                    lambda own: F.struct((F.size(own) / F.size(t)).alias("share"), own.alias("own")),
                ),
            )
            return let(
                F.array_max(near),
                lambda m: F.struct(
                    F.coalesce(-m["share"], F.lit(0.0)).alias("lack"),
                    (last - line).alias("more"),
                    line.alias("line"),
                    last.alias("last"),
                    sure.alias("family"),
                    chance.alias("probability"),
                    F.coalesce(m["share"] >= CONFIRM, F.lit(False)).alias("confirmed"),
                    notice.alias("notice"),
                    m["own"].alias("own"),
                ),
            )

        return let(scores, decide)

    def marked(p: Column) -> Column:
        """Lines with what they say: ``inner`` of their own, ``join`` together with the line before."""

        def mark(x: Column) -> Column:
            before = F.get(p, x["line"] - 1)["ws"]
            joint = F.concat_ws(" ", F.get(before, F.size(before) - 1), F.get(x["ws"], F.lit(0)))
            return F.struct(
                x["line"].alias("line"),
                x["ws"].alias("ws"),
                content_of(x["ws"]).alias("inner"),
                F.filter(F.array(joint), lambda g: g.isin(_TEMPLATE_PAIRS)).alias("join"),
            )

        return F.transform(p, mark)

    def runs(q: Column, start: Column) -> Column:
        """The runs of two lines and more from a line on whose last line adds something, as ``made``; all they say."""
        # A long line enters with its words next to the rest of the run.
        cut = F.size(start["ws"]) > REACH
        first = F.when(cut, content_of(F.slice(start["ws"], -REACH, REACH))).otherwise(start["inner"])
        begin = let(
            first,
            lambda c: F.struct(
                F.lit(0).alias("n"),
                scored(bias, c).alias("scores"),
                c.alias("content"),
                F.array().cast("array<struct<last:int,scores:array<double>,content:array<string>>>").alias("made"),
            ),
        )

        def longer(acc: Column, x: Column) -> Column:
            own = F.when(F.size(x["ws"]) > REACH, content_of(F.slice(x["ws"], 1, REACH))).otherwise(x["inner"])

            def grown(fresh: Column) -> Column:
                n = (acc["n"] + F.size(x["ws"])).alias("n")
                # A cut first line with another is not that line alone with more, so it stays.
                tells = (F.size(fresh) > 0) | (cut & (x["line"] == start["line"] + 1))

                def taken(run: Column) -> Column:
                    made = F.concat(acc["made"], F.array(run))
                    return F.struct(n, run["scores"].alias("scores"), run["content"].alias("content"), made.alias("made"))

                run = F.struct(
                    x["line"].alias("last"),
                    scored(acc["scores"], fresh).alias("scores"),
                    F.concat(acc["content"], fresh).alias("content"),
                )
                same = F.struct(n, *[acc[c].alias(c) for c in ("scores", "content", "made")])
                return F.when(tells, let(run, taken)).otherwise(same)

            ended = F.struct(F.lit(REACH).alias("n"), *[acc[c].alias(c) for c in ("scores", "content", "made")])
            fresh = F.array_except(F.concat(own, x["join"]), acc["content"])
            return F.when(acc["n"] >= REACH, acc).when(F.size(x["ws"]) == 0, ended).otherwise(let(fresh, grown))

        return F.aggregate(F.slice(q, start["line"] + 2, REACH), begin, longer)

    def explained(by: Column, x: Column) -> Column:
        overlap = (by["line"] <= x["last"]) & (x["line"] <= by["last"])
        return overlap & ((by["family"] == x["family"]) | (F.size(F.array_except(x["own"], by["own"])) == 0))

    def wrapped(q: Column, likely: Column, lines_judged: Column) -> Column:
        """Confirmed runs, without those that a line explains which holds a whole template: such a line always stands."""

        def begins(x: Column) -> Column:
            """Whether a line adds something to the next one, or the next is so long that runs hold a part of it."""
            after = F.get(q, x["line"] + 1)
            adds = F.size(F.array_except(F.concat(x["inner"], after["join"]), after["inner"])) > 0
            return (F.size(x["ws"]) > 0) & (F.size(after["ws"]) > 0) & (adds | (F.size(after["ws"]) > REACH))

        def by_whole(j: Column) -> Column:
            own = F.slice(lines_judged, j["line"] + 1, j["last"] - j["line"] + 1)
            return F.exists(own, lambda x: x.isNotNull() & x["confirmed"] & (x["lack"] == -1.0) & explained(x, j))

        def of(start: Column) -> Column:
            return let(
                runs(q, start),
                lambda r: F.when(
                    (F.size(r["made"]) > 0) & F.exists(likely, lambda t: fits(t, r["content"])),
                    F.filter(
                        F.transform(
                            F.filter(r["made"], lambda m: F.exists(likely, lambda t: fits(t, m["content"]))),
                            lambda m: judged(start["line"], m["last"], m["scores"], m["content"]),
                        ),
                        lambda j: j["confirmed"] & ~by_whole(j),
                    ),
                ),
            )

        return F.flatten(F.filter(F.transform(F.filter(q, begins), of), lambda x: x.isNotNull()))

    def groups(found: Column) -> Column:
        """Entries by line, apart where none overlaps the next."""
        none = F.slice(found, 1, 0)
        begin = F.struct(F.slice(F.array(found), 1, 0).alias("done"), none.alias("open"), F.lit(-1).alias("reach"))

        def add(acc: Column, x: Column) -> Column:
            entry = F.array(x["entry"])
            return F.when(
                x["line"] > acc["reach"],
                F.struct(F.concat(acc["done"], F.array(acc["open"])).alias("done"), entry.alias("open"), x["entry"]["last"].alias("reach")),
            ).otherwise(
                F.struct(
                    acc["done"].alias("done"),
                    F.concat(acc["open"], entry).alias("open"),
                    F.greatest(acc["reach"], x["entry"]["last"]).alias("reach"),
                )
            )

        by_line = F.array_sort(F.transform(found, lambda x: F.struct(x["line"].alias("line"), x.alias("entry"))))
        return F.aggregate(by_line, begin, add, lambda acc: F.concat(acc["done"], F.array(acc["open"])))

    def settled(single: Column, wide: Column) -> Column:
        """What stands of lines and runs that overlap."""

        def standing(group: Column) -> Column:
            return F.aggregate(
                F.array_sort(group),
                F.slice(group, 1, 0),
                lambda acc, x: F.when(F.exists(acc, lambda by: explained(by, x)), acc).otherwise(F.concat(acc, F.array(x))),
            )

        def with_rest(found: Column, runs_found: Column) -> Column:
            inside = lambda x: F.exists(runs_found, lambda by: x["line"].between(by["line"], by["last"]))
            rest = F.filter(single, lambda x: ~x["confirmed"] & ~inside(x))
            return F.array_sort(F.transform(F.concat(found, rest), shown))

        confirmed = F.concat(F.filter(single, lambda j: j["confirmed"]), wide)
        stand = F.flatten(F.transform(let(confirmed, groups), standing))
        return let(
            stand, lambda found: let(F.filter(found, lambda by: by["last"] > by["line"]), lambda r: with_rest(found, r))
        )

    def shown(j: Column) -> Column:
        return F.struct(*[j[c].alias(c) for c in ("line", "family", "probability", "confirmed", "notice")])

    def scanned(p: Column) -> Column:
        def line(x: Column) -> Column:
            scores = lambda c: judged(x["line"], x["line"], scored(bias, c), c)
            return F.when(F.exists(x["ws"], lambda w: w.isin(telling)), let(content_of(x["ws"]), scores))

        def with_runs(each: Column, one: Column, q: Column) -> Column:
            said = F.array_distinct(F.flatten(F.transform(q, lambda x: F.concat(x["inner"], x["join"]))))
            return let(
                let(said, lambda c: F.filter(every, lambda t: fits(t, c))),
                lambda likely: F.when(F.size(likely) > 0, settled(one, wrapped(q, likely, each))).otherwise(F.transform(one, shown)),
            )

        def of(each: Column, one: Column) -> Column:
            return F.when(F.size(one) > 0, let(marked(p), lambda q: with_runs(each, one, q))).otherwise(F.transform(one, shown))

        return let(
            F.transform(p, line),
            lambda each: let(F.filter(each, lambda x: x.isNotNull()), lambda one: of(each, one)),
        )

    return let(placed, scanned)


def _sampled(docs: DataFrame, text: str) -> DataFrame:
    """Lines ``x`` from any place in the texts with their hashes ``h``, those of a share of the hashes."""
    lines = docs.select(F.explode(F.split(F.col(text), "\n", -1)).alias("x")).filter(F.col("x").rlike("[A-Za-z0-9]"))
    hashed, parts = lines.select(F.xxhash64("x").alias("h"), "x"), 1 << 30
    n = hashed.agg(F.approx_count_distinct("h")).first()[0]
    if n > 2 * MAX_CORPUS_LINES:
        # So that the sort meets a bounded number of rows, however many lines there are.
        hashed = hashed.filter(F.pmod("h", F.lit(parts)) < F.lit(parts * 2 * MAX_CORPUS_LINES // n + 1))
    return hashed


def corpus_sample(docs: DataFrame, text: str = "text") -> list[str]:
    """Whole distinct lines from any place in the texts, the MAX_CORPUS_LINES of a share of the hashes, to look at."""
    return [r["x"] for r in _sampled(docs, text).distinct().orderBy("h", "x").limit(MAX_CORPUS_LINES).collect()]


def corpus_evidence(docs: DataFrame, text: str = "text") -> list[Evidence]:
    """What training uses of the lines of ``corpus_sample``, by line hash; the lines stay where they are."""

    def of(ws: Column) -> Column:
        own = F.size(F.filter(_pairs(ws), lambda p: p.isin(_TEMPLATE_PAIRS)))
        whole = F.exists(F.array(*[F.lit(t) for t in _WHOLE]), lambda t: F.contains(F.array_join(ws, " "), t))
        return F.struct(
            F.transform(F.slice(ws, 1, HEAD), lambda w: F.when(w.isin(_TEMPLATE_WORDS), w).otherwise(OTHER)).alias("head"),
            F.array_sort(F.array_distinct(F.filter(F.concat(ws, _pairs(ws)), lambda g: g.isin(_TEMPLATE_GRAMS)))).alias("grams"),
            ((own > 0) & ((2 * own >= F.size(ws) - 1) | whole)).alias("notice"),
        )

    seen = _sampled(docs, text).select("h", let(_line_words(F.col("x")), of).alias("line")).distinct()
    rows = seen.orderBy("h", "line").limit(MAX_CORPUS_LINES).select("line.*").collect()
    return [Evidence(tuple(r["head"]), frozenset(r["grams"]), r["notice"]) for r in rows]


def scan(docs: DataFrame, text: str = "text", keep: str = "doc_id") -> tuple[DataFrame, LicenseModel]:
    """``row`` and the ``notices`` of every document, confirmed or not; the model."""
    model = train(corpus_evidence(docs, text))
    narrow = docs.select(F.col(keep).alias("row"), F.col(text).alias("text"))
    return narrow.select("row", licenses_of(F.col("text"), model).alias("notices")), model
