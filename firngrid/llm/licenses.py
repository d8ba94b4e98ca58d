"""Licence scans: a trained paragraph classifier, confirmed by templates.

A paragraph is a line with words. Sparse word 1- and 2-grams feed a multinomial logistic
regression over licence families and an unknown class. It is trained on notices of the
corpus that seed patterns label, on the templates with words left out, and on other
paragraphs as unknown, all in bounded numbers. The L1 weights leave few n-grams, and a
paragraph with none of them is unknown without more work. Probabilities are tempered on
held-out rows, and the least probability that counts as known is set there too. A long
paragraph is judged by its best span (SPANS) about a word that speaks for a family,
so that a notice is found wherever it stands in it. An n-gram counts once in a span, so that
no word becomes a notice by being repeated. A prediction is confirmed if the family's template
shares enough 2-grams with the paragraph.

Defined results: null texts and empty lines have no paragraphs; paragraphs are numbered
from 0 among the lines of a text, empty ones included; unknown paragraphs give no rows; of
equally likely families the first of FAMILIES wins; repeated rows give repeated results;
an empty table gives an empty table; extra columns are ignored.
"""

from __future__ import annotations

import random
from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from firngrid.llm.texts import map_batches, sampled

# Short notices of public licences, by family.
TEMPLATES = {
    "apache": (
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "Licensed under the Apache License, Version 2.0.",
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Use of this source code is governed by a BSD-style license.",
    ),
    "cc-by": ("This work is licensed under a Creative Commons Attribution 4.0 International License.", "Licensed under CC BY 4.0."),
    "cc-by-nc": ("This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", "Licensed under CC BY-NC 4.0."),
    "gpl": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License.",
        "This work is licensed under the GNU General Public License, version 3.",
    ),
    "mit": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files to deal in the Software without restriction.",
        "Released under the MIT License.",
    ),
    "mpl": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",),
    "reserved": ("All rights reserved.", "Copyright the authors. All rights reserved."),
}
# Seed patterns that label a notice for training.
SEEDS = {
    "apache": r"\bapache licen[sc]e\b",
    "bsd": r"\bbsd([- ]style)? licen[sc]e\b",
    "cc-by": r"\bcc[- ]by [0-9]",
    "cc-by-nc": r"\bcc[- ]by[- ]nc\b",
    "gpl": r"\bgnu general public licen[sc]e\b",
    "mit": r"\bmit licen[sc]e\b",
    "mpl": r"\bmozilla public licen[sc]e\b",
    "reserved": r"\ball rights reserved\b",
}
FAMILIES = tuple(sorted(TEMPLATES))
UNKNOWN = len(FAMILIES)
#: Paragraphs of a family, and unknown ones of so many documents, that are trained on at most.
SAMPLE_KNOWN = 200
SAMPLE_UNKNOWN = 2000
SAMPLE_DOCS = 400
#: Characters of a sampled paragraph at most; longer ones are not sampled.
SAMPLE_CHARS = 2000
#: Share of the paragraph's or the template's 2-grams that confirms a prediction.
CONFIRMED = 0.5
#: 2-grams in common with a template that make a line no example of an unknown one.
SHARED_GRAMS = 3
#: Share of the held-out unknown paragraphs that may be taken for known, at most.
FALSE_KNOWN = 0.01
#: What a document with a notice that a seed could label holds.
_HINT = r"(?i)licen[sc]e|cc[- ]by|rights reserved"
#: Words of a span, and how many of them stand before the word that it is taken about; for
#: notices of a sentence and of a few words.
SPANS = ((40, 8), (14, 3))
_BREAKS = bytes(b if b > 127 or b == 10 or chr(b).isalnum() else 32 for b in range(256))


def plain(text: str) -> bytes:
    """UTF-8 with A-Z lower-cased and any ASCII but letters, digits and line ends as spaces."""
    return text.encode().lower().translate(_BREAKS)


def grams(paragraph: str | bytes) -> Counter:
    """Counts of the word 1- and 2-grams of a paragraph, or of its plain form."""
    data = plain(paragraph) if isinstance(paragraph, str) else paragraph
    words = data.decode().split()
    return Counter(words) + Counter(f"{a} {b}" for a, b in zip(words, words[1:], strict=False))


@dataclass
class LicenseModel:
    """Sparse weights by n-gram, bias, temperature and the least known probability."""

    weights: dict[str, list[float]]
    bias: list[float]
    temperature: float
    least: float

    def __post_init__(self):
        # Without an n-gram that speaks for a family, and with a bias for unknown, it is unknown.
        lead = max(self.bias[:UNKNOWN], default=0.0) > (self.bias[UNKNOWN] if self.bias else 0.0)
        speaking = {g for g, w in self.weights.items() if lead or max(w[:UNKNOWN]) > w[UNKNOWN]}
        self.words = {w.encode() for g in speaking for w in g.split(" ")}
        # By word: its own row of the weights, and those of the 2-grams that it begins.
        self.rows = np.array([*self.weights.values(), self.bias]) if self.bias else np.zeros((1, UNKNOWN + 1))
        self.singles: dict[str, int] = {}
        self.pairs: dict[str, dict[str, int]] = {}
        for k, g in enumerate(self.weights):
            first, _, second = g.partition(" ")
            if second:
                self.pairs.setdefault(first, {})[second] = k
            else:
                self.singles[first] = k
        # What an n-gram can add to a family over unknown, and what a paragraph must have of it.
        self.gains = np.maximum(0.0, self.rows[:, :UNKNOWN].max(1) - self.rows[:, UNKNOWN])[:-1].tolist()
        self.lack = -max((x - self.bias[UNKNOWN] for x in self.bias[:UNKNOWN]), default=0.0)

    def hopeless(self, words: list[str]) -> bool:
        """Whether no span of the paragraph can be known: all it has for a family is too little for the least span."""
        least = min(len(words), 1 + min(before for _, before in SPANS))
        met = {self.singles[w] for w in words if w in self.singles}
        for w, after in zip(words, words[1:], strict=False):
            if w in self.pairs and (k := self.pairs[w].get(after)) is not None:
                met.add(k)
        return sum(self.gains[k] for k in met) + 1e-6 < self.lack * max(1, 2 * least - 1) ** 0.5

    def spans(self, words: list[str]) -> list[tuple[int, int]]:
        """All words of a paragraph, and if they are many the spans about those that speak for a family."""
        out = [(0, len(words))]
        if len(words) > min(size for size, _ in SPANS):
            speaking = [at for at, word in enumerate(words) if word.encode() in self.words]
            for size, before in SPANS:
                covered = -1 if len(words) > size else len(words)
                for at in speaking:
                    if at > covered:
                        first = max(0, at - before)
                        covered = at + (size - before) // 2  # spans overlap by half of what follows
                        out.append((first, min(len(words), first + size)))
        return out

    def span_probabilities(self, words: list[str], spans: list[tuple[int, int]]) -> np.ndarray:
        """A row of ``probabilities`` for each span.

        An n-gram counts where it stands for the first time in a span, that is where it stood
        before the span the time before.
        """
        singles = [(at, k) for at, w in enumerate(words) if (k := self.singles.get(w)) is not None]
        pairs = [
            (at, k)
            for at, w in enumerate(words[:-1])
            if (after := self.pairs.get(w)) is not None and (k := after.get(words[at + 1])) is not None
        ]
        first, last = np.array(spans).T
        score = np.zeros((len(spans), UNKNOWN + 1))
        for found, end in ((singles, last), (pairs, last - 1)):
            if found:
                at, rows = np.array(found).T
                order = np.argsort(rows, kind="stable")
                again = rows[order[1:]] == rows[order[:-1]]
                before = np.full(len(at), -1)
                before[order[1:][again]] = at[order[:-1][again]]
                low = np.searchsorted(at, first)
                many = np.maximum(np.searchsorted(at, end) - low, 0)
                span = np.repeat(np.arange(len(spans)), many)
                place = np.arange(len(span)) - np.repeat(np.cumsum(many) - many, many) + low[span]
                new = before[place] < first[span]
                np.add.at(score, span[new], self.rows[rows[place[new]]])
        size = np.sqrt(np.maximum(1, 2 * (last - first) - 1))
        score = np.round((score / size[:, None] + np.array(self.bias)) / self.temperature, 9)
        share = np.exp(score - score.max(1, keepdims=True))
        return share / share.sum(1, keepdims=True)

    def probabilities(self, counts: Counter) -> np.ndarray:
        """Tempered probabilities of the families and, last, of unknown."""
        score = np.array(self.bias)
        size = max(1.0, sum(counts.values()) ** 0.5)
        for g in counts:
            if (w := self.weights.get(g)) is not None:
                score = score + np.array(w) / size
        score = score / self.temperature
        share = np.exp(score - score.max())
        return share / share.sum()

    def classify(self, paragraph: str | bytes) -> tuple[str, float, float, bool] | None:
        """``(family, probability, likeness to its template, confirmed)``, or None if unknown."""
        data = plain(paragraph) if isinstance(paragraph, str) else paragraph
        words = data.decode().split()
        if self.hopeless(words):
            return None
        spans = self.spans(words)
        share = self.span_probabilities(words, spans)
        kinds, best = share.argmax(1), share.max(1)
        known = np.flatnonzero((kinds != UNKNOWN) & (best >= self.least))
        if not len(known):
            return None
        at = known[best[known].argmax()]
        family, (first, last) = FAMILIES[kinds[at]], spans[at]
        like = template_likeness(" ".join(words[first:last]), family)
        return family, float(best[at]), like, like >= CONFIRMED

    def scan(self, text: str | None):
        """``(paragraph number, ...)`` for each known paragraph of a whole text."""
        for k, line in enumerate(plain(text or "").split(b"\n")):
            if not self.words.isdisjoint(line.split()) and (found := self.classify(line)):
                yield (k, *found)


def _pairs(paragraph: str | bytes) -> set[str]:
    return {g for g in grams(paragraph) if " " in g}


TEMPLATE_PAIRS = {family: [_pairs(t) for t in templates] for family, templates in TEMPLATES.items()}


def template_likeness(paragraph: str | bytes, family: str) -> float:
    """The largest share of 2-grams that the paragraph and a template of the family have in common."""
    own = _pairs(paragraph)
    return max((len(own & t) / min(len(own), len(t)) for t in TEMPLATE_PAIRS[family] if own and t), default=0.0)


def like_a_template(line: str) -> bool:
    """Whether a template of any family confirms the line by SHARED_GRAMS 2-grams or more."""
    own = _pairs(line)
    return any(
        max(len(own & t) for t in templates) >= SHARED_GRAMS and template_likeness(line, family) >= CONFIRMED
        for family, templates in TEMPLATE_PAIRS.items()
    )


def _without_templates(lines: DataFrame) -> DataFrame:
    """Those of ``lines (line)`` that no template confirms."""

    def batch(rows):
        return {"line": [line for line in rows["line"] if not like_a_template(line)]}

    return map_batches(lines.select("line"), batch, "line string")


def least_known(wrong: list[float], n_unknown: int) -> float:
    """The least probability, 0.5 at least, that leaves FALSE_KNOWN of ``n_unknown`` known.

    ``wrong`` are the probabilities of those unknown paragraphs that are taken for known.
    """
    allowed = int(FALSE_KNOWN * n_unknown)
    above = sorted(wrong, reverse=True)[allowed:]
    return max([0.5, *(float(np.nextafter(p, 2.0)) for p in above[:1])])


def _fit(rows: list[tuple[Counter, int]], rounds: int = 200, rate: float = 1.0, l1: float = 2e-4):
    """Proximal gradient descent with L1; returns n-gram names, weights and bias."""
    seen = Counter(g for counts, _ in rows for g in counts)
    names = {g: k for k, g in enumerate(sorted(g for g, n in seen.items() if n > 1))}
    at, cells, values = [], [], []
    for r, (counts, _) in enumerate(rows):
        size = max(1.0, sum(counts.values()) ** 0.5)
        for g in counts:  # once, however often it stands there: repeated words are no notice
            if g in names:
                at.append(r)
                cells.append(names[g])
                values.append(1 / size)
    at, cells, values = np.array(at, int), np.array(cells, int), np.array(values)
    gold = np.eye(UNKNOWN + 1)[[y for _, y in rows]]
    weights, bias = np.zeros((len(names), UNKNOWN + 1)), np.zeros(UNKNOWN + 1)
    for _ in range(rounds):
        score = np.tile(bias, (len(rows), 1))
        np.add.at(score, at, weights[cells] * values[:, None])
        share = np.exp(score - score.max(1, keepdims=True))
        share /= share.sum(1, keepdims=True)
        off = (share - gold) / len(rows)
        slope = np.zeros_like(weights)
        np.add.at(slope, cells, off[at] * values[:, None])
        weights -= rate * slope * 20
        weights = np.sign(weights) * np.maximum(0.0, np.abs(weights) - rate * l1)
        bias -= rate * off.sum(0)
    kept = np.flatnonzero(np.abs(weights).max(1) > 0)
    order = list(names)
    return {order[k]: weights[k].round(6).tolist() for k in kept}, bias.round(6).tolist()


def train(docs: DataFrame, seed: int = 5) -> LicenseModel:
    """Learn from bounded samples of paragraphs, chosen by a hash of their text."""
    texts = docs.select("text")

    def lines(of: DataFrame) -> DataFrame:
        line = of.select(F.explode(F.split("text", "\n")).alias("line"))
        return line.where(f"length(trim(line)) between 1 and {SAMPLE_CHARS}")

    low = F.lower("line")
    label = F.coalesce(
        *[F.when(low.rlike(p), F.lit(FAMILIES.index(f))) for f, p in SEEDS.items()],
        F.lit(UNKNOWN),
    )
    hinted = lines(texts.where(F.col("text").rlike(_HINT))).where(F.col("line").rlike(_HINT))
    labelled = hinted.distinct().select("line", label.alias("label"))
    known = labelled.where(F.col("label") < UNKNOWN)
    order = Window.partitionBy("label").orderBy(F.xxhash64("line"), "line")
    known = known.withColumn("k", F.row_number().over(order)).where(F.col("k") <= SAMPLE_KNOWN).drop("k")
    sample = sampled(texts, SAMPLE_DOCS)
    # Notices that only a template shows are not unknown; lines that only mention licences are.
    other = _without_templates(lines(sample).where(~F.col("line").rlike(_HINT)))
    mentions = _without_templates(labelled.where(F.col("label") == UNKNOWN))
    for lines_of, most in ((other, SAMPLE_UNKNOWN), (mentions, SAMPLE_KNOWN)):
        least = lines_of.orderBy(F.xxhash64("line"), "line").limit(most)
        known = known.unionByName(least.select("line", F.lit(UNKNOWN).alias("label")))
    rows = sorted({(r.line, r.label) for r in known.collect()})
    rng = random.Random(seed)
    for k, family in enumerate(FAMILIES):
        for template in TEMPLATES[family]:
            words = template.split()
            rows += [(" ".join(w for w in words if rng.random() > 0.1), k) for _ in range(12)]
            rows.append((template, k))
    rng.shuffle(rows)
    data = [(grams(line), y) for line, y in rows]
    held_lines = [line for line, y in rows[::4] if y == UNKNOWN]
    held, rest = data[::4], [d for k, d in enumerate(data) if k % 4]
    weights, bias = _fit(rest)

    def loss(t: float) -> float:
        model = LicenseModel(weights, bias, t, 0.0)
        return -sum(np.log(max(1e-9, model.probabilities(c)[y])) for c, y in held)

    model = LicenseModel(weights, bias, min((0.25, 0.35, 0.5, 0.7, 1.0, 1.4, 2.0), key=loss), 0.0)
    wrong = [found[1] for line in held_lines if (found := model.classify(line))]
    return LicenseModel(weights, bias, model.temperature, least_known(wrong, len(held_lines)))


def scan(docs: DataFrame, model: LicenseModel) -> DataFrame:
    """``doc_id, paragraph, family, probability, likeness, confirmed`` of known paragraphs."""
    state = model.weights, model.bias, model.temperature, model.least
    names = ("paragraph", "family", "probability", "likeness", "confirmed")

    def batch(rows):
        own = LicenseModel(*state)
        out = {k: [] for k in ("doc_id", *names)}
        for i, text in zip(rows["doc_id"], rows["text"], strict=True):
            for found in own.scan(text):
                out["doc_id"].append(i)
                for k, v in zip(names, found, strict=True):
                    out[k].append(v)
        return out

    return map_batches(
        docs.select("doc_id", "text"),
        batch,
        "doc_id long, paragraph long, family string, probability double, likeness double, confirmed boolean",
    )
