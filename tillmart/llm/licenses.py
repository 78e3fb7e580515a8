"""Licence notices in documents: a trained paragraph classifier, confirmed by comparison with templates.

Paragraphs are runs of lines that hold words, so that a line without any, be it empty or a bare comment leader, ends one; line breaks
and leaders inside do not matter, as only words count. Stretches of a paragraph are proposed where a licence's name stands, together
with the words of its sentence that lead up to it, and where many words of a longer notice stand. A stretch is a sparse vector of the
word n-grams (1 to 3 words) of templates and near misses, and its share of other words. Softmax regression over the licence families
and an unknown class gives the likeliest family; its probability is calibrated on examples kept from training. A template of that
family then has to confirm it: four fifths of the template's words in order, and agreement in all words that decide between relatives
(version, Affero, Lesser, NC, ND, SA, clauses) and in negations. In a sentence that names several licences each is looked at without
the names of the others. A family without a version (GPL, LGPL, AGPL, BSD) is reported only where no version is given.
"""

from __future__ import annotations

import math
import re
from bisect import bisect, insort
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmart.llm.common import few_at_once, smallest_hashes

UNKNOWN = "unknown"
# Paragraphs of the corpus that stand for the unknown class in training: those with the smallest hash.
SAMPLE = 4_000
LEAST_PROBABILITY = 0.5
LEAST_COVERED = 0.8  # of a template's words, in order, found in the stretch

# What licences are called, by family.
NAMED: dict[str, tuple[str, ...]] = {
    "Apache-1.1": ("Apache License, Version 1.1", "Apache Software License 1.1", "Apache-1.1"),
    "Apache-2.0": ("Apache License, Version 2.0", "Apache 2.0 License", "Apache Software License 2.0", "Apache-2.0"),
    "MIT": ("MIT License", "MIT"),
    "ISC": ("ISC License", "ISC"),
    "BSD-2-Clause": ("BSD 2-Clause License", "2-Clause BSD License", "Simplified BSD License", "BSD-2-Clause"),
    "BSD-3-Clause": ("BSD 3-Clause License", "3-Clause BSD License", "New BSD License", "BSD-3-Clause"),
    "GPL-2.0": ("GNU General Public License, version 2", "GNU GPL version 2", "GPLv2", "GPL-2.0"),
    "GPL-3.0": ("GNU General Public License, version 3", "GNU GPL version 3", "GPLv3", "GPL-3.0"),
    "LGPL-2.1": ("GNU Lesser General Public License, version 2.1", "GNU LGPL version 2.1", "LGPLv2.1", "LGPL-2.1"),
    "LGPL-3.0": ("GNU Lesser General Public License, version 3", "GNU LGPL version 3", "LGPLv3", "LGPL-3.0"),
    "AGPL-3.0": ("GNU Affero General Public License, version 3", "GNU AGPL version 3", "AGPLv3", "AGPL-3.0"),
    "MPL-1.1": ("Mozilla Public License, v. 1.1", "Mozilla Public License Version 1.1", "MPL 1.1"),
    "MPL-2.0": ("Mozilla Public License, v. 2.0", "Mozilla Public License Version 2.0", "MPL 2.0"),
    "EPL-2.0": ("Eclipse Public License, Version 2.0", "EPL 2.0"),
    "BSL-1.0": ("Boost Software License, Version 1.0", "BSL-1.0"),
    "CC0-1.0": ("CC0 1.0 Universal", "CC0 1.0", "Creative Commons Zero 1.0"),
    "Unlicense": ("Unlicense",),
}
_PARTS = {"BY": "Attribution", "NC": "NonCommercial", "ND": "NoDerivatives", "SA": "ShareAlike"}
for _parts in ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND"):
    for _version, _kind in (("3.0", "Unported"), ("4.0", "International")):
        _long = "-".join(_PARTS[part] for part in _parts.split("-"))
        _spaced = " ".join(re.findall("[A-Z][a-z]+", _long))
        NAMED[f"CC-{_parts}-{_version}"] = (
            f"CC {_parts} {_version}",
            f"Creative Commons {_long} {_version} {_kind} License",
            *([f"Creative Commons {_spaced} {_version} License"] if _spaced != _long else []),
        )
# How notices give a name, and near misses, which give one without granting anything.
PHRASES = (
    "Licensed under the {}", "Released under the {}", "Distributed under the {}", "Made available under the {}", "This work is licensed under the {}",
    "This project is licensed under the terms of the {}", "Subject to the terms of the {}", "Use of this source code is governed by the {}", "SPDX-License-Identifier: {}",
)
MISSES = (
    "is not licensed under the {}", "was never released under the {}", "cannot be distributed under the {}", "are no longer available under the {}",
    "not subject to the terms of the {}", "neither licensed nor released under the {}", "do not confuse it with the {}", "the {} and its history", "a talk about the {}",
)
_GNU = "This {} is free software: you can redistribute it and/or modify it under the terms of the GNU {}General Public License"
_EITHER = " as published by the Free Software Foundation, either version {} of the License, or (at your option) any later version."
_BSD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"
# Notices that are no name after a phrase. A family without a version is the answer where a notice gives none.
HEADERS: dict[str, tuple[str, ...]] = {
    "Apache-2.0": ('Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',),
    "MIT": ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",),
    "ISC": ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",),
    "GPL": (_GNU.format("program", ""),),
    "GPL-2.0": (_GNU.format("program", "") + _EITHER.format("2"),),
    "GPL-3.0": (_GNU.format("program", "") + _EITHER.format("3"),),
    "LGPL": (_GNU.format("library", "Lesser "),),
    "LGPL-2.1": (_GNU.format("library", "Lesser ") + _EITHER.format("2.1"),),
    "LGPL-3.0": (_GNU.format("library", "Lesser ") + _EITHER.format("3"),),
    "AGPL": (_GNU.format("program", "Affero "),),
    "AGPL-3.0": (_GNU.format("program", "Affero ") + _EITHER.format("3"),),
    "BSD": (_BSD, "Use of this source code is governed by a BSD-style license."),
    "MPL-1.1": ("The contents of this file are subject to the Mozilla Public License Version 1.1; you may not use this file except in compliance with the License",),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",),
    "Unlicense": ("This is free and unencumbered software released into the public domain.",),
}
TEMPLATES: dict[str, tuple[str, ...]] = {
    family: (*HEADERS.get(family, ()), *(phrase.format(name) for name in NAMED.get(family, ()) for phrase in PHRASES)) for family in sorted({*HEADERS, *NAMED})
}
# Words of a name that decide nothing, words that make another licence of a name, and negations.
_PLAIN = frozenset("license licence version v gnu international unported universal creative commons software clause public".split())
_OTHER = frozenset("affero lesser library agpl lgpl sa nc nd sharealike share alike noncommercial commercial noderivatives noderivs derivatives derivs derivative style like".split())
_NOT = frozenset("not never cannot neither nor without isn aren wasn unlike no".split())
_VERSION = re.compile(r"[0-9](?:\.[0-9])?")
_AROUND = 14  # words before a name among which its phrase is looked for
_LEADS = ("", "This file is ", "The text is ", "All content here is ", "Note: ", "Copyright (c) The Authors. ", "# ", "// ")
_TAILS = ("", " All rights reserved.", " See LICENSE for details.", " Thanks to all contributors.", " (c) 2021")

_WORD = re.compile(r"[a-z]+|[0-9]+(?:\.[0-9]+)*")
_STOP = re.compile(r"(?<!v)[.;!?](?:\s|$)")
# Spellings that stand for one word.
_SAME = {"gplv": "gpl", "lgplv": "lgpl", "agplv": "agpl", "licence": "license", "licenced": "licensed"}


def _word(found: str) -> str:
    """A word as it is compared: of version numbers, 2.0 is 2."""
    return found[:-2] if found.endswith(".0") and found[:-2].isdigit() else _SAME.get(found, found)


def words(text: str) -> list[str]:
    return [_word(w) for w in _WORD.findall(text.lower())]


def _grams(parts: list[str]) -> Iterator[str]:
    for size in (1, 2, 3):
        for n in range(len(parts) - size + 1):
            yield " ".join(parts[n : n + size])


def _reach(template: list[str], parts: list[str]) -> tuple[int, int]:
    """Length of the longest common subsequence of words, and how many of ``parts`` it takes from the start."""
    row = [0] * (len(parts) + 1)
    for word in template:
        last = 0
        for n, other in enumerate(parts, 1):
            last, row[n] = row[n], last + 1 if word == other else max(row[n], row[n - 1])
    return row[-1], row.index(row[-1])


def _covered(template: list[str], parts: list[str]) -> float:
    """The longest common subsequence of words, as a share of the template."""
    return _reach(template, parts)[0] / max(1, len(template))


class Template:
    """A notice as words, and the search for stretches that cover it."""

    def __init__(self, family: str, text: str) -> None:
        self.family = family
        self.words = [w for w in words(text) if w != "the"]
        self.counts = Counter(self.words)
        self.decide = {w for w in self.words if w in _OTHER or _VERSION.fullmatch(w)}
        self.need = math.ceil(LEAST_COVERED * len(self.words) - 1e-9)  # words that a stretch has to cover
        self.size = len(self.words) + len(self.words) // 2 + 1  # words of a stretch at most

    def agrees(self, parts: list[str]) -> bool:
        """Whether the words of a stretch that decide between relatives, and its negations, are those of the template."""
        if any(parts.count(w) > self.counts[w] for w in _NOT):
            return False
        return self.decide == {w for w in parts if w in _OTHER or _VERSION.fullmatch(w)}

    def possible(self, used: set[str]) -> bool:
        """Whether a paragraph of these words can cover enough."""
        return sum(n for w, n in self.counts.items() if w in used) >= self.need

    def stretches(self, parts: list[str]) -> list[tuple[int, int, float]]:
        """(start, end, covered) of all stretches that cover the template, without the words around; of overlapping ones the best."""
        at = [n for n, w in enumerate(parts) if w in self.counts]
        have: Counter[str] = Counter()
        common = after = 0
        found = set()
        for start in at:
            while after < len(at) and at[after] < start + self.size:
                word = parts[at[after]]
                have[word] += 1
                common += have[word] <= self.counts[word]
                after += 1
            if common >= self.need:  # else the order of words need not be looked at
                part = parts[start : start + self.size]
                length, end = _reach(self.words, part)
                if length >= self.need:
                    width = _reach(self.words[::-1], part[:end][::-1])[1]
                    found.add((-length, width, start + end - width))
            common -= have[parts[start]] <= self.counts[parts[start]]
            have[parts[start]] -= 1
        kept: list[tuple[int, int, float]] = []
        for less, width, start in sorted(found):
            n = bisect(kept, (start,))
            if (n == 0 or kept[n - 1][1] <= start) and (n == len(kept) or start + width <= kept[n][0]):
                insort(kept, (start, start + width, -less / len(self.words)))
        return kept


class Name:
    """What a licence is called, found where its deciding words stand in order with none between that makes another licence of it."""

    def __init__(self, family: str, text: str) -> None:
        self.family = family
        self.words = words(text)
        self.decide = [w for w in self.words if w not in _PLAIN and w != "the"]
        self.versions = any(_VERSION.fullmatch(w) for w in self.decide)

    def end(self, parts: list[str], start: int) -> int | None:
        """Where the name ends that starts with the word at ``start``, its first deciding one."""
        at = start
        for word in self.decide[1:]:
            while True:
                at += 1
                if at == len(parts):
                    return None
                if parts[at] == word:
                    break
                if parts[at] not in _PLAIN and parts[at] != "the":
                    return None
        after = at + 1
        while after < len(parts) and parts[after] in _PLAIN:
            after += 1
        around = parts[start - 1 : start] + parts[after : after + 1]
        if any(w in _OTHER for w in around):
            return None
        if self.versions and after == at + 1 and after < len(parts) and _VERSION.fullmatch(parts[after]):
            return None
        return at + 1

    def covered(self, span: list[str]) -> int:
        return _reach(self.words, span)[0]


_NAMES = [Name(family, text) for family, texts in NAMED.items() for text in texts]
_BY_FIRST: dict[str, list[Name]] = {}
for _name in _NAMES:
    _BY_FIRST.setdefault(_name.decide[0], []).append(_name)
_PHRASES = [[w for w in words(phrase.format("")) if w != "the"] for phrase in PHRASES]
_SAYS = frozenset(w for phrase in _PHRASES for w in phrase) - {"this", "of", "use", "source", "code", "work", "project", "is", "to", "by"}

# Words that texts hold whatever they are about.
_FREQUENT = frozenset("a and any are as by code following for form forms in is it may not of or that the this to under use used with without work you".split())


def keys(template: Template) -> set[str]:
    """Words of which each stretch that covers the template has one: without all of them too few of its words are left."""
    chosen: set[str] = set()
    left = len(template.words)
    for word in sorted(template.counts, key=lambda w: (w in _FREQUENT, w not in _BY_FIRST, -len(w), w)):
        if left < template.need:
            break
        chosen.add(word)
        left -= template.counts[word]
    return chosen


_SOUGHT = [Template(family, text) for family, texts in TEMPLATES.items() for text in texts]
_LONG = [Template(family, text) for family, texts in HEADERS.items() for text in texts]


@dataclass(frozen=True)
class Mention:
    """A licence's name in a paragraph, with the words before it that can make a notice of it."""

    start: int
    end: int
    left: list[str]  # the words before the name in its sentence, without other names

    @property
    def lead(self) -> int | None:
        """Where the phrase begins among the words before the name."""
        return next((n for n, w in enumerate(self.left) if w in _SAYS), None)


def _mentions(parts: list[str], fresh: list[bool]) -> list[Mention]:
    """The names in a paragraph; of names within one another the longest. ``fresh``: words that start a sentence."""
    spans: list[tuple[int, int]] = []
    for n, word in enumerate(parts):
        if names := _BY_FIRST.get(word):
            if end := max((name.end(parts, n) or 0 for name in names), default=0):
                if not spans or n >= spans[-1][1]:
                    spans.append((n, end))
    found = []
    for number, (start, end) in enumerate(spans):
        left: list[str] = []
        n, before = start, number - 1
        while n > 0 and not fresh[n] and len(left) < _AROUND:
            n -= 1
            if before >= 0 and n < spans[before][1]:
                n, before = spans[before][0], before - 1
            else:
                left.append(parts[n])
        found.append(Mention(start, end, left[::-1]))
    return found


@dataclass(frozen=True)
class Notice:
    first: int  # lines
    last: int
    family: str
    probability: float
    covered: float


@dataclass
class Paragraph:
    words: list[str]
    lines: list[int]  # that the words are on
    fresh: list[bool]  # whether a sentence starts with the word

    @staticmethod
    def all(text: str) -> Iterator[Paragraph]:
        """Runs of lines that hold words."""
        now, stop = Paragraph([], [], []), False
        for n, line in enumerate(text.lower().split("\n")):
            end = 0
            for found in _WORD.finditer(line):
                stop = stop or _STOP.search(line, max(0, end - 1), found.start()) is not None
                now.words.append(_word(found[0]))
                now.lines.append(n)
                now.fresh.append(stop)
                end, stop = found.end(), False
            if end:
                stop = _STOP.search(line, end) is not None
            elif now.words:
                yield now
                now, stop = Paragraph([], [], []), False
        if now.words:
            yield now


@dataclass(frozen=True)
class Classifier:
    families: list[str]  # the last one is the unknown class
    gram: dict[str, int]
    weights: np.ndarray  # (grams + 2, families): then the share of other words, then the bias
    heat: float
    keys: frozenset[str]  # a paragraph without any of these words covers no template

    def probabilities(self, parts: list[str]) -> np.ndarray:
        at, values = _sparse(parts, self.gram)
        return _softmax((np.array(values) @ self.weights[at] / self.heat)[None])[0]

    def judge(self, line: str) -> tuple[str, float, float] | None:
        """Family, probability and covered share of the likeliest licence notice in a line."""
        best = max(self.scan(line), key=lambda x: x.probability, default=None)
        return best and (best.family, best.probability, best.covered)

    def notices(self, paragraph: Paragraph) -> list[Notice]:
        """The notices of a paragraph, in the order of their lines; those of a family that share a line are one."""
        parts, lines = paragraph.words, paragraph.lines
        used = set(parts)
        if self.keys.isdisjoint(used):
            return []
        spans = []
        for mention in _mentions(parts, paragraph.fresh):
            if said := self._named(mention, parts):
                family, chance, covered, start = said
                spans.append((start, mention.end, family, chance, covered))
        for template in _LONG:
            if template.possible(used):
                for start, end, covered in template.stretches(parts):
                    part = parts[start:end]
                    before = parts[max(0, start - 2) : start] if not paragraph.fresh[start] else []
                    family, chance = self.likeliest(part)
                    if family == template.family and chance >= LEAST_PROBABILITY and template.agrees(part) and _NOT.isdisjoint(before):
                        spans.append((start, end, family, chance, covered))
        found = []
        for x in spans:
            # a notice without a version is none where one with a version holds it
            if not any(y[2] != x[2] and y[2].startswith(x[2] + "-") and y[0] <= x[0] + 3 and x[1] - 3 <= y[1] for y in spans):
                found.append(Notice(lines[x[0]], lines[x[1] - 1], *x[2:]))
        joined: list[Notice] = []
        for x in sorted(found, key=lambda x: (x.family, x.first, x.last)):
            if joined and joined[-1].family == x.family and x.first <= joined[-1].last:
                y = joined.pop()
                best = max(x, y, key=lambda x: (x.covered, x.probability))
                x = Notice(y.first, max(x.last, y.last), x.family, best.probability, best.covered)
            joined.append(x)
        return sorted(joined, key=lambda x: (x.first, x.last, x.family))

    def scan(self, text: str | None) -> list[Notice]:
        """The notices of a text."""
        return [x for paragraph in Paragraph.all(text or "") for x in self.notices(paragraph)]

    def likeliest(self, parts: list[str]) -> tuple[str, float]:
        chances = self.probabilities(parts)
        best = int(chances.argmax())
        return self.families[best], float(chances[best])

    def _named(self, mention: Mention, parts: list[str]) -> tuple[str, float, float, int] | None:
        """Family, probability, covered share and first word of the notice that ends with a name, if it is one."""
        span = parts[mention.start : mention.end]
        tail = mention.end
        while tail < len(parts) and parts[tail] in _PLAIN:
            tail += 1
        whole = parts[mention.start : tail]
        while mention.start - (len(whole) - tail + mention.start) > 0 and parts[tail - len(whole) - 1] in _PLAIN:
            whole = [parts[tail - len(whole) - 1], *whole]
        alone = len(whole) + (parts[0] == "the") == len(parts)  # the title of a licence
        if (lead := mention.lead) is None and not alone:
            return None
        left = mention.left if lead is not None else []
        before = mention.left[max(0, (lead or 0) - 2) :]
        for n, word in enumerate(before):
            if word in _NOT and not (n and before[n - 1] == "if"):
                return None
        view = before + whole if not alone else ["released", "under", *whole]
        family, chance = self.likeliest(view)
        if family == UNKNOWN or chance < LEAST_PROBABILITY:
            return None
        # the template of this family that covers most of it
        best = 0.0
        for name in _BY_FIRST[span[0]]:
            if name.family == family and name.end(parts, mention.start) == mention.end:
                size, covered = len(name.words), name.covered(whole)
                for phrase in _PHRASES:
                    said = _reach(phrase, left)[0]
                    if 2 * said >= len(phrase):
                        best = max(best, (said + covered) / (len(phrase) + size))
                if alone:
                    best = max(best, covered / size)
        return (family, chance, best, mention.start) if best >= LEAST_COVERED else None


def _sparse(parts: list[str], gram: dict[str, int]) -> tuple[list[int], list[float]]:
    """The grams of a stretch, all with the same value so that the length of the vector is one, its share of other words, and the bias."""
    at = sorted({gram[g] for g in _grams(parts) if g in gram})
    value = 1 / max(1.0, math.sqrt(len(at)))
    share = sum(w not in gram for w in parts) / max(1, len(parts))
    return [*at, len(gram), len(gram) + 1], [value] * len(at) + [share, 1.0]


def _softmax(margins: np.ndarray) -> np.ndarray:
    raised = np.exp(margins - margins.max(axis=1, keepdims=True))
    return raised / raised.sum(axis=1, keepdims=True)


def fit(others: list[str], steps: int = 300) -> Classifier:
    """Fit on the templates in varied surroundings, on near misses and on ``others``, paragraphs that hold no notice as far as is known.

    Of ``others`` those that cover a template or are a piece of one, as the lines of a wrapped notice are, are left out; so are those
    that give a licence's name. A fifth of all examples sets the calibration.
    """
    families = [*TEMPLATES, UNKNOWN]
    unknown = len(families) - 1
    around = [(lead, tail) for lead in _LEADS for tail in _TAILS]
    examples: list[tuple[list[str], int]] = []
    said = [words(t) for ts in TEMPLATES.values() for t in ts] + [words(phrase.format("")) for phrase in MISSES]
    gram = {g: n for n, g in enumerate(sorted({g for parts in said for g in _grams(parts)}))}
    for label, family in enumerate(families[:-1]):
        for number, template in enumerate(TEMPLATES[family]):
            # the words that a stretch has besides a notice's own are at most the two before it
            own = around if number < len(HEADERS.get(family, ())) else around[number % 8 :: 8]
            for n, (lead, _) in enumerate(own):
                parts = words(template)
                some = parts if n % 3 else [w for w in parts if w != "the"]
                examples.append((words(lead)[-2:] + some, label))
        for n, name in enumerate(NAMED.get(family, ())):
            examples += [(words(phrase.format(name)), unknown) for phrase in MISSES]
    headers = [words(t) for ts in HEADERS.values() for t in ts]
    for text in others:
        parts = words(text)
        used = set(parts)
        # a template can't be covered if too few of its words are there at all
        near = [t for t in headers if sum(w in used for w in t) >= LEAST_COVERED * len(t)]
        whole = [t for t in headers if len(parts) > 3 and sum(w in t for w in used) >= LEAST_COVERED * len(used)]
        if _mentions(parts, [False] * len(parts)):
            continue
        if not any(_covered(t, parts) >= LEAST_COVERED for t in near) and not any(_covered(parts, t) >= LEAST_COVERED for t in whole):
            examples.append((parts, unknown))
    # texts that speak of licences without naming a known one
    for text in ("All rights reserved.", "This file has a license.", "See the license for more.", "Licensed under our own terms.", "the public general version of this work", ""):
        examples += [(words(lead + text + tail), unknown) for lead, tail in around]
    # examples of the same grams are one that weighs more
    counted = Counter((*map(tuple, _sparse(parts, gram)), label) for parts, label in examples)
    features = np.zeros((len(counted), len(gram) + 2), np.float32)
    for row, (at, values, _) in zip(features, counted):
        row[list(at)] = values
    wanted = np.eye(len(families), dtype=np.float32)[[label for *_, label in counted]]
    share = np.array(list(counted.values()), np.float32)
    share /= wanted @ (wanted.T @ share)  # each class weighs the same
    held = np.arange(len(counted)) % 5 == 0
    x, y, s = features[~held], wanted[~held], share[~held, None]
    weights = np.zeros((features.shape[1], len(families)), np.float32)
    moved = np.zeros_like(weights)
    for _ in range(steps):
        slope = x.T @ (s * (_softmax(x @ weights) - y)) / s.sum() + 1e-6 * weights
        moved = 0.9 * moved - 8.0 * slope
        weights += moved
    weights = weights.astype(np.float64)
    heats = np.geomspace(0.25, 4.0, 25)
    y, s = wanted[held], share[held]
    margins = features[held] @ weights
    losses = [-(s * np.log((_softmax(margins / h) * y).sum(axis=1) + 1e-12)).sum() for h in heats]
    return Classifier(families, gram, weights, float(heats[int(np.argmin(losses))]), frozenset().union(*map(keys, _SOUGHT)))


def train(spark: SparkSession, docs: DataFrame, sample: int = SAMPLE) -> Classifier:
    """Fit with at most ``sample`` paragraphs of at most 400 characters from the corpus, chosen by the hash of their text."""
    lines = docs.select(F.explode(F.split("text", "\n", -1)).alias("line")).where("length(trim(line)) between 1 and 400")
    # at least as many lines as texts; a frequent line counts once
    others = smallest_hashes(lines, ["line"], sample, docs.count(), distinct=True)
    return fit(sorted({row["line"] for row in others.toLocalIterator()}))


def scanned(spark: SparkSession, docs: DataFrame, classifier: Classifier) -> DataFrame:
    """(doc_id, families, notices) per row of ``docs`` (doc_id, text).

    families: the licences found, ascending and each once. notices: for each notice its first and last line (from 0), family,
    probability and covered share of the template, in the order of the lines. A null or empty text has none. Repeated rows and null doc_ids are carried
    along; other columns are not looked at. An empty table gives an empty table.
    """
    shipped = spark.sparkContext.broadcast(classifier)
    kind = docs.schema["doc_id"].dataType.simpleString()
    notice = pa.struct([("line", pa.int32()), ("last_line", pa.int32()), ("family", pa.string()), ("probability", pa.float64()), ("covered", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shipped.value
        for batch in batches:
            families, notices = [], []
            for text in batch.column(1).to_pylist():
                found = [
                    {"line": x.first, "last_line": x.last, "family": x.family, "probability": x.probability, "covered": x.covered}
                    for x in model.scan(text)
                ]
                notices.append(found)
                families.append(sorted({x["family"] for x in found}))
            columns = [batch.column(0), pa.array(families, pa.list_(pa.string())), pa.array(notices, pa.list_(notice))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "families", "notices"])

    columns = f"doc_id {kind}, families array<string>, notices array<struct<line:int,last_line:int,family:string,probability:double,covered:double>>"
    return few_at_once(docs).select("doc_id", "text").mapInArrow(run, columns)
