"""Licence scans: a trained paragraph classifier whose verdicts a template comparison confirms.

A paragraph is a line with a word. Sparse word n-grams feed a multinomial logistic regression with one class per licence
family and an unknown class. The family classes learn from the notices below, cut and mixed with n-grams drawn as often as all texts have them; the
unknown class learns from every paragraph of every document, in runs of as many words as the largest window, as far as it shares
little with any notice. Together these runs weigh no more than ``UNKNOWN_WEIGHT`` examples, so that a large corpus does not drown the families. The
unknown class is calibrated: a paragraph counts as a family only above the probability that keeps ``UNKNOWN_KEPT`` of all
held-back runs (a quarter) unknown. The fit makes a pass over a table of all n-gram sets for each of its steps. A family is confirmed if the
paragraph aligns with one of its notices: words in order, where missing words and strange words in between (``GAP`` each)
cost no more than ``1 - CONFIRM_AT`` of the notice. Identifier lines (``SPDX-License-Identifier: ...``) are notices too.

A notice may also be wrapped over lines, stand next to another one, or in a long line: the lines between two blank lines
are read once more in overlapping windows of words, of several sizes up to twice the longest notice. In a window, a
family whose own word (one that no other family's notices hold) takes part is weighed against the unknown class
alone, so that two notices do not take each other's chance.

Every paragraph of every whole text is read. A paragraph that lacks so many words of each notice that no
template could confirm it is passed over by a search for a few words before the model sees it.

Defined cases: null, empty and blank texts have no paragraphs and no licence; a document with several
families lists them all; equal paragraphs are found each time; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from shopmart.llm import by_value
from shopmart.llm.features import indicators, word_grams
from shopmart.llm.softmax import BITS, PACKED, chances, fit, packed, summed
from shopmart.llm.storage import discard, store

by_value(__name__)

UNKNOWN = "unknown"
#: All unknown paragraphs weigh no more together than so many variants of notices.
UNKNOWN_WEIGHT = 6000
VARIANTS = 20
LIKELY = 1000
UNKNOWN_KEPT = 0.999
#: Steps of the limit between 0.5 and 1.
LIMITS = 1 << 16
CONFIRM_AT = 0.8
KNOWN_AT = 0.5
GAP = 0.25

#: Usual notices of licence families.
NOTICES: dict[str, tuple[str, ...]] = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0",
        "you may not use this file except in compliance with the License",
    ),
    "MIT": (
        "Released under the MIT License",
        "Licensed under the MIT License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
    ),
    "GPL": (
        "This work is licensed under the GNU General Public License, version 3",
        "This program is free software: you can redistribute it and/or modify it under the terms of the "
        "GNU General Public License as published by the Free Software Foundation",
    ),
    "LGPL": ("Licensed under the GNU Lesser General Public License",),
    "AGPL": ("Licensed under the GNU Affero General Public License",),
    "BSD": (
        "Released under the BSD License",
        "Redistribution and use in source and binary forms, with or without modification, are permitted",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
        "Licensed under the Mozilla Public License",
    ),
    "CC-BY": ("Licensed under CC BY 4.0", "licensed under a Creative Commons Attribution 4.0 International License"),
    "CC-BY-SA": (
        "Licensed under CC BY-SA 4.0",
        "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    ),
    "CC-BY-NC": (
        "Licensed under CC BY-NC 4.0",
        "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    ),
    "CC-BY-ND": (
        "Licensed under CC BY-ND 4.0",
        "licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License",
    ),
    "public-domain": ("Released into the public domain", "CC0 1.0 Universal"),
    "proprietary": ("All rights reserved",),
}
#: Names in identifier lines; versions and clauses may follow most of them.
IDENTIFIERS: dict[str, tuple[str, ...]] = {
    "Apache-2.0": ("Apache-2.0",),
    "MIT": ("MIT",),
    "GPL": ("GPL",),
    "LGPL": ("LGPL",),
    "AGPL": ("AGPL",),
    "BSD": ("BSD",),
    "MPL-2.0": ("MPL-2.0",),
    "CC-BY": ("CC-BY-4.0",),
    "CC-BY-SA": ("CC-BY-SA-4.0",),
    "CC-BY-NC": ("CC-BY-NC-4.0",),
    "CC-BY-ND": ("CC-BY-ND-4.0",),
    "public-domain": ("CC0-1.0", "Unlicense"),
}
_WORD = re.compile(r"[^\W_]+")


def words_in(paragraph: str) -> list[str]:
    return _WORD.findall(paragraph.lower())


def notices_of(family: str) -> list[str]:
    return [*NOTICES[family], *(f"SPDX-License-Identifier: {name}" for name in IDENTIFIERS.get(family, ()))]


TEMPLATES = [(family, words_in(notice)) for family in NOTICES for notice in notices_of(family)]


def _marks(share: float = CONFIRM_AT) -> list[str]:
    """Words of which every paragraph that a template confirms holds one.

    A confirmed paragraph lacks at most ``len - ceil(share * len)`` words of the notice, so it has one of
    any larger number of them; the longest ones are the rarest.
    """
    found = set()
    for _, words in TEMPLATES:
        lacking = len(words) - math.ceil(share * len(words) - 1e-9)
        found.update(sorted(words, key=lambda w: (-len(w), w))[: lacking + 1])
    return sorted(found)


def alignment(paragraph: list[str], template: list[str]) -> tuple[float, int, int]:
    """Best alignment of a template with any part of a paragraph: its score, its first word, the word after its last.

    A word of the template that stands in the part, in order, adds one; a word of the paragraph between two of
    them costs ``GAP``, so words strewn over a sentence are no notice. Before and behind, words cost nothing. The score
    is a share of the template's words. Of equal scores the earliest end counts, then the latest begin. Only the template's
    own words take steps, so a long paragraph costs no more than a short one with the same notice words.
    """
    own = set(template)
    # For each number of template words passed: the best score so far plus the gaps up to its end, and its begin.
    ahead: list[tuple[float, int]] = [(-math.inf, -1)] * (len(template) + 1)
    best = (0.0, 0, 0)
    for place, word in enumerate(paragraph):
        if word not in own:
            continue
        for j in range(len(template), 0, -1):
            if word != template[j - 1]:
                continue
            score, begin = ahead[j - 1][0] - GAP * place, ahead[j - 1][1]
            if score <= 0:
                score, begin = 0.0, place
            score += 1
            if score > best[0]:
                best = (score, begin, place + 1)
            reached = (score + GAP * (place + 1), begin)
            for k in range(j, len(template) + 1):
                if ahead[k] >= reached:
                    break
                ahead[k] = reached
    return best[0] / len(template), best[1], best[2]


def similarity(paragraph: list[str], template: list[str]) -> float:
    return alignment(paragraph, template)[0]


#: Sizes of windows, half overlapping: the largest holds every run of 33 words, the longest notice has 29.
SIZES = (8, 16, 32, 64)
MARKS = set(_marks())
_HALF_MARKS = frozenset(_marks(KNOWN_AT))
_ONLY_PLAIN = bytes(c if chr(c).isascii() and chr(c).isalnum() else 32 for c in range(256))
_ANY_MARK = re.compile("|".join(_marks()), re.I)
_BLANK = re.compile(r"\n[^\S\n]*\n")
OWN_WORDS = {
    family: {w for own, words in TEMPLATES if own == family for w in words}
    - {w for own, words in TEMPLATES if own != family for w in words}
    for family in NOTICES
}


def holds_mark(content: str) -> bool:
    """Whether a mark stands anywhere in a text, in any case; a plain search rules most texts out."""
    low = content.lower()
    if not low.isascii():  # letters that the pattern takes for s and i
        low = low.replace("\u017f", "s").replace("\u0131", "i").replace("\u0307", "")
    return any(mark in low for mark in MARKS) and _ANY_MARK.search(content) is not None


def windows(content: str) -> Iterator[tuple[int, int, list[str], str]]:
    """Windows of a text in which a template is found: where the notice starts and ends, the window's words, the family."""
    edges = [0, *[m.end() for m in _BLANK.finditer(content)], len(content)]
    for begin, stop in zip(edges, edges[1:], strict=False):
        found = list(_WORD.finditer(content, begin, stop))
        words = [m.group().lower() for m in found]
        at = [i for i, word in enumerate(words) if word in MARKS]
        for size in SIZES:
            step = size // 2
            for k in sorted({k for i in at for k in (i // step - 1, i // step) if k >= 0} | ({0} if at else set())):
                part = words[k * step : k * step + size]
                held = set(part)
                likely = {
                    family
                    for family, template in TEMPLATES
                    if sum(w in held for w in template) >= CONFIRM_AT * len(template) - 1e-9
                }
                sure = sorted(family for family in likely if confirmed(part, family))
                for family in sure:
                    _, first, last = max(alignment(part, t) for own, t in TEMPLATES if own == family)
                    yield found[k * step + first].start(), found[k * step + last - 1].end(), part, family


def confirmed(paragraph: list[str], family: str) -> bool:
    return any(similarity(paragraph, words) >= CONFIRM_AT for own, words in TEMPLATES if own == family)


def runs(content: str) -> Iterator[str]:
    """Paragraphs of a text in runs of words no larger than the largest window, but for those that share much with a notice."""
    # Bytes outside of ASCII end a word here, so no word that counts is missed.
    plain = not _half_held(set(content.lower().encode().translate(_ONLY_PLAIN).decode().split()))
    for line in content.split("\n"):
        if plain and len(line) < 2 * SIZES[-1]:
            yield line
            continue
        words = line.split()
        for first in range(0, len(words), SIZES[-1]):
            last = first + SIZES[-1]
            run = " ".join(words[first:last])
            if not plain:
                own = words_in(run)
                # A notice may begin in the run before or end in the next one.
                before = words_in(" ".join(words[max(0, first - SIZES[-2]) : first]))
                behind = words_in(" ".join(words[last : last + SIZES[-2]]))
                if _resembles(own, 0, len(own)) or (
                    (before or behind) and _resembles(before + own + behind, len(before), len(own))
                ):
                    continue
            yield run


def _half_held(held: set[str]) -> list[list[str]]:
    """Templates of which half the words are among some words."""
    if _HALF_MARKS.isdisjoint(held):
        return []
    return [words for _, words in TEMPLATES if sum(map(held.__contains__, words)) >= KNOWN_AT * len(words)]


def _resembles(words: list[str], first: int, size: int) -> bool:
    """Whether half of a notice stands in the words, some of it among ``size`` ones from the first."""
    for template in _half_held(set(words)):
        score, begin, end = alignment(words, template)
        if score >= KNOWN_AT and begin < first + size and end > first:
            return True
    return False


def unknown_sets(texts: DataFrame) -> DataFrame:
    """N-gram sets, packed, of all runs of all paragraphs that share little with a notice; a quarter is ``held`` back.

    What a run says decides whether it is held back, so copies go together. Each task adds a row with ``counts`` instead:
    how often each n-gram came in its runs.
    """

    def made(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = np.zeros(1 << BITS, np.int64)

        def counted(found: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
            grams = word_grams(found)
            for hashes, _ in grams:
                np.add(counts, np.bincount((hashes >> np.uint64(64 - BITS)).astype(np.intp), minlength=1 << BITS), out=counts)
            return grams

        for batch in batches:
            found: list[str] = []
            for number, content in enumerate(batch["text"], 1):
                found.extend(runs(content))
                if found and (len(found) >= 4000 or number == len(batch)):
                    held = np.array([zlib.crc32(run.encode()) % 4 == 0 for run in found])
                    for first, starts, numbers in indicators(found, counted, BITS):
                        sizes, out = np.diff(starts), held[first : first + len(starts) - 1]
                        # A run without words has an empty set and is none.
                        rows = [
                            {"held": part, **packed(numbers[np.repeat(chosen, sizes)], np.cumsum([0, *sizes[chosen]]))}
                            for part in (False, True)
                            if (chosen := (out == part) & (sizes > 0)).any()
                        ]
                        yield pd.DataFrame(rows, columns=["held", "n", "sizes", "low", "high"]).assign(counts=None)
                    found = []
        if counts.any():
            yield pd.DataFrame({"held": [None], "n": None, "sizes": None, "low": None, "high": None, "counts": [counts]})

    return texts.select("text").mapInPandas(made, f"held boolean, {PACKED}, counts array<long>")


def _sets(texts: list[str], grams: Callable = word_grams) -> list[np.ndarray]:
    return [n[a:b] for _, starts, n in indicators(texts, grams, BITS) for a, b in zip(starts, starts[1:], strict=False)]


def _variants(counts: np.ndarray) -> tuple[list[np.ndarray], list[int]]:
    """Training sets of the families: notices with dropped words, among n-grams drawn as often as all texts have them."""
    draw = np.random.default_rng(11)
    upto = np.cumsum(counts)
    texts, around, labels = [], [], []
    for label, notices in enumerate(map(notices_of, NOTICES)):
        for number in range(VARIANTS * len(notices)):
            words = words_in(notices[number % len(notices)])
            texts.append(" ".join(w for w in words if number < 2 * len(notices) or draw.random() > 0.06))
            # Up to 11 words before and behind; each has about four n-grams.
            size = 8 * int(draw.integers(0, 12)) if upto[-1] and number >= len(notices) else 0
            around.append(np.searchsorted(upto, draw.integers(0, upto[-1], size), side="right") if size else [])
            labels.append(label)
    return [np.union1d(own, other).astype(np.intp) for own, other in zip(_sets(texts), around, strict=True)], labels


def _likely(counts: np.ndarray, rows: int) -> list[np.ndarray]:
    """Sets of n-grams drawn as often as all texts have them: a start for the fit, which then sees the texts' own sets."""
    draw, upto = np.random.default_rng(7), np.cumsum(counts)
    if not rows:
        return []
    sizes = draw.integers(1, max(2, 2 * int(upto[-1]) * 3 // (4 * rows)), LIKELY)
    return [np.unique(np.searchsorted(upto, draw.integers(0, upto[-1], size), side="right")) for size in sizes]


class Model:
    """Multinomial logistic regression over n-gram sets, of unit length each; the last class is the unknown one."""

    def __init__(self, weights: np.ndarray, limit: float) -> None:
        self.weights, self.limit = weights, limit

    def chances(self, numbers: np.ndarray) -> np.ndarray:
        margin = self.weights[numbers].sum(axis=0) / np.sqrt(max(1, len(numbers)))
        grown = np.exp(margin - margin.max())
        return grown / grown.sum()

    def family(self, numbers: np.ndarray) -> tuple[int, float]:
        chance = self.chances(numbers)
        best = int(chance[:-1].argmax())
        return best, float(chance[best])


def train(texts: DataFrame) -> Model:
    """A model for the families and the unknown class, which is the last one, from all paragraphs of all texts."""
    sets = store(unknown_sets(texts), "paragraph-sets", compression="zstd")
    learned = sets.filter("NOT held")

    rows, counts = learned.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0], np.zeros(1 << BITS, np.int64)
    by_gram = sets.select(F.posexplode("counts").alias("gram", "n")).groupBy("gram").agg(F.sum("n").alias("n"))
    for row in by_gram.collect():
        counts[row["gram"]] = row["n"]
    own, labels = _variants(counts)
    # Paragraphs of a few notice words that no notice holds: hard cases for the unknown class.
    draw = np.random.default_rng(5)
    vocabulary = sorted({w for _, words in TEMPLATES for w in words})
    loose = [" ".join(vocabulary[i] for i in draw.integers(0, len(vocabulary), 6)) for _ in range(VARIANTS * 10)]
    unknown = len(NOTICES)
    own, labels = own + _sets(loose), labels + [unknown] * len(loose)
    likely = _likely(counts, rows)
    weights = fit(learned, rows, UNKNOWN_WEIGHT, unknown, own, labels, unknown + 1, likely).astype(np.float32)
    sent = texts.sparkSession.sparkContext.broadcast(weights)

    def rank(total: np.ndarray, numbers: np.ndarray, starts: np.ndarray) -> None:
        best = chances(sent.value, numbers, starts)[:-1].max(axis=0)
        place = np.clip((2 * best - 1) * LIMITS, 0, LIMITS).astype(np.int64)
        total += np.bincount(place, minlength=len(total))

    # How many held-back paragraphs reach each limit from 0.5 to 1; limits below do not count.
    below = np.cumsum(summed(sets.filter("held"), LIMITS + 1, rank))
    sent.unpersist()
    discard(sets)
    reached = int(np.searchsorted(below, UNKNOWN_KEPT * below[-1]))
    limit = min(1.0, 0.5 + (reached + 1) / LIMITS / 2) if reached else 0.5
    return Model(np.ascontiguousarray(weights.T), limit)


def scan(documents: DataFrame, *, identifier: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``id``, ``families`` (sorted), ``spans`` (family:start:end in code points) and ``n_rejected``.

    ``n_rejected`` counts paragraphs that the model took for a family and no template confirmed.
    """
    texts = documents.select(F.col(identifier).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    model_of = train(texts)
    model = documents.sparkSession.sparkContext.broadcast((model_of.weights, model_of.limit))
    names = list(NOTICES)

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = Model(*model.value)
        for batch in batches:
            hits, parts = [], []
            for number, content in enumerate(batch["text"]):
                if holds_mark(content):
                    at = 0
                    parts.extend((number, *part) for part in windows(content))
                    for paragraph in content.split("\n"):
                        if holds_mark(paragraph):
                            hits.append((number, at, paragraph))
                        at += len(paragraph) + 1
            spans: list[list[tuple[int, int, str]]] = [[] for _ in range(len(batch))]
            doubtful: list[tuple[int, int, int]] = []
            rejected = np.zeros(len(batch), np.int64)
            for (number, at, paragraph), grams in zip(hits, _sets([p for *_, p in hits]), strict=True):
                best, sure = own.family(grams)
                if sure < own.limit:
                    continue
                if confirmed(words_in(paragraph), names[best]):
                    spans[number].append((at, at + len(paragraph), names[best]))
                else:
                    doubtful.append((number, at, at + len(paragraph)))
            for (number, start, end, words, family), grams in zip(parts, _sets([" ".join(p[3]) for p in parts]), strict=True):
                chance = own.chances(grams)
                best = names[int(chance[:-1].argmax())]
                mine, other = chance[names.index(family)], chance[-1]
                if mine >= own.limit and family == best or (
                    not OWN_WORDS[family].isdisjoint(words) and mine >= own.limit * (mine + other)
                ):
                    if not any(f == family and a < end and start < b for a, b, f in spans[number]):
                        spans[number].append((start, end, family))
            for number, start, end in doubtful:
                rejected[number] += not any(a < end and start < b for a, b, _ in spans[number])
            yield pd.DataFrame(
                {
                    "id": batch["id"],
                    "families": [",".join(sorted({f for *_, f in s})) for s in spans],
                    "spans": [",".join(f"{f}:{a}:{b}" for a, b, f in sorted(s)) for s in spans],
                    "n_rejected": rejected,
                }
            )

    return texts.mapInPandas(search, "id long, families string, spans string, n_rejected long")
