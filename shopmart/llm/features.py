"""Hashed n-gram indicators of texts, labelled samples of documents, and calibrated scores.

Both classifiers of the package share this: a text becomes the set of its n-grams, each hashed to
one of ``2 ** BITS`` numbers. Batches of texts are hashed as arrays (:mod:`shopmart.llm.words`); whole
texts are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from shopmart.llm import by_value
from shopmart.llm.storage import store
from shopmart.llm.words import paired, sorted_unique, word_hashes

by_value(__name__)

BITS = 18
#: Bytes of a word that stand for its inflected forms.
STEM = 4
_GROUP_CHARS = 400_000


def _groups(texts: Sequence[str]) -> Iterator[tuple[int, list[str]]]:
    """Texts in groups of bounded size, so that the arrays of a group stay small."""
    start, group, size = 0, [], 0
    for number, text in enumerate(texts):
        group.append(text or "")
        size += len(group[-1])
        if size >= _GROUP_CHARS:
            yield start, group
            start, group, size = number + 1, [], 0
    if group:
        yield start, group


def _neighbours(words: np.ndarray, owners: np.ndarray, step: int, salt: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of words that stand ``step`` apart in one text."""
    same = owners[step:] == owners[:-step]
    return paired(words[:-step], words[step:], salt)[same], owners[step:][same]


def word_grams(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Words, their stems, pairs of words and pairs with one word between; punctuation ends a word."""
    words, owners, stems = word_hashes(texts, "not_plain", stem=STEM)
    return [(words, owners), (stems, owners), _neighbours(words, owners, 1, 1), _neighbours(words, owners, 2, 2)]


def style_grams(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Words, pairs of words, shapes of words, pairs of shapes, and the fact that a word is repeated at once."""
    words, owners, shapes = word_hashes(texts, "white", shapes=True)
    again = (words[1:] == words[:-1]) & (owners[1:] == owners[:-1])
    repeat = np.full(int(again.sum()), 0x5EED, np.uint64)
    return [
        (words, owners),
        _neighbours(words, owners, 1, 1),
        (shapes ^ np.uint64(0xA5A5), owners),
        _neighbours(shapes, owners, 1, 3),
        (repeat, owners[1:][again]),
    ]


def indicators(texts: Sequence[str], grams: Callable, bits: int = BITS) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each group of texts: number of the first one, starts of the texts' sets, and the sets one after the other."""
    for first, group in _groups(texts):
        keys = [
            (owners.astype(np.int64) << bits) | (hashes >> np.uint64(64 - bits)).astype(np.int64)
            for hashes, owners in grams(group)
        ]
        unique = sorted_unique(np.concatenate(keys))
        owners, numbers = unique >> bits, unique & ((1 << bits) - 1)
        yield first, np.searchsorted(owners, np.arange(len(group) + 1)), numbers.astype(np.int32)


def margins(texts: Sequence[str], grams: Callable, weights: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Sum of the weights of each text's n-grams, and how many it has."""
    sums, sizes = np.zeros(len(texts)), np.zeros(len(texts), np.int64)
    for first, starts, numbers in indicators(texts, grams, bits):
        total = np.concatenate([[0.0], np.cumsum(weights[numbers], dtype=np.float64)])
        sums[first : first + len(starts) - 1] = total[starts[1:]] - total[starts[:-1]]
        sizes[first : first + len(starts) - 1] = np.diff(starts)
    return sums, sizes


class Sample:
    """Labelled documents as sets of hashed n-grams, with the weight that restores the share of their label."""

    def __init__(self, rows: pd.DataFrame, totals: dict[int, int]) -> None:
        rows = rows.sort_values(["place", "label"], kind="stable").reset_index(drop=True)
        self.sets = [np.frombuffer(x, np.int32) for x in rows["grams"]]
        self.labels = rows["label"].to_numpy(np.int64)
        drawn = np.bincount(self.labels, minlength=2)
        of_label = np.array([totals.get(label, 0) / max(1, drawn[label]) for label in (0, 1)])
        self.weights = of_label[self.labels] if len(rows) else np.zeros(0)


def labelled_sample(
    documents: DataFrame, labels: DataFrame, label: str, usable: Column, grams: Callable, per_label: int, bits: int = BITS
) -> Sample:
    """About ``per_label`` documents of each label, drawn by a hash of their id, as n-gram sets on the driver.

    The bound holds whatever the tables' size: rows of a label are drawn with the chance
    ``per_label / rows``. ``usable`` says which rows may be learned from.
    """
    known = labels.filter(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & usable)
    known = known.select("doc_id", F.col(label).cast("int").alias("label"))
    totals = {row["label"]: row["count"] for row in known.groupBy("label").count().collect()}
    place = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(label)), F.lit(1 << 40))
    chance = F.when(F.col("label") == 1, per_label / max(1, totals.get(1, 0))).otherwise(
        per_label / max(1, totals.get(0, 0))
    )
    drawn = known.withColumn("place", place).filter(F.col("place") < chance * (1 << 40)).dropDuplicates(["doc_id", "label"])
    texts = documents.select("doc_id", "text").join(F.broadcast(drawn), "doc_id")

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets = [
                numbers[a:b].tobytes()
                for _, starts, numbers in indicators(batch["text"].tolist(), grams, bits)
                for a, b in zip(starts, starts[1:], strict=False)
            ]
            yield pd.DataFrame({"label": batch["label"], "place": batch["place"], "grams": sets})

    rows = store(texts.mapInPandas(hashed, "label int, place long, grams binary"), "labelled-sample")
    collected = rows.collect()
    return Sample(pd.DataFrame(collected, columns=["label", "place", "grams"]), totals)


def platt(margin: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve that turns margins into probabilities (Newton's method, smoothed targets)."""
    if not len(margin) or labels.min() == labels.max():
        share = float(np.average(labels, weights=weights)) if len(margin) else 0.5
        return 0.0, float(np.log((share + 0.01) / (1.01 - share)))
    positive, negative = weights[labels == 1].sum(), weights[labels == 0].sum()
    scale = max(1e-9, float(np.std(margin)))
    x, slope, offset = margin / scale, 1.0, float(np.log((positive + 1) / (negative + 1)))
    target = np.where(labels == 1, 1 - 1 / ((labels == 1).sum() + 2), 1 / ((labels == 0).sum() + 2))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(slope * x + offset, -30, 30)))
        error, curve = weights * (p - target), weights * np.maximum(p * (1 - p), 1e-9)
        gradient = np.array([(error * x).sum() + 1e-3 * slope, error.sum()])
        hessian = np.array([[(curve * x * x).sum() + 1e-3, (curve * x).sum()], [(curve * x).sum(), curve.sum() + 1e-9]])
        step = np.linalg.solve(hessian, gradient)
        step *= min(1.0, 5 / max(1e-9, np.abs(step).max()))
        slope, offset = slope - step[0], offset - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return float(slope / scale), float(offset)


def probability(margin: np.ndarray, slope: float, offset: float) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(slope * margin + offset, -30, 30)))


def crc32_of(identifier: str) -> Column:
    return F.crc32(F.coalesce(F.col(identifier).cast("string"), F.lit("")).cast("binary"))
