"""Toxicity: logistic regression over hashed words, word pairs and skip-grams, learned by FTRL-proximal.

Each coordinate has its own learning rate, which falls with the squares of its gradients, and the L1
penalty keeps a coordinate at exactly zero until its evidence outweighs it, so only the few n-grams that
tell the classes apart have a weight. These travel to the tasks as two short arrays. The fit sees
at most about ``2 * PER_LABEL`` labelled documents (a documented bound, drawn by a hash of the id);
scoring reads every whole text, and a sum over n-grams present finds one bad passage in a long one.

Defined cases: as for :mod:`shopmart.llm.quality_model`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from shopmart.llm import by_value
from shopmart.llm.features import Sample, crc32_of, labelled_sample, margins, platt, probability, word_grams

by_value(__name__)

PER_LABEL = 4000
BITS = 20
ALPHA, BETA, L1, L2 = 1.0, 1.0, 8.0, 1.0
PASSES = 3
DECIDE_AT = 0.3


class Ftrl:
    """FTRL-proximal for sets of indicators."""

    def __init__(self, size: int) -> None:
        self.z, self.n = np.zeros(size), np.zeros(size)
        self.bias_z = self.bias_n = 0.0

    def weights(self, at: np.ndarray | slice) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    def bias(self) -> float:
        return -self.bias_z / ((BETA + np.sqrt(self.bias_n)) / ALPHA)

    def learn(self, numbers: np.ndarray, label: int) -> None:
        own, bias = self.weights(numbers), self.bias()
        gradient = 1 / (1 + np.exp(-np.clip(own.sum() + bias, -30, 30))) - label
        square = gradient * gradient
        rate = (np.sqrt(self.n[numbers] + square) - np.sqrt(self.n[numbers])) / ALPHA
        self.z[numbers] += gradient - rate * own
        self.n[numbers] += square
        rate = (np.sqrt(self.bias_n + square) - np.sqrt(self.bias_n)) / ALPHA
        self.bias_z += gradient - rate * bias
        self.bias_n += square


def fit(sample: Sample, bits: int = BITS, seed: int = 1) -> tuple[np.ndarray, np.ndarray, float, float]:
    """N-grams with a weight, their weights, and slope and offset of the calibration on documents held back."""
    held = np.arange(len(sample.sets)) % 5 == 0
    learner, order = Ftrl(1 << bits), np.random.default_rng(seed)
    train = np.flatnonzero(~held)
    if len(train) and sample.labels[train].min() != sample.labels[train].max():
        for _ in range(PASSES):
            for i in order.permutation(train):
                learner.learn(sample.sets[i], sample.labels[i])
    weights = learner.weights(slice(None))
    margin = np.array([weights[sample.sets[i]].sum() for i in np.flatnonzero(held)])
    numbers = np.flatnonzero(weights)
    return numbers, weights[numbers], *platt(margin, sample.labels[held], sample.weights[held])


def score(
    documents: DataFrame, labels: DataFrame, *, label: str = "toxic", held_out: Column | None = None
) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of every document."""

    def outside() -> Column:
        return crc32_of("doc_id") % 4 == 2 if held_out is None else held_out

    numbers, weights, slope, offset = fit(labelled_sample(documents, labels, label, ~outside(), word_grams, PER_LABEL, BITS))
    model = documents.sparkSession.sparkContext.broadcast((numbers, weights))

    def scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        dense = np.zeros(1 << BITS)
        dense[model.value[0]] = model.value[1]
        for batch in batches:
            sums, _ = margins(batch["text"].tolist(), word_grams, dense, BITS)
            chance = probability(sums, slope, offset)
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"],
                    "held_out": batch["held_out"],
                    "score": chance,
                    "predicted": (chance >= DECIDE_AT).astype(np.int32),
                }
            )

    rows = documents.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"), outside().alias("held_out"))
    return rows.mapInPandas(scored, "doc_id long, held_out boolean, score double, predicted int")
