"""Quality classifier: support vectors over n-grams scaled by naive Bayes.

Indicators of n-grams are scaled by the log of the ratio of their shares in the two classes; a
linear model with hinge loss is fitted to the scaled, length-normalised indicators by dual
coordinate descent, and a logistic curve fitted to documents held back from the descent makes a
probability of its margin. The fit sees a sample of at most about ``2 * PER_LABEL`` labelled documents
(a documented bound, drawn by a hash of the id); scoring reads every whole text.

Defined cases: null and empty text has no n-grams and scores by the offset alone; without labels, or
with one label only, every score is the share of that label; a null id is not held out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from shopmart.llm import by_value
from shopmart.llm.features import BITS, Sample, crc32_of, labelled_sample, margins, platt, probability, style_grams

by_value(__name__)

PER_LABEL = 4000
SMOOTHING = 1.0
COST = 1.0
PASSES = 12
DECIDE_AT = 0.3


def log_count_ratios(sets: list[np.ndarray], labels: np.ndarray, size: int) -> np.ndarray:
    """Log ratio of an n-gram's share of the documents with label 1 to its share of those with label 0."""
    counts = np.full((2, size), SMOOTHING)
    for label in (0, 1):
        chosen = [s for s, own in zip(sets, labels, strict=True) if own == label]
        if chosen:
            counts[label] += np.bincount(np.concatenate(chosen), minlength=size)
    shares = counts / counts.sum(axis=1, keepdims=True)
    return np.log(shares[1] / shares[0])


def descend(sets: list[np.ndarray], labels: np.ndarray, ratios: np.ndarray, seed: int = 1) -> np.ndarray:
    """Weights of a linear hinge-loss model over scaled, normalised indicators, by dual coordinate descent."""
    signs = np.where(labels == 1, 1.0, -1.0)
    weights, alpha = np.zeros(len(ratios)), np.zeros(len(sets))
    values = [ratios[s] / np.sqrt(max(1, len(s))) for s in sets]
    squares = np.array([float(v @ v) for v in values])
    order = np.random.default_rng(seed)
    for _ in range(PASSES):
        for i in order.permutation(len(sets)):
            if squares[i] == 0:
                continue
            slope = signs[i] * float(weights[sets[i]] @ values[i]) - 1
            new = min(max(alpha[i] - slope / squares[i], 0.0), COST)
            if new != alpha[i]:
                weights[sets[i]] += (new - alpha[i]) * signs[i] * values[i]
                alpha[i] = new
    return weights


def fit(sample: Sample, bits: int = BITS) -> tuple[np.ndarray, float, float]:
    """Weight per n-gram, and slope and offset of the calibration, which sees every fifth document only."""
    held = np.arange(len(sample.sets)) % 5 == 0
    train = [s for s, out in zip(sample.sets, held, strict=True) if not out]
    labels = sample.labels[~held]
    weights = np.zeros(1 << bits)
    if len(train) and labels.min() != labels.max():
        ratios = log_count_ratios(train, labels, 1 << bits)
        weights = descend(train, labels, ratios) * ratios
    checked = [s for s, out in zip(sample.sets, held, strict=True) if out]
    margin = np.array([weights[s].sum() / np.sqrt(max(1, len(s))) for s in checked])
    return weights, *platt(margin, sample.labels[held], sample.weights[held])


def score(
    documents: DataFrame, labels: DataFrame, *, label: str = "quality", held_out: Column | None = None
) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of every document."""

    def outside() -> Column:
        return crc32_of("doc_id") % 5 == 0 if held_out is None else held_out

    weights, slope, offset = fit(labelled_sample(documents, labels, label, ~outside(), style_grams, PER_LABEL))
    model = documents.sparkSession.sparkContext.broadcast(weights.astype(np.float32))

    def scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sums, sizes = margins(batch["text"].tolist(), style_grams, model.value)
            chance = probability(sums / np.sqrt(np.maximum(1, sizes)), slope, offset)
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
