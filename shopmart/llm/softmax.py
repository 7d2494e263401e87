"""Multinomial logistic regression over sets of hashed n-grams that lie in a table of any size.

The fit (limited-memory BFGS) takes the loss and its gradient over all sets in each of ``PASSES`` passes: tasks add
up their own rows, one array per core is shuffled by blocks, and the driver gets one sum, whose size depends on
the number of n-grams and classes only. No set is left out and the sums do not depend on how the rows are dealt, but for
rounding. Margins are divided by the root of the set's size.

Defined cases: an empty table adds nothing, so the fit sees the driver's own sets only; sets have one number at least.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from shopmart.llm import by_value

by_value(__name__)

BITS = 16
PASSES, START_PASSES, MEMORY, DECAY = 7, 25, 6, 1e-5
_BLOCK = 1 << 16


def flat(sets: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sets one after the other, and where each starts, the end included."""
    starts = np.cumsum([0, *map(len, sets)])
    return (np.concatenate(sets) if len(sets) else np.zeros(0)).astype(np.intp), starts


#: Columns of a table of packed sets; a row holds many sets.
PACKED = "n long, sizes binary, low binary, high binary"


def packed(numbers: np.ndarray, starts: np.ndarray) -> dict[str, object]:
    """A row of ascending sets: their sizes and the steps between their numbers, low and high bytes apart, which compress well."""
    steps = np.diff(numbers, prepend=0)
    begins = starts[:-1][np.diff(starts) > 0]
    steps[begins] = numbers[begins]
    sizes = np.diff(starts).astype(np.int32)
    low, high = steps.astype(np.uint8), (steps >> 8).astype(np.uint8)
    return {"n": len(sizes), "sizes": sizes.tobytes(), "low": low.tobytes(), "high": high.tobytes()}


def unpacked(sizes: bytes, low: bytes, high: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The sets of a packed row as :func:`flat` ones."""
    steps = np.frombuffer(low, np.uint8) + (np.frombuffer(high, np.uint8).astype(np.intp) << 8)
    lengths = np.frombuffer(sizes, np.int32).astype(np.int64)
    starts, total = np.concatenate([[0], np.cumsum(lengths)]), np.cumsum(steps)
    return total - np.repeat(total[starts[:-1]] - steps[starts[:-1]], lengths), starts


def summed(
    sets: DataFrame, size: int, add: Callable[[np.ndarray, np.ndarray, np.ndarray], None], kind: type = np.float64
) -> np.ndarray:
    """What ``add(total, numbers, starts)`` adds up over all sets of a table of packed ones."""

    def own(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(size)
        for batch in batches:
            for row in zip(batch["sizes"], batch["low"], batch["high"], strict=True):
                add(total, *unpacked(*row))
        parts = [(place, total[place : place + _BLOCK]) for place in range(0, size, _BLOCK)]
        yield pd.DataFrame([(place, part.astype(kind).tobytes()) for place, part in parts if part.any()], columns=["place", "part"])

    def joined(parts: pd.DataFrame) -> pd.DataFrame:
        whole = sum(np.frombuffer(part, kind).astype(np.float64) for part in parts["part"])
        return pd.DataFrame({"place": parts["place"].iloc[:1], "part": [whole.tobytes()]})

    schema = "place int, part binary"
    few = sets.select("sizes", "low", "high").coalesce(sets.sparkSession.sparkContext.defaultParallelism)
    total = np.zeros(size)
    for row in few.mapInPandas(own, schema).groupBy("place").applyInPandas(joined, schema).collect():
        part = np.frombuffer(row["part"])
        total[row["place"] : row["place"] + len(part)] = part
    return total


def chances(weights: np.ndarray, numbers: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Chance of each class (a row) for each set (a column); ``weights`` has a row per class."""
    if len(starts) < 2:
        return np.zeros((len(weights), 0), np.float32)
    margin = np.stack([np.add.reduceat(own.take(numbers), starts[:-1]) for own in weights]) / np.sqrt(np.diff(starts))
    grown = np.exp(margin - margin.max(axis=0))
    return grown / grown.sum(axis=0)


def add_gradient(total: np.ndarray, weights: np.ndarray, numbers: np.ndarray, starts: np.ndarray, labels: np.ndarray) -> None:
    """Add the gradient of the loss over some sets, a row per class, and behind it the loss."""
    slope, sizes, at = chances(weights, numbers, starts), np.diff(starts), np.arange(len(starts) - 1)
    total[-1] -= np.log(np.maximum(slope[labels, at], 1e-30)).sum()
    slope[labels, at] -= 1
    slope /= np.sqrt(sizes)
    rows = total[:-1].reshape(len(weights), -1)
    for row, own in zip(rows, slope, strict=True):
        row += np.bincount(numbers, weights=np.repeat(own, sizes), minlength=len(row))


def fit(
    sets: DataFrame,
    rows: int,
    most: float,
    label: int,
    own: Sequence[np.ndarray],
    own_labels: Sequence[int],
    classes: int,
    likely: Sequence[np.ndarray],
) -> np.ndarray:
    """Weights (a row per class) from all sets of a table, which have one label, and sets of the driver.

    The table's ``rows`` weigh alike and no more than ``most`` together; each of the driver's sets weighs 1. ``likely``
    sets only say where the passes over the table begin: at the fit that has them in the table's place.
    """
    context = sets.sparkSession.sparkContext
    size, weight = classes << BITS, min(1.0, most / max(1, rows))
    decay = DECAY * (len(own) + weight * rows)
    known, guessed = (*flat(own), np.asarray(own_labels)), (*flat(likely), np.full(len(likely), label))

    def loss(point: np.ndarray, table: Callable[[np.ndarray], np.ndarray]) -> tuple[float, np.ndarray]:
        by_class = point.reshape(classes, -1).astype(np.float32)
        total = np.zeros(size + 1)
        add_gradient(total, by_class, *known)
        total += table(by_class)
        return total[-1] + decay / 2 * point @ point, total[:-1] + decay * point

    def guess(by_class: np.ndarray) -> np.ndarray:
        total = np.zeros(size + 1)
        add_gradient(total, by_class, *guessed)
        return total * (weight * rows / max(1, len(likely)))

    def whole(by_class: np.ndarray) -> np.ndarray:
        sent = context.broadcast(by_class)

        def add(total: np.ndarray, numbers: np.ndarray, starts: np.ndarray) -> None:
            add_gradient(total, sent.value, numbers, starts, np.full(len(starts) - 1, label))

        total = summed(sets, size + 1, add, np.float32)
        sent.unpersist()
        return weight * total

    point = _descend(lambda w: loss(w, guess), np.zeros(size), START_PASSES)
    if rows:
        point = _descend(lambda w: loss(w, whole), point, PASSES)
    return point.reshape(classes, -1)


def _descend(loss: Callable[[np.ndarray], tuple[float, np.ndarray]], point: np.ndarray, passes: int) -> np.ndarray:
    """Limited-memory BFGS; a step that raises the loss is cut to a quarter, which counts as a pass."""
    value, slope = loss(point)
    pairs: list[tuple[np.ndarray, np.ndarray, float]] = []
    share = 1.0
    for _ in range(passes - 1):
        step, used = slope.copy(), []
        for moved, turned, scale in reversed(pairs):
            used.append(scale * (moved @ step))
            step -= used[-1] * turned
        if pairs:
            step *= 1 / (pairs[-1][2] * (pairs[-1][1] @ pairs[-1][1]))
        else:
            step *= min(1.0, 15 / max(1e-9, np.linalg.norm(step)))
        for (moved, turned, scale), part in zip(pairs, reversed(used), strict=True):
            step += moved * (part - scale * (turned @ step))
        after = point - share * step
        new_value, new_slope = loss(after)
        if new_value >= value:
            share /= 4
            continue
        moved, turned = after - point, new_slope - slope
        if moved @ turned > 0:
            pairs = [*pairs, (moved, turned, 1 / (moved @ turned))][-MEMORY:]
        point, value, slope, share = after, new_value, new_slope, 1.0
    return point
