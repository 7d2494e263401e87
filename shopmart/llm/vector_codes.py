"""Compress vectors to one codebook index per part (product quantisation) in whole numbers.

Every component becomes ``floor(scale * x)``. A vector is cut into equal consecutive parts, and each part position has
a codebook that starts from the vectors with the smallest identifiers. A round assigns every part to its nearest
entry and then moves each entry to the mean of its parts, rounded down. Distances are exact integers; ties go to the
lower index.

Norm-of-sum bounds spare most comparisons. A part keeps the distance of its second nearest entry and the round in
which that was measured. The codebooks of all rounds are retained, so the net way an entry has gone since any
round is known; it is never longer than the sum of its single steps. If the part is nearer to its own
entry than the old second distance less the longest net way of the other entries, no other entry can be as near
and the part stays; otherwise it is compared with all entries and stamped with the present round.

Vectors with their indexes, bounds and stamps are a stored table per round; its predecessor is deleted when
the next one is complete. Codebooks, and nothing that grows with the vectors, pass through the
driver: sums of parts are added up in each task, then by slot and position.

Defined cases: a vector that is null or holds a null or non-finite component is dropped. The others of the length
that the first of them (by identifier, nulls last, then by components) has are coded; any of another length has a null
code and error. That length must be a multiple of ``parts`` (an empty vector has distance 0) and at most
``MAX_COMPONENTS``; a scaled component of ``MAX_SCALED`` or more in size is an error, as sums could exceed 64 bits. With fewer vectors than
entries the codebooks are shorter; repeated identifiers are vectors of their own; equal entries
leave all parts to the first of them; an empty table gives no rows. Identifiers have any type that can be sorted; of other columns
only those in ``carry`` are kept, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from shopmart.llm import by_value
from shopmart.llm.storage import discard, store
from shopmart.operators.joins import dimension_join

by_value(__name__)

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
MAX_SCALED = 1 << 24
MAX_COMPONENTS = 4096
EXACT = 1 << 53
#: Rows compared with a whole codebook at a time.
BLOCK = 4096


def scaled(vectors: DataFrame, identifier: str, embedding: str, scale: int, carry: Sequence[str]) -> DataFrame:
    """``id``, ``ints`` and ``row`` of the vectors that are whole and finite."""
    values = F.col(f"`{embedding}`").cast("array<double>")
    whole = F.forall(values, lambda x: x.isNotNull() & (F.abs(x) < float("inf")))  # NaN exceeds infinity
    number = lambda x: F.floor(x * scale)
    wide = F.raise_error(F.lit(f"a scaled component of {embedding} reaches {MAX_SCALED}")).cast("int")
    ints = F.transform(values, lambda x: F.when(F.abs(number(x)) < MAX_SCALED, number(x).cast("int")).otherwise(wide))
    kept = F.struct(*[F.col(f"`{name}`") for name in carry]) if carry else F.struct(F.lit(0).alias("none"))
    return vectors.filter(values.isNotNull() & whole).select(
        F.col(f"`{identifier}`").alias("id"), ints.alias("ints"), kept.alias("row")
    )


def distances(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of all points to all entries; floats serve while they are exact."""
    largest = int(max(np.abs(points).max(initial=0), np.abs(entries).max(initial=0)))
    if 4 * largest * largest * points.shape[1] < EXACT:
        p, e = points.astype(np.float64), entries.astype(np.float64)
        return ((p * p).sum(1)[:, None] + (e * e).sum(1) - 2 * (p @ e.T)).astype(np.int64)
    return np.stack([((points - entry) ** 2).sum(1) for entry in entries], axis=1)


def net_ways(history: np.ndarray) -> np.ndarray:
    """For every round and entry of a part, the longest way any *other* entry has gone from that round to the last."""
    ways = np.sqrt(((history[-1] - history).astype(np.float64) ** 2).sum(-1))
    if ways.shape[1] < 2:
        return np.zeros_like(ways)
    order = np.argsort(ways, axis=1)
    rows = np.arange(len(ways))
    longest, next_one = order[:, -1], order[:, -2]
    others = np.repeat(ways[rows, longest][:, None], ways.shape[1], axis=1)
    others[rows, longest] = ways[rows, next_one]
    return others


def assign_part(points: np.ndarray, history: np.ndarray, codes: np.ndarray, seconds: np.ndarray, stamps: np.ndarray):
    """New indexes, second distances, stamps and exact squared distances of one part position.

    ``history`` holds the codebook of each round up to the present one; a stamp of -1 means not assigned yet.
    """
    now, entries = len(history) - 1, history[-1]
    codes, seconds, stamps = codes.copy(), seconds.copy(), stamps.copy()
    own = ((points - entries[codes]) ** 2).sum(1)
    allowed = seconds - net_ways(history)[stamps, codes]
    # Rounding of roots must not make a bound too long.
    allowed -= 1e-9 * (1 + np.abs(np.where(np.isfinite(seconds), seconds, 0)))
    stays = (stamps >= 0) & (allowed > 0) & (np.sqrt(own.astype(np.float64)) < allowed)
    again = np.flatnonzero(~stays)
    for at in range(0, len(again), BLOCK):
        rows = again[at : at + BLOCK]
        found = distances(points[rows], entries)
        best = found.argmin(1)
        place = np.arange(len(rows))
        codes[rows], own[rows], stamps[rows] = best, found[place, best], now
        if found.shape[1] > 1:
            found[place, best] = np.iinfo(np.int64).max
            seconds[rows] = np.sqrt(found.min(1).astype(np.float64))
        else:
            seconds[rows] = np.inf
    return codes, seconds, stamps, own


def _matrix(column: pa.Array, width: int, kind) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(column), width)


def _lists(values: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    edges = np.arange(0, values.size + 1, values.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(edges, pa.array(np.ascontiguousarray(values).reshape(-1), kind))


STATE = "codes array<smallint>, seconds array<double>, stamps array<tinyint>"


def assigned(vectors: DataFrame, history: np.ndarray) -> DataFrame:
    """The vectors with ``codes``, ``seconds``, ``stamps`` and the exact ``error`` for the last codebooks."""
    parts, width = history.shape[1], history.shape[3]
    first = len(history) == 1
    names = ["id", "ints", "row"]
    rows = vectors.select(*names, *([] if first else ["codes", "seconds", "stamps"]))
    schema = StructType([*rows.schema.fields[:3], *StructType.fromDDL(STATE + ", error long").fields])
    shared = vectors.sparkSession.sparkContext.broadcast(history)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = shared.value.astype(np.int64)
        for batch in batches:
            size = batch.num_rows
            points = _matrix(batch.column(1), parts * width, np.int64).reshape(size, parts, width)
            if first:
                codes = np.zeros((size, parts), np.int64)
                seconds, stamps = np.zeros((size, parts)), np.full((size, parts), -1)
            else:
                codes, stamps = _matrix(batch.column(3), parts, np.int64), _matrix(batch.column(5), parts, np.int64)
                seconds = _matrix(batch.column(4), parts, np.float64)
            error = np.zeros(size, np.int64)
            for part in range(parts):
                codes[:, part], seconds[:, part], stamps[:, part], own = assign_part(
                    points[:, part], books[:, part], codes[:, part], seconds[:, part], stamps[:, part]
                )
                error += own
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:3],
                    _lists(codes, pa.int16()),
                    _lists(seconds, pa.float64()),
                    _lists(stamps, pa.int8()),
                    pa.array(error),
                ],
                [*names, "codes", "seconds", "stamps", "error"],
            )

    return rows.mapInArrow(run, schema)


def moved_entries(state: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after a round: the mean of each entry's parts, rounded down; unused entries stay."""
    parts, entries, width = books.shape

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((parts * entries, width + 1), np.int64)
        for batch in batches:
            points = _matrix(batch.column(0), parts * width, np.int64).reshape(batch.num_rows, parts, width)
            codes = _matrix(batch.column(1), parts, np.int64)
            for part in range(parts):
                order = np.argsort(codes[:, part], kind="stable")
                ordered = codes[order, part]
                starts = np.flatnonzero(np.diff(ordered, prepend=-1))
                slots = part * entries + ordered[starts]
                sums[slots, :width] += np.add.reduceat(points[order, part], starts, axis=0) if len(starts) else 0
                sums[slots, width] += np.diff(np.append(starts, len(ordered)))
        used = np.flatnonzero(sums[:, width])
        if len(used):
            yield pa.RecordBatch.from_arrays([pa.array(used), _lists(sums[used], pa.int64())], ["slot", "sums"])

    partial = state.select("ints", "codes").mapInArrow(add_up, "slot long, sums array<long>")
    totals = (
        partial.select("slot", F.posexplode("sums").alias("place", "part"))
        .groupBy("slot", "place")
        .agg(F.sum("part").alias("total"))
        .toPandas()  # a row per component of a codebook
    )
    sums = np.zeros((parts * entries, width + 1), np.int64)
    sums[totals["slot"].to_numpy(np.int64), totals["place"].to_numpy(np.int64)] = totals["total"].to_numpy(np.int64)
    sums = sums.reshape(parts, entries, width + 1)
    counts = sums[..., width:]
    return np.where(counts > 0, np.floor_divide(sums[..., :width], np.maximum(counts, 1)), books)


def compress(
    vectors: DataFrame,
    *,
    identifier: str = "vec_id",
    embedding: str = "embedding",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
    carry: Sequence[str] = (),
) -> tuple[DataFrame, list]:
    """``id``, ``code`` (a byte per part), ``error``, ``stamps`` and ``row`` (the carried columns), and the codebooks.

    ``stamps`` is the round in which each part was last compared with all entries.
    """
    if not 0 < entries <= 256:
        raise ValueError("a byte holds an index of at most 256 entries")
    kept = scaled(vectors, identifier, embedding, scale, carry)
    order = [F.col("id").asc_nulls_last(), F.col("ints")]
    first = kept.orderBy(*order).select(F.size("ints")).first()
    size = first[0] if first else 0
    if size % parts or size > MAX_COMPONENTS:
        raise ValueError(f"vectors of {size} components cannot be cut into {parts} parts")
    fitting, others = kept.filter(F.size("ints") == size), kept.filter(F.size("ints") != size)
    seeds = fitting.orderBy(*order).limit(entries).select("ints").collect() if first else []
    books = np.array([row["ints"] for row in seeds], np.int64).reshape(len(seeds), parts, size // parts).swapaxes(0, 1)
    history, state = [books], fitting
    result = "id", "code", "error", "stamps", "row"
    unfit = others.select(
        "id", F.lit(None).cast("binary"), F.lit(None).cast("long"), F.lit(None).cast("array<tinyint>"), "row"
    )
    if not first:
        return unfit.toDF(*result), books.tolist()
    for _ in range(rounds):
        held, state = state, store(assigned(state, np.stack(history)), "vector-codes")
        if held is not fitting:
            discard(held)
        history.append(moved_entries(state, history[-1]))
    coded = store(assigned(state, np.stack(history)), "vector-codes")
    if state is not fitting:
        discard(state)
    digits = F.transform("codes", lambda code: F.lpad(F.hex(code.cast("long")), 2, "0"))
    done = coded.select("id", F.unhex(F.array_join(digits, "")), "error", "stamps", "row")
    return done.unionAll(unfit).toDF(*result), history[-1].tolist()


def with_group_error(coded: DataFrame, group: Column) -> DataFrame:
    """``coded`` with ``group_error``, the errors summed over equal groups; nulls are a group.

    The sums are joined back by their measured size, so that a frequent group does not meet in one task.
    """
    keyed = coded.withColumn("_group", F.to_json(F.struct(group.alias("group"))))
    sums = keyed.groupBy("_group").agg(F.sum("error").alias("group_error"))
    return dimension_join(keyed, sums, ["_group"]).drop("_group")
