"""Mix sources to target weights by min-cost flow over membership patterns.

A document may belong to several sources. Documents with the same set of sources form a
pattern, and only the patterns' word counts take part in the flow:

    start -> pattern -> each source of the pattern -> end

The edge into a pattern has one layer per repetition, each as wide as the pattern's words, with
a cost that rises from layer to layer; the edge out of a source is as wide as its quota. Since the
cost depends on the layer alone, successive cheapest paths fill all first layers as far as any
rerouting allows before a second one is opened, and so on (:func:`route`).

The flow says how many words each pattern gives. Every document of the pattern gives as many whole
copies as fit, and the rest comes from documents in a seeded order up to a cut, found by
:func:`selection_cuts` from sums per digit of the order key; no pattern is ever sorted or gathered in
one task. In the table of words taken the document at the cut gives a part of its words, so that a pattern gives exactly
its flow; the mix itself has whole documents only, and that one is in if at least half of it is taken.

Defined cases: null or empty text has 0 words and gives 0; a document without sources gives 0;
rows that share id and seed share their place in the order, and a tie at the cut shares the words
left, rounded down; an empty table gives no rows. Input columns of any name are left alone.
"""

from __future__ import annotations

import json
from collections import deque
from collections.abc import Mapping, Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame, functions as F

from shopmart.llm.storage import discard, store
from shopmart.llm.words import n_words

WEIGHTS = (3, 1, 2)
SHARE = Fraction(3, 2)
MAX_REPEATS = 2
SEED = "mix-1"
#: Sources and patterns are metadata held by the driver; more of them than this is an error, never a cut.
MAX_PATTERNS = 100_000
_KEY_BITS, _DIGIT_BITS = 60, 10


def source_targets(
    sizes: Mapping[str | None, int],
    weights: Sequence[int] = WEIGHTS,
    share: Fraction = SHARE,
    repeats: int = MAX_REPEATS,
) -> dict[str | None, Fraction]:
    """Exact targets: weights repeat over the sources in code point order, null last.

    A target stops at ``repeats`` times its source's size; what is cut off goes to the others by
    weight until none is above its limit.
    """
    names = sorted((name for name in sizes if name is not None)) + [None] * (None in sizes)
    weight = {name: weights[i % len(weights)] for i, name in enumerate(names)}
    left, open_names, targets = share * sum(sizes.values()), list(names), {}
    while open_names:
        unit = Fraction(left) / sum(weight[name] for name in open_names)
        above = [name for name in open_names if weight[name] * unit > repeats * sizes[name]]
        if not above:
            return targets | {name: weight[name] * unit for name in open_names}
        for name in above:
            targets[name] = Fraction(repeats * sizes[name])
            left -= targets[name]
        open_names = [name for name in open_names if name not in targets]
    return targets


def route(
    patterns: Mapping[tuple, int], quotas: Mapping[str | None, int], repeats: int = MAX_REPEATS
) -> dict[tuple[tuple, str | None], int]:
    """Words that each pattern gives to each of its sources at the least repetition cost.

    Augments along shortest paths, one repetition layer after the other; paths may take words
    back from a source and send them to another one.
    """
    flow: dict[tuple[tuple, str | None], int] = {}
    room = {source: quota for source, quota in quotas.items() if quota > 0}
    givers: dict[str | None, set[tuple]] = {}
    for _ in range(repeats):
        supply = {pattern: words for pattern, words in patterns.items() if words > 0}
        for start in sorted(supply, key=lambda p: (len(p), repr(p))):
            while supply[start]:
                path = _path(start, room, givers)
                if not path:
                    break
                edges = list(zip(path[0::2], path[1::2], strict=True))
                back = [(path[i + 2], path[i + 1]) for i in range(0, len(path) - 2, 2)]
                amount = min(supply[start], room[path[-1]], *(flow[edge] for edge in back))
                for edge in edges:
                    flow[edge] = flow.get(edge, 0) + amount
                    givers.setdefault(edge[1], set()).add(edge[0])
                for edge in back:
                    flow[edge] -= amount
                    if not flow[edge]:
                        givers[edge[1]].discard(edge[0])
                supply[start] -= amount
                room[path[-1]] -= amount
    return {edge: words for edge, words in flow.items() if words}


def _path(start: tuple, room: Mapping, givers: Mapping) -> list | None:
    """Shortest way from a pattern to a source with room: pattern, source, pattern, source, ..."""
    came: dict[tuple, list] = {start: [start]}
    queue, seen = deque([start]), set()
    while queue:
        pattern = queue.popleft()
        for source in pattern:
            if source in seen:
                continue
            seen.add(source)
            if room.get(source, 0) > 0:
                return [*came[pattern], source]
            for other in givers.get(source, ()):
                if other not in came:
                    came[other] = [*came[pattern], source, other]
                    queue.append(other)
    return None


def pattern_key(sources: Column) -> Column:
    """The set of sources as text; a null source is a member like any other."""
    return F.to_json(F.array_sort(F.array_distinct(F.coalesce(sources, F.array().cast("array<string>")))))


def order_key(identifier: Column, seed: str = SEED) -> Column:
    """A seeded number of 60 bits."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(identifier.cast("string"), F.lit("null"))).cast("binary"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def selection_cuts(measured: DataFrame, given: Mapping[str, tuple[int, int]]) -> list[tuple]:
    """Rows (pattern, copies, low, high, part) that turn the words of each pattern into words of each document.

    ``given`` holds the words asked of a pattern and its words in all; ``measured`` has the
    columns pattern, size and place. Keys below ``low`` give one more copy, keys from ``low`` to
    before ``high`` give ``part`` words of one. Each pass sums the sizes by the next ten bits of
    the key inside the interval that holds the cut, so it moves at most 1024 sums per pattern.
    """
    spark = measured.sparkSession
    done, at = [], {}
    for pattern, (asked, total) in given.items():
        copies, rest = divmod(asked, total) if total else (0, 0)
        if rest:
            at[pattern] = (copies, 0, rest)
        else:
            done.append((pattern, copies, 0, 0, 0))
    bits = 0
    while at:
        bits += _DIGIT_BITS
        opened = F.broadcast(
            spark.createDataFrame(
                [(pattern, prefix, rest) for pattern, (_, prefix, rest) in at.items()],
                "pattern string, prefix long, rest long",
            )
        )
        digit = F.shiftright("place", _KEY_BITS - bits)
        sums = (
            measured.filter("size > 0")
            .join(opened, "pattern")
            .filter(F.shiftright("place", _KEY_BITS - bits + _DIGIT_BITS) == F.col("prefix"))
            .groupBy("pattern", digit.alias("digit"))
            .agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("rows"), F.first("rest").alias("rest"))
        )
        gathered = sums.groupBy("pattern").agg(
            F.first("rest").alias("rest"), F.array_sort(F.collect_list(F.struct("digit", "words", "rows"))).alias("parts")
        )
        for row in gathered.collect():
            copies, _, rest = at.pop(row["pattern"])
            for digit_value, words, rows in row["parts"]:
                if words > rest:
                    break
                rest -= words
            low, high = digit_value << (_KEY_BITS - bits), (digit_value + 1) << (_KEY_BITS - bits)
            if rest == 0:
                done.append((row["pattern"], copies, low, low, 0))
            elif rows == 1 or bits == _KEY_BITS:
                done.append((row["pattern"], copies, low, high, rest // rows))
            else:
                at[row["pattern"]] = (copies, digit_value, rest)
    return done


def mix(
    documents: DataFrame,
    *,
    identifier: str = "doc_id",
    text: str = "text",
    sources: Column | None = None,
    weights: Sequence[int] = WEIGHTS,
    share: Fraction = SHARE,
    repeats: int = MAX_REPEATS,
    seed: str = SEED,
) -> DataFrame:
    """One row per document: ``row`` (all input columns), ``size``, ``taken``, ``pattern``, ``source_size``, ``target``.

    ``sources`` is an array column and defaults to the one source in the column ``source``. For a
    document in several sources, ``source_size`` and ``target`` are those of its first source.
    """
    spark = documents.sparkSession
    members = F.array("source") if sources is None else sources

    def measured(*kept: Column) -> DataFrame:
        return documents.select(
            *kept,
            pattern_key(members).alias("pattern"),
            n_words(F.col(text)).alias("size"),
            order_key(F.col(identifier), seed).alias("place"),
        )

    narrow = store(measured(), "mix-sizes")
    found = narrow.groupBy("pattern").agg(F.sum("size").alias("size")).limit(MAX_PATTERNS + 1).collect()
    if len(found) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} sets of sources")
    totals = {row["pattern"]: row["size"] for row in found}
    names = {key: tuple(json.loads(key)) for key in totals}
    sizes: dict[str | None, int] = {}
    for key, words in totals.items():
        for source in names[key]:
            sizes[source] = sizes.get(source, 0) + words
    # A document in several sources counts once for the size of the mix.
    overlap = Fraction(sum(totals[k] for k in totals if names[k]), sum(sizes.values()) or 1)
    targets = source_targets(sizes, weights, share * overlap, repeats)
    quotas = {source: int(target + Fraction(1, 2)) for source, target in targets.items()}
    flow = route({names[key]: words for key, words in totals.items() if names[key]}, quotas, repeats)
    given = {key: (sum(flow.get((names[key], s), 0) for s in names[key]), totals[key]) for key in totals}
    cuts = selection_cuts(narrow, given)
    discard(narrow)

    def first(key: str) -> tuple:
        source = names[key][0] if names[key] else None
        return (sizes.get(source, 0), float(targets[source])) if names[key] else (0, 0.0)

    plan = spark.createDataFrame(
        [(*cut, *first(cut[0])) for cut in cuts],
        "pattern string, copies long, low long, high long, part long, source_size long, target double",
    )
    row = F.struct(*[F.col(f"`{name}`") for name in documents.columns]).alias("row")
    extra = F.when(F.col("place") < F.col("low"), F.col("size")).when(
        F.col("place") < F.col("high"), F.least("size", "part")
    )
    return (
        measured(row)
        .join(F.broadcast(plan), "pattern")
        .select(
            "row",
            "pattern",
            "size",
            "source_size",
            "target",
            (F.col("copies") * F.col("size") + F.coalesce(extra, F.lit(0))).alias("taken"),
        )
    )


def mixed_documents(documents: DataFrame, *, text: str = "text", **options) -> DataFrame:
    """The mix itself: a row per copy, columns as in ``documents``.

    Documents come whole: the one at a source's cut is in if at least half of its words are taken.
    """
    copies = F.expr("(2 * taken + size) div (2 * size)")
    mixed = mix(documents, text=text, **options).filter("2 * taken >= size AND size > 0")
    rows = mixed.select("row", F.explode(F.sequence(F.lit(1).cast("long"), copies)).alias("copy"))
    return rows.select(*[F.col("row").getField(name).alias(name) for name in documents.columns])
