"""Pack token sequences by bulk-synchronous best fit.

Spark turns each document into pieces of at most ``SEQUENCE`` tokens, range-sorts them by length
and ranks them inside their length. Documents of one length are interchangeable, and so are gaps of
one size; both sides of a sweep are therefore runs, (length, how many) and (gap, how many), and as
lengths and gaps are bounded by the sequence, so is the number of runs, whatever the corpus holds.
A round takes the longest run of documents left, sweeps the gaps upwards from its successor, gives
each gap as many documents as it holds, opens sequences for the rest, and files the changed gaps
under their new size; the rank of a document inside its length decides which gap it gets, so no two
want the same place. Rounds go on until no run is left. What they give are rules

    (length, from rank, how many, documents a sequence, first sequence, offset)

which Spark applies to the ranked pieces. A gap that takes part in a round shrinks below half
its size, so a sequence is touched at most 11 times and there are at most some ten thousand rules.

Defined cases: null and empty text is the end token alone; the name of the added token inside a text is
that token, as for ``tokenizers``; a text longer than a sequence is cut
from its end into full pieces, and its first piece holds the rest; rows that repeat a document are
packed like any other; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from shopmart.llm import by_value
from shopmart.llm.storage import store

by_value(__name__)

SEQUENCE = 2048
END = 0
#: How the byte-level vocabulary cuts a text before its merges; a fixed part of the vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The added token of the vocabulary, which its tokenizer recognises inside a text; a fixed part of it too.
ADDED = {"<|endoftext|>": 50256}
_ENCODINGS: dict[int, object] = {}


def byte_encoding(ranks: bytes):
    """An encoder for a byte-level vocabulary given as lines of base64 token and rank; one per worker."""
    key = zlib.crc32(ranks)
    if key not in _ENCODINGS:
        import tiktoken

        merges = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in ranks.splitlines())}
        _ENCODINGS[key] = tiktoken.Encoding("bytes", pat_str=PATTERN, mergeable_ranks=merges, special_tokens=ADDED)
    return _ENCODINGS[key]


def pieces(documents: DataFrame, vocabulary: str, *, identifier: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per piece: ``id``, ``piece``, ``start``, ``length``, ``ids_crc32``, and ``ids`` if asked for.

    ``vocabulary`` is the path of a rank file on the driver; its bytes travel with the tasks.
    """
    with open(vocabulary, "rb") as file:
        ranks = documents.sparkSession.sparkContext.broadcast(file.read())
    schema = "id long, piece int, start long, length int, ids_crc32 long" + (", ids array<int>" if with_ids else "")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoding = byte_encoding(ranks.value)
        for batch in batches:
            rows = []
            for key, content in zip(batch["id"], batch["text"], strict=True):
                ids = np.append(encoding.encode_to_numpy(content, allowed_special="all"), END).astype("<u4")
                first = len(ids) % SEQUENCE or SEQUENCE
                edges = [0, *range(first, len(ids) + 1, SEQUENCE)]
                for number, (start, stop) in enumerate(zip(edges, edges[1:], strict=False)):
                    part = ids[start:stop]
                    row = (key, number, start, stop - start, zlib.crc32(part.tobytes()))
                    rows.append((*row, part.astype(np.int32)) if with_ids else row)
            names = ["id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
            yield pd.DataFrame(rows, columns=names)

    texts = documents.select(F.col(identifier).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return texts.mapInPandas(cut, schema)


def _with(frame: DataFrame, more: str) -> StructType:
    return StructType([*frame.schema.fields, *StructType.fromDDL(more).fields])


class Gaps:
    """Open sequences by gap: runs (gap, first sequence, how many), sorted by gap."""

    def __init__(self) -> None:
        self.sizes: list[int] = []
        self.runs: dict[int, list[tuple[int, int]]] = {}
        self.opened = 0

    def add(self, gap: int, first: int, count: int) -> None:
        if gap and count:
            if gap not in self.runs:
                insort(self.sizes, gap)
                self.runs[gap] = []
            self.runs[gap].append((first, count))

    def successor(self, length: int) -> tuple[int, int, int] | None:
        """Take the next run of the smallest gap that holds a length."""
        at = bisect_left(self.sizes, length)
        if at == len(self.sizes):
            return None
        gap = self.sizes[at]
        first, count = self.runs[gap].pop()
        if not self.runs[gap]:
            del self.runs[gap], self.sizes[at]
        return gap, first, count


def best_fit_rules(lengths: dict[int, int], sequence: int = SEQUENCE) -> list[tuple[int, int, int, int, int, int]]:
    """Rounds of best fit over runs: (length, from rank, how many, a sequence, first sequence, offset)."""
    gaps, rules = Gaps(), []
    for length in sorted(lengths, reverse=True):
        rank, left = 0, lengths[length]
        while left:
            found = gaps.successor(length)
            if found is None:
                a_sequence = sequence // length
                found = sequence, gaps.opened, -(-left // a_sequence)
                gaps.opened += found[2]
            gap, first, count = found
            a_sequence = gap // length
            full = min(count, left // a_sequence)
            if full:
                rules.append((length, rank, full * a_sequence, a_sequence, first, sequence - gap))
                gaps.add(gap - a_sequence * length, first, full)
                rank, left = rank + full * a_sequence, left - full * a_sequence
            if left and full < count:
                rules.append((length, rank, left, a_sequence, first + full, sequence - gap))
                gaps.add(gap - left * length, first + full, 1)
                full, left = full + 1, 0
            gaps.add(gap, first + full, count - full)
    return rules


def pack(documents: DataFrame, vocabulary: str, **options) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``: best fit over all documents."""
    cut = pieces(documents, vocabulary, **options)
    columns = cut.columns

    def ranked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rank inside the length within this range of pieces, which are sorted by length."""
        from pyspark import TaskContext

        part, last, seen = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            if len(batch):
                place = batch.groupby("length").cumcount()
                place += np.where(batch["length"] == last, seen, 0)
                last, seen = batch["length"].iloc[-1], int(place.iloc[-1]) + 1
                yield batch.assign(part=part, place=place)

    order = ["length", "id", "piece", "ids_crc32"]
    dealt = store(cut, "pack-pieces").repartitionByRange(*order).sortWithinPartitions(*order)
    sorted_pieces = store(dealt.mapInPandas(ranked, _with(dealt, "part int, place long")), "pack-ranked")

    # Ranges of the sorted pieces: together at most one row per length and one per range.
    ranges = sorted_pieces.groupBy("length", "part").count().orderBy("length", "part").collect()
    lengths: dict[int, int] = {}
    before = {}
    for row in ranges:
        before[row["length"], row["part"]] = lengths.get(row["length"], 0)
        lengths[row["length"]] = lengths.get(row["length"], 0) + row["count"]
    rules = np.array(sorted(best_fit_rules(lengths)), np.int64).reshape(-1, 6)
    offsets = np.array([(*key, ranks) for key, ranks in sorted(before.items())], np.int64).reshape(-1, 3)
    shared = documents.sparkSession.sparkContext.broadcast((rules, offsets))

    def placed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rules, offsets = shared.value
        wide = 1 << 40
        rule_keys, range_keys = rules[:, 0] * wide + rules[:, 1], offsets[:, 0] * (1 << 24) + offsets[:, 1]
        for batch in batches:
            length = batch["length"].to_numpy(np.int64)
            own = offsets[np.searchsorted(range_keys, length * (1 << 24) + batch["part"].to_numpy(np.int64)), 2]
            rank = batch["place"].to_numpy(np.int64) + own
            rule = rules[np.searchsorted(rule_keys, length * wide + rank, side="right") - 1]
            turn = rank - rule[:, 1]
            yield batch[columns].assign(
                sequence_id=rule[:, 4] + turn // rule[:, 3], offset=rule[:, 5] + turn % rule[:, 3] * length
            )

    return sorted_pieces.mapInPandas(placed, _with(cut, "sequence_id long, offset long"))
