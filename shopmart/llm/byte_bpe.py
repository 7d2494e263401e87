"""Byte-level BPE by backtracking over longest matches.

A vocabulary gives byte strings ranks in the order of their merges. A text is cut by the vocabulary's pattern,
and each match is encoded on its own: an Aho-Corasick automaton over the tokens (bytes read as Latin-1
characters) finds the longest token at every place; the encoder takes it if the token before it stays apart
from it, else the next shorter token that starts there, and steps back if none is left. Two tokens stay apart if no
merge across their border would have come before the merges inside them, which is found by undoing
those merges from the last to the first; the answer is memoised per pair. A place that was left once is
never entered again, so the work is linear in the bytes, and the ids are those that merging gives, because a
sequence of tokens whose neighbours all stay apart is unique.

The tables are built once on the driver, which reads the rank file, and travel as a broadcast whose size is that of
the vocabulary. A worker also remembers the ids of the short matches that it met last, between ``KNOWN_PIECES`` and twice as
many; this changes no result.

Defined cases: null and empty texts have no ids; a text that is one match of any length is encoded
like others; a match that is itself a token is that token, even if no merges lead to it; rows that repeat are encoded one by
one and there are no ties; identifiers have any type and may be null; an empty table gives no rows; of other
columns only those in ``carry`` are kept, whatever their names. Null ids decode to no bytes; an id
outside the vocabulary is an error.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from shopmart.llm import by_value
from shopmart.llm.packing import PATTERN

by_value(__name__)

KNOWN_PIECES = 1 << 18
KNOWN_PAIRS = 1 << 18
LONGEST_KNOWN = 64
#: Texts are given back in batches of about so many characters.
BATCH_CHARS = 1 << 21
NO_LIMIT = 1 << 62


def read_ranks(path: str) -> dict[bytes, int]:
    """The tokens of a rank file: a line each, the token in base64 and its rank."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


def apart(tables: dict, left: int, right: int, limit: int = NO_LIMIT) -> bool:
    """Whether merging leaves two neighbouring tokens apart, given merges of a rank below ``limit``."""
    tokens, ranks, firsts, seconds = tables["tokens"], tables["ranks"], tables["firsts"], tables["seconds"]
    while True:
        if ranks.get(tokens[left] + tokens[right], limit) < limit:
            return False
        # Undo the later of the two last merges; of equal ones the right one, as the leftmost pair merges first.
        undo_left = left > right and seconds[left] != left
        if not undo_left and firsts[right] == right:
            undo_left = seconds[left] != left
            if not undo_left:
                return True
        if undo_left:
            limit, left = left, seconds[left]
        else:
            limit, right = right + 1, firsts[right]


def _merged(ranks: dict[bytes, int], piece: bytes) -> list[bytes]:
    """A piece by plain merging, for the few tokens without parts of lower ranks."""
    parts = [piece[at : at + 1] for at in range(len(piece))]
    while len(parts) > 1:
        rank, at = min((ranks.get(a + b, NO_LIMIT), at) for at, (a, b) in enumerate(zip(parts, parts[1:])))
        if rank == NO_LIMIT:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return parts


def tables_of(ranks: dict[bytes, int]) -> dict:
    """Tokens by rank, the two parts of each, its longest shorter prefix, and the automaton.

    A byte is its own first and second part. Bytes and tokens that no merge makes are left out of the automaton. A token made
    from parts of higher ranks is an error: undoing merges by rank would not be undoing them by time.
    """
    import ahocorasick

    missing = [byte for byte in range(256) if bytes([byte]) not in ranks]
    if missing:
        raise ValueError(f"{len(missing)} bytes are no tokens")
    tokens = {rank: token for token, rank in sorted(ranks.items(), key=lambda pair: pair[1])}
    firsts: dict[int, int] = {}
    seconds: dict[int, int] = {}
    shorter: dict[int, int] = {}
    tables = {"tokens": tokens, "ranks": ranks, "firsts": firsts, "seconds": seconds, "shorter": shorter, "pairs": {}}
    for token in map(bytes, zip(range(256))):
        firsts[ranks[token]] = seconds[ranks[token]] = ranks[token]
    automaton = ahocorasick.Automaton()
    for rank, token in tokens.items():
        for size in range(len(token) - 1, 0, -1):
            first, second = ranks.get(token[:size]), ranks.get(token[size:])
            # Parts that merges make have lower ranks, so those are known already.
            if first in firsts and second in firsts and max(first, second) < rank and apart(tables, first, second, rank):
                firsts[rank], seconds[rank] = first, second
                break
        if rank not in firsts and _merged(ranks, token) == [token]:
            raise ValueError(f"token {rank} is made from tokens of higher ranks")
    for rank in firsts:
        token = tokens[rank]
        if len(token) > 1:
            automaton.add_word(token.decode("latin-1"), (rank, len(token)))
        prefixes = (ranks.get(token[:size]) for size in range(len(token) - 1, 0, -1))
        shorter[rank] = next((prefix for prefix in prefixes if prefix in firsts), None)
    automaton.make_automaton()
    single = [ranks[bytes([byte])] for byte in range(256)]
    sizes = {rank: len(token) for rank, token in tokens.items()}
    return tables | {"automaton": automaton, "bytes": single, "sizes": sizes}


def encode_piece(tables: dict, piece: bytes) -> list[int]:
    """Ids of one match of the pattern."""
    whole = tables["ranks"].get(piece)
    if whole is not None:
        return [whole]
    sizes, shorter, pairs = tables["sizes"], tables["shorter"], tables["pairs"]
    longest = list(map(tables["bytes"].__getitem__, piece))
    for end, (token, length) in tables["automaton"].iter(piece.decode("latin-1")):
        longest[end + 1 - length] = token  # ends only grow, so the last one seen at a place is the longest
    size = len(piece)
    left_once = bytearray(size + 1)
    ids: list[int] = []
    at, token, before = 0, longest[0], None
    while at < size:
        while token is not None:
            end = at + sizes[token]
            if not left_once[end]:
                if before is None:
                    break
                pair = before << 32 | token
                if pair not in pairs:
                    if len(pairs) >= KNOWN_PAIRS:
                        pairs.clear()
                    pairs[pair] = apart(tables, before, token)
                if pairs[pair]:
                    break
            token = shorter[token]
        if token is None:  # no token fits here: give the one before up for a shorter one
            left_once[at] = 1
            token = ids.pop()
            at -= sizes[token]
            before = ids[-1] if ids else None
        else:
            ids.append(token)
            before, at = token, end
            token = longest[at] if at < size else None
    return ids


class Pieces(dict):
    """Ids of matches as little-endian 32-bit bytes, computed when asked for and remembered.

    When the dictionary is full, what it holds becomes the older half of what is known.
    """

    def __init__(self, tables: dict) -> None:
        super().__init__()
        self.tables, self.older = tables, {}

    def __missing__(self, piece: str) -> bytes:
        data = self.older.get(piece)
        if data is None:
            ids = encode_piece(self.tables, piece.encode("utf-8"))
            data = struct.pack(f"<{len(ids)}i", *ids)
        if len(piece) <= LONGEST_KNOWN:
            if len(self) >= KNOWN_PIECES:
                self.older = dict(self)
                self.clear()
            self[piece] = data
        return data


def encode_texts(tables: dict, texts: Sequence[str | None], pattern: str = PATTERN) -> Iterator[bytes]:
    """The ids of each text as little-endian 32-bit bytes."""
    import regex

    find = regex.compile(pattern).findall
    known = tables.setdefault("pieces", Pieces(tables))  # lives as long as the broadcast tables in a worker
    for text in texts:
        yield b"".join(map(known.__getitem__, find(text or "")))


def _slices(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of rows that hold about ``BATCH_CHARS``; a row is never split."""
    marks = np.concatenate([[0], np.cumsum(sizes)])
    start = 0
    while start < len(sizes):
        stop = max(start + 1, int(np.searchsorted(marks, marks[start] + BATCH_CHARS)))
        yield start, min(stop, len(sizes))
        start = stop


def encode(
    documents: DataFrame,
    vocabulary: str,
    *,
    text: str = "text",
    carry: Sequence[str] = ("doc_id",),
    pattern: str = PATTERN,
) -> DataFrame:
    """``row`` (the columns in ``carry``) and ``ids`` of every document; ``vocabulary`` is a rank file on the driver."""
    tables = documents.sparkSession.sparkContext.broadcast(tables_of(read_ranks(vocabulary)))
    kept = F.struct(*[F.col(f"`{name}`") for name in carry]) if carry else F.struct(F.lit(0).alias("none"))
    texts = documents.select(kept.alias("row"), F.col(f"`{text}`").cast("string").alias("text"))
    schema = StructType([texts.schema["row"], *StructType.fromDDL("ids array<int>").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("text")
            sizes = pa.compute.fill_null(pa.compute.utf8_length(column), 0).to_numpy(zero_copy_only=False)
            for start, stop in _slices(sizes):
                parts = list(encode_texts(tables.value, column.slice(start, stop - start).to_pylist(), pattern))
                edges = np.concatenate([[0], np.cumsum([len(part) // 4 for part in parts])]).astype(np.int32)
                ids = pa.array(np.frombuffer(b"".join(parts), "<i4"))
                rows = batch.column("row").slice(start, stop - start)
                yield pa.RecordBatch.from_arrays([rows, pa.ListArray.from_arrays(edges, ids)], ["row", "ids"])

    return texts.mapInArrow(run, schema)


def decode(encoded: DataFrame, vocabulary: str, *, ids: str = "ids", to: str = "data") -> DataFrame:
    """The columns of ``encoded`` and the bytes of each row's ids."""
    by_rank = {rank: token for token, rank in read_ranks(vocabulary).items()}
    tokens = encoded.sparkSession.sparkContext.broadcast(by_rank)
    names = [name for name in encoded.columns if name != to]
    rows = encoded.select(*[F.col(f"`{name}`") for name in names])
    schema = StructType([*rows.schema.fields, *StructType.fromDDL(f"`{to}` binary").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(names.index(ids))
            sizes = pa.compute.fill_null(pa.compute.list_value_length(column), 0).to_numpy(zero_copy_only=False)
            for start, stop in _slices(sizes):
                part = batch.slice(start, stop - start)
                parts = list(map(tokens.value.__getitem__, part.column(names.index(ids)).flatten().to_numpy().tolist()))
                edges = np.concatenate([[0], np.cumsum(sizes[start:stop])]).tolist()
                data = [b"".join(parts[first:last]) for first, last in zip(edges, edges[1:])]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(data, pa.binary())], [*names, to])

    return rows.mapInArrow(run, schema)
