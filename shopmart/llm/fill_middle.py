"""Fill-in-middle examples: a text is cut twice between units and its middle goes to the end.

Texts are read as classes of characters, each with a mark whether white space or the end of the text follows, and a
wavelet matrix is built over the classes of a batch of texts. A unit (``UNITS``) ends at every character
of some classes; how many units end before a place is a sum of rank queries, one for each block of
classes that share their upper bits, and the place of a given end is found by bisection on these sums,
for all texts of a batch at once. Only the numbers of the cuts travel between Python and Spark, which puts the
parts together.

The number of units before each cut, whether a text stays plain, and the order of the parts come from a digest of
seed and identifier, so reruns agree. A plain text is its own example. From an example and its form alone
``restore`` gives the text back.

Defined cases: a null or empty text is plain and empty; a text that holds a marker is plain; a null identifier is
read as ``null``; a text without any end of a unit is one unit, and characters after the last end are one
more; very long texts are cut as wholes; rows that repeat get the same cuts, and equal texts with different
identifiers their own; both cuts may fall on one place, which leaves the middle empty; an empty table gives no
rows; of other columns only those in ``carry`` are kept, whatever their names.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from shopmart.llm import by_value

by_value(__name__)

MARKERS = ("<P>", "<S>", "<M>")
SEED = "1"
PLAIN_PERCENT = 10
SUFFIX_FIRST_PERCENT = 20
#: A wavelet matrix covers texts of about so many characters, or one longer text.
MATRIX_CHARS = 1 << 20

# Classes of characters; the bit FOLLOWED says that white space or the end of the text comes next.
LINE_END, WHITE, SENTENCE_END, LETTER, MARK, DIGIT, SIGN, OTHER = range(8)
FOLLOWED, LEVELS = 8, 4
WHITE_CHARS = " \t\x0b\x0c\r"
SENTENCE_CHARS = ".!?…。！？"
CLASS_OF_CATEGORY = {"L": LETTER, "M": MARK, "N": DIGIT, "P": SIGN, "S": SIGN}

#: The symbols at which a unit ends.
UNITS = {
    "character": range(16),
    "word": [FOLLOWED + kind for kind in range(SENTENCE_END, 8)],
    "sentence": [FOLLOWED + SENTENCE_END],
    "line": [LINE_END, FOLLOWED + LINE_END],
}

_BLOCK = 256


def _block_classes(block: int) -> np.ndarray:
    """Classes of 256 code points in a row."""

    def kind(char: str) -> int:
        if char == "\n":
            return LINE_END
        if char in WHITE_CHARS:
            return WHITE
        return SENTENCE_END if char in SENTENCE_CHARS else CLASS_OF_CATEGORY.get(unicodedata.category(char)[0], OTHER)

    return np.array([kind(chr(block * _BLOCK + place)) for place in range(_BLOCK)], np.uint8)


def classes_of(points: np.ndarray) -> np.ndarray:
    """Class of every code point; only blocks that occur are looked up."""
    blocks = points >> 8
    table = np.zeros((0x110000 // _BLOCK, _BLOCK), np.uint8)
    for block in np.flatnonzero(np.bincount(blocks)):
        table[block] = _block_classes(int(block))
    return table.reshape(-1)[points]


def symbols_of(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of some texts in a row, and where each text starts; the last start is the end of all."""
    starts = np.concatenate([[0], np.cumsum([len(text) for text in texts])]).astype(np.int64)
    kinds = classes_of(np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4"))
    followed = np.ones(len(kinds) + 1, bool)
    followed[:-1] = kinds <= WHITE
    followed[starts] = True
    return kinds + FOLLOWED * followed[1:].astype(np.uint8), starts


class WaveletMatrix:
    """Counts of symbols in any stretch of a sequence: a bit vector with sampled ranks for every bit of a symbol."""

    def __init__(self, symbols: np.ndarray, levels: int = LEVELS) -> None:
        self.levels, self.size = levels, len(symbols)
        self.words: list[np.ndarray] = []
        self.ones_before: list[np.ndarray] = []
        self.zeros: list[int] = []
        for level in reversed(range(levels)):
            bits = (symbols >> level) & 1
            packed = np.packbits(bits, bitorder="little")
            words = np.zeros(self.size // 64 + 1, "<u8")
            words.view(np.uint8)[: len(packed)] = packed
            before = np.zeros(len(words), np.int64)
            np.cumsum(np.bitwise_count(words[:-1]), out=before[1:])
            self.words.append(words)
            self.ones_before.append(before)
            symbols = np.concatenate([symbols[bits == 0], symbols[bits == 1]])
            self.zeros.append(self.size - int(bits.sum()))

    def _ones(self, level: int, at: np.ndarray) -> np.ndarray:
        """How many bits of a level are set before each place."""
        word, rest = at >> 6, (at & 63).astype(np.uint64)
        mask = (np.uint64(1) << rest) - np.uint64(1)
        return self.ones_before[level][word] + np.bitwise_count(self.words[level][word] & mask)

    def count(self, prefix: int, depth: int, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """How many symbols from ``start`` to before ``stop`` have ``prefix`` as their upper ``depth`` bits."""
        for level in range(depth):
            ones_start, ones_stop = self._ones(level, start), self._ones(level, stop)
            if prefix >> (depth - 1 - level) & 1:
                start, stop = self.zeros[level] + ones_start, self.zeros[level] + ones_stop
            else:
                start, stop = start - ones_start, stop - ones_stop
        return stop - start

    def rank(self, blocks: Sequence[tuple[int, int]], start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """How many symbols of some blocks lie between two places."""
        return sum((self.count(prefix, depth, start, stop) for prefix, depth in blocks), np.zeros(len(start), np.int64))

    def locate(self, blocks: Sequence[tuple[int, int]], start, stop, wanted) -> np.ndarray:
        """The first place at which ``wanted`` symbols of the blocks lie behind ``start``; ``stop`` if there are fewer."""
        low, high = start.copy(), stop.copy()
        while (low < high).any():
            middle = (low + high) >> 1
            enough = self.rank(blocks, start, middle) >= wanted
            high = np.where(enough, middle, high)
            low = np.where(enough, low, np.minimum(middle + 1, high))
        return low


def blocks_of(symbols: Sequence[int], levels: int = LEVELS) -> list[tuple[int, int]]:
    """A set of symbols as the fewest blocks (upper bits, how many of them)."""
    wanted = set(symbols)

    def cover(prefix: int, depth: int) -> list[tuple[int, int]]:
        span = 1 << (levels - depth)
        inside = sum(symbol in wanted for symbol in range(prefix * span, (prefix + 1) * span))
        if inside in (0, span):
            return [(prefix, depth)] if inside else []
        return cover(2 * prefix, depth + 1) + cover(2 * prefix + 1, depth + 1)

    return cover(0, 0)


def cuts(texts: Sequence[str], first: np.ndarray, second: np.ndarray, unit: str = "character") -> np.ndarray:
    """Columns: code points, units, and the places of both cuts.

    ``first`` and ``second`` are any numbers of at least 0; modulo the units of a text plus one they say
    how many units stand before a cut.
    """
    symbols, edges = symbols_of(texts)
    matrix, ends = WaveletMatrix(symbols), blocks_of(UNITS[unit])
    start, stop = edges[:-1], edges[1:]
    units = matrix.rank(ends, start, stop)
    filled = np.flatnonzero(stop > start)
    last_ends = np.isin(symbols[stop[filled] - 1], list(UNITS[unit]))
    units[filled] += ~last_ends
    places = [matrix.locate(ends, start, stop, number % (units + 1)) - start for number in (first, second)]
    return np.stack([stop - start, units, np.minimum(*places), np.maximum(*places)])


def _check_markers(markers: Sequence[str]) -> None:
    """Markers that could overlap each other would make an example ambiguous."""
    if len(set(markers)) != 3 or not all(markers):
        raise ValueError("give three different markers")
    for left in markers:
        for right in markers:
            shared = any(left.endswith(right[:size]) for size in range(1, min(len(left), len(right))))
            if shared or (left != right and left in right):
                raise ValueError(f"markers {left!r} and {right!r} can overlap")


def _draws(identifier: Column, seed: str) -> Column:
    """Four numbers of 32 bits from the digest of seed and identifier."""
    name = F.coalesce(identifier.cast("string"), F.lit("null"))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), name).cast("binary"), 256)
    groups = [F.conv(F.substring(digest, 1 + 8 * group, 8), 16, 10).cast("long") for group in range(4)]
    return F.array(*groups)


def examples(
    documents: DataFrame,
    *,
    identifier: str = "doc_id",
    text: str = "text",
    unit: str = "character",
    markers: Sequence[str] = MARKERS,
    seed: str = SEED,
    plain_percent: int = PLAIN_PERCENT,
    suffix_first_percent: int = SUFFIX_FIRST_PERCENT,
    carry: Sequence[str] = (),
) -> DataFrame:
    """``id``, ``n`` (code points), ``n_units``, ``form``, ``prefix_chars``, ``middle_chars``, ``output``, ``row`` (the carried columns).

    ``form`` is plain, psm (prefix, suffix, middle) or spm (suffix, prefix, middle); a plain row has no cuts.
    """
    _check_markers(markers)

    def both(content: pa.Array, first: pa.Array, second: pa.Array) -> pa.Array:
        sizes = pa.compute.utf8_length(content).to_numpy(zero_copy_only=False)
        marks, found, at = np.concatenate([[0], np.cumsum(sizes)]), [np.zeros((4, 0), np.int64)], 0
        draws = [draw.to_numpy(zero_copy_only=False) for draw in (first, second)]
        while at < len(sizes):
            stop = max(at + 1, int(np.searchsorted(marks, marks[at] + MATRIX_CHARS)))
            part = slice(at, min(stop, len(sizes)))
            texts = content.slice(at, part.stop - at).to_pylist()
            found.append(cuts(texts, draws[0][part], draws[1][part], unit))
            at = part.stop
        columns = [pa.array(column) for column in np.concatenate(found, axis=1)]
        return pa.StructArray.from_arrays(columns, ["n", "n_units", "first", "second"])

    cut = F.arrow_udf(both, "n long, n_units long, first long, second long")
    kept = [F.struct(*[F.col(f"`{name}`") for name in carry]).alias("row")] if carry else []
    drawn = documents.select(
        F.col(f"`{identifier}`").alias("id"),
        F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"),
        _draws(F.col(f"`{identifier}`"), seed).alias("draws"),
        *kept,
    )
    placed = drawn.withColumn("cut", cut("text", F.col("draws")[0], F.col("draws")[1])).select(
        "*", "cut.n", "cut.n_units", "cut.first", "cut.second"
    )
    marked = F.lit(False)
    for marker in markers:
        marked = marked | F.contains("text", F.lit(marker))
    plain = (F.col("text") == "") | marked | (F.col("draws")[2] % 100 >= 100 - plain_percent)
    suffix_first = F.col("draws")[3] % 100 < suffix_first_percent
    prefix = F.expr("substring(text, 1, cast(first as int))")
    middle = F.expr("substring(text, cast(first as int) + 1, cast(second - first as int))")
    suffix = F.expr("substring(text, cast(second as int) + 1)")
    before, after, last = map(F.lit, markers)
    shaped = placed.withColumn("form", F.when(plain, "plain").when(suffix_first, "spm").otherwise("psm"))
    cut_only = F.col("form") != "plain"
    return shaped.select(
        "id",
        "n",
        "n_units",
        "form",
        F.when(cut_only, F.col("first")).alias("prefix_chars"),
        F.when(cut_only, F.col("second") - F.col("first")).alias("middle_chars"),
        F.when(F.col("form") == "psm", F.concat(before, prefix, after, suffix, last, middle))
        .when(F.col("form") == "spm", F.concat(after, suffix, before, prefix, last, middle))
        .otherwise(F.col("text"))
        .alias("output"),
        *(["row"] if carry else []),
    )


def restore(output: Column, form: Column, markers: Sequence[str] = MARKERS) -> Column:
    """The text of an example. Markers cannot overlap and stand once each, so their first places are theirs."""
    before, after, last = markers

    def between(left: str, right: str) -> Column:
        start = F.instr(output, left) + len(left)
        return F.substring(output, start, F.instr(output, right) - start)

    start = F.instr(output, last) + len(last)
    middle = F.substring(output, start, F.length(output) - start + 1)
    psm = F.concat(between(before, after), middle, between(after, last))
    spm = F.concat(between(before, last), middle, between(after, before))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
