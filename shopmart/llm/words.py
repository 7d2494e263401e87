"""Words as JVM expressions, and as hashes of whole batches of texts in numpy.

A word is a run of characters other than space, tab, line feed, vertical tab, form feed and
carriage return. The numpy half never loops over words: a text batch becomes one byte array,
and the hash of a word is a difference of prefix sums of a polynomial modulo 2**64.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
from pyspark.sql import Column, functions as F

from shopmart.llm import by_value

by_value(__name__)

WHITE = " \t\n\x0b\x0c\r"
WHITE_RUN = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

_BASE = 0x9E3779B97F4A7C15
_CHUNK_BYTES = 1 << 19


def words_of(text: Column) -> Column:
    """The words of a text in order; none for null, empty or blank text."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(WHITE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, WHITE_RUN))


def n_words(text: Column) -> Column:
    """How many words a text has: one more than the gaps inside the trimmed text, without building the words."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(WHITE))
    joined = F.regexp_replace(trimmed, WHITE_RUN, " ")
    gaps = F.length(joined) - F.length(F.replace(joined, F.lit(" "), F.lit("")))
    return F.when(trimmed == "", 0).otherwise(gaps + 1).cast("long")


def mixed(values: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    values = values ^ (values >> np.uint64(33))
    values = values * np.uint64(0xFF51AFD7ED558CCD)
    values = values ^ (values >> np.uint64(33))
    values = values * np.uint64(0xC4CEB9FE1A85EC53)
    return values ^ (values >> np.uint64(33))


def _byte_tables() -> dict[str, np.ndarray]:
    codes = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
    letters = codes.copy()
    letters[65:91] = codes[97:123]
    white = np.zeros(256, bool)
    white[[ord(c) for c in WHITE]] = True
    plain = np.zeros(256, bool)
    plain[48:58] = plain[65:91] = plain[97:123] = plain[128:] = True
    shapes = np.arange(256)
    shapes[65:91] = shapes[97:123] = 97
    shapes[128:] = 97
    shapes[48:58] = 48
    return {"codes": letters, "white": white, "not_plain": ~plain, "shapes": shapes.astype(np.uint8)}


TABLES = _byte_tables()


class _Cache(dict):
    """Stays where it is when the module travels with a task."""

    def __reduce__(self):
        return _Cache, ()


_POWERS = _Cache()


def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base modulo 2**64 and their inverses; those of the usual size are kept."""
    if size in _POWERS:
        return _POWERS[size]
    steps = np.full(size, _BASE, np.uint64)
    back = np.full(size, pow(_BASE, -1, 1 << 64), np.uint64)
    steps[0] = back[0] = 1
    found = np.cumprod(steps, dtype=np.uint64), np.cumprod(back, dtype=np.uint64)
    if size <= 2 * _CHUNK_BYTES:
        _POWERS[size] = found
    return found


def _segments(texts: Sequence[str]) -> Iterator[tuple[bytes, np.ndarray, np.ndarray]]:
    """Texts joined by line feeds into pieces of up to half a megabyte, with the texts' numbers and lengths.

    A longer text is cut at white space, so no word is split; only a word that alone exceeds a
    piece makes the piece grow.
    """
    held: list[bytes] = []
    numbers: list[int] = []
    size = 0
    for number, text in enumerate(texts):
        data = (text or "").encode("utf-8", "surrogatepass")
        while data or not text:
            part, data = data, b""
            if len(part) > _CHUNK_BYTES:
                at = max(part.rfind(b" ", 0, _CHUNK_BYTES), part.rfind(b"\n", 0, _CHUNK_BYTES))
                if at <= 0:
                    at = min((p for p in (part.find(b" ", 1), part.find(b"\n", 1)) if p > 0), default=len(part))
                part, data = part[:at], part[at + 1 :]
            if held and size + len(part) > _CHUNK_BYTES:
                yield b"\n".join(held), np.array(numbers), np.array([len(x) for x in held])
                held, numbers, size = [], [], 0
            held.append(part)
            numbers.append(number)
            size += len(part) + 1
            if not data:
                break
    if held:
        yield b"\n".join(held), np.array(numbers), np.array([len(x) for x in held])


def word_hashes(
    texts: Sequence[str], separators: str = "white", shapes: bool = False, stem: int = 0
) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
    """Hash of every word (A-Z read as a-z), the number of its text, and if asked the hash of its shape or stem.

    ``separators`` is "white", or "not_plain" to end words also at ASCII punctuation. A shape
    keeps punctuation and reads a run of letters or of digits as one sign; a stem is the first
    ``stem`` bytes of a word.
    """
    hashes, owners, forms = [], [], []
    for data, numbers, lengths in _segments(texts):
        raw = np.frombuffer(data, np.uint8)
        if not len(raw):
            continue
        gap = TABLES[separators][raw]
        edge = np.diff(gap.astype(np.int8), prepend=1, append=1)
        starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        power, inverse = _powers(1 << max(_CHUNK_BYTES, len(raw) + 1).bit_length())
        sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(TABLES["codes"][raw] * power[: len(raw)], out=sums[1:])
        hashes.append(mixed((sums[ends] - sums[starts]) * inverse[starts]))
        firsts = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]])
        owners.append(numbers[np.searchsorted(firsts, starts, side="right") - 1])
        if stem:
            cut = np.minimum(starts + stem, ends)
            forms.append(mixed((sums[cut] - sums[starts]) * inverse[starts] + np.uint64(stem)))
        elif shapes:
            kinds = TABLES["shapes"][raw]
            kept = np.ones(len(raw), bool)
            kept[1:] = kinds[1:] != kinds[:-1]
            kept[starts] = True
            place = np.cumsum(kept) - 1
            form = np.zeros(len(raw) + 1, np.uint64)
            np.cumsum(np.where(kept, TABLES["codes"][kinds] * power[place], np.uint64(0)), out=form[1:])
            forms.append(mixed((form[ends] - form[starts]) * inverse[place[starts]] + np.uint64(7)))
    empty = np.zeros(0, np.uint64)
    return (
        np.concatenate(hashes) if hashes else empty,
        np.concatenate(owners) if owners else np.zeros(0, np.int64),
        (np.concatenate(forms) if forms else empty) if shapes or stem else None,
    )


def sorted_unique(values: np.ndarray) -> np.ndarray:
    """The different values in order; sorting in place beats the hash table of ``np.unique``."""
    values.sort()
    if not len(values):
        return values
    return values[np.concatenate([[True], values[1:] != values[:-1]])]


def paired(first: np.ndarray, second: np.ndarray, salt: int) -> np.ndarray:
    """Hash of an ordered pair of hashes."""
    shift = np.uint64((salt * 2 + 1) * _BASE % (1 << 64))
    return mixed(first * np.uint64(0xD6E8FEB86659FD93) + second + shift)
