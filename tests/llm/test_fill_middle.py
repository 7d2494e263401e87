"""Cuts against a plain count of unit ends, and examples that give their text back."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shopmart.llm import fill_middle as fim

ENDS = {
    "character": lambda text, at: True,
    "word": lambda text, at: text[at] not in " \t\x0b\x0c\r\n" and (at + 1 == len(text) or text[at + 1] in " \t\x0b\x0c\r\n"),
    "sentence": lambda text, at: text[at] in ".!?…。！？" and (at + 1 == len(text) or text[at + 1] in " \t\x0b\x0c\r\n"),
    "line": lambda text, at: text[at] == "\n",
}
ALPHABET = "ab c.\n\t!1é漢́\U0001f600-?"


def places_of(text, unit):
    """Where a text may be cut: its start, every end of a unit, its end."""
    found = [0] + [at + 1 for at in range(len(text)) if ENDS[unit](text, at)]
    return found if found[-1] == len(text) else [*found, len(text)]


@pytest.mark.parametrize("unit", fim.UNITS)
def test_cuts_equal_plain_counts(unit):
    draw = random.Random(unit)
    texts = ["", "\n", "x", *("".join(draw.choices(ALPHABET, k=draw.randrange(300))) for _ in range(200))]
    numbers = np.array([[draw.getrandbits(32) for _ in texts] for _ in range(2)])
    for text, first, second, found in zip(texts, *numbers, fim.cuts(texts, *numbers, unit).T):
        places = places_of(text, unit)
        low, high = sorted(places[int(number) % len(places)] for number in (first, second))
        assert found.tolist() == [len(text), len(places) - 1, low, high]


def test_wavelet_matrix_counts_and_locates():
    draw = np.random.default_rng(3)
    symbols = draw.integers(0, 16, 1000).astype(np.uint8)
    matrix = fim.WaveletMatrix(symbols)
    for wanted in ([3], [0, 1, 2, 3], [5, 6, 7, 12], range(16), [15]):
        blocks, inside = fim.blocks_of(wanted), np.isin(symbols, list(wanted))
        start = draw.integers(0, 1001, 50)
        stop = start + (draw.random(50) * (1001 - start)).astype(np.int64)
        assert matrix.rank(blocks, start, stop).tolist() == [inside[a:b].sum() for a, b in zip(start, stop)]
        third = np.full(50, 3)
        expected = [next((p for p in range(a, b + 1) if inside[a:p].sum() >= 3), b) for a, b in zip(start, stop)]
        assert matrix.locate(blocks, start, stop, third).tolist() == expected
    assert fim.blocks_of(range(16)) == [(0, 0)] and fim.blocks_of([6, 7]) == [(3, 3)]


def test_long_texts_and_small_matrices_agree(spark, monkeypatch):
    texts = [(i, "word one. Two\nthree! " * (i * 37 % 400)) for i in range(60)] + [(99, "a b" * 200_000)]
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    rows = [sorted(map(tuple, fim.examples(frame, unit="word").collect()))]
    monkeypatch.setattr(fim, "MATRIX_CHARS", 50)
    rows.append(sorted(map(tuple, fim.examples(frame, unit="word").collect())))
    assert rows[0] == rows[1] and len(rows[0]) == 61


@pytest.mark.parametrize("unit", fim.UNITS)
def test_examples_give_their_text_back(spark, unit):
    draw = random.Random(7)
    tricky = ["<S", "S>", "<", ">", "P>", "<M", "a<b>", "<P", "x <S >", "<P>", "with <M> inside", ""]
    texts = tricky * 12 + ["".join(draw.choices("<>PSM ab.\n", k=40)) for _ in range(300)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = fim.examples(frame, unit=unit, carry=["text"]).withColumn("back", fim.restore(F.col("output"), F.col("form")))
    forms = set()
    for row in found.collect():
        text = row["row"]["text"]
        forms.add(row["form"])
        assert row["back"] == text
        if any(marker in text for marker in fim.MARKERS) or not text:
            assert row["form"] == "plain"
        if row["form"] != "plain":
            prefix, rest = text[: row["prefix_chars"]], text[row["prefix_chars"] :]
            middle, suffix = rest[: row["middle_chars"]], rest[row["middle_chars"] :]
            parts = {"psm": f"<P>{prefix}<S>{suffix}<M>{middle}", "spm": f"<S>{suffix}<P>{prefix}<M>{middle}"}
            assert row["output"] == parts[row["form"]]
    assert forms == {"plain", "psm", "spm"}


def test_odd_rows(spark):
    schema = "doc_id string, text string, id int, n int, cut string, draws int, row int, first int"
    rows = [(None, "some text here", 1, 1, "c", 1, 1, 1), ("a", None, 1, 1, "c", 1, 1, 1), ("b", "", 1, 1, "c", 1, 1, 1)]
    rows += [("c", "same text", 1, 1, "c", 1, 1, 1)] * 2
    frame = spark.createDataFrame(rows, schema)
    found = fim.examples(frame, carry=frame.columns).collect()
    assert sorted(map(str, (row["id"] for row in found))) == ["None", "a", "b", "c", "c"]
    by_id = {row["id"]: row for row in found}
    assert [by_id[key]["form"] for key in "ab"] == ["plain", "plain"] and by_id["a"]["output"] == ""
    assert len({row["output"] for row in found if row["id"] == "c"}) == 1
    assert all(row["row"]["cut"] == "c" for row in found)
    groups = hashlib.sha256(b"1:null").hexdigest()
    first, second = (int(groups[at : at + 8], 16) % 15 for at in (0, 8))
    if by_id[None]["form"] != "plain":
        assert by_id[None]["prefix_chars"] == min(first, second)
    assert fim.examples(frame.filter("false")).count() == 0


@pytest.mark.parametrize("markers", [("<P>", "<P>", "<M>"), ("", "b", "c"), ("ab", "ba", "c"), ("aba", "x", "y"), ("<P>", "<P>x", "y")])
def test_ambiguous_markers_are_refused(spark, markers):
    with pytest.raises(ValueError):
        fim.examples(spark.createDataFrame([], "doc_id long, text string"), markers=markers)
