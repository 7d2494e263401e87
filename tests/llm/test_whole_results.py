"""Inputs on which an earlier form of an operator lost rows, text or verdicts."""


import re

import numpy as np
import pytest

from shopmart.llm import licenses, lsh_forest, mixing, pii, quality_rules
from shopmart.llm.wrapper import extract, induce


def test_template_text_keeps_varying_kids():
    """A constant label before a name, a price or a title goes alone; what it stands before stays."""

    def page(n):
        return (
            f"<article><h2>Chapter <span>{n}: The storm</span></h2><p>By <a>Jane Doe {n}</a></p>"
            f"<p>Story {n} begins here and goes on for long.</p><ul><li>Price: <b>{n}.50</b></li></ul>"
            f"<div>Read on<p>It ends with {n * 7}.</p></div><p>Share <b>this</b></p></article>"
        )

    wrapper = induce([page(n) for n in range(6)])
    wanted = "9: The storm Jane Doe 9 Story 9 begins here and goes on for long. 9.50 It ends with 63."
    assert extract(page(9), wrapper) == wanted


def test_copies_do_not_hide_a_disclosing_term(spark):
    """A name that stands next to one address only, in three contexts, one of them copied a thousand times."""
    rows = [(i, f"day{i} mail of Zaphod a.b@c.org came on {i}th noon") for i in range(2)]
    rows += [(10 + i, "once more Zaphod wrote Zaphod a.b@c.org at the end of all") for i in range(1000)]
    rows += [(5000 + i, " ".join(f"w{i}x{j}" for j in range(200))) for i in range(200)]
    rows += [(6000 + i, f"mail of others {i} the end") for i in range(1000)]
    rows += [(2, "day2 mail of Zaphod a.b@c.org came on 2th noon")]
    terms = pii.find_spans(spark.createDataFrame(rows, "doc_id long, text string"))[1].collect()
    found = {row["term"]: row["disclosure"] for row in terms}
    assert found["zaphod"] == pytest.approx(1.0) and "mail" not in found


@pytest.mark.parametrize("broadcast", [500, 0])
def test_rare_language_is_judged(spark, monkeypatch, broadcast):
    """A language with words enough for a histogram is judged, however much text of another one there is."""
    monkeypatch.setattr(quality_rules, "BROADCAST_LANGUAGES", broadcast, raising=False)
    prose = [" ".join(f"the {chr(97 + i)}{chr(97 + j)} of a and house to" for j in range(12)) for i in range(26)]
    junk = " ".join(f"{i}Q&{i * 7919}%" for i in range(60))
    rows = [(i, text, "xx") for i, text in enumerate(prose * 2)] + [(100, junk, "xx"), (101, prose[0], None)]
    much = " ".join(f"un mot et {i}" for i in range(40_000))
    rows += [(200 + i, much, "fr") for i in range(20)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = {r["row"]["doc_id"]: r for r in quality_rules.assess(frame, carry=["doc_id"]).collect()}
    assert len(found) == len(rows)
    assert found[100]["class_distance"] is not None and not found[100]["base_failed"] and not found[100]["kept"]
    assert found[0]["kept"] and found[0]["word_distance"] is not None
    assert found[101]["kept"] and found[101]["class_distance"] is None


def test_whole_keys_find_pairs_of_dense_regions():
    """Pairs at similarity 0.8 share a whole key in some tree: the only depth a dense region is sure to be paired at."""
    draw = np.random.default_rng(1)
    values = draw.integers(0, 1 << 63, (10_000, 100), dtype=np.uint64)
    left, right = (lsh_forest._signatures(list(values[:, part])) for part in (slice(0, 90), slice(10, 100)))
    same = (left == right).reshape(len(values), lsh_forest.TREES, lsh_forest.DEPTH)
    assert same.all(axis=2).any(axis=1).all()


def test_wrapped_and_joined_notices(spark):
    """Notices wrapped over lines, two licences on a line, and a short notice in a long line."""
    prose = " ".join(f"the word{i} of a tale" for i in range(60))
    gpl = (
        "This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU General "
        "Public License as published by\nthe Free Software Foundation, either version 3"
    )
    bsd = "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided"
    dual = "Licensed under the MIT License or the Apache License, Version 2.0"
    both = "Released under the MIT License. Licensed under the Apache License, Version 2.0."
    texts = {1: gpl, 2: bsd, 3: both, 4: f"{prose} All rights reserved. {prose}", 5: prose, 6: f"{prose}\n\n{gpl}", 7: dual}
    rows = list(texts.items()) + [(100 + i, f"{prose} {i} and its end") for i in range(200)]
    found = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    families = {r["id"]: r["families"] for r in found}
    assert [families[i] for i in (1, 2, 3, 5, 6)] == ["GPL", "BSD", "Apache-2.0,MIT", "", "GPL"]
    assert families[4] == "proprietary" and families[7] == "Apache-2.0,MIT"


def _story(seed, words=60):
    draw = np.random.default_rng(seed)
    return [f"w{number}" for number in draw.integers(0, 10_000, words)]


def test_one_of_each_judges_rows_not_ids(spark):
    """An id that two texts share, copies without an id, and a near copy that only such rows tie together."""
    first, other = _story(1), _story(2)
    near = [*first[:-1], "end"]
    nearer = ["start", *near[1:]]
    rows = [(1, first), (2, near), (2, other), (None, first), (None, other[::-1]), (3, _story(3)), (3, _story(3)), (None, nearer)]
    texts = [(key, " ".join(words), "x", 1) for key, words in rows] + [(5, "", "x", 1), (5, None, "x", 1)]
    frame = spark.createDataFrame(texts, "doc_id long, text string, mark string, id int")
    kept = lsh_forest.one_of_each(frame)
    assert kept.columns == frame.columns
    found = sorted(((row["doc_id"], row["text"]) for row in kept.collect()), key=repr)
    wanted = [texts[place][:2] for place in (0, 2, 4, 5, 6, 8, 9)]
    assert found == sorted(wanted, key=repr)
    named = {(row["id"], row["n_shingles"], row["component"]) for row in lsh_forest.near_duplicates(frame).collect()}
    assert (2, 56, 1) in named and (2, 56, 2) in named and (None, 56, 1) in named and (None, 56, None) in named


@pytest.mark.parametrize("broadcast", [500_000, -1])
def test_components_of_shared_ids_equal_all_pairs(spark, monkeypatch, broadcast):
    monkeypatch.setattr(lsh_forest, "BROADCAST_IDS", broadcast)
    draw = np.random.default_rng(9)
    rows = []
    for group in range(30):
        words = _story(100 + group, 50)
        for _ in range(int(draw.integers(1, 5))):
            copy = list(words)
            copy[int(draw.integers(0, 50))] = "changed"
            rows.append((int(draw.integers(0, 25)) if draw.random() > 0.2 else None, " ".join(copy)))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    sets = [frozenset(tuple(t.split()[i : i + 5]) for i in range(46)) for _, t in rows]
    group_of = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]) and group_of[a] != group_of[b]:
                group_of = [group_of[b] if g == group_of[a] else g for g in group_of]
    smallest = {g: min((rows[i][0] for i in range(len(rows)) if group_of[i] == g and rows[i][0] is not None), default=None) for g in group_of}
    expected = sorted(((rows[i][0], smallest[group_of[i]]) for i in range(len(rows))), key=repr)
    found = lsh_forest.near_duplicates(frame)
    assert sorted(((r["id"], r["component"]) for r in found.collect()), key=repr) == expected


def test_the_mix_takes_whole_documents(spark):
    rows = [(i, f"document {i} " + "word " * (i % 37), "abc"[i % 3], 1) for i in range(200)] + [(900, None, "a", 1), (901, "", None, 1)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string, size int")
    texts = {key: text for key, text, *_ in rows}
    mixed = mixing.mixed_documents(frame)
    assert mixed.columns == frame.columns
    taken = {}
    for row in mixed.collect():
        assert row["text"] == texts[row["doc_id"]]
        taken[row["source"]] = taken.get(row["source"], 0) + len(row["text"].split())
    longest = 40
    for row in mixing.mix(frame).select("row.source", "target").distinct().collect():
        assert abs(taken.get(row["source"], 0) - row["target"]) <= longest


def _personal_rows():
    rows = [(i, f"note{i} from Zaphod a.b@c.org about {i * 7} sales") for i in range(6)]
    rows += [(10 + i, f"our sales of part{i} went well") for i in range(6)]
    return rows + [(20 + i, f"a.b@c.org Trillian a.b@c.org day{i}") for i in range(4)] + [(30, "Trillian alone Trillian")]


def _terms(spark, rows):
    found = pii.find_spans(spark.createDataFrame(rows, "doc_id long, text string"))[1].collect()
    return {row["term"]: round(row["disclosure"], 6) for row in found}


def test_disclosure_does_not_move_with_unrelated_text(spark):
    """Half of the term's occurrences stand elsewhere; more text about other things does not make it disclose more."""
    rows = _personal_rows()
    unrelated = [(1000 + i, " ".join(f"u{i}x{j}" for j in range(20))) for i in range(5000)]
    assert _terms(spark, rows) == _terms(spark, rows + unrelated)
    assert "sales" not in _terms(spark, rows + unrelated)


def test_an_occurrence_counts_once(spark, monkeypatch):
    """Between two spans of one entity a term is one occurrence: 4 of 6 are next to it, not 8."""
    monkeypatch.setattr(pii, "GENERALISE_AT", 0.1)
    found = _terms(spark, _personal_rows())
    assert found["trillian"] == pytest.approx(4 / 6, abs=1e-6) and found["zaphod"] == 1
    assert found["sales"] == 0.5


@pytest.mark.parametrize("limit", [64 << 20, -1])
def test_spans_of_terms_equal_plain_search(spark, monkeypatch, limit):
    monkeypatch.setattr(pii, "BROADCAST_FOUND", limit)
    monkeypatch.setattr(pii, "GENERALISE_AT", 0.5)  # row 42 holds the name without the address
    rows = _personal_rows() + [(40, None), (41, ""), (42, "ZAPHOD, zaphod-x xzaphod Zaphod2"), (42, "ZAPHOD, zaphod-x xzaphod Zaphod2")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    spans, terms = pii.find_spans(frame)
    known = {row["term"] for row in terms.collect()}
    assert "zaphod" in known
    expected = []
    for key, text in rows:
        words = [(m.start(), m.end()) for m in re.finditer(r"[^\W_]+", text or "") if m.group().lower() in known]
        inside = [(m.start(), m.end()) for m in re.finditer(r"a\.b@c\.org", text or "")]
        words = [w for w in words if not any(w[0] < e and s < w[1] for s, e in inside)]
        expected.append((key, tuple(sorted(words))))
    found = [(row["id"], tuple(sorted((s["start"], s["end"]) for s in row["terms"]))) for row in spans.collect()]
    assert sorted(found) == sorted(expected)
