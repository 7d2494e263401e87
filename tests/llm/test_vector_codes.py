"""Codes against plain rounds that compare every part with every entry."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shopmart.llm import vector_codes as vc


def plain(rows, parts=4, entries=256, rounds=4, scale=1024):
    """(id, code, error) by whole comparisons in Python integers, and the codebooks."""
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if v is not None and all(map(usable, v))]
    kept.sort(key=lambda pair: (pair[0] is None, pair[0] or 0, pair[1]))
    width = len(kept[0][1]) // parts
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for _, v in kept]
    books = [[list(v[p]) for v in cut[:entries]] for p in range(parts)]

    def nearest():
        found = []
        for v in cut:
            ways = [[sum((a - b) ** 2 for a, b in zip(v[p], e)) for e in books[p]] for p in range(parts)]
            found.append([(w.index(min(w)), min(w)) for w in ways])
        return found

    for _ in range(rounds):
        chosen = nearest()
        for p in range(parts):
            for e in range(len(books[p])):
                own = [v[p] for v, c in zip(cut, chosen) if c[p][0] == e]
                if own:
                    books[p][e] = [sum(column) // len(own) for column in zip(*own)]
    final = nearest()
    codes = [(i, "".join(f"{c:02X}" for c, _ in f), sum(d for _, d in f)) for (i, _), f in zip(kept, final)]
    return codes, books


def usable(x):
    return x is not None and math.isfinite(x)


def clustered(count, size, seed, spread=0.05):
    draw = random.Random(seed)
    centres = [[draw.uniform(-1, 1) for _ in range(size)] for _ in range(6)]
    return [(i, [float(np.float32(c + draw.gauss(0, spread))) for c in draw.choice(centres)]) for i in range(count)]


def run(spark, rows, **options):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    coded, books = vc.compress(frame, **options)
    found = [(r["id"], bytes(r["code"]).hex().upper(), r["error"]) for r in coded.collect()]
    return sorted(found, key=repr), books, coded


@pytest.mark.parametrize("entries, parts, size", [(256, 4, 8), (7, 2, 6), (1, 4, 4), (16, 1, 5)])
def test_codes_equal_whole_comparisons(spark, entries, parts, size):
    rows = clustered(120, size, entries)
    found, books, _ = run(spark, rows, entries=entries, parts=parts)
    codes, expected = plain(rows, parts=parts, entries=entries)
    assert found == sorted(codes, key=repr) and books == expected


def test_ties_equal_vectors_and_dropped_rows(spark):
    same = [0.5, -0.25, 0.125, 0.0]
    rows = [(i, same) for i in range(5)] + [(i, [-1.0, 1.0, 0.0, 0.3]) for i in range(5, 8)]
    rows += [(None, [0.1, 0.2, 0.3, 0.4]), (3, [0.2, 0.2, 0.2, 0.2]), (3, [0.2, 0.2, 0.2, 0.2])]
    bad = [(20, None), (21, [0.1, None, 0.1, 0.1]), (22, [float("nan"), 0.0, 0.0, 0.0]), (0, [0.0, float("-inf"), 0.0, 0.0])]
    found, books, _ = run(spark, rows + bad, entries=6)
    codes, expected = plain(rows + bad, entries=6)
    assert found == sorted(codes, key=repr) and books == expected and len(found) == len(rows)


def test_bounds_spare_comparisons(spark):
    """Clear clusters settle: after the first rounds most parts keep their entry without a comparison."""
    rows = clustered(400, 8, 11, spread=0.01)
    _, _, coded = run(spark, rows, entries=6)
    stamps = np.array([row["stamps"] for row in coded.collect()])
    assert (stamps < vc.ROUNDS).mean() > 0.5


def test_net_ways_are_tighter_than_summed_steps():
    draw = np.random.default_rng(1)
    history = np.cumsum(draw.integers(-9, 10, (5, 12, 4)), axis=0)
    ways = vc.net_ways(history)
    steps = np.sqrt((np.diff(history, axis=0) ** 2).sum(-1))
    for stamp in range(5):
        net = np.sqrt(((history[-1] - history[stamp]) ** 2).sum(-1))
        for entry in range(12):
            others = np.delete(net, entry)
            assert ways[stamp, entry] == others.max()
            assert ways[stamp, entry] <= np.delete(steps[stamp:].sum(0), entry).max() + 1e-9
    assert (vc.net_ways(history[:, :1]) == 0).all()


def test_wide_components_are_exact():
    points = np.array([[2**24 - 1, 1 - 2**24, 5], [3, 4, 5]])
    entries = np.array([[1 - 2**24, 2**24 - 1, 6], [3, 4, 6]])
    expected = [[sum((int(a) - int(b)) ** 2 for a, b in zip(p, e)) for e in entries] for p in points]
    assert vc.distances(points, entries).tolist() == expected


def test_refused_and_odd_vectors(spark):
    schema = "vec_id string, embedding array<double>, codes string, error string, row string, ints string, label int"
    rows = [("a", [0.1] * 4), ("b", [0.2] * 5), (None, [0.3] * 4), ("c", []), ("d", None), ("b", [0.2] * 4)]
    frame = spark.createDataFrame([(*row, "c", "e", "r", "i", n % 2 or None) for n, row in enumerate(rows)], schema)
    coded, books = vc.compress(frame, carry=frame.columns)
    found = {(r["id"], len(r["row"]["embedding"])): r for r in coded.collect()}
    assert len(found) == 5 and len(books[0]) == 3
    assert found["b", 5]["code"] is None and found["c", 0]["error"] is None and found["b", 4]["error"] == 0
    summed = vc.with_group_error(coded, F.col("row.label")).collect()
    assert len(summed) == 5
    nothing, books = vc.compress(frame.filter("false"))
    assert nothing.count() == 0 and nothing.columns == ["id", "code", "error", "stamps", "row"] and books == [[]] * 4
    with pytest.raises(ValueError):
        vc.compress(frame.filter("size(embedding) = 5"))
    with pytest.raises(Exception, match="reaches"):
        vc.compress(spark.createDataFrame([(1, [1e9] * 4)], "vec_id long, embedding array<float>"))
    empty = spark.createDataFrame([(1, [])], "vec_id long, embedding array<float>")
    assert [(bytes(r["code"]), r["error"]) for r in vc.compress(empty)[0].collect()] == [(bytes(4), 0)]


@pytest.mark.parametrize("limit", [None, 0])
def test_group_error(spark, monkeypatch, limit):
    """Nulls are one group; the sums are right whether they are broadcast or not."""
    if limit is not None:
        from shopmart.operators import joins

        monkeypatch.setitem(joins.dimension_join.__kwdefaults__, "broadcast_bytes", limit)
    rows = [(i, i * i, None if i % 3 == 0 else i % 2) for i in range(60)]
    frame = spark.createDataFrame(rows, "id long, error long, label int")
    sums = {}
    for _, error, label in rows:
        sums[label] = sums.get(label, 0) + error
    found = vc.with_group_error(frame, F.col("label")).collect()
    assert len(found) == 60 and all(row["group_error"] == sums[row["label"]] for row in found)


def test_codebook_digest(spark):
    from shopmart.llm.queries import QUERIES

    found = QUERIES["op13_vector_codes"](spark, "/root/testdata/sf0.001").toPandas()
    import duckdb

    rows = duckdb.sql("SELECT vec_id, embedding FROM '/root/testdata/sf0.001/embeddings.parquet'").fetchall()
    codes, books = plain(rows)
    listed = ",".join(str(x) for part in books for entry in part for x in entry)
    assert set(found["codebooks_sha256"]) == {hashlib.sha256(listed.encode()).hexdigest()}
    assert dict(zip(found["vec_id"], found["code"])) == {i: code.lower() for i, code, _ in codes}
