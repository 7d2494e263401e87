"""Null, empty, very long, tied and repeated rows, empty tables and clashing column names."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from shopmart.llm import (
    exact_dedup,
    licenses,
    lsh_forest,
    mixing,
    packing,
    pii,
    quality_model,
    quality_rules,
    toxicity,
    wrapper,
)

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, size long, kept boolean, row string, "
    "words string, pattern string, place long, content string, salt int, id long, component long"
)
LONG = " ".join(f"word{i % 977}x{i}" for i in range(30_000))
PLAIN = "the cat and the dog of a house in the town " * 8


def vocabulary():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def odd(spark):
    texts = [
        (1, None, None, None),
        (2, "", "en", "b"),
        (3, " \n\t \x0b", "en", "b"),
        (4, "word", "en", "a"),
        (5, LONG, "en", "a"),
        (6, PLAIN, "en", ""),
        (6, PLAIN, "en", ""),
        (7, PLAIN, None, "a"),
        (None, PLAIN + "null id", "en", None),
        (8, "x" * 200_000, "de", "c"),
        (9, "\U0001f600 é + 1 (375) 555-4393 " * 3, "fr", "c"),
    ]
    rows = [(d, t, la, s, 0, 1, True, "r", "w", "p", 1, "c", 1, 7, 7) for d, t, la, s in texts]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(d, q, x, 0) for d, q, x in [(5, 1, 0), (6, 0, 1), (7, 1, 0), (4, None, None), (8, 0, 1), (None, 1, 1)]]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int, text int")


OPERATORS = {
    "mix": lambda d, _: mixing.mix(d),
    "mixed": lambda d, _: mixing.mixed_documents(d),
    "pii": lambda d, _: pii.find_spans(d)[0],
    "sanitise": lambda d, _: pii.sanitise(d),
    "copies": lambda d, _: exact_dedup.mark_copies(d, carry=d.columns),
    "rules": lambda d, _: quality_rules.assess(d),
    "good": lambda d, _: quality_rules.good_documents(d),
    "pack": lambda d, _: packing.pack(d, vocabulary()),
    "quality": lambda d, lab: quality_model.score(d, lab),
    "toxic": lambda d, lab: toxicity.score(d, lab),
    "near": lambda d, _: lsh_forest.near_duplicates(d),
    "one_of_each": lambda d, _: lsh_forest.one_of_each(d),
    "licenses": lambda d, _: licenses.scan(d),
}
ONE_ROW_EACH = ("mix", "pii", "sanitise", "copies", "rules", "quality", "toxic", "near", "licenses")


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_rows(odd, labels, name):
    found = OPERATORS[name](odd, labels)
    rows = found.collect()
    if name in ONE_ROW_EACH:
        assert len(rows) == odd.count()
    if name in ("mixed", "sanitise", "good", "one_of_each"):
        assert found.columns == odd.columns


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_tables(odd, labels, name):
    assert OPERATORS[name](odd.filter("false"), labels.filter("false")).count() == 0


def test_defined_results(odd):
    copies = {(r["id"], r["kept"]): r for r in exact_dedup.mark_copies(odd, keep="max").collect()}
    assert copies[7, True]["group_size"] == 3 and (6, True) not in copies
    assert copies[2, True]["group_size"] == 2  # null counts as empty
    near = {r["id"]: r for r in lsh_forest.near_duplicates(odd).collect()}
    assert [near[d]["n_shingles"] for d in (1, 2, 3, 4)] == [0, 0, 0, 1]
    assert near[7]["component"] == 6 and near[None]["component"] == 6 and near[1]["component"] == 1
    taken = {r["row"]["doc_id"]: r for r in mixing.mix(odd).collect()}
    assert taken[1]["taken"] == 0 and taken[5]["size"] == 30_000
    packed = packing.pack(odd, vocabulary())
    lengths = {r["id"]: r for r in packed.filter("id IN (1, 2)").collect()}
    assert lengths[1]["length"] == lengths[2]["length"] == 1
    full = packed.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("m"))
    assert full.filter("n <> m OR n > 2048").isEmpty()


def test_odd_pages(spark):
    pages = [
        (1, None, None, 1),
        (2, "http://a.org/x", "", 1),
        (3, "http://a.org/y", "<p>one<p>two &amp; <b>th</b>ree<script>var a='<p>'</script>", 1),
        (3, "http://a.org/y", "<p>one<p>two &amp; <b>th</b>ree<script>var a='<p>'</script>", 1),
        (4, "no url", "<div>" * 3000 + "deep" + "</div>" * 3000, 1),
        (5, "http://b.org", "plain < text <!-- lost", 1),
        (None, "http://b.org", "<article>null id</article>", 1),
    ]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string, wrapper int")
    found = {(r["id"], r["url"]): r["text"] for r in wrapper.main_texts(frame).collect()}
    assert found[1, None] == "" and found[2, "http://a.org/x"] == ""
    assert found[3, "http://a.org/y"] == "one two & three" and found[4, "no url"] == "deep"
    assert found[5, "http://b.org"] == "plain < text" and found[None, "http://b.org"] == "null id"
    assert wrapper.main_texts(frame.filter("false")).count() == 0


def test_stages_on_odd_rows(spark, odd):
    for docs in (odd, odd.filter("false")):
        for name, stage in corpus_pipeline.STAGES:
            found = stage(spark, docs, "")
            assert name == "best_fit_packing" or found.columns == docs.columns
            found.count()
