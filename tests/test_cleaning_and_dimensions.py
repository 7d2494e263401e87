import pytest
from pyspark.sql import functions as F

from shopmart.operators import joins
from shopmart.operators.cleaning import clean_counts, clean_events
from shopmart.operators.curation import insert_cleaned, insert_cleaned_semi
from shopmart.operators.dimensions import distinct_keys, merge_keys, merge_metrics, new_keys
from shopmart.schemas import EVENT_SCHEMA


def pairs(spark, *rows):
    return spark.createDataFrame(list(rows), "brand string, category_code string")


def test_null_brand_is_counted_first(spark, rows):
    frame = pairs(spark, ("a", "x"), (None, None), (None, "x"), ("b", None))
    assert rows(clean_counts(frame)) == [(2, 1)]
    assert rows(clean_events(frame)) == [("a", "x")]


def test_category_extract_requires_the_brand(spark, rows):
    frame = pairs(spark, ("a", "x"), ("a", None), (None, "y"))
    assert rows(distinct_keys(frame, "category_code")) == [("x",), (None,)]
    assert rows(distinct_keys(frame, "category_code", require="category_code")) == [("x",), ("y",)]
    assert rows(distinct_keys(frame, "brand")) == [("a",)]


def test_merge(spark, rows):
    source = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "brand string")
    target = spark.createDataFrame([("a",), ("c",)], "brand string")
    assert rows(new_keys(source, target, "brand")) == [("b",)]
    assert rows(merge_keys(source, target, "brand")) == [("a",), ("b",), ("c",)]
    assert rows(merge_metrics(source, target, "brand")) == [("brand", 2, 2, 1, 3)]
    again = merge_keys(source, target, "brand")
    assert new_keys(source, again, "brand").isEmpty()


def test_merge_into_empty_set(spark, rows):
    source = spark.createDataFrame([("a",), ("a",)], "brand string")
    empty = spark.createDataFrame([], "brand string")
    assert rows(new_keys(source, empty, "brand")) == [("a",)]
    assert rows(merge_metrics(source, empty, "brand")) == [("brand", 1, 0, 1, 1)]


def test_repeated_mapping_pair_repeats_the_event(spark):
    values = {"category_code": "x", "brand": "a"}
    event = [values.get(name) for name in EVENT_SCHEMA.fieldNames()]
    lone = [{"category_code": "y", "brand": "a"}.get(name) for name in EVENT_SCHEMA.fieldNames()]
    staging = spark.createDataFrame([event, lone], EVENT_SCHEMA).withColumn("dataset_key", F.lit("1"))
    mapping = pairs(spark, ("a", "x"), ("a", "x"), ("b", "x"))
    assert insert_cleaned(staging, mapping).count() == 2
    assert insert_cleaned_semi(staging, mapping).count() == 1
    assert insert_cleaned(staging, mapping).columns == [*EVENT_SCHEMA.fieldNames(), "dataset_key"]


@pytest.mark.parametrize("how", ["inner", "left_semi"])
@pytest.mark.parametrize("broadcast_bytes", [10_000, 80, 50, 0])
def test_hot_key_join_equals_plain_join(spark, monkeypatch, how, broadcast_bytes):
    """One pair holds a third of the events; every way to join gives the same rows."""
    monkeypatch.setattr(joins.hot_keys, "__defaults__", (2,))
    number = F.col("id")
    brand = F.when(number % 3 == 0, "hot").when(number % 100 == 1, None).otherwise(F.concat(F.lit("b"), number % 50))
    facts = spark.range(30_000).select("id", brand.alias("brand"), F.lit("x").alias("category_code"))
    dimension = pairs(spark, ("hot", "x"), ("hot", "x"), ("b1", "x"), ("b2", "x"), ("b2", "y"), (None, "x"), ("b7", None))
    keys = ["brand", "category_code"]
    expected = sorted(row.id for row in facts.join(dimension, keys, how).collect())
    joined = joins.dimension_join(facts, dimension, keys, how, broadcast_bytes=broadcast_bytes)
    assert sorted(row.id for row in joined.collect()) == expected
    assert sorted(joined.columns) == ["brand", "category_code", "id"]


def test_hot_keys_are_the_most_frequent(spark, rows):
    frame = spark.createDataFrame([("a",)] * 5 + [("b",)] * 3 + [("c",)] * 4 + [(None,)] * 9, "k string")
    assert rows(joins.hot_keys(frame, ["k"], 2)) == [("a",), ("c",)]


def test_other_joins_are_refused(spark):
    frame = spark.createDataFrame([("a",)], "k string")
    with pytest.raises(ValueError, match="unsupported"):
        joins.dimension_join(frame, frame, ["k"], "left")


def test_value_bytes(spark):
    frame = spark.createDataFrame([("ab", 1), ("é", None), (None, 2)], "k string, n long")
    assert joins.value_bytes(frame) == 3 * 16 + 3 * 8 + 4
    assert joins.value_bytes(frame.limit(0)) == 0


@pytest.mark.parametrize("how", ["inner", "left_semi"])
def test_large_dimension_join_reads_the_facts_once(spark, tmp_path, monkeypatch, plan, how):
    """Besides the count of the frequent keys; no branch leaves them together, and their facts are dealt over many salts."""
    monkeypatch.setattr(joins.hot_keys, "__defaults__", (2,))
    number = F.col("id")
    spark.range(4000).select(F.when(number % 3 == 0, "hot").otherwise(F.concat(F.lit("b"), number % 500)).alias("k"), number.alias("n")).write.parquet(str(tmp_path / "facts"))
    spark.createDataFrame([("hot", 1), ("hot", 2), ("b1", 3), ("b7", 4)], "k string, d int").write.parquet(str(tmp_path / "dimension"))
    facts, dimension = (spark.read.parquet(str(tmp_path / name)) for name in ("facts", "dimension"))
    joined = joins.dimension_join(facts, dimension, ["k"], how, broadcast_bytes=0)
    text = plan(joined)
    assert text.count("/facts]") == 1 and "Union" not in text and "_salt" in text
    expected = facts.join(dimension, "k", how)
    assert sorted(map(tuple, joined.collect())) == sorted(map(tuple, expected.collect()))
    salt = F.pmod(F.xxhash64("k", "n"), F.lit(joins.SALTS))
    assert facts.filter("k = 'hot'").select(salt).distinct().count() == joins.SALTS
