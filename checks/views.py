"""Test tables in the shape of shop events (see FIXTURES.md)."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from shopmart.operators.cleaning import clean_events
from shopmart.operators.curation import insert_cleaned
from shopmart.operators.joins import dimension_join, value_bytes
from shopmart.schemas import EVENT_COLUMNS, HOLIDAY_SCHEMA
from shopmart.session import scratch_path

# Parameters of the marts on the test tables.
CART = "click"
PURCHASE = "purchase"
SALE_WINDOW = ("2024-01-15", "2024-01-29")
SALE_DAYS = ("2024-01-19", "2024-01-28")
LAST_SALE_DAY = "2024-01-29"
EXCLUDED = ("economy",)
NARROW = ("small", "promo")
LABELS = ("narrow", "broad")
CODES = ("economy", "large", "medium", "promo", "small", "standard")
ALLOWED = ("large", "medium", "promo", "small", "standard")
PAGE_SIZE = 10
FIRST_DAY_END = "2024-01-02"

# Two holidays overlap, one date is repeated, one name is not on the list.
HOLIDAY_ROWS = [
    ("New Year", "2024-01-01", "2024-01-08", "2024-01-01"),
    ("Black Friday", "2024-01-19", "2024-01-26", "2024-01-26"),
    ("Valentines Day", "2024-01-25", "2024-01-28", "2024-01-26"),
    ("Unlisted Day", "2024-01-10", "2024-01-12", "2024-01-11"),
]

_STORED: dict[tuple[str, str, str], str] = {}
_BYTES: dict[tuple[str, str, str], int] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(spark: SparkSession, sf_dir: str, name: str, write: Callable[[str], None]) -> str:
    """Path of a derived table, written once per application to the shared folder."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _STORED:
        path = scratch_path(spark, name)
        write(path)
        _STORED[key] = path
    return _STORED[key]


def measured(spark: SparkSession, sf_dir: str, name: str, frame: DataFrame) -> int:
    """Bytes of a dimension, measured once per application."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _BYTES:
        _BYTES[key] = value_bytes(frame)
    return _BYTES[key]


def catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per product: three-level category code and a brand with an apostrophe."""
    word = lambda number: F.split_part("p_name", F.lit(" "), F.lit(number))
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_size").cast("long").alias("category_id"),
        F.concat_ws(".", F.lower("p_type"), word(2), word(1)).alias("category_code"),
        F.concat(word(1), F.lit("'s "), F.lower("p_brand")).alias("brand"),
        F.lower("p_type").alias("top_category"),
        F.lower("p_brand").alias("maker"),
    )


def shop_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with a product of the catalogue; every tenth has no brand, every fifteenth no category."""
    day = F.dayofmonth("ts")
    events = table(spark, sf_dir, "events").select(
        "event_id",
        F.col("ts").alias("event_time"),
        "event_type",
        (F.col("user_id") * 13 + F.col("event_id") % 5).alias("product_id"),
        F.col("value").alias("price"),
        "user_id",
        F.concat_ws("-", F.col("user_id"), F.floor((day - 1) / 7)).alias("user_session"),
        F.when(day <= 10, "1").when(day <= 20, "2").otherwise("3").alias("dataset_key"),
    )
    products = catalogue(spark, sf_dir).drop("top_category", "maker")
    size = measured(spark, sf_dir, "part", products)
    joined = dimension_join(events, products, ["product_id"], dimension_bytes=size)
    return joined.withColumns(
        {
            "brand": F.when(F.col("event_id") % 10 != 0, F.col("brand")),
            "category_code": F.when(F.col("event_id") % 15 != 0, F.col("category_code")),
        }
    ).select("event_id", *EVENT_COLUMNS, "dataset_key")


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_events(shop_events(spark, sf_dir))


def first_day(events: DataFrame) -> DataFrame:
    """The events before the second day: the state that a merge finds."""
    return events.filter(F.col("event_time") < F.lit(FIRST_DAY_END).cast("timestamp_ntz"))


def holidays(spark: SparkSession) -> DataFrame:
    rows = [(name, *map(date.fromisoformat, days)) for name, *days in HOLIDAY_ROWS]
    return spark.createDataFrame(rows, HOLIDAY_SCHEMA)


def mapping_final(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of the catalogue lines sized 20 and up; the pairs of maker brand#2 appear twice."""

    def write(path: str) -> None:
        lines = catalogue(spark, sf_dir).filter(F.col("category_id") >= 20)
        pairs = lines.select("brand", "category_code").distinct()
        again = lines.filter(F.col("maker") == "brand#2").select("brand", "category_code").distinct()
        pairs.union(again).write.parquet(path)

    return spark.read.parquet(stored(spark, sf_dir, "mapping-final", write))


def final_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    mapping = mapping_final(spark, sf_dir)
    size = measured(spark, sf_dir, "mapping-final", mapping)
    return insert_cleaned(cleaned(spark, sf_dir).drop("event_id"), mapping, dimension_bytes=size)


def dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each brand sells, as far as the catalogue lines sized 40 and up tell."""
    lines = catalogue(spark, sf_dir).filter(F.col("category_id") >= 40)
    return lines.select("brand", F.col("top_category").alias("category_index")).distinct()


def brands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaned(spark, sf_dir).select("brand").distinct()
