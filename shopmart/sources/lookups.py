"""Small tables a user brings: the holiday calendar and the brand dictionary."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shopmart.schemas import HOLIDAY_SCHEMA, MAPPING_SCHEMA


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    reader = spark.read.schema(schema)
    if path.rstrip("/").endswith((".csv", ".csv.gz")):
        return reader.options(header=True, enforceSchema=False, escape='"', mode="FAILFAST").csv(path)
    return reader.parquet(path)


def read_holidays(spark: SparkSession, path: str) -> DataFrame:
    """holiday, start_date, end_date, date; from CSV with a header or Parquet."""
    return _read(spark, path, HOLIDAY_SCHEMA)


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """brand, category_index; from CSV with a header or Parquet."""
    return _read(spark, path, MAPPING_SCHEMA)
