"""Removal of events without a brand or category."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def clean_events(events: DataFrame) -> DataFrame:
    """Events that have both a brand and a category code."""
    return events.dropna("any", subset=["brand", "category_code"])


def deleted_rows() -> tuple[Column, Column]:
    """Which rows a missing brand removes, and which of the rest a missing category."""
    brand, category = F.col("brand"), F.col("category_code")
    return brand.isNull(), brand.isNotNull() & category.isNull()


def clean_counts(events: DataFrame) -> DataFrame:
    """Both deletion counts from one pass over two columns."""
    no_brand, no_category = deleted_rows()
    return events.agg(
        F.count_if(no_brand).alias("deleted_null_brand"),
        F.count_if(no_category).alias("deleted_null_category"),
    )
