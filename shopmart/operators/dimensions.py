"""Distinct keys and their merge into a unique set."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def distinct_keys(events: DataFrame, key: str, require: str = "brand") -> DataFrame:
    """Distinct values of ``key`` over the events in which ``require`` is present.

    With ``require`` on another column than the key, a null key can be one of the values.
    """
    return events.filter(F.col(require).isNotNull()).select(key).distinct()


def new_keys(source: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Distinct non-null source keys that the target does not hold.

    The target key is a primary key and never null, so an anti-join gives what a null-aware
    NOT IN would, and unlike that it may shuffle both sides.
    """
    fresh = source.select(key).filter(F.col(key).isNotNull()).distinct()
    return fresh.join(target.select(key), key, "left_anti")


def merge_keys(source: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """The unique set after the merge: one shuffle with duplicates dropped on the map side."""
    return target.select(key).union(source.select(key)).filter(F.col(key).isNotNull()).distinct()


def merge_metrics(source: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Source, before, inserted and after counts of a merge, out of one shuffle on the key."""
    marked = (
        source.select(key, F.lit(1).alias("offered"), F.lit(0).alias("held"))
        .union(target.select(key, F.lit(0), F.lit(1)))
        .filter(F.col(key).isNotNull())
    )
    per_key = marked.groupBy(key).agg(F.max("offered").alias("offered"), F.max("held").alias("held"))
    counted = per_key.agg(
        F.count_if(F.col("offered") == 1).alias("source_count"),
        F.count_if(F.col("held") == 1).alias("target_before"),
        F.count_if(F.col("held") == 0).alias("inserted"),
        F.count("*").alias("target_after"),
    )
    return counted.select(F.lit(key).alias("key_name"), "*")
