"""Events restricted to valid brand and category pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame

from shopmart.operators.joins import dimension_join
from shopmart.schemas import EVENT_COLUMNS

PAIR = ["brand", "category_code"]


def _event_columns(staging: DataFrame) -> list[str]:
    return [*EVENT_COLUMNS, *(name for name in staging.columns if name not in EVENT_COLUMNS)]


def insert_cleaned(staging: DataFrame, mapping: DataFrame, **options) -> DataFrame:
    """Event columns of the staging rows that join a mapping pair, once per equal pair."""
    joined = dimension_join(staging, mapping.select(*PAIR), PAIR, "inner", **options)
    return joined.select(*_event_columns(staging))


def insert_cleaned_semi(staging: DataFrame, mapping: DataFrame, **options) -> DataFrame:
    """The staging rows that have a mapping pair, each once whatever the mapping repeats."""
    joined = dimension_join(staging, mapping.select(*PAIR), PAIR, "left_semi", **options)
    return joined.select(*_event_columns(staging))
