"""Dataset registry: key -> file and table names."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from shopmart.schemas import DATASET_SCHEMA, REGISTRY_TYPE

FIELDS = DATASET_SCHEMA.fieldNames()

# First month and number of months in the default registry.
FIRST_MONTH = (2019, 10)
MONTHS = 7
TABLE_KINDS = ("eCommerce", "brands", "categories")
MONTH_NAMES = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")


@dataclass(frozen=True)
class Dataset:
    key: str
    dataset_url: str
    table_name: str
    brands_table_name: str
    categories_table_name: str


def monthly_registry(landing: str, first: tuple[int, int] = FIRST_MONTH, months: int = MONTHS) -> dict[str, Dataset]:
    """One dataset per month, keyed "1", "2", ...; files lie below ``landing``.

    From the thirteenth month on table names carry the year, or they would be those of an earlier month.
    """
    registry = {}
    for number in range(months):
        year, month = divmod(first[0] * 12 + first[1] - 1 + number, 12)
        name = MONTH_NAMES[month]
        registry[str(number + 1)] = Dataset(
            str(number + 1),
            f"{landing.rstrip('/')}/{year}-{name}.csv.gz",
            *[f"{kind}_{name}" if number < 12 else f"{kind}_{name}_{year}" for kind in TABLE_KINDS],
        )
    return registry


def check_names(registry: Mapping[str, Dataset]) -> None:
    """Two datasets that share a table would overwrite each other's rows, so that is an error."""
    for kinds in (("table_name",), ("brands_table_name", "categories_table_name")):
        owners: dict[str, str] = {}
        for key, dataset in registry.items():
            for name in filter(None, (getattr(dataset, kind) for kind in kinds)):
                if name.lower() in owners:
                    raise ValueError(f"datasets {owners[name.lower()]!r} and {key!r} share the table {name!r}")
                owners[name.lower()] = key


def parse_registry(text: str) -> dict[str, Dataset]:
    """Registry from its JSON text."""
    entries = json.loads(text)
    registry = {key: Dataset(key, *(entry.get(name) for name in FIELDS)) for key, entry in entries.items()}
    check_names(registry)
    return registry


def lookup(registry: Mapping[str, Dataset], key: str, needed: tuple[str, ...] = ("dataset_url", "table_name")) -> Dataset:
    """The dataset under ``key``; an unknown key or an empty needed field is an error."""
    if key not in registry:
        raise ValueError(f"dataset {key!r} is not registered")
    dataset = registry[key]
    missing = [name for name in needed if not getattr(dataset, name)]
    if missing:
        raise ValueError(f"dataset {key!r} lacks {', '.join(missing)}")
    return dataset


def registry_rows(frame: DataFrame, json_text: Column) -> DataFrame:
    """One row per dataset out of a column of registry JSON texts.

    ``is_valid`` is false where the file or the table name is missing.
    """
    entries = frame.select(F.explode(F.from_json(json_text, REGISTRY_TYPE)).alias("key", "entry"))
    return entries.select("key", "entry.*").withColumn(
        "is_valid",
        (F.coalesce(F.length("dataset_url"), F.lit(0)) > 0) & (F.coalesce(F.length("table_name"), F.lit(0)) > 0),
    )
