"""Training corpus from raw documents: quality rules, exact and near copies, source mix, packing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shopmart.llm import exact_dedup, lsh_forest, mixing, quality_rules
from shopmart.llm.queries import packed
from shopmart.llm.storage import store

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.good_documents(docs)


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id stays."""
    return exact_dedup.distinct_documents(docs, keep="max")


def unlike_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near copies (five-word shingles, similarity 0.8) the document with the smallest id stays."""
    return lsh_forest.one_of_each(docs)


def mixed_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per copy that the mix takes, of whole documents."""
    return mixing.mixed_documents(docs)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all rows with their place in a sequence of 2048 tokens."""
    return packed(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", good_documents),
    ("exact_dedup", distinct_documents),
    ("near_dedup", unlike_documents),
    ("source_mix", mixed_documents),
    ("best_fit_packing", packed_sequences),
]

#: Tokens and similarity joins are beyond SQL here; tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
