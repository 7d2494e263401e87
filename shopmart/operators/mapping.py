"""Brand to category mapping: prompts, replies, classification, checks and expansion."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from shopmart.functions.rates import top_category
from shopmart.functions.text import has_sql_block, pair_member, prompt, sql_block, value_pairs
from shopmart.schemas import CATEGORY_CODES


def batch_prompts(batches: DataFrame, codes: Sequence[str] = CATEGORY_CODES) -> DataFrame:
    """One prompt per batch; a batch is a bounded list of brands."""
    gathered = batches.groupBy("batch_id").agg(F.collect_list("brand").alias("brands"))
    return gathered.select("batch_id", prompt(F.col("brands"), codes).alias("prompt"))


def ask(prompts: DataFrame, answer: Callable[[str], str], parallel: int | None = None) -> DataFrame:
    """Replies of a user-supplied model, called once per batch on the executors.

    ``parallel`` sets over how many tasks the calls are spread; batches are small, so without it
    adaptive execution may merge them into few tasks. A lost task calls the model again:
    store the replies before using them twice.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame({"batch_id": frame["batch_id"], "reply": [answer(text) for text in frame["prompt"]]})

    requests = prompts.select("batch_id", "prompt")
    if parallel:
        requests = requests.repartition(parallel, "batch_id")
    return requests.mapInPandas(run, "batch_id long, reply string")


def extract_blocks(replies: DataFrame, reply: str = "reply", strict: bool = False) -> DataFrame:
    """Adds ``sql_text``, the first fenced block, and ``parse_ok``."""
    return replies.withColumns(
        {"sql_text": sql_block(F.col(reply), strict), "parse_ok": has_sql_block(F.col(reply))}
    )


def parse_replies(replies: DataFrame, reply: str = "reply", strict: bool = False, keep: Sequence[str] = ()) -> DataFrame:
    """(brand, category_index) rows out of replies, after the columns to keep; the statement is read, never run."""
    blocks = extract_blocks(replies, reply, strict)
    pairs = blocks.select(*keep, F.explode(value_pairs(F.col("sql_text"))).alias("pair"))
    return pairs.select(
        *keep,
        pair_member(F.col("pair"), 1).alias("brand"), pair_member(F.col("pair"), 2).alias("category_index")
    )


def classify_brands(brands: DataFrame, dictionary: DataFrame, codes: Sequence[str] = CATEGORY_CODES) -> DataFrame:
    """Mapping without a model: all codes a dictionary (brand, category_index) lists for a brand.

    A brand the dictionary does not know gets one code, picked by its MD5 digest, so that
    every brand is mapped and a rerun maps it alike.
    """
    known = dictionary.select("brand", "category_index").distinct()
    pick = F.conv(F.substring(F.md5(F.col("brand").cast("binary")), 1, 4), 16, 10).cast("int") % F.lit(len(codes))
    fallback = F.element_at(F.array(*map(F.lit, codes)), pick + 1)
    return (
        brands.select("brand")
        .join(known, "brand", "left")
        .select("brand", F.coalesce("category_index", fallback).alias("category_index"))
    )


def valid_mapping(mapping: DataFrame, codes: Sequence[str] = CATEGORY_CODES) -> DataFrame:
    """Pairs whose code is allowed."""
    return mapping.filter(F.col("category_index").isin(list(codes)))


def asked_pairs(replies: DataFrame, batches: DataFrame) -> DataFrame:
    """Pairs of the replies for brands that their own batch asked for, each once."""
    found = parse_replies(replies, keep=["batch_id"])
    asked = batches.select("batch_id", "brand")
    return found.join(asked, ["batch_id", "brand"], "left_semi").select("brand", "category_index").distinct()


def mapping_counts(mapping: DataFrame, codes: Sequence[str] = CATEGORY_CODES) -> DataFrame:
    """Accepted and rejected pairs."""
    allowed = F.coalesce(F.col("category_index").isin(list(codes)), F.lit(False))
    return mapping.agg(F.count_if(allowed).alias("accepted"), F.count_if(~allowed).alias("rejected"))


def expand_mapping(mapping: DataFrame, events: DataFrame) -> DataFrame:
    """(brand, category_code) pairs of the events whose top category is mapped to the brand.

    Only pairs that occur are produced. Any other pair could not match an event, so joining
    events with the result is the same as with all codes of each mapped category, without
    the product of brands and codes.
    """
    observed = (
        events.select("brand", "category_code")
        .filter(F.col("brand").isNotNull() & F.col("category_code").isNotNull())
        .distinct()
        .withColumn("category_index", top_category(F.col("category_code")))
    )
    return observed.join(mapping, ["brand", "category_index"], "left_semi").select("brand", "category_code")
