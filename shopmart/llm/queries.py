"""The registered queries of the package and the SQL they are compared with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shopmart.llm import (
    byte_bpe,
    exact_dedup,
    fill_middle,
    licenses,
    lsh_forest,
    mixing,
    packing,
    pii,
    quality_model,
    quality_rules,
    toxicity,
    vector_codes,
    wrapper,
)

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select(F.col("row.doc_id").alias("doc_id"), "size", "source_size", "target", "taken")


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = exact_dedup.mark_copies(table(spark, sf_dir, "documents"), keep="max")
    return marked.select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("sha256").alias("text_sha256")
    )


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_rules.assess(table(spark, sf_dir, "documents"), carry=["doc_id"])
    return found.select(
        F.col("row.doc_id").alias("doc_id"),
        *["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
    )


def op2_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, _ = pii.find_spans(table(spark, sf_dir, "documents"))

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    listed = pii.span_list(F.col("base"))
    return found.select(
        F.col("id").alias("doc_id"),
        *[count(kind) for kind in pii.KINDS],
        F.sha2(listed.cast("binary"), 256).alias("base_sha256"),
        pii.span_list(F.concat("base", "terms")).alias("spans"),
    )


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))


def packed(documents: DataFrame) -> DataFrame:
    import public_tokenizers

    pieces = packing.pack(documents, public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return pieces.select(
        F.col("id").alias("doc_id"),
        "piece",
        "start",
        F.col("length").cast("long").alias("length"),
        "ids_crc32",
        "sequence_id",
        "offset",
    )


def op6_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lsh_forest.near_duplicates(table(spark, sf_dir, "documents"), width=2)
    return found.select(F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"), "kept")


def op7_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = wrapper.main_texts(table(spark, sf_dir, "pages"))
    return found.select(
        F.col("id").alias("page_id"), "url", "text", F.length("text").cast("long").alias("n_chars")
    )


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "families", "spans", "n_rejected")


def digest(value: Column) -> Column:
    return F.sha2(value.cast("binary"), 256)


def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_middle.examples(table(spark, sf_dir, "documents"))
    return made.select(
        F.col("id").alias("doc_id"),
        *["n", "form", "prefix_chars", "middle_chars"],
        digest(F.col("output")).alias("output_sha256"),
        digest(fill_middle.restore(F.col("output"), F.col("form"))).alias("restored_sha256"),
    )


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    vocabulary = public_tokenizers.path("byte_bpe_50k.tiktoken")
    encoded = byte_bpe.encode(table(spark, sf_dir, "documents"), vocabulary, pattern=public_tokenizers.PATTERN)
    return byte_bpe.decode(encoded, vocabulary).select(
        F.col("row.doc_id").alias("doc_id"),
        F.size("ids").cast("long").alias("n_tokens"),
        digest(F.array_join(F.col("ids").cast("array<string>"), " ")).alias("ids_sha256"),
        digest(F.col("data")).alias("decoded_sha256"),
    )


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, codebooks = vector_codes.compress(table(spark, sf_dir, "embeddings"), carry=["label"])
    entries = ",".join(str(value) for part in codebooks for entry in part for value in entry)
    return vector_codes.with_group_error(coded, F.col("row.label")).select(
        F.col("id").alias("vec_id"),
        F.lower(F.hex("code")).alias("code"),
        "error",
        F.col("group_error").alias("label_error"),
        digest(F.lit(entries)).alias("codebooks_sha256"),
    )


QUERIES: dict[str, Query] = {
    "op1_source_mix": op1_source_mix,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_quality_rules": op4_quality_rules,
    "op2_personal_data": op2_personal_data,
    "op5_best_fit_packing": op5_best_fit_packing,
    "op6_quality_model": op6_quality_model,
    "op10_toxicity": op10_toxicity,
    "op8_lsh_forest": op8_lsh_forest,
    "op7_main_text": op7_main_text,
    "op9_license_scan": op9_license_scan,
    "op11_fill_middle": op11_fill_middle,
    "op12_byte_bpe": op12_byte_bpe,
    "op13_vector_codes": op13_vector_codes,
}
