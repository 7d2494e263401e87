"""One query per operator, each over whole test tables."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from checks import views
from checks.views import ALLOWED, CART, CODES, PAGE_SIZE, PURCHASE
from shopmart.functions.text import null_token, quoted, quoted_list, utf8_repair
from shopmart.operators import cleaning, curation, dimensions, mapping, paging
from shopmart.operators.intervals import holiday_events
from shopmart.plans import jobs, marts
from shopmart.schemas import EVENT_COLUMNS, NULL_TOKENS
from shopmart.session import scratch_path
from shopmart.sources.event_files import infer_types, read_raw_events
from shopmart.sources.registry import FIELDS, Dataset, registry_rows
from shopmart.sources.tables import DETAIL, MART, Tables
from shopmart.streaming.incremental import incremental_load, load_into_staging

Query = Callable[[SparkSession, str], DataFrame]
STORED_COLUMNS = [*EVENT_COLUMNS, "dataset_key"]

CATEGORY_OPTIONS = {
    "cart": CART,
    "purchase": PURCHASE,
    "excluded": views.EXCLUDED,
    "narrow": views.NARROW,
    "labels": views.LABELS,
}
SALES_OPTIONS = {
    "window": views.SALE_WINDOW,
    "sale": views.SALE_DAYS,
    "last_day": views.LAST_SALE_DAY,
    "purchase": PURCHASE,
}


def as_doubles(mart: DataFrame) -> DataFrame:
    """Decimal rates to 12 places as doubles, the only form both engines print alike."""
    return mart.select(*[F.round(name, 12).cast("double").alias(name) for name in mart.columns])


# Sources and sinks


def landing(spark: SparkSession, sf_dir: str) -> str:
    """The events as CSV files per dataset: the second plain, the others gzip."""

    def write(path: str) -> None:
        events = views.shop_events(spark, sf_dir).select(*STORED_COLUMNS)
        texts = events.withColumn("event_time", F.concat(F.col("event_time").cast("string"), F.lit(" UTC")))
        for codec, chosen in (("gzip", F.col("dataset_key") != "2"), ("none", F.col("dataset_key") == "2")):
            (
                texts.filter(chosen)
                .hint("rebalance", "dataset_key")
                .write.mode("append")
                .partitionBy("dataset_key")
                .options(header=True, compression=codec, escape='"')
                .csv(path)
            )

    return views.stored(spark, sf_dir, "landing", write)


def landed_datasets(root: str) -> list[Dataset]:
    suffix = {"1": "csv.gz", "2": "csv", "3": "csv.gz"}
    return [
        Dataset(key, f"{root}/dataset_key={key}/*.{ending}", f"events_{key}", f"brands_{key}", f"categories_{key}")
        for key, ending in suffix.items()
    ]


def load_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = Tables(spark, scratch_path(spark, "warehouse"))
    jobs.load_datasets(tables, landed_datasets(landing(spark, sf_dir)), clean=False)
    return jobs.staging_events(tables, name=jobs.RAW)


def load_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = Tables(spark, scratch_path(spark, "warehouse"))
    datasets = landed_datasets(landing(spark, sf_dir))
    found = {dataset.key: jobs.load_dataset(tables, dataset) for dataset in datasets}
    return spark.createDataFrame(
        [(key, m.rows, m.deleted_null_brand, m.deleted_null_category) for key, m in found.items()],
        "dataset_key string, rows_read long, deleted_null_brand long, deleted_null_category long",
    )


def daily_datasets(spark: SparkSession, sf_dir: str) -> list[Dataset]:
    """The events as one gzip CSV file set per day of the month: some thirty datasets."""

    def write(path: str) -> None:
        events = views.shop_events(spark, sf_dir).withColumn("dataset_key", F.dayofmonth("event_time").cast("string"))
        texts = events.withColumn("event_time", F.concat(F.col("event_time").cast("string"), F.lit(" UTC")))
        dealt = texts.select(*STORED_COLUMNS).hint("rebalance", "dataset_key")
        dealt.write.partitionBy("dataset_key").options(header=True, compression="gzip", escape='"').csv(path)

    root = views.stored(spark, sf_dir, "daily-landing", write)
    days = views.shop_events(spark, sf_dir).select(F.dayofmonth("event_time").alias("day")).distinct().collect()
    return [Dataset(str(d), f"{root}/dataset_key={d}", f"e_{d}", f"b_{d}", f"c_{d}") for d in sorted(r.day for r in days)]


def built_many_datasets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All days loaded in one call: what was counted, and the brands and categories stored for each."""
    tables = Tables(spark, scratch_path(spark, "warehouse"))
    datasets = daily_datasets(spark, sf_dir)
    jobs.load_all(tables, {dataset.key: dataset for dataset in datasets})
    counted = tables.read(DETAIL, jobs.METRICS).select(
        "dataset_key", F.col("rows").alias("rows_read"), "deleted_null_brand", "deleted_null_category"
    )
    for column, name in jobs.DIMENSIONS.items():
        stored = tables.read(DETAIL, name, f"{column} string, dataset_key string")
        counted = counted.join(stored.groupBy("dataset_key").agg(F.count("*").alias(name)), "dataset_key", "left")
    return counted.fillna(0, list(jobs.DIMENSIONS.values()))


def reload_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged events after the second dataset has been loaded again from a file with nothing but its header."""
    tables = Tables(spark, scratch_path(spark, "warehouse"))
    datasets = landed_datasets(landing(spark, sf_dir))
    jobs.load_datasets(tables, datasets)
    header = scratch_path(spark, "header")
    read_raw_events(spark, datasets[1].dataset_url).limit(0).coalesce(1).write.options(header=True).csv(header)
    jobs.load_dataset(tables, Dataset("2", header, *[getattr(datasets[1], f) for f in FIELDS[1:]]))
    return jobs.staging_events(tables)


def incremental_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The final table after two datasets, then the third, have been loaded, mapped and inserted."""
    tables = Tables(spark, scratch_path(spark, "warehouse"))
    datasets = landed_datasets(landing(spark, sf_dir))
    inserted = []
    for known in (datasets[:2], datasets, datasets):
        jobs.load_all(tables, {dataset.key: dataset for dataset in known})
        jobs.map_brands(tables, views.dictionary(spark, sf_dir), codes=CODES)
        jobs.expand_mapping(tables)
        inserted.append(jobs.insert_cleaned(tables))
    # Datasets that hold newly observed pairs are inserted again; a run with nothing new touches none.
    assert inserted[0] == ["1", "2"] and "3" in inserted[1] and inserted[2] == [], inserted
    return tables.read(DETAIL, jobs.FINAL, jobs.STORED_EVENT_SCHEMA)


def noisy_model(codes: Sequence[str]) -> Callable[[str], str]:
    """The stand-in model with every pair twice, a brand that nobody asked for, and a code that is not allowed for some brands."""
    answer = digest_model(codes)

    def noisy(prompt: str) -> str:
        rows = re.findall(r"\(('(?:[^']|'')*'), ('(?:[^']|'')*')\)", answer(prompt))
        listed = []
        for name, code in rows:
            digest = hashlib.md5(name[1:-1].replace("''", "'").encode()).hexdigest()
            listed.append(f"({name}, {code if digest[0] > '3' else NOT_ALLOWED})")
        values = ",\n".join([*listed, f"('a stranger', '{codes[0]}')", *listed])
        return f"```sql\nINSERT INTO brand_category_mapping VALUES\n{values};\n```"

    return noisy


NOT_ALLOWED = "'no such code'"


def built_model_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mapping by a model that repeats itself, names foreign brands and gives codes that are refused."""
    tables = Tables(spark, scratch_path(spark, "warehouse"))
    jobs.load_all(tables, {dataset.key: dataset for dataset in landed_datasets(landing(spark, sf_dir))})
    jobs.map_brands(tables, answer=noisy_model(CODES), codes=CODES, size=PAGE_SIZE, parallel=4)
    accepted = tables.read(DETAIL, jobs.MAPPING).withColumn("allowed", F.lit(True))
    refused = tables.read(DETAIL, jobs.REJECTS).drop("run").withColumn("allowed", F.lit(False))
    return accepted.unionByName(refused)


def streamed_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    loaded = incremental_load(
        spark,
        landing(spark, sf_dir),
        scratch_path(spark, "streamed"),
        scratch_path(spark, "stream-checkpoint"),
    )
    return loaded.drop("load_id")


def streamed_final_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The final table, stored by time, when all files come as a stream, in two batches or more, and nothing comes afterwards."""
    tables = Tables(spark, scratch_path(spark, "warehouse"))
    checkpoint = scratch_path(spark, "stream-checkpoint")
    for _ in range(2):
        load_into_staging(tables, landing(spark, sf_dir), checkpoint, files_per_trigger=8)
        jobs.map_brands(tables, views.dictionary(spark, sf_dir), codes=CODES)
        jobs.expand_mapping(tables)
        inserted = jobs.insert_cleaned(tables, by_time=True)
    assert inserted == [], inserted
    return tables.read(DETAIL, jobs.FINAL, jobs.STORED_EVENT_SCHEMA)


def dataset_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One registry text per dataset of the events, read back into rows."""
    keys = views.shop_events(spark, sf_dir).select("dataset_key").distinct()
    named = lambda prefix: F.concat(F.lit(prefix), F.col("dataset_key"))
    entry = F.struct(
        F.concat(F.lit("landing/part-"), F.col("dataset_key"), F.lit(".csv.gz")).alias("dataset_url"),
        F.when(F.col("dataset_key") != "3", named("events_")).alias("table_name"),
        named("brands_").alias("brands_table_name"),
        named("categories_").alias("categories_table_name"),
    )
    texts = keys.select(F.to_json(F.create_map("dataset_key", entry)).alias("registry"))
    return registry_rows(texts, F.col("registry"))


def token_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Brand cells in which 19 of every 23 event ids carry a missing-value token."""
    slot = F.col("event_id") % 23
    cell = F.when(slot < len(NULL_TOKENS), F.element_at(F.array(*map(F.lit, NULL_TOKENS)), (slot % 19 + 1).cast("int")))
    return views.shop_events(spark, sf_dir).select("event_id", F.coalesce(cell, F.col("brand")).alias("cell"))


def null_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_cells(spark, sf_dir).select("event_id", null_token(F.col("cell")).alias("brand"))


def infer_column_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = landing(spark, sf_dir)
    return infer_types(read_raw_events(spark, [dataset.dataset_url for dataset in landed_datasets(root)]))


def brands_saved_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Brands saved where no table is, after a second save of other rows to the same name."""
    tables = Tables(spark, scratch_path(spark, "warehouse"))
    brands = dimensions.distinct_keys(views.shop_events(spark, sf_dir), "brand")
    for frame in (brands, brands.select(F.upper("brand").alias("brand"))):
        tables.save_if_absent(frame, DETAIL, "brands")
    return tables.read(DETAIL, "brands")


def brands_saved_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Brands saved as a new table; a second save is refused and leaves the first."""
    tables = Tables(spark, scratch_path(spark, "warehouse"))
    brands = dimensions.distinct_keys(views.shop_events(spark, sf_dir), "brand")
    tables.save_new(brands, DETAIL, "brands")
    try:
        tables.save_new(brands.select(F.upper("brand").alias("brand")), DETAIL, "brands")
    except AnalysisException:
        return tables.read(DETAIL, "brands")
    raise AssertionError("a table that is there was written again")


def insert_cleaned_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The final table after it has been written twice."""
    tables = Tables(spark, scratch_path(spark, "warehouse"))
    for _ in range(2):
        tables.replace_partitions(views.final_table(spark, sf_dir), DETAIL, jobs.FINAL, "dataset_key")
    return tables.read(DETAIL, jobs.FINAL, jobs.STORED_EVENT_SCHEMA)


# Stored warehouse, from files to marts


def warehouse(spark: SparkSession, sf_dir: str) -> Tables:
    """All jobs run over the landed files, once per application."""

    def write(path: str) -> None:
        options = jobs.MartOptions(
            holiday={"cart": CART, "purchase": PURCHASE},
            category=CATEGORY_OPTIONS,
            sales=SALES_OPTIONS,
        )
        registry = {dataset.key: dataset for dataset in landed_datasets(landing(spark, sf_dir))}
        lookup_table = views.dictionary(spark, sf_dir)
        jobs.build_all(
            Tables(spark, path), registry, views.holidays(spark), lookup_table, codes=CODES, options=options
        )

    return Tables(spark, views.stored(spark, sf_dir, "warehouse", write))


def built(layer: str, name: str, schema=None) -> Query:
    return lambda spark, sf_dir: warehouse(spark, sf_dir).read(layer, name, schema)


def built_holiday_conversion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_doubles(warehouse(spark, sf_dir).read(MART, "conversion_rates_holidays"))


def built_category_conversion(spark: SparkSession, sf_dir: str) -> DataFrame:
    mart = warehouse(spark, sf_dir).read(MART, "categories_conversion_rates")
    return mart.withColumn("conversion_rate", F.col("conversion_rate").cast("double"))


# Cleaning, dimensions, merge


def clean_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.cleaned(spark, sf_dir)


def clean_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean_counts(views.shop_events(spark, sf_dir))


def distinct_of(key: str) -> Query:
    return lambda spark, sf_dir: dimensions.distinct_keys(views.shop_events(spark, sf_dir), key)


def merge_sides(spark: SparkSession, sf_dir: str, key: str) -> tuple[DataFrame, DataFrame]:
    """All events as the source, the keys of the first day as the target."""
    events = views.cleaned(spark, sf_dir)
    return events, views.first_day(events).select(key).distinct()


def new_of(key: str) -> Query:
    return lambda spark, sf_dir: dimensions.new_keys(*merge_sides(spark, sf_dir, key), key)


def merged(key: str) -> Query:
    return lambda spark, sf_dir: dimensions.merge_keys(*merge_sides(spark, sf_dir, key), key)


def merge_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = [dimensions.merge_metrics(*merge_sides(spark, sf_dir, key), key) for key in ("brand", "category_code")]
    return counts[0].union(counts[1])


# Mapping


def brand_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paging.page(views.brands(spark, sf_dir), "brand", PAGE_SIZE, PAGE_SIZE)


def brand_pages_sought(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first, the middle and the last page, each sought in one stored index, by number and by the key before it."""
    index = paging.store_pages(views.brands(spark, sf_dir), "brand")
    last = (index.rows() - 1) // PAGE_SIZE
    found = []
    for number in (0, last // 2, last):
        wanted = index.page(PAGE_SIZE, number * PAGE_SIZE)
        found.append(wanted.withColumns({"page": F.lit(number).cast("long"), "sought_by": F.lit("number")}))
        before = index.page(1, number * PAGE_SIZE - 1).first() if number else None
        wanted = index.after(before["brand"] if before else "", PAGE_SIZE)
        found.append(wanted.withColumns({"page": F.lit(number).cast("long"), "sought_by": F.lit("key")}))
    return reduce(DataFrame.unionByName, found)


def brand_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paging.number_batches(views.brands(spark, sf_dir), "brand", PAGE_SIZE)


def batch_prompt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mapping.batch_prompts(brand_batches(spark, sf_dir), CODES)


def classify_brands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mapping.classify_brands(views.brands(spark, sf_dir), views.dictionary(spark, sf_dir), CODES)


def valid_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mapping.valid_mapping(classify_brands(spark, sf_dir), ALLOWED)


def mapping_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mapping.mapping_counts(classify_brands(spark, sf_dir), ALLOWED)


def expand_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mapping.expand_mapping(valid_mapping(spark, sf_dir), views.cleaned(spark, sf_dir))


def mapping_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One reply per batch of brands with the batch's pairs in a fenced block."""
    pairs = brand_batches(spark, sf_dir).join(classify_brands(spark, sf_dir), "brand")
    row = F.concat(F.lit("    ("), quoted(F.col("brand")), F.lit(", "), quoted(F.col("category_index")), F.lit(")"))
    rows = pairs.groupBy("batch_id").agg(F.array_join(F.array_sort(F.collect_list(row)), ",\n").alias("rows"))
    return rows.select(
        "batch_id",
        F.concat(
            F.lit("Here is the statement:\n```sql\nINSERT INTO brand_category_mapping (brand, category_index) VALUES\n"),
            F.col("rows"),
            F.lit(";\n```\nAnother one: ```sql\nVALUES ('none', 'none')\n```"),
        ).alias("reply"),
    )


def parse_mapping_reply(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mapping.parse_replies(mapping_replies(spark, sf_dir), strict=True)


def digest_model(codes: Sequence[str]) -> Callable[[str], str]:
    """Stands in for a model: maps each brand in the prompt to a code picked by its MD5 digest.

    A nested function travels to the workers by value, so they need not import this module.
    """

    def answer(prompt: str) -> str:
        section = prompt.split("Brands: ", 1)[1].split("\nReply with", 1)[0]
        names = [text.replace("''", "'") for text in re.findall(r"'((?:[^']|'')*)'", section)]
        code = {name: codes[int(hashlib.md5(name.encode()).hexdigest()[:4], 16) % len(codes)] for name in names}
        rows = ",\n".join("('{}', '{}')".format(name.replace("'", "''"), code[name]) for name in names)
        return f"Done.\n```sql\nINSERT INTO brand_category_mapping VALUES\n{rows};\n```"

    return answer


def ask_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    replies = mapping.ask(batch_prompt(spark, sf_dir), digest_model(CODES), parallel=4)
    return mapping.parse_replies(replies, strict=True)


def extract_sql_block(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation turn as a reply: assistants add two blocks, users none, systems say nothing."""
    turns = views.table(spark, sf_dir, "conversations")
    block = F.concat(
        F.lit("\n```sql\n \n"),
        F.concat_ws(" ", F.lit("VALUES"), quoted(F.col("text"))),
        F.lit("\t\n```\nor ```sql\nVALUES (1)```"),
    )
    reply = F.when(F.col("role") == "assistant", F.concat("text", block)).when(F.col("role") == "user", F.col("text"))
    found = mapping.extract_blocks(turns.select("conv_id", "turn", F.coalesce(reply, F.lit("")).alias("reply")))
    return found.select("conv_id", "turn", "sql_text", "parse_ok")


def repaired_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document texts with a cut-off two-byte character before and a stray byte behind them."""
    broken = F.concat(F.lit(b"\xc3"), F.encode("text", "UTF-8"), F.lit(b"\xff")).cast("string")
    return views.table(spark, sf_dir, "documents").select("doc_id", utf8_repair(broken).alias("text"))


def quoted_brands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The brand list of each batch as it goes into a prompt."""
    lists = brand_batches(spark, sf_dir).groupBy("batch_id").agg(F.collect_list("brand").alias("brands"))
    return lists.select("batch_id", quoted_list(F.col("brands")).alias("brand_list"))


# Final table and marts


def insert_cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.final_table(spark, sf_dir)


def insert_cleaned_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    staging = views.cleaned(spark, sf_dir).drop("event_id")
    mapping_pairs = views.mapping_final(spark, sf_dir)
    size = views.measured(spark, sf_dir, "mapping-final", mapping_pairs)
    return curation.insert_cleaned_semi(staging, mapping_pairs, dimension_bytes=size)


def holiday_pairs(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    events = views.final_table(spark, sf_dir)
    return holiday_events(events, views.holidays(spark), event_types=(CART, PURCHASE), **options)


def holiday_rows(**options) -> Query:
    columns = ["holiday", "event_time", "event_type", "product_id", "user_id", "user_session"]
    return lambda spark, sf_dir: holiday_pairs(spark, sf_dir, **options).select(*columns)


def event_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.event_totals(views.final_table(spark, sf_dir), CART, PURCHASE)


def cart_then_purchase(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.cart_then_purchase(holiday_pairs(spark, sf_dir), CART, PURCHASE)


def holiday_conversion(spark: SparkSession, sf_dir: str) -> DataFrame:
    mart = marts.holiday_conversion(
        views.final_table(spark, sf_dir), views.holidays(spark), cart=CART, purchase=PURCHASE
    )
    return as_doubles(mart)


def category_conversion(spark: SparkSession, sf_dir: str) -> DataFrame:
    mart = marts.category_conversion(views.final_table(spark, sf_dir), **CATEGORY_OPTIONS)
    return mart.withColumn("conversion_rate", F.col("conversion_rate").cast("double"))


def daily_purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.daily_purchases(views.final_table(spark, sf_dir), views.SALE_WINDOW, PURCHASE)


def black_friday_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.black_friday_sales(views.final_table(spark, sf_dir), views.holidays(spark), **SALES_OPTIONS)


QUERIES: dict[str, Query] = {
    "dataset_registry": dataset_registry,
    "load_events": load_events,
    "load_metrics": load_metrics,
    "incremental_load": streamed_load,
    "streamed_final_table": streamed_final_table,
    "reload_empty": reload_empty,
    "null_tokens": null_tokens,
    "infer_types": infer_column_types,
    "clean_events": clean_events,
    "clean_counts": clean_counts,
    "distinct_brands": distinct_of("brand"),
    "brands_saved_if_absent": brands_saved_if_absent,
    "brands_saved_once": brands_saved_once,
    "distinct_categories": distinct_of("category_code"),
    "new_brands": new_of("brand"),
    "new_categories": new_of("category_code"),
    "merge_unique_brands": merged("brand"),
    "merge_unique_categories": merged("category_code"),
    "merge_metrics": merge_metrics,
    "brand_page": brand_page,
    "brand_pages_sought": brand_pages_sought,
    "brand_batches": brand_batches,
    "quoted_brands": quoted_brands,
    "batch_prompt": batch_prompt,
    "ask_model": ask_model,
    "extract_sql_block": extract_sql_block,
    "parse_mapping_reply": parse_mapping_reply,
    "utf8_repair": repaired_texts,
    "classify_brands": classify_brands,
    "valid_mapping": valid_mapping,
    "mapping_counts": mapping_counts,
    "expand_mapping": expand_mapping,
    "insert_cleaned": insert_cleaned,
    "insert_cleaned_semi": insert_cleaned_semi,
    "insert_cleaned_stored": insert_cleaned_stored,
    "holiday_events": holiday_rows(),
    "holiday_events_binned": holiday_rows(bin_days=1),
    "holiday_events_whole_days": holiday_rows(inclusive_end_day=True),
    "event_totals": event_totals,
    "cart_then_purchase": cart_then_purchase,
    "holiday_conversion": holiday_conversion,
    "category_conversion": category_conversion,
    "daily_purchases": daily_purchases,
    "black_friday_sales": black_friday_sales,
    "incremental_insert": incremental_insert,
    "built_many_datasets": built_many_datasets,
    "built_model_mapping": built_model_mapping,
    "built_unique_brands": built(DETAIL, jobs.UNIQUE["brand"]),
    "built_unique_categories": built(DETAIL, jobs.UNIQUE["category_code"]),
    "built_mapping": built(DETAIL, jobs.MAPPING),
    "built_final_mapping": built(DETAIL, jobs.FINAL_MAPPING),
    "built_final_table": built(DETAIL, jobs.FINAL, jobs.STORED_EVENT_SCHEMA),
    "built_holiday_conversion": built_holiday_conversion,
    "built_category_conversion": built_category_conversion,
    "built_black_friday_sales": built(MART, "black_friday_sales"),
}
