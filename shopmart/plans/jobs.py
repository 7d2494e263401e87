"""Stored steps from event files to marts.

Every step can be repeated: events and dimensions are replaced by dataset, marts as a whole,
and the unique sets and the mapping only receive keys they lack. What a dataset holds, its distinct pairs of brand and
category, is stored when it is staged; dimensions, expansion and the question which datasets an insert
has to touch are answered from these pairs and the ledger, without reading events again.
"""

from __future__ import annotations

import logging
import time
import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, functions as F, types as T

from shopmart.operators import curation, dimensions, mapping as mappings
from shopmart.operators.cleaning import clean_events, deleted_rows
from shopmart.operators.joins import BROADCAST_BYTES, value_bytes
from shopmart.operators.paging import number_batches
from shopmart.plans import marts
from shopmart.schemas import (
    BATCH_SIZE,
    CATEGORY_CODES,
    EVENT_SCHEMA,
    MAPPING_SCHEMA,
    STORED_EVENT_SCHEMA,
)
from shopmart.session import scratch_path
from shopmart.sources.event_files import read_dataset_events, spread, typed_events
from shopmart.sources.registry import FIELDS, Dataset, check_names, lookup
from shopmart.sources.tables import DETAIL, MART, STAGING, Tables

log = logging.getLogger(__name__)

RAW = "events_raw"
EVENTS = "events"
FINAL = "final_table"
UNIQUE = {"brand": "unique_brands", "category_code": "unique_categories"}
MAPPING = "brand_category_mapping"
FINAL_MAPPING = "brand_category_mapping_final"
PAIRS = "dataset_pairs"
DIMENSIONS = {"brand": "dataset_brands", "category_code": "dataset_categories"}
METRICS = "load_metrics"
REPLIES = "brand_mapping_replies"
REJECTS = "brand_mapping_rejects"
MODEL_TASKS = 256
#: Batches whose replies are stored together; a crash asks again for no more than these.
WAVE = 4 * MODEL_TASKS
LEDGER = "finished_steps"
LEDGER_SCHEMA = "step string, dataset_key string, version string, at long"
PAIR_SCHEMA = "brand string, category_code string"
REPLY_SCHEMA = "run string, prompt_digest string, batch_id long, reply string"
MARTS = ("conversion_rates_holidays", "categories_conversion_rates", "black_friday_sales")


@dataclass(frozen=True)
class LoadMetrics:
    rows: int = 0
    deleted_null_brand: int = 0
    deleted_null_category: int = 0
    seconds: float = field(default=0.0, compare=False)


@dataclass(frozen=True)
class MappingReport:
    """What became of the brands that were to be mapped."""

    brands: int = 0
    accepted_pairs: int = 0
    rejected_pairs: int = 0
    unmapped_brands: int = 0


def store_events(
    tables: Tables,
    events: DataFrame,
    layer: str,
    name: str,
    keys: Iterable[str],
    gather: bool = False,
    schema: T.StructType | str = EVENT_SCHEMA,
) -> None:
    """Replace the partitions of the given datasets; one that has no rows any more is emptied."""
    seen = Observation()
    watched = events.observe(seen, F.collect_set("dataset_key").alias("keys"))
    tables.replace_partitions(watched, layer, name, "dataset_key", gather=gather)
    for key in set(keys) - set(observed(seen).get("keys", ())):
        tables.empty_partition(layer, name, schema, "dataset_key", key)


def observed(seen: Observation) -> dict:
    """What rode along with a write. Nothing if it had no rows: adaptive execution then drops the observation too."""
    try:
        return seen.get
    except Py4JJavaError:
        return {}


def load_datasets(
    tables: Tables, datasets: Sequence[Dataset], clean: bool = True, multi_line: bool = False
) -> dict[str, LoadMetrics]:
    """Read the files of some datasets and replace their partitions in ``events``.

    Reading, counting, cleaning and writing are one scan of all files, whatever the number of datasets: rows
    get their key from the path of their file, and one counter of (outcome, dataset) rides along with the write,
    whose seconds are those of all datasets of the call. A dataset without rows leaves its partition
    empty, alone or among others. With ``clean`` off all rows go to ``events_raw``,
    from where ``clean_dataset`` takes them.
    """
    started = time.monotonic()
    keys = [dataset.key for dataset in datasets]
    urls = {dataset.key: dataset.dataset_url for dataset in datasets}
    raw = read_dataset_events(tables.spark, urls, multi_line)
    if raw.isEmpty() and not tables.exists(STAGING, EVENTS if clean else RAW):
        return {key: LoadMetrics() for key in keys}
    no_brand, no_category = deleted_rows()
    outcome = F.when(no_brand, OUTCOMES[1]).when(no_category, OUTCOMES[2]).otherwise(OUTCOMES[0])
    seen = Observation()
    most = len(OUTCOMES) * len(keys)  # with as many places as there are items the count is exact
    counter = F.expr(f"approx_top_k(item, {most}, {most + 1000})").alias("counts")
    events = typed_events(spread(raw, "dataset_key", multi_line=multi_line))
    events = events.withColumn("item", F.concat(outcome, F.lit(":"), "dataset_key")).observe(seen, counter).drop("item")
    store_events(tables, clean_events(events) if clean else events, STAGING, EVENTS if clean else RAW, keys)
    counts = {item["item"]: item["count"] for item in observed(seen).get("counts", ())}
    if clean:
        stage(tables, keys)
    seconds = time.monotonic() - started
    metrics = {}
    for key in keys:
        kept, brandless, uncategorised = (counts.get(f"{name}:{key}", 0) for name in OUTCOMES)
        deleted = (brandless, uncategorised) if clean else (0, 0)
        metrics[key] = LoadMetrics(kept + brandless + uncategorised, *deleted, seconds)
    keep_metrics(tables, metrics)
    log.info("loaded %s in %.1f s", metrics, seconds)
    return metrics


OUTCOMES = ("kept", "no brand", "no category")


def keep_metrics(tables: Tables, metrics: Mapping[str, LoadMetrics]) -> None:
    """Append what a load has counted, a row per dataset."""
    rows = [(key, m.rows, m.deleted_null_brand, m.deleted_null_category, m.seconds, time.time_ns()) for key, m in metrics.items()]
    schema = "dataset_key string, rows long, deleted_null_brand long, deleted_null_category long, seconds double, at long"
    tables.append(tables.spark.createDataFrame(rows, schema).coalesce(1), DETAIL, METRICS)


def stage(tables: Tables, keys: Sequence[str]) -> None:
    """Store the distinct pairs of newly staged datasets, and note that their events have changed."""
    chosen = staging_events(tables).filter(F.col("dataset_key").isin(list(keys)))
    pairs = chosen.select("brand", "category_code", "dataset_key").distinct()
    store_events(tables, pairs, DETAIL, PAIRS, keys, gather=True, schema=PAIR_SCHEMA)
    finish(tables, "stage", dict.fromkeys(keys, uuid.uuid4().hex))


def staged_pairs(tables: Tables, keys: Sequence[str] | None = None) -> DataFrame:
    """Distinct (brand, category_code, dataset_key) of the staged datasets, or of some."""
    pairs = tables.read(DETAIL, PAIRS, T.StructType.fromDDL(f"{PAIR_SCHEMA}, dataset_key string"))
    return pairs if keys is None else pairs.filter(F.col("dataset_key").isin(list(keys)))


def load_dataset(tables: Tables, dataset: Dataset, clean: bool = True, multi_line: bool = False) -> LoadMetrics:
    return load_datasets(tables, [dataset], clean, multi_line)[dataset.key]


def stage_loaded(tables: Tables, events: DataFrame, keys: Sequence[str]) -> None:
    """Stage some datasets from rows that are stored elsewhere, all their rows included, and add their keys to the unique sets."""
    chosen = events.filter(F.col("dataset_key").isin(list(keys)))
    store_events(tables, clean_events(chosen), STAGING, EVENTS, keys)
    stage(tables, keys)
    publish(tables, [Dataset(key, *[""] * len(FIELDS)) for key in keys])


def publish(tables: Tables, datasets: Sequence[Dataset]) -> None:
    """Dimensions of newly staged datasets, and their keys in the unique sets; the ledger then has them as loaded."""
    extract_dimensions(tables, datasets)
    for column in UNIQUE:
        merge_unique(tables, datasets, column)
    finish(tables, "load", [dataset.key for dataset in datasets])


def clean_dataset(tables: Tables, key: str) -> LoadMetrics:
    """Copy a dataset from ``events_raw`` to ``events`` without the rows that lack brand or category."""
    seen = Observation()
    no_brand, no_category = deleted_rows()
    events = staging_events(tables, key, RAW).observe(
        seen,
        F.count("*").alias("rows"),
        F.count_if(no_brand).alias("deleted_null_brand"),
        F.count_if(no_category).alias("deleted_null_category"),
    )
    store_events(tables, clean_events(events), STAGING, EVENTS, [key])
    stage(tables, [key])
    return LoadMetrics(**seen.get)


def staging_events(tables: Tables, key: str | None = None, name: str = EVENTS) -> DataFrame:
    """Staged events, or those of one dataset, which reads only its partition."""
    events = tables.read(STAGING, name, STORED_EVENT_SCHEMA)
    return events if key is None else events.filter(F.col("dataset_key") == key)


def extract_dimensions(tables: Tables, datasets: Dataset | Sequence[Dataset], keep_existing: bool = False) -> None:
    """Distinct brands and categories of some datasets, refreshed unless ``keep_existing``; one job for each of the two."""
    datasets = [datasets] if isinstance(datasets, Dataset) else datasets
    for column, name in DIMENSIONS.items():
        keys = [d.key for d in datasets if not (keep_existing and tables.exists(DETAIL, name, f"/dataset_key={d.key}"))]
        if keys:
            pairs = staged_pairs(tables, keys).filter(F.col("brand").isNotNull())
            rows = pairs.select(column, "dataset_key").distinct()
            store_events(tables, rows, DETAIL, name, keys, gather=True, schema=f"{column} string")


def dimension(tables: Tables, column: str, datasets: Dataset | Sequence[Dataset]) -> DataFrame:
    """The stored brands or categories of some datasets."""
    keys = [d.key for d in ([datasets] if isinstance(datasets, Dataset) else datasets)]
    rows = tables.read(DETAIL, DIMENSIONS[column], T.StructType.fromDDL(f"{column} string, dataset_key string"))
    return rows.filter(F.col("dataset_key").isin(keys)).select(column)


def merge_unique(tables: Tables, datasets: Sequence[Dataset], key: str) -> dict[str, int]:
    """Add the keys of some datasets that the unique set lacks; returns the counts of the merge."""
    tables.create_if_absent(DETAIL, UNIQUE[key], f"{key} string")
    source, target = dimension(tables, key, datasets), tables.read(DETAIL, UNIQUE[key])
    counts = dimensions.merge_metrics(source, target, key).drop("key_name").first().asDict()
    if counts["inserted"]:
        tables.append(dimensions.new_keys(source, target, key), DETAIL, UNIQUE[key])
    return counts


def map_brands(
    tables: Tables,
    dictionary: DataFrame | None = None,
    answer: Callable[[str], str] | None = None,
    codes: Sequence[str] = CATEGORY_CODES,
    size: int = BATCH_SIZE,
    parallel: int | None = None,
) -> MappingReport:
    """Map the unique brands that are not mapped yet, by a model's replies or a dictionary.

    Of a reply only the pairs of brands in its own batch count, each once. Pairs with a code that is not
    allowed go to ``brand_mapping_rejects``; a brand without an accepted pair stays unmapped and is
    asked for again by the next run, and the report says how many there are. A reply without a
    statement is an error, raised after the other replies are stored. ``parallel`` bounds how many
    calls run at a time; without it there is a task per batch, up to ``MODEL_TASKS``.

    Replies are kept in a log as they come, ``WAVE`` batches at a time. A run that did not come to its end leaves its replies there,
    and the next one takes them for the same prompts instead of asking again. Replies and rejects of earlier runs stay.
    """
    tables.create_if_absent(DETAIL, MAPPING, MAPPING_SCHEMA)
    known, failed, run = tables.read(DETAIL, MAPPING), 0, uuid.uuid4().hex
    brands = dimensions.new_keys(tables.read(DETAIL, UNIQUE["brand"]), known, "brand")
    if answer is not None:
        batches = fixed(number_batches(brands, "brand", size), "mapping-batches")
        asked = batches.count()
        replies = logged_replies(tables, mappings.batch_prompts(batches, codes), answer, parallel, run)
        failed = mappings.extract_blocks(replies).filter(~F.col("parse_ok")).count()
        found = mappings.asked_pairs(replies, batches)
    elif dictionary is not None:
        asked = brands.count()
        found = mappings.classify_brands(brands, dictionary, codes)
    else:
        raise ValueError("give a dictionary or a function that answers prompts")
    # What is found depends on which brands are mapped, so it is fixed before the mapping changes.
    found = fixed(found, "mapping-found")
    accepted = mappings.valid_mapping(found, codes)
    refused = found.filter(~F.coalesce(F.col("category_index").isin(list(codes)), F.lit(False)))
    tables.append(refused.withColumn("run", F.lit(run)), DETAIL, REJECTS)
    counts = mappings.mapping_counts(found, codes).first()
    mapped = accepted.select("brand").distinct().count()
    tables.append(accepted, DETAIL, MAPPING)
    if answer is not None:
        used = replies.select("run").distinct().collect()  # this run, and those it went on with
        finish(tables, "map", {row.run: run for row in used})
    report = MappingReport(asked, counts["accepted"], counts["rejected"], asked - mapped)
    log.info("mapped %s", report)
    if failed:
        raise ValueError(f"{failed} replies hold no sql block; their brands are not mapped")
    return report


def fixed(frame: DataFrame, name: str) -> DataFrame:
    """A frame as a written table of the shared folder, so that every use sees the same rows."""
    path = scratch_path(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def logged_replies(
    tables: Tables, prompts: DataFrame, answer: Callable[[str], str], parallel: int | None, run: str
) -> DataFrame:
    """Replies to all prompts (run, batch_id, reply), out of the log where an unfinished run has asked the same."""
    tables.create_if_absent(DETAIL, REPLIES, REPLY_SCHEMA)
    prompts = fixed(prompts.withColumn("prompt_digest", F.sha2("prompt", 256)), "mapping-prompts")
    finished_runs = list(finished(tables, "map"))

    def open_replies() -> DataFrame:
        logged = tables.read(DETAIL, REPLIES, T.StructType.fromDDL(REPLY_SCHEMA)).filter(~F.col("run").isin(finished_runs))
        first = logged.groupBy("prompt_digest").agg(F.min(F.struct("run", "reply")).alias("first"))
        return first.select("prompt_digest", "first.run", "first.reply")

    batches = prompts.agg(F.max("batch_id")).first()[0]
    for start in range(0, 0 if batches is None else batches + 1, WAVE):
        wave = prompts.filter(F.col("batch_id").between(start, start + WAVE - 1))
        wave = fixed(wave.join(open_replies(), "prompt_digest", "left_anti"), "mapping-wave")
        asked = wave.count()
        if asked:
            tasks = parallel or min(MODEL_TASKS, asked)
            answers = mappings.ask(wave, answer, tasks).join(wave.select("batch_id", "prompt_digest"), "batch_id")
            tables.append(answers.select(F.lit(run).alias("run"), "prompt_digest", "batch_id", "reply"), DETAIL, REPLIES)
    return prompts.join(open_replies(), "prompt_digest").select("run", "batch_id", "reply")


def expand_mapping(tables: Tables, rebuild: bool = False) -> None:
    """Add the observed pairs that the mapping allows and the final mapping lacks, out of the stored pairs of the datasets.

    ``rebuild`` writes the final mapping anew, without pairs that no dataset holds any more.
    """
    pairs = mappings.expand_mapping(tables.read(DETAIL, MAPPING), staged_pairs(tables).drop("dataset_key"))
    if rebuild or not tables.exists(DETAIL, FINAL_MAPPING):
        tables.replace(pairs, DETAIL, FINAL_MAPPING)
        return
    fresh = fixed(pairs.join(tables.read(DETAIL, FINAL_MAPPING), curation.PAIR, "left_anti"), "mapping-fresh")
    if not fresh.isEmpty():
        tables.append(fresh, DETAIL, FINAL_MAPPING)


def insert_states(tables: Tables) -> dict[str, str]:
    """For each staged dataset what its part of the final table depends on: its events, and its pairs that are mapped."""
    mapped = staged_pairs(tables).join(tables.read(DETAIL, FINAL_MAPPING).select(*curation.PAIR), curation.PAIR)
    mark = F.xxhash64(*curation.PAIR).cast("decimal(38,0)")
    sums = mapped.groupBy("dataset_key").agg(F.count("*").alias("pairs"), F.sum(mark).alias("mark")).collect()
    marks = {row.dataset_key: f"{row.pairs}:{row.mark}" for row in sums}
    return {key: f"{version}:{marks.get(key, '0:0')}" for key, version in versions(tables, "stage").items()}


def insert_cleaned(
    tables: Tables, key: str | None = None, rebuild: bool = False, by_time: bool = False
) -> list[str]:
    """Put the mapped events of one dataset into the final table, or of all that need it; returns their keys.

    Without a key those datasets are inserted whose events or mapped pairs have changed since they were, or all with
    ``rebuild``. Staging files hold one dataset each. A broadcast mapping leaves the rows where they are,
    so every task writes to few partitions; a mapping that is too large for that mixes the
    datasets, and their rows are gathered again before writing. ``by_time`` shuffles the rows into ranges of time,
    so that each file of a dataset holds its own span and a query of some days opens only theirs.
    """
    states, done = insert_states(tables), versions(tables, "insert")
    keys = [key] if key is not None else sorted(k for k in states if rebuild or states[k] != done.get(k))
    if not keys:
        return []
    pairs = tables.read(DETAIL, FINAL_MAPPING)
    size = value_bytes(pairs)
    events = staging_events(tables).filter(F.col("dataset_key").isin(keys))
    kept = curation.insert_cleaned(events, pairs, dimension_bytes=size)
    if by_time:
        # Rows of one moment may be very many, so a hash of the row is part of the ranges.
        ranges = ("dataset_key", "event_time", F.xxhash64(*kept.columns))
        kept = kept.repartitionByRange(*ranges).sortWithinPartitions("dataset_key", "event_time")
    store_events(tables, kept, DETAIL, FINAL, keys, gather=not by_time and key is None and size > BROADCAST_BYTES)
    finish(tables, "insert", {k: states.get(k, "") for k in keys})
    return keys


@dataclass(frozen=True)
class MartOptions:
    """Arguments for the mart functions where their defaults do not fit."""

    holiday: Mapping[str, object] = field(default_factory=dict)
    category: Mapping[str, object] = field(default_factory=dict)
    sales: Mapping[str, object] = field(default_factory=dict)


def build_marts(
    tables: Tables, holidays: DataFrame, options: MartOptions = MartOptions(), keep_existing: bool = False
) -> None:
    """Store the three marts anew; with ``keep_existing`` a mart that is there is an error."""
    events = tables.read(DETAIL, FINAL, STORED_EVENT_SCHEMA)
    save = tables.save_new if keep_existing else tables.replace
    frames = (
        marts.holiday_conversion(events, holidays, **options.holiday),
        marts.category_conversion(events, **options.category),
        marts.black_friday_sales(events, holidays, **options.sales),
    )
    for frame, name in zip(frames, MARTS):
        save(frame, MART, name)


def register_all(tables: Tables, registry: Mapping[str, Dataset] | None = None) -> None:
    """Make events, final table, key sets, mapping and marts queryable as ``layer.name`` in SQL.

    With a registry the tables that it names for each dataset are views of the shared ones.
    """
    tables.register(STAGING, EVENTS, "dataset_key")
    for name in (FINAL, PAIRS, *DIMENSIONS.values()):
        tables.register(DETAIL, name, "dataset_key")
    for name in (*UNIQUE.values(), MAPPING, FINAL_MAPPING):
        tables.register(DETAIL, name)
    for name in MARTS:
        tables.register(MART, name)
    for dataset in (registry or {}).values():
        events = ", ".join(f"`{name}`" for name in EVENT_SCHEMA.fieldNames())
        tables.register_part(STAGING, dataset.table_name, EVENTS, events, dataset.key)
        tables.register_part(DETAIL, dataset.brands_table_name, DIMENSIONS["brand"], "brand", dataset.key)
        tables.register_part(DETAIL, dataset.categories_table_name, DIMENSIONS["category_code"], "category_code", dataset.key)


def versions(tables: Tables, step: str) -> dict[str, str]:
    """For the datasets a step has handled, what it handled last; one row per dataset."""
    tables.create_if_absent(DETAIL, LEDGER, LEDGER_SCHEMA)
    rows = tables.read(DETAIL, LEDGER, T.StructType.fromDDL(LEDGER_SCHEMA)).filter(F.col("step") == step)
    last = rows.groupBy("dataset_key").agg(F.max(F.struct("at", "version")).alias("last"))
    return {row.dataset_key: row.last.version for row in last.collect()}


def finished(tables: Tables, step: str) -> set[str]:
    """Keys of the datasets a step has handled."""
    return set(versions(tables, step))


def finish(tables: Tables, step: str, handled: Mapping[str, str] | Iterable[str]) -> None:
    """Note in the ledger that a step has handled some datasets, and what it handled."""
    handled = handled if isinstance(handled, Mapping) else dict.fromkeys(handled, "")
    rows = [(step, key, version, time.time_ns()) for key, version in handled.items()]
    if rows:
        tables.append(tables.spark.createDataFrame(rows, LEDGER_SCHEMA).coalesce(1), DETAIL, LEDGER)


def pending(tables: Tables, registry: Mapping[str, Dataset], step: str) -> list[str]:
    """Registry keys a step has not handled, in order."""
    done = finished(tables, step)
    return [key for key in registry if key not in done]


def load_all(tables: Tables, registry: Mapping[str, Dataset]) -> dict[str, LoadMetrics]:
    """Load, extract and merge every dataset that has not been loaded yet.

    All of them are read at once. If that fails the halves are, and so on, so that a bad file keeps
    only its own dataset out; the error names the datasets that are still to be loaded.
    """
    check_names(registry)
    needed = ("dataset_url", "table_name", "brands_table_name", "categories_table_name")
    datasets = [lookup(registry, key, needed) for key in pending(tables, registry, "load")]
    if not datasets:
        return {}
    metrics, failed = _load_halves(tables, datasets)
    datasets = [dataset for dataset in datasets if dataset.key in metrics]
    if any(metrics[dataset.key].rows for dataset in datasets):
        publish(tables, datasets)
    else:
        finish(tables, "load", [dataset.key for dataset in datasets])
    if failed:
        raise ValueError(f"datasets not loaded: {', '.join(sorted(failed))}") from next(iter(failed.values()))
    return metrics


def _load_halves(
    tables: Tables, datasets: Sequence[Dataset]
) -> tuple[dict[str, LoadMetrics], dict[str, PySparkException]]:
    """Metrics of the datasets that load, and the errors of the others."""
    try:
        return load_datasets(tables, datasets), {}
    except PySparkException as error:
        if len(datasets) == 1:
            return {}, {datasets[0].key: error}
    middle = len(datasets) // 2
    left, right = (_load_halves(tables, part) for part in (datasets[:middle], datasets[middle:]))
    return left[0] | right[0], left[1] | right[1]


def build_all(
    tables: Tables,
    registry: Mapping[str, Dataset],
    holidays: DataFrame,
    dictionary: DataFrame | None = None,
    answer: Callable[[str], str] | None = None,
    codes: Sequence[str] = CATEGORY_CODES,
    options: MartOptions = MartOptions(),
    size: int = BATCH_SIZE,
    parallel: int | None = None,
) -> dict[str, LoadMetrics]:
    """Everything from files to marts; a rerun loads and maps only what is new."""
    metrics = load_all(tables, registry)
    map_brands(tables, dictionary, answer, codes, size, parallel)
    expand_mapping(tables)
    insert_cleaned(tables)
    build_marts(tables, holidays, options)
    return metrics
