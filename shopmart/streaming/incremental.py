"""Load of newly landed event files, each file once."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T
from pyspark.sql.streaming.query import StreamingQuery

from shopmart.operators.cleaning import clean_events
from shopmart.plans import jobs
from shopmart.schemas import EVENT_SCHEMA
from shopmart.sources.event_files import event_reader, spread, typed_events
from shopmart.sources.tables import STAGING, Tables

ARRIVED = "events_arrived"
DATASET_KEY = T.StructType([T.StructField("dataset_key", T.StringType())])
LOADED_SCHEMA = T.StructType([*EVENT_SCHEMA.fields, *DATASET_KEY.fields, T.StructField("load_id", T.LongType())])


def start_incremental_load(
    spark: SparkSession,
    landing: str,
    target: str,
    checkpoint: str,
    *,
    clean: bool = False,
    files_per_trigger: int | None = None,
    multi_line: bool = False,
    then: Callable[[Sequence[str]], None] | None = None,
) -> StreamingQuery:
    """Load the files below ``landing/dataset_key=<key>/`` that no earlier run has loaded.

    The checkpoint is the cursor: a run takes what is new, stops by itself, and the next run
    goes on behind it. A batch that is repeated after a failure overwrites its own
    ``load_id`` partitions, so its rows are stored once. All new files form one batch unless
    ``files_per_trigger`` limits it; 1 gives the file-by-file order of a manual loop. ``then`` is called with the
    datasets of a batch once its rows are stored and before it counts as done, so after a failure it is called again.
    """
    reader = event_reader(spark.readStream, DATASET_KEY, multi_line)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)

    def store(batch: DataFrame, batch_id: int) -> None:
        events = typed_events(spread(batch, "dataset_key")).withColumn("load_id", F.lit(batch_id).cast("long"))
        seen = Observation()
        (
            (clean_events(events) if clean else events)
            .observe(seen, F.collect_set("dataset_key").alias("keys"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("dataset_key", "load_id")
            .parquet(target)
        )
        keys = sorted(jobs.observed(seen).get("keys", ()))
        if then and keys:
            then(keys)

    return (
        reader.csv(landing)
        .writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def incremental_load(spark: SparkSession, landing: str, target: str, checkpoint: str, **options) -> DataFrame:
    """Run the load to its end and return the stored table, which is empty as long as no file has come."""
    query = start_incremental_load(spark, landing, target, checkpoint, **options)
    query.awaitTermination()
    return loaded_events(spark, target)


def load_into_staging(tables: Tables, landing: str, checkpoint: str, **options) -> list[str]:
    """Bring newly landed files into staging, dimensions, unique sets and ledger; returns the datasets that received rows.

    Every batch is one commit: its rows are stored under their load, and the datasets it touches are staged anew from
    all their loads. Each of these steps replaces what it wrote before, so a batch that broke off
    anywhere is repeated without doubling rows. Mapping, expansion and insert then go on from the ledger
    as after a load of whole files. A late file costs a rewrite of its own dataset, of no other one.
    """
    target, touched = tables.path(STAGING, ARRIVED), set()

    def publish(keys: Sequence[str]) -> None:
        jobs.stage_loaded(tables, loaded_events(tables.spark, target).drop("load_id"), keys)
        touched.update(keys)

    start_incremental_load(tables.spark, landing, target, checkpoint, then=publish, **options).awaitTermination()
    return sorted(touched)


def loaded_events(spark: SparkSession, target: str) -> DataFrame:
    """What has been loaded so far; no rows as long as no file has come."""
    try:
        return spark.read.schema(LOADED_SCHEMA).parquet(target)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LOADED_SCHEMA)
