"""Intermediate tables in the shared folder that ``spark.checkpoint.dir`` names."""

from __future__ import annotations

from pyspark.sql import DataFrame

from shopmart.session import scratch_path


def store(frame: DataFrame, name: str, **options: str) -> DataFrame:
    """Write a frame as Parquet and read it back, so that its lineage ends at files that outlive an executor."""
    spark = frame.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    frame.write.options(**options).parquet(path)
    stored = spark.read.schema(frame.schema).parquet(path)
    stored._stored_at = path
    return stored


def discard(*frames: DataFrame) -> None:
    """Delete tables made by :func:`store` that no result reads any more."""
    for frame in frames:
        jvm = frame.sparkSession._jvm
        path = jvm.org.apache.hadoop.fs.Path(frame._stored_at)
        path.getFileSystem(frame.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def shuffle_partitions(frame: DataFrame) -> int:
    return int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))
