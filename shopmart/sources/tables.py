"""Stored tables: Parquet folders below one shared root, and a JDBC source."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from py4j.java_gateway import JavaObject
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, types as T

# Layers of the warehouse.
STAGING = "dds_stg"
DETAIL = "dds"
MART = "dm"


@dataclass(frozen=True)
class Tables:
    """Named Parquet tables in the layers ``dds_stg``, ``dds`` and ``dm`` below ``root``.

    A table is the folder of its name until it is replaced as a whole. From then on it is the folder that its
    newest version file names: ``<name>__versions/<number>-<folder>`` is an empty file, put there once the
    folder holds all rows. Creating it is the only step that readers see, on object stores too.
    """

    spark: SparkSession
    root: str

    def _base(self, layer: str, name: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{name.lower()}"

    def _hadoop(self, path: str) -> tuple[JavaObject, JavaObject]:
        place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()), place

    def versions(self, layer: str, name: str) -> list[str]:
        """Names of the version files, oldest first; a table that was never replaced has none."""
        files, place = self._hadoop(f"{self._base(layer, name)}__versions")
        return sorted(entry.getPath().getName() for entry in files.listStatus(place)) if files.exists(place) else []

    def path(self, layer: str, name: str) -> str:
        """The folder that holds the table now."""
        base, versions = self._base(layer, name), self.versions(layer, name)
        return f"{base}__{versions[-1].split('-')[1]}" if versions else base

    def read(self, layer: str, name: str, schema: T.StructType | None = None) -> DataFrame:
        """A table; a schema fixes the type of partition columns, which are inferred otherwise."""
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        return reader.parquet(self.path(layer, name))

    def exists(self, layer: str, name: str, part: str = "") -> bool:
        """Whether a table, or a ``part`` of it such as ``/dataset_key=1``, has been written."""
        try:
            self.spark.read.parquet(self.path(layer, name) + part)
        except AnalysisException as error:
            if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return False
            raise
        return True

    def create_if_absent(self, layer: str, name: str, schema: T.StructType | str) -> None:
        """An empty table with the given columns, unless the table is there."""
        empty = self.spark.createDataFrame([], schema)
        empty.write.mode("ignore").parquet(self.path(layer, name))

    def save_if_absent(self, frame: DataFrame, layer: str, name: str) -> None:
        """Write a new table; one that is there stays as it is."""
        frame.write.mode("ignore").parquet(self.path(layer, name))

    def save_new(self, frame: DataFrame, layer: str, name: str) -> None:
        """Write a new table; one that is there is an error."""
        frame.write.mode("errorifexists").parquet(self.path(layer, name))

    def replace(self, frame: DataFrame, layer: str, name: str) -> None:
        """Write a new version of the table beside the old one, then make it the current one.

        Whatever fails, and wherever it stops, the table is either the old one or the new one, whole. ``frame`` may
        read the table it replaces. The version before stays for readers that have begun with it; older ones
        go. Of two replacements at the same time one wins as a whole.
        """
        base, folder = self._base(layer, name), uuid.uuid4().hex
        try:
            frame.write.parquet(f"{base}__{folder}")
            versions = self.versions(layer, name)
            number = int(versions[-1].split("-")[0]) + 1 if versions else 1
            files, mark = self._hadoop(f"{base}__versions/{number:010d}-{folder}")
            files.create(mark, False).close()
        except BaseException:
            if folder not in {version.split("-")[1] for version in self.versions(layer, name)}:
                self._drop(f"{base}__{folder}")
            raise
        for version in versions[:-1]:
            self._drop(f"{base}__versions/{version}")
            self._drop(f"{base}__{version.split('-')[1]}")
        if versions:
            self._drop(base)
        if self.spark.catalog.tableExists(f"{layer}.{name.lower()}"):
            self.register(layer, name)

    def _drop(self, path: str) -> None:
        files, place = self._hadoop(path)
        files.delete(place, True)

    def append(self, frame: DataFrame, layer: str, name: str) -> None:
        frame.write.mode("append").parquet(self.path(layer, name))

    def replace_partitions(self, frame: DataFrame, layer: str, name: str, *keys: str, gather: bool = False) -> None:
        """Overwrite only the partitions that occur in ``frame``, so that a rerun adds nothing.

        ``gather`` is for rows that are spread over many tasks and many partitions: the
        rebalance hint collects a partition into few files, and adaptive execution splits
        one that holds most of the rows.
        """
        if gather:
            frame = frame.hint("rebalance", *keys)
        (
            frame.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*keys)
            .parquet(self.path(layer, name))
        )

    def empty_partition(self, layer: str, name: str, schema: T.StructType | str, key: str, value: str) -> None:
        """Leave a partition without rows; ``schema`` is that of the table without the key."""
        empty = self.spark.createDataFrame([], schema)
        empty.write.mode("overwrite").parquet(f"{self.path(layer, name)}/{key}={value}")

    def register(self, layer: str, name: str, *keys: str) -> None:
        """Make a stored table known to SQL as ``layer.name``; ``keys`` are its partition columns."""
        target, location = f"{layer}.{name.lower()}", self.path(layer, name)
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}")
        self.spark.sql(f"DROP TABLE IF EXISTS {target}")  # an external table: its files stay
        columns = [field for field in self.read(layer, name).schema if field.name not in keys]
        fields = [f"`{field.name}` {field.dataType.simpleString()}" for field in columns]
        fields += [f"`{key}` string" for key in keys]
        parts = f"PARTITIONED BY ({', '.join(f'`{key}`' for key in keys)})" if keys else ""
        self.spark.sql(f"CREATE TABLE {target} ({', '.join(fields)}) USING parquet {parts} LOCATION '{location}'")
        if keys:
            self.spark.sql(f"ALTER TABLE {target} RECOVER PARTITIONS")

    def register_part(self, layer: str, name: str, whole: str, columns: str, key: str) -> None:
        """Make the part of one dataset of a registered table known to SQL as ``layer.name``."""
        value = key.replace("\\", "\\\\").replace("'", "\\'")
        self.spark.sql(
            f"CREATE OR REPLACE VIEW {layer}.`{name.lower()}` AS "
            f"SELECT {columns} FROM {layer}.{whole} WHERE dataset_key = '{value}'"
        )


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str,
    lower: str,
    upper: str,
    partitions: int,
    **options: str,
) -> DataFrame:
    """A database table, read in parallel ranges of a numeric, date or timestamp column."""
    return (
        spark.read.format("jdbc")
        .options(
            url=url,
            dbtable=table,
            partitionColumn=partition_column,
            lowerBound=lower,
            upperBound=upper,
            numPartitions=partitions,
            **options,
        )
        .load()
    )
