"""Ordered pages over a unique key."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from shopmart.schemas import BATCH_SIZE
from shopmart.session import scratch_path

_ROW_BITS = 33  # monotonically_increasing_id keeps the row position in the low 33 bits


def key_ranks(keys: DataFrame, key: str) -> DataFrame:
    """Every row with its 0-based ``position`` in ascending key order, without one global task.

    The rows are range-partitioned and sorted, and stored in the shared folder together with
    their range number and place in the range. Storing them fixes the ranges: sampling them
    again, or losing an executor, could move their limits. What remains is adding up the
    sizes of the preceding ranges, one row per range.
    """
    spark: SparkSession = keys.sparkSession
    place = scratch_path(spark, "key-ranks")
    row_id = F.monotonically_increasing_id()
    ranged = keys.repartitionByRange(key).sortWithinPartitions(key)
    ranged.withColumn("_id", row_id).select(
        *keys.columns,
        F.shiftright("_id", _ROW_BITS).alias("_range"),
        F.col("_id").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)).alias("_place"),
    ).write.parquet(place)

    stored = spark.read.parquet(place)
    before = Window.partitionBy(F.lit(0)).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        stored.groupBy("_range")
        .agg(F.count("*").alias("_rows"))
        .select("_range", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    )
    ranked = stored.join(F.broadcast(starts), "_range")  # one row per range partition
    return ranked.select(*keys.columns, (F.col("_start") + F.col("_place")).alias("position"))


def number_batches(keys: DataFrame, key: str, size: int = BATCH_SIZE) -> DataFrame:
    """All pages at once: ``batch_id`` counts pages of ``size`` keys in ascending order."""
    ranked = key_ranks(keys, key)
    return ranked.select(*keys.columns, F.floor(F.col("position") / F.lit(size)).alias("batch_id"))


def page(keys: DataFrame, key: str, limit: int = BATCH_SIZE, offset: int = 0) -> DataFrame:
    """``limit`` keys after the first ``offset``, in ascending order, cut out of the distributed ranks."""
    ranked = key_ranks(keys, key)
    return ranked.filter(F.col("position").between(offset, offset + limit - 1)).select(*keys.columns).orderBy(key)


@dataclass(frozen=True)
class PageIndex:
    """Keys stored in sorted ranges, with a table of the limits, size and start of each range.

    Pages are sought in the small table and read from the one or two ranges that hold them; nothing is written
    and no other range is opened, wherever the page lies. ``store_pages`` makes one, and
    ``PageIndex(spark, place, key, schema)`` opens it again later. Keys are unique and not null, as for ``key_ranks``.
    """

    spark: SparkSession
    place: str
    key: str
    schema: T.StructType

    def ranges(self) -> DataFrame:
        """``range``, ``first_key``, ``last_key``, ``rows`` and ``start``, the number of keys in the ranges before."""
        return self.spark.read.parquet(f"{self.place}/index")

    def rows(self) -> int:
        return self.ranges().agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]

    def page(self, limit: int = BATCH_SIZE, offset: int = 0) -> DataFrame:
        """``limit`` keys after the first ``offset``, in ascending order."""
        end = F.col("start") + F.col("rows")
        found = self.ranges().filter((F.col("start") < offset + limit) & (end > offset)).collect()
        place = F.element_at(F.create_map(*[F.lit(v) for r in found for v in (r["range"], r["start"])]), F.col("_range"))
        position = (place + F.col("_place")) if found else F.lit(0)
        return self._of([r["range"] for r in found], position.between(offset, offset + limit - 1))

    def after(self, value: object, limit: int = BATCH_SIZE) -> DataFrame:
        """The ``limit`` keys that follow ``value``, which need not be a key itself."""
        behind = self.ranges().filter(F.col("last_key") > F.lit(value))
        # The first of these ranges may hold keys before the value, so those that follow it must give the page alone.
        reach = behind.agg(F.min_by(F.col("start") + F.col("rows"), "start")).first()[0]
        found = [] if reach is None else behind.filter(F.col("start") < reach + limit).select("range").collect()
        return self._of([r["range"] for r in found], F.col(self.key) > F.lit(value)).limit(limit)

    def _of(self, ranges: list[int], chosen: Column) -> DataFrame:
        """The chosen rows of some ranges in ascending order; only the folders of these are listed and read."""
        if not ranges:
            return self.spark.createDataFrame([], self.schema)
        stored = T.StructType([*self.schema.fields, T.StructField("_place", T.LongType()), T.StructField("_range", T.IntegerType())])
        reader = self.spark.read.schema(stored).option("basePath", f"{self.place}/keys")
        rows = reader.parquet(*[f"{self.place}/keys/_range={number}" for number in ranges])
        return rows.filter(chosen).select(*self.schema.names).orderBy(self.key)


def store_pages(keys: DataFrame, key: str, place: str | None = None) -> PageIndex:
    """Store keys in sorted ranges with their index, in ``place`` or a new scratch folder."""
    spark: SparkSession = keys.sparkSession
    place = place or scratch_path(spark, "pages")
    row_id = F.monotonically_increasing_id()
    ranged = keys.repartitionByRange(key).sortWithinPartitions(key).withColumn("_id", row_id)
    ranged.select(
        *keys.columns,
        F.col("_id").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)).alias("_place"),
        F.shiftright("_id", _ROW_BITS).cast("int").alias("_range"),
    ).write.partitionBy("_range").parquet(f"{place}/keys")
    stored = T.StructType([*keys.schema.fields, T.StructField("_place", T.LongType()), T.StructField("_range", T.IntegerType())])
    sizes = spark.read.schema(stored).parquet(f"{place}/keys").groupBy(F.col("_range").alias("range"))
    sizes = sizes.agg(F.min(key).alias("first_key"), F.max(key).alias("last_key"), F.count("*").alias("rows"))
    before = Window.partitionBy(F.lit(0)).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # a row per range
    starts = sizes.withColumn("start", F.coalesce(F.sum("rows").over(before), F.lit(0)))
    starts.coalesce(1).write.parquet(f"{place}/index")
    return PageIndex(spark, place, key, keys.schema)
