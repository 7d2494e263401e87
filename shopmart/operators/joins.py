"""Join of a large event table with a dimension whose size is checked."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from shopmart.session import scratch_path

# A dimension whose values take at most this many bytes is sent to every executor.
BROADCAST_BYTES = 64 * 1024 * 1024

# This many of the most frequent keys are dealt over so many parts when the dimension is larger.
HOT_KEYS = 1_000
SALTS = 32


def row_bytes(frame: DataFrame) -> Column:
    """Bytes of one row: text by its length, other columns eight each, and the row itself."""

    def width(field: T.StructField) -> Column:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            return F.coalesce(F.octet_length(field.name), F.lit(0))
        return F.lit(8)

    return reduce(lambda left, right: left + right, map(width, frame.schema.fields), F.lit(16)).cast("long")


def value_bytes(frame: DataFrame) -> int:
    """Bytes of all rows."""
    return frame.agg(F.sum(row_bytes(frame))).first()[0] or 0


def hot_keys(facts: DataFrame, keys: list[str], count: int = HOT_KEYS) -> DataFrame:
    """The most frequent keys, stored so that every use sees the same choice.

    Frequencies are combined on the map side, so a key that fills a third of the table
    reaches the shuffle as one row per task.
    """
    path = scratch_path(facts.sparkSession, "hot-keys")
    (
        facts.dropna("any", subset=keys)
        .groupBy(*keys)
        .agg(F.count("*").alias("_rows"))
        .orderBy(F.desc("_rows"), *keys)
        .limit(count)
        .select(*keys)
        .write.parquet(path)
    )
    return facts.sparkSession.read.parquet(path)


def dimension_join(
    facts: DataFrame,
    dimension: DataFrame,
    keys: list[str],
    how: str = "inner",
    *,
    dimension_bytes: int | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Inner or left semi join that does not depend on how the keys are spread.

    Up to ``broadcast_bytes`` the dimension is broadcast and the facts are not shuffled; its
    size is measured first unless the caller knows it. With a larger dimension both sides are shuffled once, on the
    key and a salt: a fact with one of the most frequent keys gets one of ``SALTS`` salts by a hash of its
    columns, so that a repeated task salts it alike, and a dimension row with such a key is repeated for each. All
    others have salt 0, and none of their keys holds more than one in ``HOT_KEYS`` rows. The facts are
    read once for the frequent keys, of the key columns only, and once for the join.
    """
    if how not in ("inner", "left_semi"):
        raise ValueError(f"unsupported join {how!r}")
    if (value_bytes(dimension) if dimension_bytes is None else dimension_bytes) <= broadcast_bytes:
        return facts.join(F.broadcast(dimension), keys, how)
    hot = F.broadcast(hot_keys(facts, keys).withColumn("_hot", F.lit(True)))  # at most HOT_KEYS rows
    one_salt = F.pmod(F.xxhash64(*[F.col(f"`{name}`") for name in facts.columns]), F.lit(SALTS)).cast("int")
    salted = facts.join(hot, keys, "left").withColumn("_salt", F.when(F.col("_hot"), one_salt).otherwise(0)).drop("_hot")
    every_salt = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    if how == "left_semi":
        dimension = dimension.select(*keys).distinct()
    repeated = dimension.join(hot, keys, "left").withColumn("_salt", F.explode(every_salt)).drop("_hot")
    return salted.join(repeated, [*keys, "_salt"], how).drop("_salt")
