"""Event files: CSV and gzip CSV with a header."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from decimal import Decimal
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.readwriter import DataFrameReader
from pyspark.sql.streaming.readwriter import DataStreamReader

from shopmart.functions.text import null_token
from shopmart.schemas import EVENT_SCHEMA, EVENT_TIME_FORMAT, NULL_TOKENS, RAW_EVENT_SCHEMA


def _column(name: str) -> str:
    """A header name as one identifier, whatever characters it has."""
    return "`" + name.replace("`", "``") + "`"


def _csv_options(reader, multi_line: bool):
    """Quotes are escaped by doubling; a file whose header or row width differs is an error."""
    return (
        reader.option("header", True)
        .option("enforceSchema", False)
        .option("quote", '"')
        .option("escape", '"')
        .option("mode", "FAILFAST")
        .option("multiLine", multi_line)
    )


def event_reader(
    reader: DataFrameReader | DataStreamReader, partitions: T.StructType | None = None, multi_line: bool = False
):
    """CSV reader for event files with every cell kept as text.

    Spark picks the codec by suffix, so plain and ``.gz`` files go through the same call.
    ``multi_line`` admits line breaks inside quoted cells; plain files then cannot be split,
    which is why it is off unless asked for. Without it such a cell stops the load.
    """
    schema = T.StructType(RAW_EVENT_SCHEMA.fields + (partitions.fields if partitions else []))
    return _csv_options(reader, multi_line).schema(schema)


def read_raw_events(spark: SparkSession, path: str | Sequence[str], multi_line: bool = False) -> DataFrame:
    paths = path if isinstance(path, str) else list(path)
    return event_reader(spark.read, multi_line=multi_line).csv(paths)


def read_raw(spark: SparkSession, path: str | Sequence[str], multi_line: bool = False) -> DataFrame:
    """Any CSV with a header: the columns it names, every cell as text."""
    paths = path if isinstance(path, str) else list(path)
    return _csv_options(spark.read, multi_line).csv(paths)


# Endings of files that one task must read as a whole.
UNSPLITTABLE = (".gz", ".gzip", ".zst", ".deflate", ".lz4", ".snappy")


NO_HOST = "^([a-zA-Z][a-zA-Z0-9+.-]*:)//(?=/)"


def spread(frame: DataFrame, *keys: str, multi_line: bool = False) -> DataFrame:
    """Even out a scan of files that cannot be split.

    Such a file is read by one task however large it is; with ``multi_line`` plain files are read so, too. The
    rebalance hint lets adaptive execution cut the output into partitions of the advisory size, and ``keys``
    keep rows of one key together as far as that size allows. Plain files are not shuffled; a frame that does not tell its
    files, as a streamed batch, is.
    """
    files = frame.inputFiles()
    splittable = files and not multi_line and not any(name.lower().endswith(UNSPLITTABLE) for name in files)
    return frame if splittable else frame.hint("rebalance", *keys)


def read_dataset_events(spark: SparkSession, urls: Mapping[str, str], multi_line: bool = False) -> DataFrame:
    """Raw events of several datasets (key -> file, folder or pattern) with ``dataset_key``, out of one scan.

    The files are listed once per dataset, and each row gets its dataset by the path of its file, so that the plan is the
    same for any number of datasets. A file that belongs to two datasets gives its rows to both.
    """
    # The two listings write a path without a host with three slashes and with one.
    files = {
        key: [re.sub(NO_HOST, r"\1", name) for name in read_raw_events(spark, url, multi_line).inputFiles()]
        for key, url in urls.items()
    }
    paths = list(dict.fromkeys(urls.values()))
    listed = {url: files[key] for key, url in urls.items()}
    every = [name for names in listed.values() for name in names]
    if len(set(every)) < len(every):  # patterns that overlap would read a file twice
        paths = sorted(map(unquote, set(every)))
    owners = spark.createDataFrame(
        [(name, key) for key, names in files.items() for name in names], "_file string, dataset_key string"
    )
    place = F.regexp_replace(F.col("_metadata.file_path"), NO_HOST, "$1")
    raw = read_raw_events(spark, paths, multi_line).withColumn("_file", place)
    # The listing is on the driver already: a row per file.
    return raw.join(F.broadcast(owners), "_file").drop("_file")


def typed_events(
    raw: DataFrame,
    schema: T.StructType = EVENT_SCHEMA,
    tokens: Sequence[str] = NULL_TOKENS,
    time_format: str = EVENT_TIME_FORMAT,
) -> DataFrame:
    """Raw cells as event columns: missing-value tokens become null, then cells are cast.

    A cell that does not fit its type stops the load, by ANSI mode or else by the check behind
    the cast. Columns outside the schema, such as partition columns, pass through.
    """

    def cell(field: T.StructField) -> Column:
        value = null_token(F.col(_column(field.name)), tokens)
        if isinstance(field.dataType, T.TimestampNTZType):
            typed = F.to_timestamp_ntz(value, F.lit(time_format))
        else:
            typed = value.cast(field.dataType)
        misfit = F.concat(F.lit(f"{field.name} cannot hold "), value)
        refused = F.when(value.isNotNull(), F.raise_error(misfit).cast(field.dataType))
        return F.coalesce(typed, refused).alias(field.name)

    rest = [F.col(_column(name)) for name in raw.columns if name not in schema.fieldNames()]
    return raw.select(*map(cell, schema.fields), *rest)


def read_events(spark: SparkSession, path: str | Sequence[str], multi_line: bool = False) -> DataFrame:
    """Typed events of one or more files."""
    return typed_events(spread(read_raw_events(spark, path, multi_line), multi_line=multi_line))


# Number formats that count as numeric when types are inferred.
INTEGER_CELL = r"^\s*[+-]?[0-9]+\s*$"
REAL_CELL = r"(?i)^\s*[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:e[+-]?[0-9]+)?\s*$"
INFINITE_CELL = "(?i)^[+-]?inf(?:inity)?$"

# What a column was seen to hold, as bits.
MISSING, SIGNED, NEGATIVE, WIDE, REAL, OTHER = 1, 2, 4, 8, 16, 32


def _cell_kind(name: str, tokens: Sequence[str]) -> Column:
    """Bits of one cell. WIDE is an integer outside the signed 64-bit range."""
    cell = F.col(_column(name))
    number = F.trim(cell).try_cast("decimal(38,0)")
    sign = F.when(cell.contains("-"), NEGATIVE).otherwise(0)
    integer = (
        F.when(F.length(cell) <= 18, sign + SIGNED)
        .when(number.between(Decimal(-(2**63)), Decimal(2**63 - 1)), sign + SIGNED)
        .when(number.between(Decimal(-(10**20)), Decimal(2**64 - 1)), sign + WIDE)
        .otherwise(OTHER)
    )
    finite = F.abs(cell.try_cast("double")) < float("inf")
    return (
        F.when(cell.isNull() | cell.isin(list(tokens)), MISSING)
        .when(cell.rlike(INTEGER_CELL), integer)
        .when(cell.rlike(REAL_CELL) & finite | cell.rlike(INFINITE_CELL), REAL)
        .otherwise(OTHER)
    )


def infer_types(raw: DataFrame, tokens: Sequence[str] = NULL_TOKENS) -> DataFrame:
    """Column types (BIGINT, FLOAT, TEXT) that hold every cell of a text frame.

    One pass over the whole input with one bit set per column and task. An integer column
    with a missing cell, and a column of missing cells only, is FLOAT; a column with any
    cell that is no number is TEXT.
    """
    seen = raw.agg(*[F.bit_or(_cell_kind(name, tokens)).alias(name) for name in raw.columns])
    named = [
        F.struct(F.lit(position).alias("position"), F.lit(name).alias("column_name"), F.col(_column(name)).alias("seen"))
        for position, name in enumerate(raw.columns)
    ]
    rows = seen.select(F.inline(F.array(*named)))

    def has(bits: int) -> Column:
        return F.col("seen").bitwiseAND(F.lit(bits)) != 0

    column_type = (
        F.when(F.col("seen").isNull() | has(OTHER), "TEXT")
        .when(has(REAL), "FLOAT")
        .when(has(WIDE) & has(MISSING | NEGATIVE), "TEXT")
        .when(has(MISSING), "FLOAT")
        .otherwise("BIGINT")
    )
    return rows.select("position", "column_name", column_type.alias("column_type"))


# Spark types of the inferred ones.
SPARK_TYPES = {"BIGINT": T.LongType(), "FLOAT": T.DoubleType(), "TEXT": T.StringType()}


def inferred_schema(raw: DataFrame, tokens: Sequence[str] = NULL_TOKENS) -> T.StructType:
    """Inferred types as a schema for ``typed_events``; one row per column is fetched."""
    found = infer_types(raw, tokens).orderBy("position").collect()
    return T.StructType([T.StructField(row.column_name, SPARK_TYPES[row.column_type]) for row in found])


def read_inferred(spark: SparkSession, path: str | Sequence[str], multi_line: bool = False) -> DataFrame:
    """Typed rows of CSV files without a declared schema, from a pass for the types and one for the rows."""
    raw = read_raw(spark, path, multi_line)
    return typed_events(spread(raw, multi_line=multi_line), inferred_schema(raw))
