"""Table schemas and default parameters."""

from __future__ import annotations

from pyspark.sql import types as T

# event_time carries no zone: the files print UTC wall-clock time, and TIMESTAMP_NTZ keeps
# it whatever the session time zone is.
EVENT_SCHEMA = T.StructType(
    [
        T.StructField("event_time", T.TimestampNTZType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("product_id", T.LongType()),
        T.StructField("category_id", T.LongType()),
        T.StructField("category_code", T.StringType()),
        T.StructField("brand", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("user_session", T.StringType()),
    ]
)
EVENT_COLUMNS = EVENT_SCHEMA.fieldNames()

RAW_EVENT_SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in EVENT_COLUMNS])

MAPPING_SCHEMA = "brand string, category_index string"
FINAL_MAPPING_SCHEMA = "brand string, category_code string"
HOLIDAY_SCHEMA = "holiday string, start_date date, end_date date, date date"

DATASET_SCHEMA = T.StructType(
    [
        T.StructField("dataset_url", T.StringType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("brands_table_name", T.StringType()),
        T.StructField("categories_table_name", T.StringType()),
    ]
)
REGISTRY_TYPE = T.MapType(T.StringType(), DATASET_SCHEMA)

# Holidays that count for the conversion mart.
HOLIDAYS = (
    "New Year",
    "Black Friday",
    "Valentines Day",
    "International Womens Day",
    "Defender of the Fatherland Day",
)

# The autumn sale.
SALE_WINDOW = ("2019-11-10", "2019-12-03")
SALE_DAYS = ("2019-11-22", "2019-12-02")
LAST_SALE_DAY = "2019-12-03"
SALE_LABELS = ("Black Friday", "Last sale day", "no sale")

# Category conversion mart.
EXCLUDED_CATEGORIES = ("electronics",)
NARROW_CATEGORIES = ("auto", "computers", "medicine", "construction")
NARROW_LABEL = "Узконаправленные товары"
BROAD_LABEL = "Широконаправленные"

# Category codes a brand can be mapped to, and brands per batch.
CATEGORY_CODES = (
    "apparel",
    "accessories",
    "appliances",
    "auto",
    "computers",
    "construction",
    "country_yard",
    "electronics",
    "furniture",
    "kids",
    "medicine",
    "sport",
    "stationery",
)
BATCH_SIZE = 25

# CSV cells read as null, the pandas default set.
NULL_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

# Fixed value: how event files print time; the fraction is optional.
EVENT_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss[.SSSSSS] 'UTC'"

# Stored event tables carry the registry key of their dataset as a partition column.
STORED_EVENT_SCHEMA = T.StructType([*EVENT_SCHEMA.fields, T.StructField("dataset_key", T.StringType())])
