"""DuckDB SQL with the results the queries must have. Every text reads whole base tables."""

from __future__ import annotations

from checks.views import ALLOWED, CODES, FIRST_DAY_END, HOLIDAY_ROWS, LABELS, PAGE_SIZE
from shopmart.functions.text import PROMPT_HEAD, PROMPT_TAIL
from shopmart.schemas import EVENT_COLUMNS, HOLIDAYS, NULL_TOKENS, SALE_LABELS


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _texts(values) -> str:
    return ", ".join(_text(value) for value in values)


_HOLIDAYS = ",\n    ".join(
    f"({_text(name)}, DATE '{start}', DATE '{end}', DATE '{day}')" for name, start, end, day in HOLIDAY_ROWS
)
_EVENT = ", ".join(EVENT_COLUMNS)

# Views in order of use; a query takes the ones it names.
VIEWS = {
    "catalogue": """
  SELECT p_partkey AS product_id, CAST(p_size AS BIGINT) AS category_id, lower(p_type) AS top_category,
    lower(p_brand) AS maker,
    lower(p_type) || '.' || split_part(p_name, ' ', 2) || '.' || split_part(p_name, ' ', 1) AS category_code,
    split_part(p_name, ' ', 1) || '''s ' || lower(p_brand) AS brand
  FROM part""",
    "shop_events": """
  SELECT e.event_id, e.ts AS event_time, e.event_type, c.product_id, c.category_id,
    CASE WHEN e.event_id % 15 <> 0 THEN c.category_code END AS category_code,
    CASE WHEN e.event_id % 10 <> 0 THEN c.brand END AS brand,
    e.value AS price, e.user_id,
    e.user_id || '-' || CAST((day(e.ts) - 1) // 7 AS VARCHAR) AS user_session,
    CASE WHEN day(e.ts) <= 10 THEN '1' WHEN day(e.ts) <= 20 THEN '2' ELSE '3' END AS dataset_key
  FROM events e JOIN catalogue c ON c.product_id = e.user_id * 13 + e.event_id % 5""",
    "cleaned": """
  SELECT * FROM shop_events WHERE brand IS NOT NULL AND category_code IS NOT NULL""",
    "holidays": f"""
  SELECT * FROM (VALUES
    {_HOLIDAYS}) h(holiday, start_date, end_date, "date")""",
    "mapping_final": """
  SELECT DISTINCT brand, category_code FROM catalogue WHERE category_id >= 20
  UNION ALL
  SELECT DISTINCT brand, category_code FROM catalogue WHERE category_id >= 20 AND maker = 'brand#2'""",
    "final_table": """
  SELECT c.* EXCLUDE (event_id) FROM cleaned c JOIN mapping_final m
    ON m.brand = c.brand AND m.category_code = c.category_code""",
    "holiday_pairs": f"""
  SELECT h.holiday, f.event_time, f.event_type, f.product_id, f.user_id, f.user_session
  FROM final_table f, holidays h
  WHERE h.holiday IN ({_texts(HOLIDAYS)}) AND f.event_type IN ('click', 'purchase')
    AND f.event_time >= h.start_date AND f.event_time <= h.end_date""",
    "converted": """
  SELECT user_id, user_session, product_id,
    min(event_time) FILTER (event_type = 'click') AS added_to_cart_time,
    max(event_time) FILTER (event_type = 'purchase') AS purchased_time
  FROM holiday_pairs GROUP BY ALL
  HAVING count(*) = 2 AND added_to_cart_time < purchased_time""",
    "brands": """
  SELECT DISTINCT brand FROM cleaned""",
    "batches": f"""
  SELECT brand, CAST((row_number() OVER (ORDER BY brand) - 1) // {PAGE_SIZE} AS BIGINT) AS batch_id FROM brands""",
    "brand_lists": """
  SELECT batch_id, string_agg('''' || replace(brand, '''', '''''') || '''', ',' || chr(10) || ' ' ORDER BY brand)
    AS brand_list
  FROM batches GROUP BY batch_id""",
    "digest_codes": f"""
  SELECT brand, list_value({_texts(CODES)})[CAST('0x' || substr(md5(brand), 1, 4) AS INT) % {len(CODES)} + 1]
    AS category_index
  FROM brands""",
    "mapping": """
  WITH known AS (SELECT DISTINCT brand, top_category FROM catalogue WHERE category_id >= 40)
  SELECT d.brand, coalesce(k.top_category, d.category_index) AS category_index
  FROM digest_codes d LEFT JOIN known k ON k.brand = d.brand""",
    "days": """
  SELECT CAST(event_time AS DATE) AS "day", count(*) AS purchases FROM final_table
  WHERE event_type = 'purchase' AND event_time >= TIMESTAMP '2024-01-15' AND event_time < TIMESTAMP '2024-01-30'
  GROUP BY 1""",
}

# The final table of the stored warehouse: events whose brand is mapped to their top category.
BUILT_FINAL_TABLE = """
  SELECT c.* EXCLUDE (event_id) FROM cleaned c JOIN mapping m
    ON m.brand = c.brand AND m.category_index = split_part(c.category_code, '.', 1)"""

_USES = {
    "shop_events": ["catalogue"],
    "cleaned": ["shop_events"],
    "mapping_final": ["catalogue"],
    "final_table": ["cleaned", "mapping_final"],
    "holiday_pairs": ["final_table", "holidays"],
    "converted": ["holiday_pairs"],
    "brands": ["cleaned"],
    "batches": ["brands"],
    "brand_lists": ["batches"],
    "digest_codes": ["brands"],
    "mapping": ["digest_codes", "catalogue"],
    "days": ["final_table"],
}


def _query(select: str, *uses: str, built: bool = False) -> str:
    """The select with the views it needs; ``built`` takes the stored warehouse's final table."""
    texts, links = dict(VIEWS), dict(_USES)
    if built:
        texts["final_table"], links["final_table"] = BUILT_FINAL_TABLE, ["cleaned", "mapping"]
    ordered: list[str] = []

    def add(name: str) -> None:
        if name not in ordered:
            for used in links.get(name, []):
                add(used)
            ordered.append(name)

    for name in uses:
        add(name)
    views = ",\n".join(f"{name} AS ({texts[name]}\n)" for name in ordered)
    return f"WITH {views}\n{select}"


def _merge_metrics(key: str) -> str:
    held = f"SELECT DISTINCT {key} FROM cleaned WHERE event_time < TIMESTAMP '{FIRST_DAY_END}'"
    return f"""
SELECT '{key}' AS key_name,
  (SELECT count(DISTINCT {key}) FROM cleaned) AS source_count,
  (SELECT count(*) FROM ({held})) AS target_before,
  (SELECT count(DISTINCT {key}) FROM cleaned WHERE {key} NOT IN ({held})) AS inserted,
  (SELECT count(*) FROM ({held})) +
    (SELECT count(DISTINCT {key}) FROM cleaned WHERE {key} NOT IN ({held})) AS target_after"""


def _new_keys(key: str) -> str:
    return f"""
SELECT DISTINCT {key} FROM cleaned
WHERE {key} NOT IN (SELECT {key} FROM cleaned WHERE event_time < TIMESTAMP '{FIRST_DAY_END}')"""


def _column_type(position: int, name: str) -> str:
    """The type a column must get, from a cast of all its cells."""
    return f"""
SELECT {position} AS position, '{name}' AS column_name,
  CASE WHEN count(*) FILTER (cell IS NOT NULL AND TRY_CAST(cell AS DOUBLE) IS NULL) > 0 THEN 'TEXT'
       WHEN count(cell) = count(*) AND bool_and(regexp_full_match(cell, '[+-]?[0-9]+')) THEN 'BIGINT'
       ELSE 'FLOAT' END AS column_type
FROM (SELECT CAST({name} AS VARCHAR) AS cell FROM shop_events)"""


_STORED_EVENTS = f"SELECT {_EVENT}, dataset_key FROM "
_HALF_UP = "(({0}) * 2 * {2} + ({1})) // (2 * ({1}))"

_HOLIDAY_CONVERSION = """
SELECT CAST({on_holiday} AS DOUBLE) / 1000000000000 AS holiday_conversion,
  CAST({otherwise} AS DOUBLE) / 1000000000000 AS overall_conversion
FROM (SELECT
  CAST((SELECT count(*) FROM converted) AS HUGEINT) AS hp,
  CAST((SELECT count(*) FROM holiday_pairs WHERE event_type = 'click') AS HUGEINT) AS hc,
  CAST((SELECT count(*) FROM final_table WHERE event_type = 'purchase') AS HUGEINT) AS ap,
  CAST((SELECT count(*) FROM final_table WHERE event_type = 'click') AS HUGEINT) AS ac)""".format(
    on_holiday=_HALF_UP.format("hp", "hc", 10**12), otherwise=_HALF_UP.format("ap - hp", "ac - hc", 10**12)
)

_CATEGORY_CONVERSION = f"""
SELECT top_category, add_to_cart_count, purchase_count,
  CAST({_HALF_UP.format("purchase_count", "add_to_cart_count", 10**4)} AS DOUBLE) / 10000 AS conversion_rate,
  CASE WHEN top_category = 'small' OR top_category = 'promo' THEN '{LABELS[0]}' ELSE '{LABELS[1]}' END AS category
FROM (
  SELECT string_split(category_code, '.')[1] AS top_category,
    CAST(sum(CASE event_type WHEN 'click' THEN 1 ELSE 0 END) AS BIGINT) AS add_to_cart_count,
    CAST(sum(CASE event_type WHEN 'purchase' THEN 1 ELSE 0 END) AS BIGINT) AS purchase_count
  FROM final_table GROUP BY 1)
WHERE top_category <> 'economy' AND add_to_cart_count > 0"""

_BLACK_FRIDAY = f"""
SELECT d.purchases, d."day",
  CASE WHEN d."day" >= DATE '2024-01-19' AND d."day" < DATE '2024-01-29' THEN '{SALE_LABELS[0]}'
       WHEN d."day" = DATE '2024-01-29' THEN '{SALE_LABELS[1]}' ELSE '{SALE_LABELS[2]}' END AS saleday
FROM days d LEFT JOIN holidays h ON h."date" = d."day\""""

_PROMPT = (
    "SELECT batch_id, "
    + _text(PROMPT_HEAD.replace("{codes}", ", ".join(CODES)))
    + " || brand_list || "
    + _text(PROMPT_TAIL)
    + " AS prompt FROM brand_lists"
)

_EXPANDED = """
SELECT DISTINCT c.brand, c.category_code FROM cleaned c JOIN mapping m
  ON m.brand = c.brand AND m.category_index = split_part(c.category_code, '.', 1)"""

_HOLIDAY_COLUMNS = "holiday, event_time, event_type, product_id, user_id, user_session"

ORACLE: dict[str, str] = {
    "dataset_registry": _query(
        """
SELECT dataset_key AS "key", 'landing/part-' || dataset_key || '.csv.gz' AS dataset_url,
  CASE WHEN dataset_key <> '3' THEN 'events_' || dataset_key END AS table_name,
  'brands_' || dataset_key AS brands_table_name, 'categories_' || dataset_key AS categories_table_name,
  dataset_key <> '3' AS is_valid
FROM (SELECT DISTINCT dataset_key FROM shop_events)""",
        "shop_events",
    ),
    "load_events": _query(_STORED_EVENTS + "shop_events", "shop_events"),
    "load_metrics": _query(
        """
SELECT dataset_key, count(*) AS rows_read, count(*) - count(brand) AS deleted_null_brand,
  count(brand) - count(CASE WHEN brand IS NOT NULL THEN category_code END) AS deleted_null_category
FROM shop_events GROUP BY dataset_key""",
        "shop_events",
    ),
    "built_many_datasets": _query(
        """
SELECT CAST(day(event_time) AS VARCHAR) AS dataset_key, count(*) AS rows_read,
  count(*) - count(brand) AS deleted_null_brand,
  count(brand) - count(CASE WHEN brand IS NOT NULL THEN category_code END) AS deleted_null_category,
  count(DISTINCT CASE WHEN category_code IS NOT NULL THEN brand END) AS dataset_brands,
  count(DISTINCT CASE WHEN brand IS NOT NULL THEN category_code END) AS dataset_categories
FROM shop_events GROUP BY ALL""",
        "shop_events",
    ),
    "reload_empty": _query(_STORED_EVENTS + "cleaned WHERE dataset_key <> '2'", "cleaned"),
    "incremental_load": _query(_STORED_EVENTS + "shop_events", "shop_events"),
    "null_tokens": _query(
        f"""
SELECT event_id, CASE WHEN cell IN ({_texts(NULL_TOKENS)}) THEN NULL ELSE cell END AS brand
FROM (SELECT event_id, coalesce(
    CASE WHEN event_id % 23 < 19 THEN list_value({_texts(NULL_TOKENS)})[event_id % 23 + 1] END, brand) AS cell
  FROM shop_events)""",
        "shop_events",
    ),
    "infer_types": _query(
        "\nUNION ALL\n".join(_column_type(position, name) for position, name in enumerate(EVENT_COLUMNS)),
        "shop_events",
    ),
    "clean_events": _query("SELECT * FROM cleaned", "cleaned"),
    "clean_counts": _query(
        """
SELECT (SELECT count(*) FROM shop_events WHERE brand IS NULL) AS deleted_null_brand,
  (SELECT count(*) FROM shop_events WHERE brand IS NOT NULL AND category_code IS NULL) AS deleted_null_category""",
        "shop_events",
    ),
    "distinct_brands": _query("SELECT DISTINCT brand FROM shop_events WHERE brand IS NOT NULL", "shop_events"),
    "brands_saved_if_absent": _query("SELECT DISTINCT brand FROM shop_events WHERE brand IS NOT NULL", "shop_events"),
    "brands_saved_once": _query("SELECT DISTINCT brand FROM shop_events WHERE brand IS NOT NULL", "shop_events"),
    "distinct_categories": _query(
        "SELECT DISTINCT category_code FROM shop_events WHERE brand IS NOT NULL", "shop_events"
    ),
    "new_brands": _query(_new_keys("brand"), "cleaned"),
    "new_categories": _query(_new_keys("category_code"), "cleaned"),
    "merge_unique_brands": _query("SELECT DISTINCT brand FROM cleaned", "cleaned"),
    "merge_unique_categories": _query("SELECT DISTINCT category_code FROM cleaned", "cleaned"),
    "merge_metrics": _query(_merge_metrics("brand") + "\nUNION ALL" + _merge_metrics("category_code"), "cleaned"),
    "brand_page": _query(f"SELECT brand FROM brands ORDER BY brand LIMIT {PAGE_SIZE} OFFSET {PAGE_SIZE}", "brands"),
    "brand_pages_sought": _query(
        "SELECT b.brand, p.page, s.sought_by FROM batches AS b"
        " JOIN (SELECT unnest([0, max(batch_id) // 2, max(batch_id)]) AS page FROM batches) AS p ON b.batch_id = p.page"
        " CROSS JOIN (VALUES ('number'), ('key')) AS s(sought_by)",
        "batches",
    ),
    "brand_batches": _query("SELECT brand, batch_id FROM batches", "batches"),
    "quoted_brands": _query("SELECT batch_id, brand_list FROM brand_lists", "brand_lists"),
    "batch_prompt": _query(_PROMPT, "brand_lists"),
    "ask_model": _query("SELECT brand, category_index FROM digest_codes", "digest_codes"),
    "extract_sql_block": """
SELECT conv_id, turn,
  CASE role WHEN 'assistant' THEN 'VALUES ''' || replace(text, '''', '''''') || '''' ELSE '' END AS sql_text,
  role <> 'user' AS parse_ok
FROM conversations""",
    "parse_mapping_reply": _query("SELECT brand, category_index FROM mapping", "mapping"),
    "utf8_repair": "SELECT doc_id, chr(65533) || text || chr(65533) AS text FROM documents",
    "classify_brands": _query("SELECT brand, category_index FROM mapping", "mapping"),
    "valid_mapping": _query(
        f"SELECT brand, category_index FROM mapping WHERE category_index IN ({_texts(ALLOWED)})", "mapping"
    ),
    "mapping_counts": _query(
        """
SELECT (SELECT count(*) FROM mapping WHERE category_index <> 'economy') AS accepted,
  (SELECT count(*) FROM mapping WHERE category_index = 'economy') AS rejected""",
        "mapping",
    ),
    "expand_mapping": _query(
        _EXPANDED + f" WHERE m.category_index IN ({_texts(ALLOWED)})",
        "cleaned",
        "mapping",
    ),
    "insert_cleaned": _query(_STORED_EVENTS + "final_table", "final_table"),
    "insert_cleaned_semi": _query(
        _STORED_EVENTS
        + "cleaned c WHERE EXISTS (FROM mapping_final m WHERE m.brand = c.brand AND m.category_code = c.category_code)",
        "cleaned",
        "mapping_final",
    ),
    "insert_cleaned_stored": _query(_STORED_EVENTS + "final_table", "final_table"),
    "holiday_events": _query(f"SELECT {_HOLIDAY_COLUMNS} FROM holiday_pairs", "holiday_pairs"),
    "holiday_events_binned": _query(f"SELECT {_HOLIDAY_COLUMNS} FROM holiday_pairs", "holiday_pairs"),
    "holiday_events_whole_days": _query(
        f"""
SELECT {_HOLIDAY_COLUMNS} FROM final_table f, holidays h
WHERE h.holiday IN ({_texts(HOLIDAYS)}) AND f.event_type IN ('click', 'purchase')
  AND CAST(f.event_time AS DATE) BETWEEN h.start_date AND h.end_date""",
        "final_table",
        "holidays",
    ),
    "event_totals": _query(
        """
SELECT (SELECT count(*) FROM final_table WHERE event_type = 'purchase') AS overall_purchases,
  (SELECT count(*) FROM final_table WHERE event_type = 'click') AS overall_carts""",
        "final_table",
    ),
    "cart_then_purchase": _query("SELECT * FROM converted", "converted"),
    "holiday_conversion": _query(_HOLIDAY_CONVERSION, "converted"),
    "category_conversion": _query(_CATEGORY_CONVERSION, "final_table"),
    "daily_purchases": _query('SELECT "day", purchases FROM days', "days"),
    "black_friday_sales": _query(_BLACK_FRIDAY, "days", "holidays"),
    "built_unique_brands": _query("SELECT brand FROM brands", "brands"),
    "built_unique_categories": _query("SELECT DISTINCT category_code FROM cleaned", "cleaned"),
    "built_mapping": _query("SELECT brand, category_index FROM mapping", "mapping"),
    "built_final_mapping": _query(_EXPANDED, "cleaned", "mapping"),
    "built_model_mapping": _query(
        """
SELECT brand, CASE WHEN substr(md5(brand), 1, 1) > '3' THEN category_index ELSE 'no such code' END AS category_index,
  substr(md5(brand), 1, 1) > '3' AS allowed
FROM digest_codes""",
        "digest_codes",
    ),
    "incremental_insert": _query(_STORED_EVENTS + "final_table", "final_table", built=True),
    "streamed_final_table": _query(_STORED_EVENTS + "final_table", "final_table", built=True),
    "built_final_table": _query(_STORED_EVENTS + "final_table", "final_table", built=True),
    "built_holiday_conversion": _query(_HOLIDAY_CONVERSION, "converted", built=True),
    "built_category_conversion": _query(_CATEGORY_CONVERSION, "final_table", built=True),
    "built_black_friday_sales": _query(_BLACK_FRIDAY, "days", "holidays", built=True),
}
