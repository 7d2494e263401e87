"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

#: Words of a text, as the queries define them.
_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP1 = rf"""
WITH measured AS (
  SELECT doc_id, source, CAST(len({_WORDS}) AS BIGINT) AS size,
    CAST('0x' || substr(md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 15) AS BIGINT) AS place
  FROM documents
), sized AS (
  SELECT source, CAST(sum(size) AS HUGEINT) AS source_size FROM measured GROUP BY source
), weighed AS (
  SELECT *, CAST([3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS HUGEINT) AS weight
  FROM sized
), ranked AS (
  SELECT *, row_number() OVER (ORDER BY 2.0 * source_size / weight, source NULLS LAST) AS place,
    sum(source_size) OVER () AS total
  FROM weighed
), stops AS (
  SELECT s.k, 3 * any_value(r.total) - 4 * coalesce(sum(r.source_size) FILTER (r.place <= s.k), 0) AS rest,
    sum(r.weight) FILTER (r.place > s.k) AS weights
  FROM range(0, (SELECT count(*) FROM ranked)) s(k), ranked r GROUP BY s.k
), level AS (
  SELECT s.* FROM stops s JOIN ranked r ON r.place = s.k + 1
  WHERE s.rest * r.weight <= 4 * r.source_size * s.weights ORDER BY s.k LIMIT 1
), targets AS (
  SELECT r.source, r.source_size, r.place <= l.k AS full,
    CASE WHEN r.place <= l.k THEN CAST(2 * r.source_size AS DOUBLE)
      ELSE CAST(r.weight * l.rest AS DOUBLE) / CAST(2 * l.weights AS DOUBLE) END AS target,
    CASE WHEN r.place <= l.k THEN 2 * r.source_size
      ELSE (2 * r.weight * l.rest + 2 * l.weights) // (4 * l.weights) END AS quota
  FROM ranked r, level l
), placed AS (
  SELECT m.doc_id, m.size, m.place, t.source_size, t.target,
    CASE WHEN t.source_size = 0 THEN 0 ELSE t.quota // t.source_size END AS copies,
    CASE WHEN t.source_size = 0 THEN 0 ELSE t.quota % t.source_size END AS rest,
    coalesce(sum(m.size) OVER (PARTITION BY m.source ORDER BY m.place
      RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS upto,
    sum(m.size) OVER (PARTITION BY m.source, m.place) AS tied,
    count(*) FILTER (m.size > 0) OVER (PARTITION BY m.source, m.place) AS ties
  FROM measured m JOIN targets t ON m.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, CAST(source_size AS BIGINT) AS source_size, target,
  CAST(copies * size + CASE WHEN upto <= rest THEN size
    WHEN upto - tied < rest THEN least(size, (rest - (upto - tied)) // ties) ELSE 0 END AS BIGINT) AS taken
FROM placed
"""

OP3 = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
  sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

OP11 = r"""
WITH drawn AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS digest
  FROM documents
), numbers AS (
  SELECT doc_id, text, length(text) AS n,
    [CAST('0x' || substr(digest, 8 * i + 1, 8) AS BIGINT) FOR i IN range(4)] AS h
  FROM drawn
), placed AS (
  SELECT *, least(h[1] % (n + 1), h[2] % (n + 1)) AS low, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS high,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h[3] % 100 >= 90
      THEN 'plain' WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM numbers
), parts AS (
  SELECT *, substr(text, 1, low) AS prefix, substr(text, low + 1, high - low) AS middle, substr(text, high + 1) AS suffix
  FROM placed
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN low END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN high - low END AS middle_chars,
  sha256(CASE form WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle ELSE text END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM parts
"""


def _codes_of(books: str) -> str:
    """Index and distance of the nearest entry for every part: the products of whole numbers are exact doubles."""
    return f"""(
  SELECT row, part, arg_min(entry, distance * 256 + entry) AS entry, min(distance) AS error FROM (
    SELECT p.row, p.part, b.entry, list_inner_product(p.v, p.v) - 2 * list_inner_product(p.v, b.v)
      + list_inner_product(b.v, b.v) AS distance
    FROM parts p JOIN {books} b ON b.part = p.part
  ) GROUP BY row, part)"""


def _op13(rounds: int = 4) -> str:
    steps = [
        """kept AS (
  SELECT vec_id, label, row_number() OVER (ORDER BY vec_id NULLS LAST) AS row,
    [CAST(floor(1024 * CAST(x AS DOUBLE)) AS DOUBLE) FOR x IN embedding] AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS (
  SELECT row, part, v[part * len(v) // 4 + 1 : (part + 1) * len(v) // 4] AS v FROM kept, range(4) r(part)
), books0 AS MATERIALIZED (
  SELECT part, row - 1 AS entry, v FROM parts WHERE row <= 256
)"""
    ]
    for number in range(rounds):
        steps.append(
            f"""codes{number} AS MATERIALIZED {_codes_of(f"books{number}")}, moved{number} AS (
  SELECT part, entry, list(mean ORDER BY place) AS v FROM (
    SELECT c.part, c.entry, place, floor(sum(p.v[place]) / count(*)) AS mean
    FROM codes{number} c JOIN parts p ON p.row = c.row AND p.part = c.part, range(1, len(p.v) + 1) r(place)
    GROUP BY c.part, c.entry, place
  ) GROUP BY part, entry
), books{number + 1} AS MATERIALIZED (
  SELECT b.part, b.entry, coalesce(m.v, b.v) AS v
  FROM books{number} b LEFT JOIN moved{number} m ON m.part = b.part AND m.entry = b.entry
)"""
        )
    return f"""
WITH {", ".join(steps)}, codes AS MATERIALIZED {_codes_of(f"books{rounds}")}, whole AS (
  SELECT row, string_agg(format('{{:02x}}', entry), '' ORDER BY part) AS code, CAST(sum(error) AS BIGINT) AS error
  FROM codes GROUP BY row
), listed AS (
  SELECT sha256(string_agg(array_to_string([CAST(x AS BIGINT) FOR x IN v], ','), ',' ORDER BY part, entry)) AS digest
  FROM books{rounds}
)
SELECT k.vec_id, w.code, w.error, CAST(sum(w.error) OVER (PARTITION BY k.label) AS BIGINT) AS label_error,
  l.digest AS codebooks_sha256
FROM kept k JOIN whole w ON w.row = k.row, listed l
"""


ORACLE: dict[str, str] = {
    "op1_source_mix": OP1,
    "op3_exact_dedup": OP3,
    "op11_fill_middle": OP11,
    "op13_vector_codes": _op13(),
}
