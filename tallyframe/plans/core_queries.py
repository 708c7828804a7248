"""Queries on the core operators for received data (nested records, deliveries, lines) with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.operators import delivery, nested, rowcheck
from tallyframe.session import table


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return nested.line_item_keys(table(spark, d, "fd"), table(spark, d, "ptr"))


def p4_line_items(spark: SparkSession, d: str) -> DataFrame:
    return nested.line_items(table(spark, d, "fd"), table(spark, d, "ptr"))


def p4_nodes(spark: SparkSession, d: str) -> DataFrame:
    """How many items each schedule holds, by the intervals of the node tables alone."""
    nodes = nested.report_nodes(table(spark, d, "fd"), table(spark, d, "ptr"), ("schedule", "item"))
    of = lambda kind, *names: nodes.where(F.col("kind") == kind).select("doc", *(F.col(n).alias(f"{kind}_{n}") for n in names))
    inside = (F.col("schedule_pre") < F.col("item_pre")) & (F.col("schedule_post") > F.col("item_post"))
    held = of("schedule", "body_id", "label", "pre", "post").join(of("item", "pre", "post"), "doc").where(inside)
    return held.groupBy(F.col("schedule_body_id").alias("body_id"), F.col("schedule_label").alias("schedule")).agg(F.count("*").alias("items"))


def p4_amounts(spark: SparkSession, d: str) -> DataFrame:
    return nested.line_amounts(table(spark, d, "fd"), table(spark, d, "ptr"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return delivery.surplus_deliveries(table(spark, d, "independent_expenditure_2024"))


def p6_delivered_once(spark: SparkSession, d: str) -> DataFrame:
    return delivery.deliver_once(table(spark, d, "independent_expenditure_2024"))


FIRST_BATCHES = 30


def p6_batches(spark: SparkSession, d: str) -> DataFrame:
    """Surplus deliveries where the first batches were decided before the others, which take up what was seen."""
    ie = table(spark, d, "independent_expenditure_2024")
    first, later = ie.where(F.col("batch_no") <= FIRST_BATCHES), ie.where(~F.coalesce(F.col("batch_no") <= FIRST_BATCHES, F.lit(False)))
    surplus, seen = delivery.split_deliveries(first)
    return surplus.unionByName(delivery.surplus_deliveries(later, seen))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return rowcheck.rejected(table(spark, d, "raw_lines"))


def p7_ie_rows(spark: SparkSession, d: str) -> DataFrame:
    return rowcheck.sound_rows(table(spark, d, "raw_lines"), "ie_csv")


def p7_fd_rows(spark: SparkSession, d: str) -> DataFrame:
    return rowcheck.sound_rows(table(spark, d, "raw_lines"), "fd_index")


QUERIES = {f.__name__: f for f in (p4_found, p4_line_items, p4_nodes, p4_amounts, p6_found, p6_delivered_once, p6_batches, p7_found, p7_ie_rows, p7_fd_rows)}

_P6_KEYED = r"""
WITH canon AS (
  SELECT *, upper(regexp_replace(coalesce(tran_id, ''), '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g')) AS ident_,
    upper(regexp_replace(coalesce(amndt_ind, ''), '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g')) AS version_,
    coalesce(CAST(try_cast(trim(file_num) AS DECIMAL(38,6)) AS VARCHAR), upper(trim(coalesce(file_num, '')))) AS serial_
  FROM independent_expenditure_2024),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY serial_, version_, ident_ ORDER BY received_at NULLS LAST, delivery_no) AS rank_ FROM canon)
"""

# Each line item of both kinds of report as JSON, in document order.
_ITEMS = r"""
WITH text AS (SELECT body_id, ltrim(body, chr(65279)) AS t FROM fd),
once AS (SELECT body_id, CASE WHEN json_valid(t) THEN CAST(t AS JSON) END AS j FROM text),
read AS (SELECT body_id, CASE WHEN json_type(j) = 'VARCHAR' AND json_valid(j ->> '$') THEN CAST(j ->> '$' AS JSON) WHEN json_type(j) = 'OBJECT' THEN j END AS j FROM once),
page AS (
  SELECT body_id, 0 AS page, json_extract(j, '$.schedules') AS s FROM read WHERE j IS NOT NULL
  UNION ALL
  SELECT body_id, i, json_extract(j, '$.pages[' || (i - 1) || '].schedules') FROM (SELECT *, unnest(generate_series(1, CAST(json_array_length(json_extract(j, '$.pages')) AS BIGINT))) AS i FROM read WHERE json_type(json_extract(j, '$.pages')) = 'ARRAY')),
letter AS (SELECT body_id, page, s, unnest(json_keys(s)) AS k, generate_subscripts(json_keys(s), 1) AS place FROM page WHERE json_type(s) = 'OBJECT'),
value AS (SELECT body_id, page, place, upper(k) AS schedule, json_extract(s, '$."' || k || '"') AS v FROM letter WHERE length(k) = 1),
list AS (SELECT body_id, page, place, schedule, CASE
    WHEN json_type(v) = 'ARRAY' THEN CAST(v AS JSON[])
    WHEN json_type(v) = 'OBJECT' AND json_exists(v, '$.items') THEN CASE WHEN json_type(json_extract(v, '$.items')) = 'ARRAY' THEN CAST(json_extract(v, '$.items') AS JSON[]) END
    WHEN json_type(v) = 'OBJECT' THEN [v] END AS items FROM value
  UNION ALL SELECT body_id, 0, 0, 'PTR', list_transform(transactions, lambda t: to_json(t)) FROM ptr),
each AS (SELECT body_id, page, place, schedule, i, items[i] AS x FROM (SELECT *, unnest(generate_series(1, len(items))) AS i FROM list) WHERE coalesce(json_type(items[i]), 'NULL') <> 'NULL'),
item AS (SELECT body_id, schedule, CAST(row_number() OVER (PARTITION BY body_id, schedule ORDER BY page, place, i) AS INTEGER) AS item_no, x FROM each)"""

_CELLS = r"""
WITH line AS (SELECT line_no, file_name, feed, coalesce(line_text, '') AS t FROM raw_lines),
cut AS (SELECT line_no, file_name, feed, CASE
    WHEN feed = 'fd_index' THEN string_split(t, chr(9))
    WHEN regexp_full_match(t, '(?s:("([^"]|"")*"|[^",]*)(,("([^"]|"")*"|[^",]*))*)')
      THEN list_transform(regexp_extract_all(',' || t, '(?s:,("(?:[^"]|"")*"|[^",]*))', 1),
        lambda c: CASE WHEN starts_with(c, '"') THEN replace(c[2:-2], '""', '"') ELSE c END) END AS c FROM line)"""

ORACLE = {
    "p4_line_items": _ITEMS
    + r"""
SELECT body_id, schedule, item_no, coalesce(x ->> '$.asset', x ->> '$.source', x ->> '$.creditor', x ->> '$.organization') AS name, x ->> '$.owner' AS owner, coalesce(x ->> '$.asset_type', x ->> '$.liability_type') AS item_type,
  CASE WHEN json_type(x, '$.income_type') = 'ARRAY' THEN array_to_string(CAST(json_extract(x, '$.income_type') AS VARCHAR[]), '; ') ELSE x ->> '$.income_type' END AS income_type, coalesce(x ->> '$.transaction_type', x ->> '$.position') AS role, coalesce(x ->> '$.transaction_date', x ->> '$.date_incurred', x ->> '$.date_raw') AS date_text,
  CASE WHEN json_type(x) = 'OBJECT' THEN coalesce(x ->> '$.raw_text', x ->> '$.description') ELSE x ->> '$' END AS raw_text FROM item""",
    "p4_nodes": _ITEMS + " SELECT body_id, schedule, count(*) AS items FROM item GROUP BY ALL",
    "p4_amounts": _ITEMS
    + r""",
amount AS (SELECT body_id, schedule, item_no, f AS field, json_extract(x, '$.' || f) AS v FROM item, (VALUES ('value_of_asset'), ('income_amount'), ('income_preceding'), ('amount_range'), ('amount'), ('amount_preceding')) AS names(f) WHERE json_type(x) = 'OBJECT'),
shown AS (SELECT *, json_type(v) AS kind, v ->> '$' AS t FROM amount WHERE coalesce(json_type(v), 'NULL') <> 'NULL'),
cell AS (SELECT *, CASE WHEN kind = 'OBJECT' THEN v ->> '$.low' WHEN kind = 'VARCHAR' THEN regexp_extract(t, '^\s*\$?\s*([0-9][0-9,]*)\s*-\s*\$?\s*([0-9][0-9,]*)\s*$', 1) END AS l,
  CASE WHEN kind = 'OBJECT' THEN v ->> '$.high' WHEN kind = 'VARCHAR' THEN regexp_extract(t, '^\s*\$?\s*([0-9][0-9,]*)\s*-\s*\$?\s*([0-9][0-9,]*)\s*$', 2) END AS h,
  CASE WHEN kind = 'OBJECT' THEN v ->> '$.exact' WHEN kind <> 'BOOLEAN' THEN t END AS e FROM shown)
SELECT body_id, schedule, item_no, field, CAST(try_cast(regexp_replace(l, '[$, ]', '', 'g') AS DOUBLE) AS BIGINT) AS low, CAST(try_cast(regexp_replace(h, '[$, ]', '', 'g') AS DOUBLE) AS BIGINT) AS high,
  CASE WHEN coalesce(l, '') = '' OR kind = 'OBJECT' THEN try_cast(regexp_replace(e, '[$, ]', '', 'g') AS DOUBLE) END AS exact, CASE WHEN kind = 'OBJECT' THEN v ->> '$.label' ELSE t END AS text FROM cell""",
    "p7_ie_rows": _CELLS
    + r"""
SELECT line_no, file_name, c[1] AS cand_id, c[2] AS cand_name, c[3] AS spe_id, c[4] AS spe_nam, c[5] AS ele_type, c[6] AS can_office_state, CAST(c[7] AS INTEGER) AS can_office_dis, c[8] AS can_office, c[9] AS cand_pty_aff,
  CAST(c[10] AS DECIMAL(18,2)) AS exp_amo, CAST(try_strptime(c[11], '%d-%b-%y') AS DATE) AS exp_date, CAST(c[12] AS DECIMAL(18,2)) AS agg_amo, c[13] AS sup_opp, c[14] AS pur, c[15] AS pay, c[16] AS file_num, c[17] AS amndt_ind,
  c[18] AS tran_id, c[19] AS image_num, CAST(try_strptime(c[20], '%d-%b-%y') AS DATE) AS receipt_dat, CAST(c[21] AS INTEGER) AS fec_election_yr, c[22] AS prev_file_num, CAST(try_strptime(c[23], '%d-%b-%y') AS DATE) AS dissem_dt
FROM cut WHERE feed = 'ie_csv' AND len(c) = 23
  AND regexp_full_match(c[1], '\s*|[HSP][A-Za-z0-9]{8}') AND c[8] IN ('H', 'S', 'P') AND regexp_full_match(c[7], '[0-9]{2}') AND regexp_full_match(c[10], '-?[0-9]+(\.[0-9]{1,2})?') AND regexp_full_match(c[12], '-?[0-9]+(\.[0-9]{1,2})?')
  AND trim(c[13]) IN ('', 'S', 'O') AND regexp_full_match(c[16], '[0-9]+') AND regexp_full_match(c[17], 'N|A[0-9]?') AND regexp_full_match(c[18], '[A-Za-z0-9-]+') AND regexp_full_match(c[21], '[0-9]{4}')
  AND len(list_filter([c[11], c[20], c[23]], lambda x: trim(x) <> '' AND NOT (regexp_full_match(x, '[0-9]{2}-[A-Z]{3}-[0-9]{2}') AND try_strptime(x, '%d-%b-%y') IS NOT NULL))) = 0""",
    "p7_fd_rows": _CELLS
    + r"""
SELECT line_no, file_name, c[1] AS prefix, c[2] AS last, c[3] AS first, c[4] AS suffix, c[5] AS filing_type, c[6] AS state_dst, CAST(c[7] AS INTEGER) AS year, CAST(try_strptime(c[8], '%m/%d/%Y') AS DATE) AS filing_date, c[9] AS doc_id
FROM cut WHERE feed = 'fd_index' AND len(c) = 9 AND regexp_full_match(c[5], '[A-Z]') AND regexp_full_match(c[6], '\s*|[A-Z]{2}[0-9]{2}') AND regexp_full_match(c[7], '[0-9]{4}') AND regexp_full_match(c[9], '[0-9]+')
  AND (trim(c[8]) = '' OR (regexp_full_match(c[8], '[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}') AND try_strptime(c[8], '%m/%d/%Y') IS NOT NULL))""",
    "p4_found": """
WITH text AS (SELECT body_id, ltrim(body, chr(65279)) AS t FROM fd),
once AS (SELECT body_id, CASE WHEN json_valid(t) THEN CAST(t AS JSON) END AS j FROM text),
read AS (SELECT body_id, CASE WHEN json_type(j) = 'VARCHAR' AND json_valid(j ->> '$') THEN CAST(j ->> '$' AS JSON) WHEN json_type(j) = 'OBJECT' THEN j END AS j FROM once),
page AS (
  SELECT body_id, 0 AS page, json_extract(j, '$.schedules') AS s FROM read WHERE j IS NOT NULL
  UNION ALL
  SELECT body_id, 1, json_extract(p, '$.schedules') FROM (SELECT body_id, unnest(CAST(json_extract(j, '$.pages') AS JSON[])) AS p FROM read WHERE json_type(json_extract(j, '$.pages')) = 'ARRAY')),
letter AS (SELECT body_id, s, unnest(json_keys(s)) AS k FROM page WHERE json_type(s) = 'OBJECT'),
value AS (SELECT body_id, upper(k) AS schedule, json_extract(s, '$."' || k || '"') AS v FROM letter WHERE length(k) = 1),
list AS (SELECT body_id, schedule, CASE
    WHEN json_type(v) = 'ARRAY' THEN CAST(v AS JSON[])
    WHEN json_type(v) = 'OBJECT' AND json_exists(v, '$.items') THEN CASE WHEN json_type(json_extract(v, '$.items')) = 'ARRAY' THEN CAST(json_extract(v, '$.items') AS JSON[]) END
    WHEN json_type(v) = 'OBJECT' THEN [v] END AS items FROM value),
counted AS (SELECT body_id, schedule, CAST(sum(len(list_filter(items, lambda x: coalesce(json_type(x), 'NULL') <> 'NULL'))) AS BIGINT) AS n FROM list GROUP BY 1, 2
  UNION ALL SELECT body_id, 'PTR', CAST(len(list_filter(transactions, lambda x: x IS NOT NULL)) AS BIGINT) FROM ptr)
SELECT body_id, schedule, CAST(unnest(generate_series(1, n)) AS INTEGER) AS item_no FROM counted WHERE n > 0
""",
    "p6_found": _P6_KEYED + "SELECT delivery_no FROM ranked WHERE ident_ <> '' AND rank_ > 1",
    "p6_delivered_once": _P6_KEYED + "SELECT * EXCLUDE (ident_, version_, serial_, rank_) FROM ranked WHERE ident_ = '' OR rank_ = 1",
    "p6_batches": _P6_KEYED.replace("ORDER BY received_at", "ORDER BY batch_no IS NULL OR batch_no > 30, received_at") + "SELECT delivery_no FROM ranked WHERE ident_ <> '' AND rank_ > 1",
    "p7_found": r"""
WITH line AS (SELECT line_no, feed, coalesce(line_text, '') AS t FROM raw_lines),
cut AS (SELECT line_no, feed, CASE
    WHEN feed = 'fd_index' THEN string_split(t, chr(9))
    WHEN regexp_full_match(t, '(?s:("([^"]|"")*"|[^",]*)(,("([^"]|"")*"|[^",]*))*)')
      THEN list_transform(regexp_extract_all(',' || t, '(?s:,("(?:[^"]|"")*"|[^",]*))', 1),
        lambda c: CASE WHEN starts_with(c, '"') THEN replace(c[2:-2], '""', '"') ELSE c END) END AS c FROM line),
judged AS (SELECT line_no, CASE
  WHEN c IS NULL THEN 'quoting'
  WHEN len(c) <> CASE feed WHEN 'ie_csv' THEN 23 ELSE 9 END THEN 'column_count'
  WHEN feed = 'ie_csv' AND NOT (
    regexp_full_match(c[1], '\s*|[HSP][A-Za-z0-9]{8}') AND regexp_full_match(c[8], '[HSP]') AND regexp_full_match(c[7], '[0-9]{2}')
    AND regexp_full_match(c[10], '-?[0-9]+(\.[0-9]{1,2})?') AND regexp_full_match(c[12], '-?[0-9]+(\.[0-9]{1,2})?')
    AND regexp_full_match(c[13], '[SO]|\s*') AND regexp_full_match(c[16], '[0-9]+') AND regexp_full_match(c[17], 'N|A[0-9]?')
    AND regexp_full_match(c[18], '[A-Za-z0-9-]+') AND regexp_full_match(c[21], '[0-9]{4}')
    AND (trim(c[11]) = '' OR (regexp_full_match(c[11], '[0-9]{2}-[A-Z]{3}-[0-9]{2}') AND try_strptime(c[11], '%d-%b-%y') IS NOT NULL))
    AND (trim(c[20]) = '' OR (regexp_full_match(c[20], '[0-9]{2}-[A-Z]{3}-[0-9]{2}') AND try_strptime(c[20], '%d-%b-%y') IS NOT NULL))
    AND (trim(c[23]) = '' OR (regexp_full_match(c[23], '[0-9]{2}-[A-Z]{3}-[0-9]{2}') AND try_strptime(c[23], '%d-%b-%y') IS NOT NULL)))
    THEN 'bad_value'
  WHEN feed = 'fd_index' AND NOT (
    regexp_full_match(c[5], '[A-Z]') AND regexp_full_match(c[6], '\s*|[A-Z]{2}[0-9]{2}') AND regexp_full_match(c[7], '[0-9]{4}')
    AND regexp_full_match(c[9], '[0-9]+')
    AND (trim(c[8]) = '' OR (regexp_full_match(c[8], '[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}') AND try_strptime(c[8], '%m/%d/%Y') IS NOT NULL)))
    THEN 'bad_value' END AS reason FROM cut)
SELECT line_no, reason FROM judged WHERE reason IS NOT NULL
""",
}
