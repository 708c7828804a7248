"""Queries on filings, their bodies and their filers, with the SQL that each is held against."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.functions import values
from tallyframe.functions.text import name_key
from tallyframe.operators import directory, identity, lines, nested, quality, residuals, reshape, review
from tallyframe.operators.predicates import FilingFilter, HoldingFilter, TradeFilter
from tallyframe.plans import answers
from tallyframe.plans.core_queries import ORACLE as CORE
from tallyframe.session import table

_SINCE, _UNTIL = date(2019, 1, 1), date(2022, 12, 31)


def filings_filter(spark: SparkSession, d: str) -> DataFrame:
    want = FilingFilter(member="ee", state="ca", filing_type="fd", since=_SINCE, until=_UNTIL)
    return answers.filings(table(spark, d, "filings"), want).rows.select("row_no", "doc_id", "coverage_year", "filer_id", "filing_date", values.last_first(F.col("filer")).alias("filer_name"))


def type_family(spark: SparkSession, d: str) -> DataFrame:
    f = table(spark, d, "filings")
    code = F.col("filing_type.code")
    return f.groupBy(values.family(code).alias("family"), code.alias("code"), values.filing_label(code).alias("label")).agg(F.count("*").alias("n"))


def point_lookup(spark: SparkSession, d: str) -> DataFrame:
    f = table(spark, d, "filings").select("doc_id", "coverage_year", "row_no", "filer_id", "pdf_class")
    return f.where("doc_id = '10000306'").orderBy("coverage_year", "row_no").limit(1)


def filing_detail(spark: SparkSession, d: str) -> DataFrame:
    out = reshape.detail(table(spark, d, "filings"), table(spark, d, "ptr"), table(spark, d, "fd"), "10000306")
    return out.select("doc_id", "row_no", F.coalesce(F.size("transactions"), F.lit(-1)).alias("n_transactions"), F.length("body").alias("body_chars"))


def _flat(spark: SparkSession, d: str, want: TradeFilter = TradeFilter()) -> DataFrame:
    return reshape.trades(reshape.current_filings(table(spark, d, "filings")), table(spark, d, "ptr"), want)


def trades(spark: SparkSession, d: str) -> DataFrame:
    want = TradeFilter(asset="corp", transaction_type="s", since=date(2016, 1, 1), min_amount=1001)
    t = F.col("transaction")
    return _flat(spark, d, want).select("doc_id", "coverage_year", "item", "filer_id", t["ticker"].alias("ticker"), F.substring(t["asset"], 1, 48).alias("asset"), values.amount_floor(t["amount_range"]).alias("least"))


def trades_by_ticker(spark: SparkSession, d: str) -> DataFrame:
    """Roll-up of all trades by ticker."""
    t = F.col("transaction")
    rows = _flat(spark, d).where(t["ticker"].isNotNull())
    return rows.groupBy(t["ticker"].alias("ticker")).agg(F.count("*").alias("n_trades"), F.count_distinct("filer_id").alias("n_filers"), F.sum(values.cents(values.amount_floor(t["amount_range"]))).alias("least_total"))


def null_ticker_blindspot(spark: SparkSession, d: str) -> DataFrame:
    return residuals.ticker_blind_spot(_flat(spark, d), since=date(2018, 1, 1))


def bucket_low(spark: SparkSession, d: str) -> DataFrame:
    t = F.col("transaction")
    again = values.amount_of(t["amount_range"]["label"])
    rows = _flat(spark, d).where(values.amount_floor(t["amount_range"]) >= 15001)
    return rows.select("doc_id", "coverage_year", "item", again["low"].alias("low"), again["high"].alias("high"), again["exact"].alias("exact"), F.when(again["exact"].isNull(), reshape.sparse_json(t["amount_range"])).alias("stored"))


def holdings(spark: SparkSession, d: str) -> DataFrame:
    want = HoldingFilter(asset="bond", owner="jt")
    rows = answers.holdings(reshape.current_filings(table(spark, d, "filings")), reshape.schedule_a(table(spark, d, "fd"), want), want).rows
    return rows.select("doc_id", "coverage_year", "item", "filer_id", F.col("holding.asset").alias("asset"), F.col("holding.asset_type").alias("asset_type"))


def year_summary(spark: SparkSession, d: str) -> DataFrame:
    return answers.summary(table(spark, d, "filings"), table(spark, d, "unparsed_manifest")).rows


def type_counts(spark: SparkSession, d: str) -> DataFrame:
    return residuals.type_counts(table(spark, d, "filings"), ["coverage_year"])


def residual_counts(spark: SparkSession, d: str) -> DataFrame:
    return residuals.efiled_counts(table(spark, d, "filings"))


def unparsed_reasons(spark: SparkSession, d: str) -> DataFrame:
    from tallyframe import types as kinds
    from tallyframe.operators.money import reason_counts

    return reason_counts(table(spark, d, "unparsed_manifest"), kinds.FILING_REASONS)


def identity_ladder(spark: SparkSession, d: str) -> DataFrame:
    """Seats to legislators, and the identifier that follows from it."""
    m = identity.match_seats(table(spark, d, "filings"), table(spark, d, "legislators_current"))
    return m.select("row_no", "seat_bioguide", "ambiguous", identity.filer_id(F.col("seat_bioguide"), F.col("state_district.state"), F.col("filer")).alias("built_id"))


def _reasoned(spark: SparkSession, d: str) -> DataFrame:
    leg = table(spark, d, "legislators_current")
    m = identity.match_seats(table(spark, d, "filings").where("bioguide_id IS NULL"), leg)
    return identity.unmatched_reason(m, leg)


def identity_warnings(spark: SparkSession, d: str) -> DataFrame:
    w = identity.identity_warnings(_reasoned(spark, d))
    return w.select("filer_id", "reason", F.concat_ws("|", "raw_names").alias("raw_names"), "documents", F.concat_ws(",", F.col("districts").cast("array<string>")).alias("districts"))


def warning_documents(spark: SparkSession, d: str) -> DataFrame:
    return identity.warning_documents(_reasoned(spark, d))


def identity_report(spark: SparkSession, d: str) -> DataFrame:
    reasoned = _reasoned(spark, d)
    return identity.report(identity.identity_warnings(reasoned), reasoned, table(spark, d, "legislators_current"))


def match_summary(spark: SparkSession, d: str) -> DataFrame:
    return identity.match_summary(table(spark, d, "filings"), identity.identity_warnings(_reasoned(spark, d)))


def seat_holders(spark: SparkSession, d: str) -> DataFrame:
    h = identity.seat_holders(table(spark, d, "legislators_current"))
    return h.select("state", "district", F.concat_ws(",", F.transform("holders", lambda x: x["bioguide"])).alias("holders"))


def name_keys(spark: SparkSession, d: str) -> DataFrame:
    f = table(spark, d, "filings")
    return f.select("row_no", name_key(F.col("state_district.state"), F.col("filer.last"), F.col("filer.first"), F.col("filer.suffix")).alias("name_key"))


def seat_parse(spark: SparkSession, d: str) -> DataFrame:
    s = values.state_district(F.col("state_district.raw"))
    return table(spark, d, "filings").select("row_no", s["state"].alias("state"), s["district"].alias("district"))


def stratified_sample(spark: SparkSession, d: str) -> DataFrame:
    rows = reshape.current_filings(table(spark, d, "filings")).where("trim(doc_id) <> ''")
    return review.select(rows, 0.02, "0").select("doc_id", "coverage_year", F.col("stratum.pdf_class").alias("pdf_class"), F.col("stratum.family").alias("family"))


def _labels(filings: DataFrame) -> DataFrame:
    """Verdicts made up from the filings themselves (there is no table of verdicts): a fixed share of documents is
    labelled, some for another snapshot."""
    digit = F.conv(F.substring(F.sha2("doc_id", 256), 1, 2), 16, 10).cast("int")
    n_wrong, n_missing = F.pmod(digit, F.lit(3)), F.pmod(digit, F.lit(5))
    return filings.where(digit < 200).select(
        "doc_id", (n_wrong == 0).alias("is_fully_precise"), (n_missing == 0).alias("is_fully_recalled"), n_wrong.alias("n_incorrect_entries"), n_missing.alias("n_missing_entries"),
        (digit % 2 == 0).alias("is_metadata_accurate"), (digit % 7 != 0).alias("is_metadata_fully_complete"), F.when(digit % 11 == 0, "old").otherwise(F.sha2(F.concat_ws("|", "doc_id", "filer_id"), 256)).alias("snapshot"),
    )


def _labelled(spark: SparkSession, d: str) -> DataFrame:
    rows = reshape.current_filings(table(spark, d, "filings")).where("trim(doc_id) <> ''")
    one = rows.groupBy("doc_id").agg(F.max("row_no").alias("row_no"))  # the entry loaded last of each document
    chosen = review.select(rows.drop("snapshot").join(one.select("row_no"), "row_no", "left_semi"), 1.0)
    return review.with_labels(chosen, _labels(chosen), F.sha2(F.concat_ws("|", "doc_id", "filer_id"), 256))


def scorecard(spark: SparkSession, d: str) -> DataFrame:
    return review.scorecard(_labelled(spark, d))


def snapshot_stale(spark: SparkSession, d: str) -> DataFrame:
    return _labelled(spark, d).where("stale").select("doc_id", "current_snapshot")


def reference_search(spark: SparkSession, d: str) -> DataFrame:
    return directory.search(table(spark, d, "legislators_current"), "ALDE")


def member_links(spark: SparkSession, d: str) -> DataFrame:
    links, without = identity.member_links(table(spark, d, "legislators_current"))
    return links.select("bioguide_id", "candidate_id", F.lit(None).cast("string").alias("reason")).unionByName(without)


def ticker_extract(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "ptr").select("body_id", F.posexplode("transactions").alias("item", "t")).where("t IS NOT NULL")
    return t.select("body_id", "item", values.ticker(F.col("t.asset")).alias("ticker"), values.type_code(values.type_tag(F.col("t.asset"))).alias("asset_type"), values.transaction_kind(F.col("t.transaction_type")).alias("kind"))


def calendar_fold(spark: SparkSession, d: str) -> DataFrame:
    years = table(spark, d, "filings").select(F.col("coverage_year").alias("year")).distinct()
    return years.select("year", values.cycle_of(F.col("year")).alias("cycle"), values.congress_of(F.col("year")).alias("congress"))


def invariants(spark: SparkSession, d: str) -> DataFrame:
    """Violations among trades of which some were damaged: codes and symbols in lower case, both a date and its raw text,
    bounds the wrong way round."""
    t = F.col("transaction")
    owner = t["owner"]
    worse = t.withField("asset_type", F.when(owner == "SP", F.lower(t["asset_type"])).otherwise(t["asset_type"])).withField("ticker", F.when(owner == "JT", F.lower(t["ticker"])).otherwise(t["ticker"]))
    worse = worse.withField("date_raw", F.when(owner == "DC", F.lit("02/30/2020")).otherwise(t["date_raw"])).withField("amount_range", F.when(owner == "DC", t["amount_range"].withField("low", t["amount_range"]["high"] + 1)).otherwise(t["amount_range"]))
    return quality.counts(quality.ptr_violations(_flat(spark, d).withColumn("transaction", worse)))


def schedule_invariants(spark: SparkSession, d: str) -> DataFrame:
    """Amounts of annual reports that are neither a range nor exact, by schedule and field."""
    amounts = nested.line_amounts(table(spark, d, "fd"), table(spark, d, "ptr"))
    return quality.amount_violations(amounts).groupBy("schedule", "field").agg(F.count("*").alias("n"))


def review_residual(spark: SparkSession, d: str) -> DataFrame:
    """What the scorecard of a sample is silent on."""
    filings = reshape.current_filings(table(spark, d, "filings")).where("trim(doc_id) <> ''")
    return review.review_residual(filings, review.select(filings, 0.5).dropDuplicates(["doc_id"]), _labels(filings).dropDuplicates(["doc_id"]))


def classify_text(spark: SparkSession, d: str) -> DataFrame:
    return lines.text_class(table(spark, d, "documents"))


def line_items(spark: SparkSession, d: str) -> DataFrame:
    """Lines of each part of annual report pages: headings filled forward, counted by part."""
    pages = table(spark, d, "documents").where("source = 'clerk_fd_page'")
    heading = F.upper(values.part(F.col("line"), r"(?i)^part ([a-z]):"))
    split = lines.segments(lines.split_lines(pages), heading)
    none = F.lower(F.col("line")).startswith("nothing to report")
    return split.where("segment IS NOT NULL AND heading IS NULL").groupBy("doc_id", "segment").agg(F.count("*").alias("n_lines"), F.bool_or(none).alias("none_disclosed"))


def set_ops(spark: SparkSession, d: str) -> DataFrame:
    """Documents listed as unparsed: those that have a filing, and those that have none."""
    listed = table(spark, d, "unparsed_manifest").select("doc_id").where("trim(coalesce(doc_id, '')) <> ''").distinct()
    filed = table(spark, d, "filings").select("doc_id").where("trim(coalesce(doc_id, '')) <> ''").distinct()
    both = listed.join(filed, "doc_id", "left_semi").withColumn("side", F.lit("filed"))
    return both.unionByName(listed.join(filed, "doc_id", "left_anti").withColumn("side", F.lit("missing")))


QUERIES = {
    f.__name__: f
    for f in (
        filings_filter, type_family, point_lookup, filing_detail, trades, trades_by_ticker, null_ticker_blindspot, bucket_low, holdings, year_summary, type_counts,
        residual_counts, unparsed_reasons, identity_ladder, identity_warnings, warning_documents, identity_report, match_summary, seat_holders, name_keys, seat_parse, stratified_sample, scorecard,
        snapshot_stale, reference_search, member_links, ticker_extract, calendar_fold, invariants, schedule_invariants, review_residual, classify_text, line_items, set_ops,
    )
}

CURRENT = """cur AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY coverage_year, doc_id ORDER BY load_no DESC NULLS LAST, row_no DESC) AS k_ FROM filings) WHERE k_ = 1 OR trim(coalesce(doc_id, '')) = '')"""
_FLAT = f"""{CURRENT},
body AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY coverage_year, doc_id ORDER BY body_id DESC) AS k_ FROM ptr) WHERE k_ = 1),
flat AS (SELECT doc_id, coverage_year, filer_id, i - 1 AS item, transactions[i] AS t
  FROM (SELECT f.doc_id, f.coverage_year, f.filer_id, b.transactions, unnest(generate_series(1, len(b.transactions))) AS i
        FROM cur f JOIN body b ON f.coverage_year = b.coverage_year AND f.doc_id = b.doc_id WHERE f.filing_type.code = 'P') WHERE transactions[i] IS NOT NULL)"""
_COUNTS = """count(*) AS total, count(*) FILTER (pdf_class = 'efiled') AS efiled, count(*) FILTER (pdf_class = 'scanned') AS scanned,
  count(*) FILTER (pdf_class = 'missing') AS missing, count(*) FILTER (coalesce(pdf_class, '') NOT IN ('efiled', 'scanned', 'missing')) AS not_classified,
  count(*) FILTER (coalesce(parse_status, 'ok') = 'ok') AS ok, count(*) FILTER (coalesce(parse_status, 'ok') <> 'ok') AS error"""
_SLUG = r"lower(regexp_replace(trim(regexp_replace(strip_accents(coalesce({0}, '')), '[^\w\s]', ' ', 'g')), '\s+', '-', 'g'))"
KEY = (
    "concat_ws('.', lower(coalesce(nullif(state_district.state, ''), 'unk')), "
    + _SLUG.format("filer.last")
    + ", "
    + _SLUG.format("regexp_extract(trim(coalesce(filer.first, '')), '^\\S+')")
    + ", nullif("
    + _SLUG.format("filer.suffix")
    + ", ''))"
)
SEATS = """seat AS (SELECT DISTINCT bioguide, last, upper(t.state) AS state, t.district AS district FROM
  (SELECT id.bioguide AS bioguide, name.last AS last, unnest(terms) AS t FROM legislators_current) WHERE t.type = 'rep' AND t.state IS NOT NULL AND t.district IS NOT NULL),
idx AS (SELECT lower(trim(strip_accents(last))) AS lk, state, district, count(DISTINCT bioguide) AS n, CASE WHEN count(DISTINCT bioguide) = 1 THEN min(bioguide) END AS b FROM seat GROUP BY ALL),
matched AS (SELECT f.*, CASE WHEN coalesce(f.filing_type.code, '') <> 'C' THEN i.b END AS seat_bioguide, coalesce(i.n > 1, false) AS ambiguous
  FROM filings f LEFT JOIN idx i ON lower(trim(strip_accents(f.filer.last))) = i.lk AND upper(f.state_district.state) = i.state AND f.state_district.district = i.district)"""
_REASONED = (
    SEATS
    + """,
held AS (SELECT DISTINCT state, district FROM seat),
reasoned AS (SELECT m.*, CASE WHEN m.filing_type.code = 'C' THEN 'candidate' WHEN m.state_district.state IS NULL OR m.state_district.district IS NULL THEN 'no_district'
  WHEN m.ambiguous THEN 'ambiguous_seat' WHEN h.state IS NOT NULL THEN 'suspicious' ELSE 'unknown_seat' END AS reason,
  concat_ws(' ', nullif(m.filer.first, ''), nullif(m.filer.last, ''), nullif(m.filer.suffix, '')) AS raw_name
  FROM matched m LEFT JOIN held h ON upper(m.state_district.state) = h.state AND m.state_district.district = h.district WHERE m.bioguide_id IS NULL),
rank(reason, r) AS (VALUES ('suspicious', 1), ('ambiguous_seat', 2), ('unknown_seat', 3), ('candidate', 4), ('no_district', 5)),
warn AS (SELECT filer_id, arg_min(reason, r) AS reason, count(*) AS documents,
  coalesce(array_to_string(list_sort(list_distinct(list(state_district.district) FILTER (state_district.district IS NOT NULL))), ','), '') AS districts FROM reasoned JOIN rank USING (reason) GROUP BY 1),
nm AS (SELECT filer_id, string_agg(raw_name, '|' ORDER BY seen) AS raw_names FROM (SELECT filer_id, raw_name, min(row_no) AS seen FROM reasoned GROUP BY 1, 2) GROUP BY 1)"""
)
_SAMPLE = """one AS (SELECT * FROM cur WHERE trim(coalesce(doc_id, '')) <> '' AND parse_status = 'ok')"""
_LABELLED = f"""{CURRENT},
chosen AS (SELECT doc_id, filer_id, coalesce(nullif(pdf_class, ''), 'unknown') AS pdf_class, CASE WHEN filing_type.code = 'P' THEN 'ptr' ELSE 'other' END AS family
  FROM (SELECT * FROM cur WHERE trim(coalesce(doc_id, '')) <> '' QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY row_no DESC) = 1) WHERE parse_status = 'ok'),
digit AS (SELECT *, ('0x' || substr(sha256(doc_id), 1, 2))::INTEGER AS g FROM chosen),
lab AS (SELECT *, CASE WHEN g < 200 THEN CASE WHEN g % 11 = 0 THEN 'old' ELSE sha256(concat_ws('|', doc_id, filer_id)) END END AS snapshot, sha256(concat_ws('|', doc_id, filer_id)) AS cur_snap FROM digit),
fresh AS (SELECT *, snapshot IS NOT NULL AND snapshot <> cur_snap AS stale, snapshot IS NOT NULL AND snapshot = cur_snap AS fresh FROM lab)"""
_LABELS_SCORE = """count(*) FILTER (snapshot IS NOT NULL) AS n_reviewed, count(*) FILTER (stale) AS n_stale,
  count(*) FILTER (fresh AND g % 3 = 0) / nullif(count(*) FILTER (fresh), 0) AS precise_rate, count(*) FILTER (fresh AND g % 5 = 0) / nullif(count(*) FILTER (fresh), 0) AS recalled_rate,
  count(*) FILTER (fresh AND g % 2 = 0) / nullif(count(*) FILTER (fresh), 0) AS metadata_accurate_rate, count(*) FILTER (fresh AND g % 7 <> 0) / nullif(count(*) FILTER (fresh), 0) AS metadata_complete_rate,
  CAST(coalesce(sum(g % 3) FILTER (fresh), 0) AS BIGINT) AS incorrect_entries, CAST(coalesce(sum(g % 5) FILTER (fresh), 0) AS BIGINT) AS missing_entries"""

ORACLE = {
    "filings_filter": """SELECT row_no, doc_id, coverage_year, filer_id, filing_date, concat_ws(', ', nullif(trim(filer.last), ''), nullif(trim(filer.first), '')) AS filer_name FROM filings
WHERE (contains(lower(filer_id), 'ee') OR contains(lower(coalesce(filer.prefix, '')), 'ee') OR contains(lower(coalesce(filer.first, '')), 'ee') OR contains(lower(coalesce(filer.last, '')), 'ee') OR contains(lower(coalesce(filer.suffix, '')), 'ee'))
AND upper(state_district.state) = 'CA' AND coalesce(filing_type.code, '') <> 'P' AND filing_date BETWEEN DATE '2019-01-01' AND DATE '2022-12-31'""",
    "type_family": """SELECT CASE WHEN filing_type.code = 'P' THEN 'ptr' ELSE 'fd' END AS family, filing_type.code AS code,
CASE filing_type.code WHEN 'C' THEN 'candidate_report' WHEN 'X' THEN 'extension' WHEN 'P' THEN 'periodic_transaction_report' WHEN 'O' THEN 'annual_report' WHEN 'A' THEN 'amendment' WHEN 'D' THEN 'unknown_d'
WHEN 'W' THEN 'withdrawal' WHEN 'H' THEN 'unknown_h' WHEN 'T' THEN 'termination' WHEN 'B' THEN 'unknown_b' WHEN 'G' THEN 'unknown_g' WHEN 'E' THEN 'unknown_e' ELSE 'unknown' END AS label, count(*) AS n FROM filings GROUP BY ALL""",
    "point_lookup": "SELECT doc_id, coverage_year, row_no, filer_id, pdf_class FROM filings WHERE doc_id = '10000306' ORDER BY coverage_year, row_no LIMIT 1",
    "filing_detail": """WITH one AS (SELECT * FROM filings WHERE doc_id = '10000306' ORDER BY coverage_year, row_no LIMIT 1)
SELECT o.doc_id, o.row_no, coalesce(len(arg_max(p.transactions, p.body_id)), -1) AS n_transactions, CAST(length(arg_max(b.body, b.body_id)) AS INTEGER) AS body_chars
FROM one o LEFT JOIN ptr p ON o.doc_id = p.doc_id AND o.coverage_year = p.coverage_year LEFT JOIN fd b ON o.doc_id = b.doc_id AND o.coverage_year = b.coverage_year GROUP BY 1, 2""",
    "trades": f"""WITH {_FLAT} SELECT doc_id, coverage_year, item, filer_id, t.ticker AS ticker, substr(t.asset, 1, 48) AS asset, coalesce(t.amount_range.exact, CAST(t.amount_range.low AS DOUBLE)) AS least FROM flat
WHERE contains(lower(t.asset), 'corp') AND starts_with(upper(t.transaction_type), 'S') AND t.transaction_date >= DATE '2016-01-01' AND coalesce(t.amount_range.exact, CAST(t.amount_range.low AS DOUBLE)) >= 1001""",
    "trades_by_ticker": f"""WITH {_FLAT} SELECT t.ticker AS ticker, count(*) AS n_trades, count(DISTINCT filer_id) AS n_filers, sum(CAST(coalesce(t.amount_range.exact, CAST(t.amount_range.low AS DOUBLE)) AS DECIMAL(18,2))) AS least_total
FROM flat WHERE t.ticker IS NOT NULL GROUP BY 1""",
    "null_ticker_blindspot": f"""WITH {_FLAT} SELECT count(*) FILTER (t.asset_type IN ('ST', 'OP') AND coalesce(t.ticker, '') = '') AS without_ticker, count(*) AS trades FROM flat WHERE t.transaction_date >= DATE '2018-01-01'""",
    "bucket_low": f"""WITH {_FLAT} SELECT doc_id, coverage_year, item, t.amount_range.low AS low, t.amount_range.high AS high, t.amount_range.exact AS exact,
CASE WHEN t.amount_range.exact IS NULL THEN '{{"low":' || t.amount_range.low || ',"high":' || t.amount_range.high || ',"label":"' || t.amount_range.label || '"}}' END AS stored
FROM flat WHERE coalesce(t.amount_range.exact, CAST(t.amount_range.low AS DOUBLE)) >= 15001""",
    "holdings": f"""WITH {CURRENT},
lastfd AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY coverage_year, doc_id ORDER BY body_id DESC) AS k_ FROM fd) WHERE k_ = 1),
once AS (SELECT body_id, coverage_year, doc_id, CASE WHEN json_valid(ltrim(body, chr(65279))) THEN CAST(ltrim(body, chr(65279)) AS JSON) END AS j FROM lastfd),
read AS (SELECT body_id, coverage_year, doc_id, CASE WHEN json_type(j) = 'VARCHAR' AND json_valid(j ->> '$') THEN CAST(j ->> '$' AS JSON) WHEN json_type(j) = 'OBJECT' THEN j END AS j FROM once),
page AS (SELECT body_id, coverage_year, doc_id, 0 AS page, json_extract(j, '$.schedules') AS s FROM read WHERE j IS NOT NULL
  UNION ALL SELECT body_id, coverage_year, doc_id, i, json_extract(j, '$.pages[' || (i - 1) || '].schedules') FROM (SELECT *, unnest(generate_series(1, CAST(json_array_length(json_extract(j, '$.pages')) AS BIGINT))) AS i FROM read WHERE json_type(json_extract(j, '$.pages')) = 'ARRAY')),
letter AS (SELECT * FROM (SELECT *, unnest(json_keys(s)) AS k FROM page WHERE json_type(s) = 'OBJECT') WHERE upper(k) = 'A'),
val AS (SELECT body_id, coverage_year, doc_id, page, json_extract(s, '$."' || k || '"') AS v FROM letter),
lst AS (SELECT body_id, coverage_year, doc_id, page, CASE WHEN json_type(v) = 'ARRAY' THEN CAST(v AS JSON[]) WHEN json_type(v) = 'OBJECT' AND json_type(json_extract(v, '$.items')) = 'ARRAY' THEN CAST(json_extract(v, '$.items') AS JSON[]) WHEN json_type(v) = 'OBJECT' AND NOT json_exists(v, '$.items') THEN [v] END AS items FROM val),
it AS (SELECT body_id, coverage_year, doc_id, page, i, items[i] AS x FROM (SELECT *, unnest(generate_series(1, len(items))) AS i FROM lst) WHERE coalesce(json_type(items[i]), 'NULL') <> 'NULL'),
numbered AS (SELECT *, CAST(row_number() OVER (PARTITION BY body_id ORDER BY page, i) AS INTEGER) AS item FROM it)
SELECT f.doc_id, f.coverage_year, n.item, f.filer_id, n.x ->> '$.asset' AS asset, n.x ->> '$.asset_type' AS asset_type FROM numbered n JOIN cur f ON f.coverage_year = n.coverage_year AND f.doc_id = n.doc_id
WHERE coalesce(f.filing_type.code, '') <> 'P' AND contains(lower(n.x ->> '$.asset'), 'bond') AND upper(n.x ->> '$.owner') = 'JT'""",
    "year_summary": f"""SELECT f.*, coalesce(u.unparsed, 0) AS unparsed FROM (SELECT coverage_year, {_COUNTS}, count(DISTINCT filer_id) FILTER (bioguide_id IS NULL) AS identity_warnings FROM filings GROUP BY 1) f LEFT JOIN (SELECT coverage_year, count(*) AS unparsed FROM unparsed_manifest GROUP BY 1) u USING (coverage_year)""",
    "type_counts": "SELECT coverage_year, filing_type.code AS code, count(*) AS n FROM filings GROUP BY ALL",
    "residual_counts": "SELECT count(*) FILTER (pdf_class = 'efiled' AND filing_type.code = 'P') AS efiled_ptr, count(*) FILTER (pdf_class = 'efiled' AND coalesce(filing_type.code, '') <> 'P') AS efiled_other FROM filings",
    "unparsed_reasons": """SELECT r.reason, count(u.reason) AS n FROM (VALUES ('scanned'), ('missing'), ('extract_failed'), ('unknown_type'), ('date_out_of_range'), ('schedule_incomplete')) r(reason) LEFT JOIN unparsed_manifest u USING (reason) GROUP BY 1""",
    "identity_ladder": f"""WITH {SEATS} SELECT row_no, seat_bioguide, ambiguous, coalesce('bioguide:' || nullif(seat_bioguide, ''), 'name:' || {KEY}) AS built_id FROM matched""",
    "identity_warnings": f"""WITH {_REASONED} SELECT filer_id, reason, raw_names, documents, districts FROM warn JOIN nm USING (filer_id)""",
    "warning_documents": f"WITH {_REASONED} SELECT filer_id, doc_id, row_no, reason FROM reasoned",
    "identity_report": f"""WITH {_REASONED}, h AS (SELECT DISTINCT filer_id, bioguide FROM reasoned JOIN seat ON upper(state_district.state) = seat.state AND state_district.district = seat.district),
hs AS (SELECT filer_id, array_to_string(list_slice(list_sort(list(bioguide)), 1, 4), ', ') AS holders FROM h GROUP BY 1)
SELECT filer_id, reason, replace(raw_names, '|', '; ') AS names, documents, coalesce(holders, '') AS holders FROM warn JOIN nm USING (filer_id) LEFT JOIN hs USING (filer_id)""",
    "match_summary": f"""WITH {_REASONED} SELECT (SELECT count(DISTINCT bioguide_id) FROM filings) AS matched, count(*) AS unmatched, count(*) FILTER (reason = 'candidate') AS candidate, count(*) FILTER (reason = 'no_district') AS no_district,
count(*) FILTER (reason = 'unknown_seat') AS unknown_seat, count(*) FILTER (reason = 'ambiguous_seat') AS ambiguous_seat, count(*) FILTER (reason = 'suspicious') AS suspicious FROM warn""",
    "seat_holders": f"""WITH {SEATS} SELECT state, district, string_agg(DISTINCT bioguide, ',' ORDER BY bioguide) AS holders FROM seat GROUP BY ALL""",
    "name_keys": f"SELECT row_no, {KEY} AS name_key FROM filings",
    "seat_parse": """SELECT row_no, CASE WHEN coalesce(state_district.raw, '') <> '' THEN substr(state_district.raw, 1, 2) END AS state,
CASE WHEN coalesce(state_district.raw, '') <> '' THEN coalesce(try_cast(nullif(trim(substr(state_district.raw, 3)), '') AS INTEGER), 0) END AS district FROM filings""",
    "stratified_sample": f"""WITH {CURRENT}, {_SAMPLE}, s AS (SELECT *, coalesce(nullif(pdf_class, ''), 'unknown') AS pc, CASE WHEN filing_type.code = 'P' THEN 'ptr' ELSE 'other' END AS family FROM one),
r AS (SELECT *, row_number() OVER (PARTITION BY pc, family ORDER BY substr(sha256('0:' || doc_id), 1, 16), doc_id) AS k, count(*) OVER (PARTITION BY pc, family) AS n FROM s)
SELECT doc_id, coverage_year, pc AS pdf_class, family FROM r WHERE k <= ceil(0.02 * n)""",
    "scorecard": f"""WITH {_LABELLED} SELECT pdf_class, family, false AS overall, {_LABELS_SCORE} FROM fresh GROUP BY 1, 2 UNION ALL SELECT NULL, NULL, true, {_LABELS_SCORE} FROM fresh""",
    "snapshot_stale": f"WITH {_LABELLED} SELECT doc_id, cur_snap AS current_snapshot FROM fresh WHERE stale",
    "reference_search": """SELECT id.bioguide AS bioguide, coalesce(nullif(name.official_full, ''), name.first || ' ' || name.last) AS name, CASE terms[-1].type WHEN 'rep' THEN 'house' WHEN 'sen' THEN 'senate' END AS chamber, terms[-1].state AS state
FROM legislators_current WHERE contains(lower(strip_accents(coalesce(nullif(name.official_full, ''), name.first || ' ' || name.last))), 'alde') OR contains(lower(id.bioguide), 'alde')""",
    "member_links": """SELECT bioguide_id, candidate_id, NULL AS reason FROM (SELECT id.bioguide AS bioguide_id, unnest(id.fec) AS candidate_id FROM legislators_current) WHERE trim(candidate_id) <> ''
UNION ALL SELECT id.bioguide, NULL, 'no_fec_id' FROM legislators_current WHERE id.fec IS NULL OR len(list_filter(id.fec, lambda x: trim(coalesce(x, '')) <> '')) = 0""",
    "ticker_extract": r"""WITH t AS (SELECT body_id, i - 1 AS item, transactions[i] AS t FROM (SELECT body_id, transactions, unnest(generate_series(1, len(transactions))) AS i FROM ptr) WHERE transactions[i] IS NOT NULL)
SELECT body_id, item, nullif(upper(trim(coalesce(nullif(regexp_extract(t.asset, '\(([^()]+)\)\s*\[[^\[\]]+\]', 1), ''), regexp_extract_all(t.asset, '\(([^()]+)\)', 1)[-1]))), '') AS ticker,
nullif(upper(trim(regexp_extract(t.asset, '\[([^\[\]]+)\]', 1))), '') AS asset_type, CASE WHEN contains(lower(t.transaction_type), '(partial)') THEN 'S(partial)' ELSE upper(left(trim(t.transaction_type), 1)) END AS kind FROM t""",
    "calendar_fold": "SELECT DISTINCT coverage_year AS year, coverage_year + coverage_year % 2 AS cycle, CAST((coverage_year - 1789) // 2 + 1 AS INTEGER) AS congress FROM filings",
    "invariants": f"""WITH {_FLAT}, w AS (SELECT doc_id, CASE WHEN t.owner = 'SP' THEN lower(t.asset_type) ELSE t.asset_type END AS asset_type, CASE WHEN t.owner = 'JT' THEN lower(t.ticker) ELSE t.ticker END AS ticker, t.transaction_date AS day,
  CASE WHEN t.owner = 'DC' THEN '02/30/2020' ELSE t.date_raw END AS raw, t.amount_range IS NOT NULL AS has, CASE WHEN t.owner = 'DC' THEN t.amount_range.high + 1 ELSE t.amount_range.low END AS low, t.amount_range.high AS high, t.amount_range.exact AS exact FROM flat)
SELECT invariant, count(*) AS n FROM (
SELECT 'asset_type_normalised' AS invariant FROM w WHERE asset_type IS NOT NULL AND asset_type <> upper(trim(asset_type))
UNION ALL SELECT 'ticker_upper' FROM w WHERE ticker IS NOT NULL AND (ticker <> upper(ticker) OR trim(ticker) = '')
UNION ALL SELECT 'date_or_raw' FROM w WHERE day IS NOT NULL AND raw IS NOT NULL
UNION ALL SELECT 'amount_shape' FROM w WHERE has AND NOT coalesce((low IS NOT NULL AND high IS NOT NULL AND exact IS NULL AND low <= high) OR (low IS NULL AND high IS NULL AND exact IS NOT NULL), false)) GROUP BY 1""",
    "schedule_invariants": f"""SELECT schedule, field, count(*) AS n FROM ({CORE["p4_amounts"]}) WHERE NOT coalesce((low IS NOT NULL AND high IS NOT NULL AND exact IS NULL AND low <= high) OR (low IS NULL AND high IS NULL AND exact IS NOT NULL), false) GROUP BY ALL""",
    "review_residual": f"""WITH {CURRENT}, f AS (SELECT * FROM cur WHERE trim(coalesce(doc_id, '')) <> ''), one AS (SELECT *, coalesce(nullif(pdf_class, ''), 'unknown') AS pc, CASE WHEN filing_type.code = 'P' THEN 'ptr' ELSE 'other' END AS family FROM f WHERE parse_status = 'ok'),
r AS (SELECT *, row_number() OVER (PARTITION BY pc, family ORDER BY substr(sha256('0:' || doc_id), 1, 16), doc_id) AS k, count(*) OVER (PARTITION BY pc, family) AS n FROM one), chosen AS (SELECT DISTINCT doc_id FROM r WHERE k <= ceil(0.5 * n))
SELECT (SELECT count(*) FROM f) AS filings, (SELECT count(*) FROM f WHERE coalesce(parse_status, '') <> 'ok') AS not_reviewable, count(*) AS selected, count(*) FILTER (('0x' || substr(sha256(doc_id), 1, 2))::INTEGER >= 200) AS unlabelled FROM chosen""",
    "set_ops": """WITH l AS (SELECT DISTINCT doc_id FROM unparsed_manifest WHERE trim(coalesce(doc_id, '')) <> ''), f AS (SELECT DISTINCT doc_id FROM filings WHERE trim(coalesce(doc_id, '')) <> '')
SELECT doc_id, 'filed' AS side FROM (SELECT * FROM l INTERSECT SELECT * FROM f) UNION ALL SELECT doc_id, 'missing' FROM (SELECT * FROM l EXCEPT SELECT * FROM f)""",
    "classify_text": r"""SELECT doc_id, CAST(length(regexp_replace(text, '[\s\x{0B}\x{85}\p{Z}]', '', 'g')) AS INTEGER) AS chars,
CASE WHEN text IS NULL THEN 'missing' WHEN length(regexp_replace(text, '[\s\x{0B}\x{85}\p{Z}]', '', 'g')) >= 20 THEN 'efiled' ELSE 'scanned' END AS pdf_class FROM documents""",
    "line_items": r"""WITH s AS (SELECT doc_id, string_split_regex(text, '\r\n|[\n\r]') AS l FROM documents WHERE source = 'clerk_fd_page' AND text IS NOT NULL),
x AS (SELECT doc_id, i, l[i] AS line, nullif(upper(regexp_extract(l[i], '(?i)^part ([a-z]):', 1)), '') AS heading FROM (SELECT doc_id, l, unnest(generate_series(1, len(l))) AS i FROM s)),
y AS (SELECT *, last_value(heading IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS segment FROM x)
SELECT doc_id, segment, count(*) AS n_lines, bool_or(starts_with(lower(line), 'nothing to report')) AS none_disclosed FROM y WHERE segment IS NOT NULL AND heading IS NULL GROUP BY 1, 2""",
}
