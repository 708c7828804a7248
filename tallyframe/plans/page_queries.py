"""Queries that extract records from page texts. The pages of the documents table print their own furniture."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe import types as kinds
from tallyframe.operators import extract
from tallyframe.operators.columns import Layout
from tallyframe.session import table

# The furniture of the pages in the documents table.
PAGES = Layout(
    heading=r"^Part ([A-J]):", none_line=r"^Nothing to report\.?\s*$", trailer=r"^(?:oath and signature|digitally signed|page \d+ of)",
    status=r"^(?:row status:|r\x00+ s\x00+:)", footnote=r"^\* The guide to this form lists", furniture=("holding holder", "holder creditor", "source type"),
    empty_box="hkwdc", ticked_box="hkwdcb",
)


def _pages(spark: SparkSession, d: str, source: str) -> DataFrame:
    return table(spark, d, "documents").where(F.col("source") == source).select("doc_id", "text")


def _damaged_reports(spark: SparkSession, d: str) -> DataFrame:
    """Reports of transactions in which one range is printed the wrong way round."""
    return _pages(spark, d, "clerk_ptr_page").withColumn("text", F.replace("text", F.lit("$50,001 - $100,000"), F.lit("$100,000 - $50,001")))


def _damaged_holdings(spark: SparkSession, d: str) -> DataFrame:
    """Annual reports that lost the boxes and line ends behind some sums, so that rows ran together."""
    return _pages(spark, d, "clerk_fd_page").withColumn("text", F.regexp_replace("text", r"\$1,001 - \$15,000 hkwdcb?[\r\n]+", "\\$1,001 - \\$15,000 "))


def page_transactions(spark: SparkSession, d: str) -> DataFrame:
    rows, _ = extract.transactions(_pages(spark, d, "clerk_ptr_page"), PAGES)
    t = F.col("transaction")
    return rows.select("doc_id", "item", t["owner"].alias("owner"), t["ticker"].alias("ticker"), t["transaction_type"].alias("kind"), t["transaction_date"].alias("traded"), t["amount_range"]["low"].alias("low"), t["amount_range"]["high"].alias("high"), t["cap_gains_over_200"].alias("ticked"))


def page_wrapped(spark: SparkSession, d: str) -> DataFrame:
    """The same rows where each upper bound stands on a line of its own and each sum up to 200 is exact."""
    wrapped = F.regexp_replace(F.replace("text", F.lit("$1 - $200"), F.lit("$157.25")), r"(?m)^(.* \$[0-9,]+ -) (\$[0-9,]+)(.*)$", "$1$3\n$2")
    rows, _ = extract.transactions(_pages(spark, d, "clerk_ptr_page").withColumn("text", wrapped), PAGES)
    t = F.col("transaction")
    return rows.select("doc_id", "item", t["asset"].alias("asset"), t["amount_range"]["low"].alias("low"), t["amount_range"]["high"].alias("high"), t["amount_range"]["exact"].alias("exact"), t["cap_gains_over_200"].alias("ticked"))


def page_failures(spark: SparkSession, d: str) -> DataFrame:
    return extract.transactions(_damaged_reports(spark, d), PAGES)[1]


def page_holdings(spark: SparkSession, d: str) -> DataFrame:
    items = extract.schedule_items(_pages(spark, d, "clerk_fd_page"), PAGES, letters="A")
    return items.select("doc_id", "item_no", "A.asset", "A.owner", "A.asset_type", F.col("A.value_of_asset.low").alias("value_low"), "A.income_type", F.col("A.income_amount.low").alias("income_low"), F.col("A.income_preceding.low").alias("preceding_low"))


def page_incomplete(spark: SparkSession, d: str) -> DataFrame:
    return extract.incomplete(_damaged_holdings(spark, d), PAGES)


def _printed_reports(spark: SparkSession, d: str) -> DataFrame:
    """(doc_id, text): an annual report of each customer, printed as the form prints it, with something in each schedule."""
    # The table is a small file, but what is made of each row isn't small.
    c = table(spark, d, "customer").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "c_custkey")
    year = (F.lit(2010) + F.pmod("c_nationkey", F.lit(12))).cast("string")
    name, n = F.col("c_name"), F.col("c_custkey").cast("string")
    line = lambda *parts: F.concat(*(F.lit(p) if isinstance(p, str) else p for p in parts))
    lines = [
        line("ScheDule A: assets"), line("asset owner value of asset"), line(name, " Fund ", n, " [MF] SP $250,001 - Rent $15,001 -"), line("$500,000 $50,000"), line("L\0\0\0\0\0\0\0\0: City ", n), line(name, " Bond [GS]  Undetermined Interest $201 - $1,000 gfedcb"),
        line("year to year"), line("ScheDule B: transactions"), line(name, " Stock [ST] JT 01/02/", year, " S (partial) $1,001 - $15,000 gfedc"),
        line("SCHEDULE C: earned income"), line(name, " Spouse Salary $", n, ".00 N/A"), line("Schedule D: liabilities"), line("liability owner"), line("SP ", name, " Bank May ", year, " Mortgage on ", n, " Road, $100,001 - Dallas, TX $250,000"),
        line("schedule E: positions"), line("Vice President ", name, " Foundation"), line("schedule F: agreements"), line("January ", year, " State of ", name, " Pension from fund ", n), line("schedule G: gifts"), line(name, " painting $", n, ".50"),
        line("schedule H: travel"), line("Trip Details Inclusions"), line(name, " Forum 01/02/", year, " - 01/05/", year, " Washington, DC - 3 Club Miami, FL"), line("schedule I: payments to charity"), line(name, " Paper Article 04/22/", year, " $500.00"),
        line("schedule J: compensation"), line(name, " Inc (Dallas, TX) Legal advice ", n), line("Digitally Signed: ", name), line("schedule K appendix"),
    ]
    return c.select(F.col("c_custkey").cast("long").alias("doc_id"), F.concat_ws("\n", *lines).alias("text"))


def page_schedules(spark: SparkSession, d: str) -> DataFrame:
    """The columns of all ten schedules, read back from printed reports."""
    items = extract.schedule_items(_printed_reports(spark, d))

    def cells(kind, c: Column) -> list[Column]:
        out = []
        for f in kind:
            if f.name not in ("raw_text", "asset_type_raw"):
                out += [c[f.name][x].cast("string") for x in ("low", "high")] if isinstance(f.dataType, T.StructType) else [c[f.name].cast("string")]
        return out

    shown = F.coalesce(*(F.when(F.col("schedule") == letter, F.concat_ws("|", *cells(kind, F.col(letter)))) for letter, kind in kinds.SCHEDULES.items()))
    return items.select("doc_id", "schedule", "item_no", shown.alias("columns"))


QUERIES = {f.__name__: f for f in (page_transactions, page_wrapped, page_failures, page_holdings, page_incomplete, page_schedules)}

_HEAD = r"^(?:(SP|DC|JT)\s+)?(.+?)\s+([Ss] \(partial\)|[PpSsEe])\s+(\d{2}/\d{2}/\d{4})\s+(\d{2}/\d{2}/\d{4})\s+\$([\d,]+)\s+-\s+\$([\d,]+)"
_LINES = rf"""
WITH s AS (SELECT doc_id, string_split_regex(text, '\r\n|[\n\r]') AS l FROM documents WHERE source = 'clerk_ptr_page' AND text IS NOT NULL),
x AS (SELECT doc_id, i, trim(replace(l[i], chr(9), ' ')) AS line FROM (SELECT doc_id, l, unnest(generate_series(1, len(l))) AS i FROM s)),
y AS (SELECT *, min(CASE WHEN regexp_matches(line, '(?i)^\* The guide to this form lists') THEN i END) OVER (PARTITION BY doc_id) AS foot FROM x),
k AS (SELECT *, bool_or(contains(line, chr(0))) OVER (PARTITION BY doc_id) AS lost FROM y WHERE foot IS NULL OR i < foot),
r AS (SELECT *, regexp_extract(line, '{_HEAD}\s*(hkwdcb?)?\s*$', ['owner', 'asset', 'kind', 'd1', 'd2', 'low', 'high', 'box']) AS g,
  regexp_matches(line, '{_HEAD}\s*(?:hkwdcb|hkwdc)\s*$') OR (lost AND regexp_matches(line, '{_HEAD}\s*$')) AS head FROM k),
guard AS (SELECT doc_id, count(*) FILTER (head) AS have, count(*) FILTER (head AND g.low = '50,001' AND g.high = '100,000') AS inverted, count(*) FILTER (regexp_matches(line, '(?i)^(?:row status:|r\x00+ s\x00+:)')) AS want FROM r GROUP BY 1)"""

# The lines of Part A up to what ends it; a holding's line has its tag, owner and sums, and ends in a box.
_PART_A = r"""
WITH s AS (SELECT doc_id, string_split_regex({text}, '\r\n|[\n\r]') AS l FROM documents WHERE source = 'clerk_fd_page' AND text IS NOT NULL),
x AS (SELECT doc_id, i, trim(replace(l[i], chr(9), ' ')) AS line FROM (SELECT doc_id, l, unnest(generate_series(1, len(l))) AS i FROM s)),
y AS (SELECT *, nullif(upper(regexp_extract(line, '(?i)^part ([a-j]):', 1)), '') AS heading, regexp_matches(line, '(?i)^(oath and signature|digitally signed|page [0-9]+ of)') AS ends FROM x WHERE line <> ''),
z AS (SELECT *, last_value(heading IGNORE NULLS) OVER w AS part, max(CASE WHEN heading IS NOT NULL THEN i END) OVER w AS opened, max(CASE WHEN ends THEN i END) OVER w AS closed FROM y WINDOW w AS (PARTITION BY doc_id ORDER BY i ROWS UNBOUNDED PRECEDING)),
a AS (SELECT *, regexp_matches(line, ' hkwdcb?$') OR regexp_matches(line, '\] *(?:(?:SP|DC|JT) *)?(?:\$|None)') AS starts, len(regexp_extract_all(line, '\[[A-Za-z0-9]+\]')) AS tags
  FROM z WHERE part = 'A' AND heading IS NULL AND coalesce(closed, 0) < opened AND NOT regexp_matches(line, '(?i)^(holding holder|nothing to report)'))"""

ORACLE = {
    "page_transactions": _LINES
    + r"""
SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS INTEGER) AS item, coalesce(nullif(g.owner, ''), 'self') AS owner,
  nullif(upper(trim(coalesce(nullif(regexp_extract(asset, '\(([^()]+)\)\s*\[[^\[\]]+\]', 1), ''), regexp_extract_all(asset, '\(([^()]+)\)', 1)[-1]))), '') AS ticker,
  CASE WHEN contains(lower(g.kind), '(partial)') THEN 'S(partial)' ELSE upper(left(g.kind, 1)) END AS kind, CAST(try_strptime(g.d1, '%m/%d/%Y') AS DATE) AS traded,
  CAST(replace(g.low, ',', '') AS BIGINT) AS low, CAST(replace(g.high, ',', '') AS BIGINT) AS high, CASE g.box WHEN 'hkwdcb' THEN true WHEN 'hkwdc' THEN false END AS ticked
FROM (SELECT *, g.asset AS asset FROM r) JOIN guard USING (doc_id) WHERE head AND have = want""",
    "page_wrapped": _LINES
    + r"""
SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS INTEGER) AS item, trim(regexp_replace(g.asset, '\s+', ' ', 'g')) AS asset, CASE WHEN g.high <> '200' THEN CAST(replace(g.low, ',', '') AS BIGINT) END AS low,
  CASE WHEN g.high <> '200' THEN CAST(replace(g.high, ',', '') AS BIGINT) END AS high, CASE WHEN g.high = '200' THEN 157.25::DOUBLE END AS exact, CASE g.box WHEN 'hkwdcb' THEN true WHEN 'hkwdc' THEN false END AS ticked
FROM r JOIN guard USING (doc_id) WHERE head AND have = want""",
    "page_failures": _LINES + " SELECT doc_id, 'extract_failed' AS reason FROM guard WHERE have - inverted <> want",
    "page_holdings": _PART_A.replace("{text}", "text")
    + r""",
m AS (SELECT *, list_transform(regexp_extract_all(line, '\$[0-9,]+ - \$[0-9,]+'), lambda x: list_transform(string_split(replace(replace(x, '$', ''), ',', ''), ' - '), lambda y: CAST(y AS BIGINT))) AS sums FROM a),
n AS (SELECT *, list_transform(sums, lambda x: CASE WHEN x[1] <= x[2] THEN x[1] END) AS low FROM m)
SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY i) AS INTEGER) AS item_no, trim(regexp_replace(split_part(line, '[', 1), '\s+', ' ', 'g')) AS asset,
  nullif(regexp_extract(line, '\] *(SP|DC|JT) ', 1), '') AS owner, regexp_extract(line, '\[([A-Z0-9]+)\]', 1) AS asset_type, low[1] AS value_low,
  nullif(regexp_extract(line, '^[^$]*\$[0-9,]+ - \$[0-9,]+ ([^$]*[^$ ]) *(\$|$)', 1), '') AS income_type,
  CASE WHEN NOT contains(line, ' None $') THEN low[2] END AS income_low, CASE WHEN contains(line, ' None $') THEN low[2] END AS preceding_low
FROM n WHERE starts""",
    "page_incomplete": _PART_A.replace("{text}", r"regexp_replace(text, '\$1,001 - \$15,000 hkwdcb?[\r\n]+', '$1,001 - $15,000 ', 'g')")
    + r""",
i AS (SELECT doc_id, tags, greatest(sum(CAST(starts AS INTEGER)) OVER (PARTITION BY doc_id ORDER BY i), 1) AS item FROM a),
o AS (SELECT doc_id, item, sum(tags) AS tags FROM i GROUP BY ALL),
n AS (SELECT doc_id, count(*) AS items, sum(tags) AS tags, max(tags) AS most FROM o GROUP BY 1)
SELECT doc_id, 'A' AS schedule, CASE WHEN (items = 1 AND tags >= 3) OR (items * 2 <= tags AND tags >= 4) THEN 'extract_failed' ELSE 'schedule_incomplete' END AS reason
FROM n WHERE (items = 1 AND tags >= 3) OR (items * 2 <= tags AND tags >= 4) OR most >= 2""",
    "page_schedules": """
WITH c AS (SELECT CAST(c_custkey AS BIGINT) AS doc_id, c_name AS n, CAST(c_custkey AS VARCHAR) AS k, CAST(2010 + c_nationkey % 12 AS VARCHAR) AS y FROM customer)
SELECT doc_id, 'A' AS schedule, 1 AS item_no, n || ' Fund ' || k || '|SP|MF|250001|500000|Rent|15001|50000|City ' || k AS columns FROM c
UNION ALL SELECT doc_id, 'A', 2, n || ' Bond|GS|Interest|201|1000' FROM c
UNION ALL SELECT doc_id, 'B', 1, n || ' Stock|JT|ST|' || y || '-01-02|S(partial)|1001|15000|false' FROM c
UNION ALL SELECT doc_id, 'C', 1, n || '|Spouse Salary|$' || k || '.00|N/A' FROM c
UNION ALL SELECT doc_id, 'D', 1, n || ' Bank|SP|May ' || y || '|Mortgage on ' || k || ' Road, Dallas, TX|100001|250000' FROM c
UNION ALL SELECT doc_id, 'E', 1, 'Vice President|' || n || ' Foundation' FROM c
UNION ALL SELECT doc_id, 'F', 1, 'January ' || y || '|State of ' || n || '|Pension from fund ' || k FROM c
UNION ALL SELECT doc_id, 'G', 1, n || ' painting|$' || k || '.50' FROM c
UNION ALL SELECT doc_id, 'H', 1, n || ' Forum Club|01/02/' || y || ' - 01/05/' || y || '|Washington, DC - Miami, FL' FROM c
UNION ALL SELECT doc_id, 'I', 1, n || ' Paper|Article|04/22/' || y || '|$500.00' FROM c
UNION ALL SELECT doc_id, 'J', 1, n || ' Inc (Dallas, TX)|Legal advice ' || k FROM c
""",
}

# What each text of `txt` (doc_id, text) is as a report of transactions and as an annual report.
_ANY = "FROM documents WHERE source = '{0}' AND text IS NOT NULL"
READINGS = f"""as_ptr AS ({_LINES.replace(_ANY.format("clerk_ptr_page"), "FROM txt")}
  SELECT guard.doc_id, have <> want AS ptr_failed, coalesce((SELECT bool_or(try_strptime(g.d1, '%m/%d/%Y') IS NULL OR try_strptime(g.d2, '%m/%d/%Y') IS NULL OR year(try_strptime(g.d1, '%m/%d/%Y')) NOT BETWEEN 1990 AND 2100) FROM r WHERE r.doc_id = guard.doc_id AND head), false) AS odd_date FROM guard),
as_fd AS ({_PART_A.replace("{text}", "text").replace(_ANY.format("clerk_fd_page"), "FROM txt")},
  i AS (SELECT doc_id, tags, greatest(sum(CAST(starts AS INTEGER)) OVER (PARTITION BY doc_id ORDER BY i), 1) AS item FROM a),
  o AS (SELECT doc_id, item, sum(tags) AS tags FROM i GROUP BY ALL),
  n AS (SELECT doc_id, count(*) AS items, sum(tags) AS tags, max(tags) AS most FROM o GROUP BY 1),
  h AS (SELECT doc_id, bool_or(heading IS NOT NULL) AS headed FROM y GROUP BY 1)
  SELECT h.doc_id, headed, coalesce((items = 1 AND tags >= 3) OR (items * 2 <= tags AND tags >= 4), false) AS fd_failed, coalesce(most >= 2, false) AS incomplete FROM h LEFT JOIN n USING (doc_id)),
readings AS (SELECT txt.doc_id, length(regexp_replace(text, '[\\s\\x{{0B}}\\x{{85}}\\p{{Z}}]', '', 'g')) AS chars, coalesce(ptr_failed, false) AS ptr_failed, coalesce(odd_date, false) AS odd_date, coalesce(headed, false) AS headed, coalesce(fd_failed, false) AS fd_failed,
  coalesce(incomplete, false) AS incomplete FROM txt LEFT JOIN as_ptr USING (doc_id) LEFT JOIN as_fd USING (doc_id))"""
