"""The parses from raw rows as queries. The raw files of committee money are made from the order tables and the
legislators: suppliers and spenders are committees, orders the contributions, candidate ids the links. Some rows are
short or repeat a transaction id, as in the bulk files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe import types as kinds
from tallyframe.operators import directory, reshape, review
from tallyframe.plans import pipelines
from tallyframe.plans.filing_queries import CURRENT, KEY, SEATS
from tallyframe.plans.money_queries import EXPENDITURES
from tallyframe.plans.page_queries import PAGES, READINGS
from tallyframe.session import table


def _cols(width: int, **at) -> list:
    """An array of `width` texts with the columns at c0, c1, .. set."""
    return F.array(*(F.coalesce(at.get(f"c{i}", F.lit("")), F.lit("")) for i in range(width)))


def _master(spark: SparkSession, d: str) -> DataFrame:
    """Suppliers (those of nation 7 as short rows; each once more under its own id, which counts), and spenders."""
    s, n = table(spark, d, "supplier"), table(spark, d, "nation")
    code = F.element_at(F.array(*map(F.lit, [*kinds.ORGANISATIONS, "", "Y"])), (F.pmod("s_nationkey", F.lit(8)) + 1).cast("int"))
    whole = _cols(15, c0=F.col("s_suppkey").cast("string"), c1=F.concat(F.lit(" "), "s_name"), c9=F.lit("Q"), c12=code, c13=F.when(F.pmod("s_suppkey", F.lit(5)) == 0, "").otherwise(F.col("n_name")))
    named = s.join(n, s["s_nationkey"] == n["n_nationkey"])
    rows = named.select(F.when(F.col("s_nationkey") == 7, F.slice(whole, 1, 13)).otherwise(whole).alias("cols"), F.col("s_suppkey").alias("row"))
    old = named.select(_cols(15, c0=F.col("s_suppkey").cast("string"), c1=F.lit("OLD"), c12=F.lit("C")).alias("cols"), (F.lit(-1) - F.col("s_suppkey")).alias("row"))
    ie = table(spark, d, "independent_expenditure_2024")
    spenders = ie.groupBy(F.trim("spe_id").alias("id")).agg(F.min("delivery_no").alias("first")).where("id <> ''")
    return rows.unionByName(old).unionByName(spenders.select(_cols(15, c0=F.col("id"), c1=F.col("id"), c12=F.lit("V"), c13=F.concat(F.lit("org of "), "id")).alias("cols"), (F.col("first") + 1_000_000_000).alias("row")))


def _linkage(spark: SparkSession, d: str) -> DataFrame:
    """Three rows for each candidate id: an authorised committee, the principal one, and another principal one."""
    ids = reshape.candidate_ids(table(spark, d, "legislators_current")).select("candidate_id").distinct().where(~F.col("candidate_id").startswith("S"))
    row = lambda kind, tag, order: ids.select(_cols(7, c0=F.col("candidate_id"), c3=F.concat(F.lit(f"C{tag}"), "candidate_id"), c5=F.lit(kind)).alias("cols"), F.lit(order).cast("long").alias("row"))
    short = ids.select(F.array(F.col("candidate_id")).alias("cols"), F.lit(0).cast("long").alias("row"))
    return row("A", "a", 1).unionByName(row("P", "p", 2)).unionByName(row("P", "z", 3)).unionByName(short)


def _pas2(spark: SparkSession, d: str) -> DataFrame:
    """Orders: urgent ones of a customer all bear one transaction id, high ones none, low ones are short rows. The customer
    is the recipient; every hundred and ten customers have the same contributor, some of whom are no supplier."""
    o = table(spark, d, "orders")
    kind, customer = F.substring("o_orderpriority", 1, 1), F.col("o_custkey").cast("string")
    tran = F.when(kind == "1", F.concat(F.lit("c"), customer)).when(kind == "2", "").otherwise(F.concat(F.lit("o"), F.col("o_orderkey").cast("string")))
    whole = _cols(20, c0=F.pmod("o_custkey", F.lit(110)).cast("string"), c4=F.lit("img"), c13=F.date_format("o_orderdate", "MMddyyyy"), c14=F.col("o_totalprice").cast("string"), c15=customer, c17=tran)
    return o.select(F.when(kind == "5", F.slice(whole, 1, 10)).otherwise(whole).alias("cols"), F.col("o_orderkey").alias("row"))


def _money(spark: SparkSession, d: str) -> pipelines.Money:
    return pipelines.parse_money(_master(spark, d), _linkage(spark, d), _pas2(spark, d), table(spark, d, "independent_expenditure_2024"), table(spark, d, "legislators_current"))


def fec_counters(spark: SparkSession, d: str) -> DataFrame:
    return _money(spark, d).counters


def fec_contributions(spark: SparkSession, d: str) -> DataFrame:
    return _money(spark, d).contributions.select("row", "contributor_committee_id", "recipient_committee_id", "amount", "date", F.nullif("transaction_id", F.lit("")).alias("transaction_id"), "organization_type")


def fec_links(spark: SparkSession, d: str) -> DataFrame:
    return _money(spark, d).links.select("bioguide_id", "candidate_id", "committee_id")


def fec_breaches(spark: SparkSession, d: str) -> DataFrame:
    return _money(spark, d).breaches


def fec_expenditures(spark: SparkSession, d: str) -> DataFrame:
    return _money(spark, d).expenditures.select("delivery_no", "spender_committee_id", "connected_organization_name", "bioguide_id", "amount", "reason")


def fec_residual(spark: SparkSession, d: str) -> DataFrame:
    return _money(spark, d).residual.groupBy("what", "reason").agg(F.count("*").alias("n"))


def fec_committees(spark: SparkSession, d: str) -> DataFrame:
    """The committees that gave."""
    return _money(spark, d).committees.select("committee_id", "name", "connected_organization_name", "organization_type", "first_row")


def _pages(spark: SparkSession, d: str) -> DataFrame:
    """(doc_id, text): the last page text of each filing."""
    pages = table(spark, d, "documents").where(F.col("source").isin("clerk_ptr_page", "clerk_fd_page") & F.col("filing_doc_id").isNotNull())
    last = pages.groupBy("filing_doc_id").agg(F.max("doc_id").alias("doc_id")).select("doc_id")
    return pages.join(last, "doc_id", "left_semi").select(F.col("filing_doc_id").alias("doc_id"), "text")


def _year(spark: SparkSession, d: str) -> pipelines.Year:
    return pipelines.parse_filings(reshape.current_filings(table(spark, d, "filings")).drop("pdf_class", "parse_status"), _pages(spark, d), table(spark, d, "legislators_current"), PAGES)


def clerk_parse(spark: SparkSession, d: str) -> DataFrame:
    return _year(spark, d).filings.select("row_no", "doc_id", "filer_id", "bioguide_id", "pdf_class", "parse_status", F.concat_ws(",", "reasons").alias("reasons"))


def clerk_unparsed(spark: SparkSession, d: str) -> DataFrame:
    return _year(spark, d).unparsed.groupBy("reason").agg(F.count("*").alias("n"))


def committee_search(spark: SparkSession, d: str) -> DataFrame:
    """House seats on committees; each state has a committee with one subcommittee."""
    people = table(spark, d, "legislators_current")
    named = reshape.name_rows(people).where("state IS NOT NULL")
    sub = F.array(F.struct(F.lit("Rules").alias("name"), F.lit("01").alias("thomas_id")))
    congress = F.when(F.col("state") < "N", F.array(F.lit(116), F.lit(117))).otherwise(F.array(F.lit(117)))
    definitions = named.select("state").distinct().select(F.lit("house").alias("type"), F.concat(F.lit("Committee on "), "state").alias("name"), F.concat(F.lit("HS"), "state").alias("thomas_id"), congress.alias("congresses"), sub.alias("subcommittees"))
    member = F.struct(F.col("name"), F.lit("x").alias("party"), F.length("name").alias("rank"), F.lit(None).cast("string").alias("title"), F.col("bioguide"))
    lists = lambda tail: named.groupBy(F.concat(F.lit("HS"), "state", F.lit(tail)).alias("code")).agg(F.collect_list(member).alias("members"))
    both = lists("").unionByName(lists("01"))
    membership = both.select(F.create_map("code", "members").alias("membership"))
    return directory.search_committees(people, definitions, membership, "an", 116).select("bioguide", "name", "code", "committee", "subcommittee", "rank")


def review_queue(spark: SparkSession, d: str) -> DataFrame:
    """The reviewer's queue: each chosen filing with its state (open, done, stale), and what the scorecard is silent on."""
    rows = reshape.current_filings(table(spark, d, "filings")).where("trim(doc_id) <> ''")
    ptr = reshape.latest(table(spark, d, "ptr"), ["coverage_year", "doc_id"], "body_id").select("coverage_year", "doc_id", F.col("transactions").alias("body"))
    chosen = review.select(rows, 0.05).join(ptr, ["coverage_year", "doc_id"], "left")
    # Verdicts on filings of known members; those on the members of one state were given for an older record.
    labels = chosen.where("filer_id LIKE 'bioguide:%'").select("doc_id", F.when(F.col("state_district.state") == "CA", "older").otherwise(review.snapshot(chosen)).alias("snapshot")).dropDuplicates(["doc_id"])
    return review.queue(chosen, labels).select("doc_id", "coverage_year", "state")


QUERIES = {f.__name__: f for f in (fec_counters, fec_contributions, fec_links, fec_breaches, fec_expenditures, fec_residual, fec_committees, clerk_parse, clerk_unparsed, committee_search, review_queue)}

_CM = """cm AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS committee_id, CASE WHEN s_nationkey = 7 THEN 'OLD' ELSE s_name END AS name, CASE WHEN s_nationkey <> 7 AND s_suppkey % 5 <> 0 THEN n_name END AS conn,
    CASE WHEN s_nationkey = 7 THEN 'C' ELSE (['C','T','L','M','V','W','','Y'])[s_nationkey % 8 + 1] END AS raw FROM supplier JOIN nation ON s_nationkey = n_nationkey
  UNION ALL SELECT DISTINCT trim(spe_id), trim(spe_id), 'org of ' || trim(spe_id), 'V' FROM independent_expenditure_2024 WHERE trim(spe_id) <> ''),
org(raw, otype) AS (VALUES ('C', 'corporation'), ('T', 'trade'), ('L', 'labor'), ('M', 'membership'), ('V', 'cooperative'), ('W', 'corporation_without_capital_stock')),
com AS (SELECT cm.*, otype FROM cm LEFT JOIN org USING (raw)),
con AS (SELECT o_orderkey AS row, CAST(o_custkey % 110 AS VARCHAR) AS ctr, CAST(o_custkey AS VARCHAR) AS rec, o_totalprice AS amount, CAST(o_orderdate AS DATE) AS date,
  CASE left(o_orderpriority, 1) WHEN '1' THEN 'c' || o_custkey WHEN '2' THEN NULL ELSE 'o' || o_orderkey END AS tran FROM orders WHERE left(o_orderpriority, 1) <> '5'),
one AS (SELECT * FROM con QUALIFY tran IS NULL OR row_number() OVER (PARTITION BY tran ORDER BY row) = 1),
split AS (SELECT one.*, com.*, CASE WHEN committee_id IS NULL THEN 'unresolved_committee' WHEN otype IS NULL THEN 'not_connected_ssf' END AS reason FROM one LEFT JOIN com ON ctr = committee_id),
kept AS (SELECT * FROM split WHERE reason IS NULL),
breach AS (SELECT ctr, rec, sum(CAST(amount AS DECIMAL(18,2))) AS total, count(*) AS n FROM kept GROUP BY ALL HAVING total > 10000),
fec AS (SELECT id.bioguide AS bioguide_id, unnest(id.fec) AS candidate_id FROM legislators_current),
cand AS (SELECT * FROM fec WHERE trim(candidate_id) <> '' AND bioguide_id IS NOT NULL)"""
_IE = EXPENDITURES + ", spent AS (SELECT x.*, conn FROM x LEFT JOIN com ON spender_committee_id = committee_id)"
_COUNTERS = {
    "source_committees": "(SELECT 2 * count(*) FROM supplier) + (SELECT count(*) FROM com WHERE raw = 'V' AND starts_with(conn, 'org of '))", "source_committees_short": "SELECT count(*) FROM supplier WHERE s_nationkey = 7",
    "source_links": "SELECT 4 * count(DISTINCT candidate_id) FROM cand WHERE NOT starts_with(candidate_id, 'S')", "source_links_short": "SELECT count(DISTINCT candidate_id) FROM cand WHERE NOT starts_with(candidate_id, 'S')",
    "source_contributions": "SELECT count(*) FROM orders", "contributions_kept": "SELECT count(*) FROM kept", "contributions_unresolved_committee": "SELECT count(*) FROM split WHERE reason = 'unresolved_committee'",
    "contributions_not_connected_ssf": "SELECT count(*) FROM split WHERE reason = 'not_connected_ssf'", "contributions_malformed_short_row": "SELECT count(*) FROM orders WHERE left(o_orderpriority, 1) = '5'",
    **{f"kept_{label}": f"SELECT count(*) FROM kept WHERE otype = '{label}'" for label in kinds.ORGANISATIONS.values()},
    "committees": "SELECT count(*) FROM com", "committees_contributing": "SELECT count(DISTINCT ctr) FROM kept", "links_resolved": "SELECT count(*) FROM cand WHERE NOT starts_with(candidate_id, 'S')",
    "links_no_principal_committee": "SELECT count(*) FROM cand WHERE starts_with(candidate_id, 'S')", "links_no_fec_id": "SELECT count(*) FROM legislators_current WHERE id.bioguide IS NOT NULL AND id.bioguide NOT IN (SELECT bioguide_id FROM cand)",
    "source_expenditures": "SELECT count(*) FROM spent", "expenditures_kept": "SELECT count(*) FROM spent WHERE office = 'H'", "expenditures_not_house_candidate": "SELECT count(*) FROM spent WHERE coalesce(office, '') <> 'H'",
    "expenditures_unresolved_candidate": "SELECT count(*) FROM spent WHERE office = 'H' AND candidate_id IS NULL", "expenditures_malformed_short_row": "SELECT 0", "expenditures_support": "SELECT count(*) FROM spent WHERE office = 'H' AND support_oppose = 'support'",
    "expenditures_oppose": "SELECT count(*) FROM spent WHERE office = 'H' AND support_oppose = 'oppose'", "expenditures_unspecified": "SELECT count(*) FROM spent WHERE office = 'H' AND support_oppose IS NULL", "limit_breaches": "SELECT count(*) FROM breach",
}
_PARSED = f"""{CURRENT}, {SEATS.replace("FROM filings f LEFT JOIN", "FROM cur f LEFT JOIN")},
last AS (SELECT filing_doc_id AS doc, max(doc_id) AS d FROM documents WHERE source IN ('clerk_ptr_page', 'clerk_fd_page') AND filing_doc_id IS NOT NULL GROUP BY 1),
txt AS (SELECT last.doc AS doc_id, text FROM last JOIN documents ON d = documents.doc_id WHERE text IS NOT NULL),
{READINGS},
seen AS (SELECT m.*, CASE WHEN r.doc_id IS NULL THEN 'missing' WHEN r.chars < 20 THEN 'scanned' ELSE 'efiled' END AS klass, r.*, coalesce(m.filing_type.code, '') AS code FROM matched m LEFT JOIN readings r ON m.doc_id = r.doc_id),
tried AS (SELECT *, klass = 'efiled' AND CASE WHEN code = 'P' THEN ptr_failed ELSE fd_failed OR (code IN ('O', 'A') AND NOT headed) END AS failed FROM seen),
parsed AS (SELECT row_no, doc_id, coalesce('bioguide:' || nullif(seat_bioguide, ''), 'name:' || {KEY}) AS filer_id, seat_bioguide AS bioguide_id, CASE WHEN NOT failed THEN klass END AS pdf_class, CASE WHEN failed THEN 'error' ELSE 'ok' END AS parse_status,
  concat_ws(',', CASE WHEN klass <> 'efiled' THEN klass END, CASE WHEN failed THEN 'extract_failed' END, CASE WHEN code NOT IN ('C','X','P','O','A','D','W','H','T','B','G','E') THEN 'unknown_type' END,
    CASE WHEN klass = 'efiled' AND NOT failed AND code = 'P' AND odd_date THEN 'date_out_of_range' END, CASE WHEN klass = 'efiled' AND NOT failed AND code <> 'P' AND incomplete THEN 'schedule_incomplete' END) AS reasons FROM tried)"""

ORACLE = {
    "fec_counters": f"WITH {_CM}, {_IE} " + " UNION ALL ".join(f"SELECT '{name}' AS counter, CAST(({sql}) AS BIGINT) AS n" for name, sql in _COUNTERS.items()),
    "fec_contributions": f"WITH {_CM} SELECT row, ctr AS contributor_committee_id, rec AS recipient_committee_id, amount, date, tran AS transaction_id, otype AS organization_type FROM kept",
    "fec_links": f"WITH {_CM} SELECT bioguide_id, candidate_id, 'Cp' || candidate_id AS committee_id FROM cand WHERE NOT starts_with(candidate_id, 'S')",
    "fec_breaches": f"WITH {_CM} SELECT ctr AS contributor_committee_id, rec AS recipient_committee_id, total, n AS n_contributions, coalesce(conn, name) AS organization FROM breach JOIN com ON ctr = committee_id",
    "fec_expenditures": f"WITH {_CM}, {_IE} SELECT delivery_no, spender_committee_id, conn AS connected_organization_name, bioguide_id, amount, reason FROM spent WHERE office = 'H'",
    "fec_residual": f"""WITH {_CM}, {_IE} SELECT 'contribution' AS what, reason, count(*) AS n FROM split WHERE reason IS NOT NULL GROUP BY ALL UNION ALL SELECT 'contribution', 'malformed_short_row', count(*) FROM orders WHERE left(o_orderpriority, 1) = '5'
UNION ALL SELECT 'expenditure', reason, count(*) FROM spent WHERE reason IS NOT NULL GROUP BY ALL UNION ALL SELECT 'link', 'no_principal_committee', count(*) FROM cand WHERE starts_with(candidate_id, 'S') HAVING count(*) > 0
UNION ALL SELECT 'link', 'no_fec_id', count(*) FROM legislators_current WHERE id.bioguide IS NOT NULL AND id.bioguide NOT IN (SELECT bioguide_id FROM cand) HAVING count(*) > 0""",
    "fec_committees": f"WITH {_CM} SELECT committee_id, name, conn AS connected_organization_name, otype AS organization_type, min(row) AS first_row FROM kept GROUP BY ALL",
    "clerk_parse": f"WITH {_PARSED} SELECT * FROM parsed",
    "clerk_unparsed": f"WITH {_PARSED} SELECT reason, count(*) AS n FROM (SELECT unnest(string_split(reasons, ',')) AS reason FROM parsed WHERE reasons <> '') GROUP BY 1",
    "committee_search": """WITH p AS (SELECT id.bioguide AS bioguide, coalesce(nullif(name.official_full, ''), trim(name.first || ' ' || name.last)) AS name, terms[-1].state AS state FROM legislators_current)
SELECT bioguide, name, 'HS' || state || s.code AS code, 'Committee on ' || state AS committee, s.sub AS subcommittee, CAST(length(name) AS INTEGER) AS rank FROM p, (VALUES ('', NULL), ('01', 'Rules')) s(code, sub)
WHERE state < 'N' AND (contains(lower(strip_accents(name)), 'an') OR contains(lower(bioguide), 'an'))""",
    "review_queue": f"""WITH {CURRENT}, one AS (SELECT *, coalesce(nullif(pdf_class, ''), 'unknown') AS pc, CASE WHEN filing_type.code = 'P' THEN 'ptr' ELSE 'other' END AS family FROM cur WHERE trim(coalesce(doc_id, '')) <> '' AND parse_status = 'ok'),
r AS (SELECT *, row_number() OVER (PARTITION BY pc, family ORDER BY substr(sha256('0:' || doc_id), 1, 16), doc_id) AS k, count(*) OVER (PARTITION BY pc, family) AS n FROM one)
SELECT doc_id, coverage_year, CASE WHEN coalesce(filer_id, '') NOT LIKE 'bioguide:%' THEN 'open' WHEN state_district.state = 'CA' THEN 'stale' ELSE 'done' END AS state FROM r WHERE k <= ceil(0.05 * n)""",
}
