"""Queries on committee money. Independent expenditures have a table of their own; contributions and committees are
played by the order tables: suppliers are committees, nations the organisations behind them, customers the members,
orders the members' committees, and line items the contributions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe import types as kinds
from tallyframe.functions import values
from tallyframe.operators import identity, money, reshape
from tallyframe.plans import answers
from tallyframe.session import table


def _committees(spark: SparkSession, d: str) -> DataFrame:
    s, n = table(spark, d, "supplier"), table(spark, d, "nation")
    code = F.element_at(F.array(*map(F.lit, [*kinds.ORGANISATIONS, "X", "Y"])), (F.pmod("s_nationkey", F.lit(8)) + 1).cast("int"))
    joined = s.join(n, s["s_nationkey"] == n["n_nationkey"])
    named = F.when(F.pmod("s_suppkey", F.lit(5)) == 0, F.lit("")).otherwise(F.col("n_name"))
    one = joined.select(F.col("s_suppkey").cast("string").alias("committee_id"), F.col("s_name").alias("name"), named.alias("connected_organization_name"), code.alias("organization_type_raw"), values.label_of(code, kinds.ORGANISATIONS).alias("organization_type"))
    return one.withColumn("cycle", F.explode(F.array(*(F.lit(c) for c in range(1994, 2004, 2)))))


def _contributions(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem")
    year = F.year("l_shipdate")
    return li.select(
        F.col("l_orderkey").cast("string").alias("recipient_committee_id"), F.col("l_suppkey").cast("string").alias("contributor_committee_id"), F.col("l_extendedprice").alias("amount"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("row"), values.cycle_of(year).alias("cycle"),
    )


def _links(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    return o.select(F.concat(F.lit("M"), F.lpad(F.col("o_custkey").cast("string"), 6, "0")).alias("bioguide_id"), F.col("o_orderkey").cast("string").alias("committee_id"), F.lit(1994).alias("cycle"), F.col("o_orderkey").alias("row"))


def donors(spark: SparkSession, d: str) -> DataFrame:
    return answers.donors(_contributions(spark, d), _committees(spark, d), _links(spark, d), "m00001").rows


def pac(spark: SparkSession, d: str) -> DataFrame:
    return answers.recipients(_contributions(spark, d), _committees(spark, d), _links(spark, d), "on_1").rows


def pac_limit(spark: SparkSession, d: str) -> DataFrame:
    members = money.recipient_members(_links(spark, d))
    kept = _contributions(spark, d).join(members, "recipient_committee_id").withColumn("recipient_committee_id", F.col("bioguide_id"))
    return money.over_limit(kept, 100_000)


def path1_split(spark: SparkSession, d: str) -> DataFrame:
    """Contributions kept and left out, by reason."""
    known = _committees(spark, d).where("cycle = 1994 AND cast(committee_id AS int) % 7 <> 0").drop("cycle")
    rows = _contributions(spark, d).select("*", F.lit("").alias("transaction_id"), F.lit(False).alias("short"))
    split = money.split_contributions(rows, known)
    return split.groupBy(F.coalesce("reason", F.lit("kept")).alias("reason"), "organization_type").agg(F.count("*").alias("n"), F.sum(values.cents(F.col("amount"))).alias("total"))


def dedup_first(spark: SparkSession, d: str) -> DataFrame:
    ie = table(spark, d, "independent_expenditure_2024").withColumn("tran_id", F.trim("tran_id"))
    return money.keep_first(ie, "tran_id", "delivery_no").select("delivery_no", "tran_id")


def _expenditures(spark: SparkSession, d: str) -> DataFrame:
    links = reshape.candidate_ids(table(spark, d, "legislators_current")).select("candidate_id", F.col("bioguide").alias("bioguide_id"), F.struct("bioguide", "place").alias("place"))
    return money.expenditures(table(spark, d, "independent_expenditure_2024"), links)


def ie_rows(spark: SparkSession, d: str) -> DataFrame:
    kept = _expenditures(spark, d).where("office = 'H'")
    return kept.select("delivery_no", "spender_committee_id", "candidate_id", "bioguide_id", "support_oppose", "support_oppose_raw", "amount", "date", "transaction_id", "reason")


def ie_direction(spark: SparkSession, d: str) -> DataFrame:
    return money.direction_counts(_expenditures(spark, d).where("office = 'H'"))


def ie_reasons(spark: SparkSession, d: str) -> DataFrame:
    return money.reason_counts(_expenditures(spark, d), kinds.EXPENDITURE_REASONS)


def ie_spenders(spark: SparkSession, d: str) -> DataFrame:
    """Each spender's money for and against, under the name of its first delivery."""
    e = _expenditures(spark, d)
    side = lambda s: F.coalesce(F.sum(F.when(F.col("support_oppose") == s, values.cents(F.col("amount")))), F.lit(0).cast("decimal(28,2)"))
    return e.groupBy("spender_committee_id").agg(F.min_by("spender_name", "delivery_no").alias("spender_name"), side("support").alias("supporting"), side("oppose").alias("opposing"), F.count("*").alias("n"))


def date_parse(spark: SparkSession, d: str) -> DataFrame:
    ie = table(spark, d, "independent_expenditure_2024")
    compact = F.date_format(values.day_month_date(F.col("receipt_dat")), "MMddyyyy")
    slashed = F.date_format(values.day_month_date(F.col("dissem_dt")), "M/d/yyyy")
    return ie.select("delivery_no", values.day_month_date(F.col("exp_date")).alias("exp_date"), values.compact_date(compact).alias("receipt_date"), values.mdy_date(slashed, 2024).alias("dissem_date"))


def amount_parse(spark: SparkSession, d: str) -> DataFrame:
    ie = table(spark, d, "independent_expenditure_2024")
    return ie.select("delivery_no", values.money(F.col("exp_amo")).alias("exp_amount"), values.money(F.col("agg_amo")).alias("agg_amount"), values.money(F.col("tran_id")).alias("not_a_number"))


QUERIES = {f.__name__: f for f in (donors, pac, pac_limit, path1_split, dedup_first, ie_rows, ie_direction, ie_reasons, ie_spenders, date_parse, amount_parse)}

_CM = """cm AS (SELECT CAST(s_suppkey AS VARCHAR) AS committee_id, s_name AS name, CASE WHEN s_suppkey % 5 = 0 THEN '' ELSE n_name END AS conn,
  (['C','T','L','M','V','W','X','Y'])[s_nationkey % 8 + 1] AS raw, (['corporation','trade','labor','membership','cooperative','corporation_without_capital_stock',NULL,NULL])[s_nationkey % 8 + 1] AS otype
  FROM supplier JOIN nation ON s_nationkey = n_nationkey),
con AS (SELECT CAST(l_orderkey AS VARCHAR) AS rec, CAST(l_suppkey AS VARCHAR) AS ctr, l_extendedprice AS amount, l_orderkey * 10 + l_linenumber AS row, year(l_shipdate) + year(l_shipdate) % 2 AS cycle FROM lineitem),
lnk AS (SELECT 'M' || lpad(CAST(o_custkey AS VARCHAR), 6, '0') AS bio, CAST(o_orderkey AS VARCHAR) AS cid FROM orders)"""
EXPENDITURES = r"""leg AS (SELECT candidate_id, max(bioguide) AS bioguide_id FROM (SELECT id.bioguide AS bioguide, unnest(id.fec) AS candidate_id FROM legislators_current) WHERE trim(candidate_id) <> '' GROUP BY 1),
e AS (SELECT delivery_no, trim(coalesce(spe_id, '')) AS spender_committee_id, nullif(trim(coalesce(spe_nam, '')), '') AS spender_name, nullif(trim(coalesce(cand_id, '')), '') AS candidate_id,
  nullif(upper(trim(coalesce(can_office, ''))), '') AS office, CASE upper(trim(coalesce(sup_opp, ''))) WHEN 'S' THEN 'support' WHEN 'O' THEN 'oppose' END AS support_oppose, nullif(trim(coalesce(sup_opp, '')), '') AS support_oppose_raw,
  coalesce(try_cast(trim(exp_amo) AS DOUBLE), 0.0) AS amount, CAST(try_strptime(upper(trim(exp_date)), '%d-%b-%y') AS DATE) AS date,
  nullif(regexp_replace(coalesce(tran_id, ''), '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g'), '') AS transaction_id FROM independent_expenditure_2024),
x AS (SELECT e.*, leg.bioguide_id, CASE WHEN coalesce(office, '') <> 'H' THEN 'not_house_candidate' WHEN e.candidate_id IS NULL THEN 'unresolved_candidate' END AS reason FROM e LEFT JOIN leg ON e.candidate_id = leg.candidate_id)"""

ORACLE = {
    "donors": f"""WITH {_CM}, r AS (SELECT DISTINCT cid FROM lnk WHERE contains(lower(bio), 'm00001'))
SELECT coalesce(nullif(conn, ''), name) AS organization, arg_min(otype, row) FILTER (true) AS organization_type_, sum(CAST(amount AS DECIMAL(18,2))) AS total, count(*) AS n_contributions
FROM con JOIN cm ON ctr = committee_id WHERE cycle BETWEEN 1994 AND 2002 AND rec IN (SELECT cid FROM r) GROUP BY 1""",
    "pac": f"""WITH {_CM}, m AS (SELECT committee_id FROM cm WHERE contains(lower(coalesce(nullif(conn, ''), name)), 'on_1'))
SELECT bio AS bioguide_id, sum(CAST(amount AS DECIMAL(18,2))) AS total, count(*) AS n_contributions FROM con JOIN lnk ON rec = cid WHERE cycle BETWEEN 1994 AND 2002 AND ctr IN (SELECT committee_id FROM m) GROUP BY 1""",
    "pac_limit": f"""WITH {_CM} SELECT ctr AS contributor_committee_id, bio AS recipient_committee_id, sum(CAST(amount AS DECIMAL(18,2))) AS total, count(*) AS n_contributions FROM con JOIN lnk ON rec = cid GROUP BY 1, 2 HAVING total > 100000""",
    "path1_split": f"""WITH {_CM} SELECT CASE WHEN k.committee_id IS NULL THEN 'unresolved_committee' WHEN raw IN ('C','T','L','M','V','W') THEN 'kept' ELSE 'not_connected_ssf' END AS reason, otype AS organization_type, count(*) AS n, sum(CAST(amount AS DECIMAL(18,2))) AS total
FROM con LEFT JOIN (SELECT * FROM cm WHERE CAST(committee_id AS INT) % 7 <> 0) k ON ctr = k.committee_id GROUP BY ALL""",
    "dedup_first": """SELECT delivery_no, tran_id FROM (SELECT delivery_no, trim(tran_id, ' ') AS tran_id, row_number() OVER (PARTITION BY trim(tran_id, ' ') ORDER BY delivery_no) AS k FROM independent_expenditure_2024) WHERE k = 1 OR coalesce(tran_id, '') = ''""",
    "ie_rows": f"WITH {EXPENDITURES} SELECT delivery_no, spender_committee_id, candidate_id, bioguide_id, support_oppose, support_oppose_raw, amount, date, transaction_id, reason FROM x WHERE office = 'H'",
    "ie_direction": f"WITH {EXPENDITURES} SELECT coalesce(support_oppose, 'unspecified') AS direction, count(*) AS n, sum(CAST(amount AS DECIMAL(18,2))) AS total FROM x WHERE office = 'H' GROUP BY 1",
    "ie_reasons": f"WITH {EXPENDITURES} SELECT r.reason, count(x.reason) AS n FROM (VALUES ('not_house_candidate'), ('unresolved_candidate'), ('malformed_short_row')) r(reason) LEFT JOIN x USING (reason) GROUP BY 1",
    "ie_spenders": f"""WITH {EXPENDITURES} SELECT spender_committee_id, arg_min(spender_name, delivery_no) AS spender_name, coalesce(sum(CAST(amount AS DECIMAL(18,2))) FILTER (support_oppose = 'support'), 0) AS supporting,
coalesce(sum(CAST(amount AS DECIMAL(18,2))) FILTER (support_oppose = 'oppose'), 0) AS opposing, count(*) AS n FROM x GROUP BY 1""",
    "date_parse": """SELECT delivery_no, CAST(try_strptime(upper(trim(exp_date)), '%d-%b-%y') AS DATE) AS exp_date, CAST(try_strptime(upper(trim(receipt_dat)), '%d-%b-%y') AS DATE) AS receipt_date,
CASE WHEN year(try_strptime(upper(trim(dissem_dt)), '%d-%b-%y')) <= 2024 THEN CAST(try_strptime(upper(trim(dissem_dt)), '%d-%b-%y') AS DATE) END AS dissem_date FROM independent_expenditure_2024""",
    "amount_parse": r"""SELECT delivery_no, coalesce(try_cast(trim(exp_amo) AS DOUBLE), 0.0) AS exp_amount, coalesce(try_cast(trim(agg_amo) AS DOUBLE), 0.0) AS agg_amount,
coalesce(try_cast(regexp_replace(tran_id, '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g') AS DOUBLE), 0.0) AS not_a_number FROM independent_expenditure_2024""",
}
ORACLE["donors"] = ORACLE["donors"].replace("arg_min(otype, row) FILTER (true) AS organization_type_", "arg_min(otype, (cycle, row)) AS organization_type")
