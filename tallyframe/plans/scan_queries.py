"""Queries that write a table in a raw format to the shared folder and read it back through its source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.operators.rowcheck import IE_COLUMNS
from tallyframe.session import shared_dir, table
from tallyframe.sources import files


def _folder(spark: SparkSession, name: str) -> str:
    """One folder below the shared one for each scan of an application; the next run of the scan replaces its files."""
    return f"{shared_dir(spark)}/scan-{spark.sparkContext.applicationId}-{name}"


def xml_scan(spark: SparkSession, d: str) -> DataFrame:
    f = table(spark, d, "filings")
    text = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    day = F.date_format("filing_date", "M/d/yyyy")
    entries = f.select(
        text(F.col("filer.prefix")).alias("Prefix"), text(F.col("filer.last")).alias("Last"), text(F.col("filer.first")).alias("First"), text(F.col("filer.suffix")).alias("Suffix"),
        text(F.col("filing_type.code")).alias("FilingType"), text(F.col("state_district.raw")).alias("StateDst"), text(F.col("coverage_year")).alias("Year"), text(day).alias("FilingDate"), text(F.col("doc_id")).alias("DocID"),
    )
    path = _folder(spark, "xml")
    entries.write.mode("overwrite").option("rootTag", "FinancialDisclosure").option("rowTag", "Member").xml(path)
    back = files.filings_from_index(files.index_entries(spark, path), 2024, 2030)
    return back.select("doc_id", F.trim("filer.last").alias("last"), F.col("filing_type.label").alias("label"), F.col("state_district.district").alias("district"), "filing_date")


def csv_scan(spark: SparkSession, d: str) -> DataFrame:
    ie = table(spark, d, "independent_expenditure_2024")
    path = _folder(spark, "csv")
    ie.select(*(F.coalesce(F.col(c), F.lit("")).alias(c) for c in IE_COLUMNS)).write.mode("overwrite").option("header", True).option("escape", '"').option("emptyValue", "").option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return files.headed_csv(spark, path, IE_COLUMNS).groupBy("can_office", "short").agg(F.count("*").alias("n"), F.count_distinct("spe_nam").alias("spenders"))


def pipe_scan(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "supplier")
    path = _folder(spark, "pipe")
    s.select(F.concat_ws("|", F.col("s_suppkey").cast("string"), "s_name", F.lit(""), F.col("s_nationkey").cast("string"))).write.mode("overwrite").text(path)
    c = F.col("cols")
    return files.pipe_rows(spark, f"{path}/*.txt").select(c[0].alias("id"), c[1].alias("name"), c[3].alias("nation"), F.size(c).alias("n_cols"))


QUERIES = {f.__name__: f for f in (xml_scan, csv_scan, pipe_scan)}

ORACLE = {
    "xml_scan": """SELECT trim(doc_id) AS doc_id, trim(coalesce(filer.last, '')) AS last, CASE filing_type.code WHEN 'C' THEN 'candidate_report' WHEN 'X' THEN 'extension' WHEN 'P' THEN 'periodic_transaction_report' WHEN 'O' THEN 'annual_report'
WHEN 'A' THEN 'amendment' WHEN 'D' THEN 'unknown_d' WHEN 'W' THEN 'withdrawal' WHEN 'H' THEN 'unknown_h' WHEN 'T' THEN 'termination' WHEN 'B' THEN 'unknown_b' WHEN 'G' THEN 'unknown_g' WHEN 'E' THEN 'unknown_e' ELSE 'unknown' END AS label,
CASE WHEN coalesce(state_district.raw, '') <> '' THEN coalesce(try_cast(nullif(trim(substr(state_district.raw, 3)), '') AS INTEGER), 0) END AS district, filing_date FROM filings WHERE trim(coalesce(doc_id, '')) <> ''""",
    "csv_scan": "SELECT nullif(can_office, '') AS can_office, false AS short, count(*) AS n, count(DISTINCT nullif(spe_nam, '')) AS spenders FROM independent_expenditure_2024 GROUP BY 1, 2",
    "pipe_scan": "SELECT CAST(s_suppkey AS VARCHAR) AS id, s_name AS name, CAST(s_nationkey AS VARCHAR) AS nation, 4 AS n_cols FROM supplier",
}
