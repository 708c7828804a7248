"""What an answer can't see: counts of filings by class, status and reason."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.functions import values
from tallyframe.operators.predicates import FilingFilter, lacks_ticker, within

PDF_CLASSES = ("efiled", "scanned", "missing")


def class_counts(filings: DataFrame, by: list[str]) -> DataFrame:
    """Total, each class with zeros, not_classified (null), and errors, which are a part of the others."""
    known = F.coalesce(F.col("pdf_class").isin(*PDF_CLASSES), F.lit(False))
    return filings.groupBy(*by).agg(
        F.count("*").alias("total"),
        *(F.count_if(F.col("pdf_class") == c).alias(c) for c in PDF_CLASSES),
        F.count_if(~known).alias("not_classified"),
        F.count_if(F.coalesce("parse_status", F.lit("ok")) == "ok").alias("ok"),
        F.count_if(F.coalesce("parse_status", F.lit("ok")) != "ok").alias("error"),
    )


def type_counts(filings: DataFrame, by: list[str]) -> DataFrame:
    return filings.groupBy(*by, F.col("filing_type.code").alias("code")).agg(F.count("*").alias("n"))


def efiled_counts(filings: DataFrame) -> DataFrame:
    """How many e-filed reports of transactions and of other kinds there are: the ones with bodies."""
    efiled = F.col("pdf_class") == "efiled"
    ptr = values.family(F.col("filing_type.code")) == "ptr"
    return filings.agg(F.count_if(efiled & ptr).alias("efiled_ptr"), F.count_if(efiled & ~ptr).alias("efiled_other"))


def ticker_blind_spot(flat: DataFrame, member: str | None = None, since=None, until=None) -> DataFrame:
    """How many trades that should have a ticker have none, in the scope of member and dates alone."""
    scope = FilingFilter(member=member).on_filing() & within(F.col("transaction.transaction_date"), since, until)
    return flat.where(scope).agg(F.count_if(lacks_ticker(F.col("transaction.asset_type"), F.col("transaction.ticker"))).alias("without_ticker"), F.count("*").alias("trades"))


def year_summary(filings: DataFrame, unparsed: DataFrame) -> DataFrame:
    """A row for each year: class counts, how many filers are unmatched (each is an identity warning of the year), and how
    many entries the list of unparsed filings has for it."""
    listed = unparsed.groupBy("coverage_year").agg(F.count("*").alias("unparsed"))
    warned = filings.where("bioguide_id IS NULL").groupBy("coverage_year").agg(F.count_distinct("filer_id").alias("identity_warnings"))
    out = class_counts(filings, ["coverage_year"]).join(listed, "coverage_year", "left").join(warned, "coverage_year", "left")
    return out.fillna(0, ["unparsed", "identity_warnings"])
