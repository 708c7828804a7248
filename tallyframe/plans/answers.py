"""Queries as answers: rows, what they guarantee, and the residual they can't see."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.operators import directory, money, residuals, reshape
from tallyframe.operators.predicates import FilingFilter, HoldingFilter, TradeFilter

FLOOR, CEILING, NONE = "at least these", "at most these", "no guarantee"


class NoData(LookupError):
    """None of the partitions asked for is there."""


@dataclass(frozen=True)
class Answer:
    rows: DataFrame
    guarantee: str
    residual: DataFrame


def require(present: list[int], wanted: list[int], what: str) -> tuple[list[int], list[int]]:
    """(present, skipped) of the partitions wanted; an error if there is none, not an empty result."""
    have = set(present)
    found, skipped = [w for w in wanted if w in have], [w for w in wanted if w not in have]
    if not found:
        raise NoData(f"no {what} among {sorted(wanted)}")
    return found, skipped


def partitions(df: DataFrame, column: str) -> list[int]:
    """The values of a partition column, of which there are few."""
    return sorted(r[0] for r in df.select(column).distinct().collect() if r[0] is not None)


def filings(table: DataFrame, want: FilingFilter = FilingFilter()) -> Answer:
    fuzzy = want.member or (want.filing_type and len(want.filing_type) > 3)
    return Answer(table.where(want.on_filing()), CEILING if fuzzy else FLOOR, residuals.class_counts(table, ["coverage_year"]))


def trades(table: DataFrame, ptr: DataFrame, want: TradeFilter = TradeFilter()) -> Answer:
    """An exact ticker gives a floor, with the trades that have none as the residual; a part of the asset a ceiling."""
    rows = reshape.trades(table, ptr, want)
    if want.ticker:
        return Answer(rows, FLOOR, residuals.ticker_blind_spot(reshape.trades(table, ptr), want.member, want.since, want.until))
    return Answer(rows, CEILING if want.asset or want.member else FLOOR, residuals.efiled_counts(table))


def holdings(table: DataFrame, holdings_of: DataFrame, want: HoldingFilter = HoldingFilter()) -> Answer:
    return Answer(reshape.holdings(table, holdings_of, want), CEILING if want.asset or want.member else FLOOR, residuals.efiled_counts(table))


def summary(table: DataFrame, unparsed: DataFrame) -> Answer:
    return Answer(residuals.year_summary(table, unparsed), FLOOR, residuals.efiled_counts(table))


def donors(contributions: DataFrame, committees: DataFrame, links: DataFrame, member: str, organisation_type: str | None = None) -> Answer:
    """Who gave to a member; nothing is guaranteed if no committee is known for the member."""
    recipients = money.member_recipients(links, member)
    rows = money.donors(contributions, committees, recipients, organisation_type)
    unknown = contributions.join(recipients, "recipient_committee_id", "left_semi").join(committees.select("cycle", F.col("committee_id").alias("contributor_committee_id")), ["cycle", "contributor_committee_id"], "left_anti")
    return Answer(rows, NONE if recipients.isEmpty() else FLOOR, unknown.agg(F.count("*").alias("unknown_contributor")))


def recipients(contributions: DataFrame, committees: DataFrame, links: DataFrame, organisation: str) -> Answer:
    rows, unattributed = money.recipients_of(contributions, committees, links, organisation)
    return Answer(rows, CEILING, unattributed)


def members(legislators: DataFrame, needle: str) -> Answer:
    everyone = legislators.agg(F.count("*").alias("searched"))
    return Answer(directory.search(legislators, needle), CEILING, everyone)
