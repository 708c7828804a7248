"""Filters on filings, trades and holdings. Two-valued: what is null never matches, except where a line says so."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyframe import types as kinds
from tallyframe.functions import values
from tallyframe.functions.text import contains_ci, equals_ci


def member_like(needle: str, filer_id: Column, filer: Column) -> Column:
    """The needle within the filer's id or any part of the name."""
    return reduce(lambda a, b: a | b, (contains_ci(c, needle) for c in (filer_id, filer["prefix"], filer["first"], filer["last"], filer["suffix"])))


def type_matches(wanted: str, code: Column, label: Column) -> Column:
    """`fd` (all but reports of transactions, a missing code included), `ptr`, one letter, or part of the label."""
    w = wanted.lower()
    if w in ("fd", "ptr"):
        return values.family(code) == w
    if len(wanted) == 1:
        return F.coalesce(F.upper(code) == wanted.upper(), F.lit(False))
    return contains_ci(label, wanted)


def within(day: Column, since: date | None, until: date | None) -> Column:
    """Inclusive window; a null day is outside as soon as there is a bound."""
    out = F.lit(True)
    if since is not None:
        out = out & F.coalesce(day >= F.lit(since), F.lit(False))
    if until is not None:
        out = out & F.coalesce(day <= F.lit(until), F.lit(False))
    return out


@dataclass(frozen=True)
class FilingFilter:
    member: str | None = None
    bioguide: str | None = None
    state: str | None = None
    filing_type: str | None = None
    since: date | None = None
    until: date | None = None

    def on_filing(self) -> Column:
        out = F.lit(True)
        if self.member:
            out = out & member_like(self.member, F.col("filer_id"), F.col("filer"))
        if self.bioguide:
            out = out & equals_ci(F.col("bioguide_id"), self.bioguide)
        if self.state:
            out = out & equals_ci(F.col("state_district.state"), self.state)
        if self.filing_type:
            out = out & type_matches(self.filing_type, F.col("filing_type.code"), F.col("filing_type.label"))
        return out & within(F.col("filing_date"), self.since, self.until)


@dataclass(frozen=True)
class TradeFilter:
    member: str | None = None
    bioguide: str | None = None
    ticker: str | None = None
    asset: str | None = None
    owner: str | None = None
    transaction_type: str | None = None  # a prefix: S also finds S(partial)
    since: date | None = None
    until: date | None = None
    min_amount: float | None = None  # also 0 leaves out null amounts

    def on_trade(self, t: Column) -> Column:
        out = within(t["transaction_date"], self.since, self.until)
        if self.ticker:
            out = out & equals_ci(t["ticker"], self.ticker)
        if self.asset:
            out = out & contains_ci(t["asset"], self.asset)
        if self.owner:
            out = out & equals_ci(t["owner"], self.owner)
        if self.transaction_type:
            out = out & F.coalesce(F.upper(t["transaction_type"]).startswith(self.transaction_type.upper()), F.lit(False))
        if self.min_amount is not None:
            out = out & F.coalesce(values.amount_floor(t["amount_range"]) >= self.min_amount, F.lit(False))
        return out

    def on_filing(self) -> Column:
        return FilingFilter(member=self.member, bioguide=self.bioguide).on_filing()


@dataclass(frozen=True)
class HoldingFilter:
    member: str | None = None
    bioguide: str | None = None
    asset: str | None = None
    owner: str | None = None
    asset_type: str | None = None
    min_value: float | None = None

    def on_holding(self, h: Column) -> Column:
        out = F.lit(True)
        if self.asset:
            out = out & contains_ci(h["asset"], self.asset)
        if self.owner:
            out = out & equals_ci(h["owner"], self.owner)
        if self.asset_type:
            out = out & equals_ci(h["asset_type"], self.asset_type)
        if self.min_value is not None:
            out = out & F.coalesce(values.amount_floor(h["value_of_asset"]) >= self.min_value, F.lit(False))
        return out

    def on_filing(self) -> Column:
        return FilingFilter(member=self.member, bioguide=self.bioguide).on_filing()


def lacks_ticker(asset_type: Column, ticker: Column) -> Column:
    """A type that has tickers, without one: what a ticker filter can't see."""
    return F.coalesce(asset_type.isin(*kinds.TICKERED_TYPES), F.lit(False)) & (F.coalesce(ticker, F.lit("")) == "")


def connected(organisation_raw: Column) -> Column:
    """Committees that an organisation stands behind; an unknown type is none."""
    return F.coalesce(organisation_raw, F.lit("")).isin(*kinds.ORGANISATIONS)


def is_house(office: Column) -> Column:
    return F.coalesce(F.upper(F.trim(office)) == "H", F.lit(False))


def reviewable(parse_status: Column) -> Column:
    return F.coalesce(parse_status == "ok", F.lit(False))


def in_scope(code: Column, families: set[str] | None) -> Column:
    """Whether a filing's family is wanted; filings out of scope are kept, only not looked into."""
    return F.lit(True) if not families else values.family(code).isin(*sorted(families))
