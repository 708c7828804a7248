"""The two parses from raw rows: committee money of a cycle, and the filings of a year with their pages.

Both give tables, what was left out and why, and counters that reconcile one with the other. Nothing is collected."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe import types as kinds
from tallyframe.functions import values
from tallyframe.operators import columns, extract, identity, money
from tallyframe.operators.reshape import candidate_ids


@dataclass(frozen=True)
class Money:
    """One cycle. residual: the contributions and expenditures that were left out, links that couldn't be made."""

    committees: DataFrame
    contributions: DataFrame
    links: DataFrame
    expenditures: DataFrame
    breaches: DataFrame
    residual: DataFrame
    counters: DataFrame


def _counted(df: DataFrame, **counts: Column) -> DataFrame:
    """(counter, n) of one aggregate over a table."""
    row = df.agg(*(c.alias(name) for name, c in counts.items()))
    return row.select(F.explode(F.array(*(F.struct(F.lit(n).alias("counter"), F.col(n).cast("long").alias("n")) for n in counts))).alias("x")).select("x.*")


def parse_money(master: DataFrame, linkage: DataFrame, pas2: DataFrame, expenditures: DataFrame, legislators: DataFrame, limit: int = kinds.CYCLE_LIMIT, order: str = "delivery_no") -> Money:
    """master, linkage, pas2: split rows (cols, row) of the bulk files; expenditures: rows of the headed file.

    Contributions pass the filter for connected committees and stay one for each transaction id; every other row has a
    reason. Expenditures for House candidates stay, unattributed ones too (then also with a reason)."""
    committee = money.committees(master)
    every = money.split_contributions(money.read_contributions(pas2), committee)
    kept = every.where("reason IS NULL")
    resolved, unresolved = identity.member_links(legislators, money.principal_committees(linkage))
    # All ids of a legislator attribute an expenditure, also those without a principal committee.
    ids = candidate_ids(legislators).select("candidate_id", F.col("bioguide").alias("bioguide_id"), F.struct("bioguide", "place").alias("place"))
    spent = money.expenditures(expenditures, ids, committee, row=order)
    in_house = F.coalesce("reason", F.lit("unresolved_candidate")) == "unresolved_candidate"
    house = spent.where(in_house)
    breaches = money.over_limit(kept, limit).join(committee.select(F.col("committee_id").alias("contributor_committee_id"), values.org_key(F.col("connected_organization_name"), F.col("name")).alias("organization")), "contributor_committee_id", "left")

    left_out = every.where("reason IS NOT NULL").select(F.lit("contribution").alias("what"), F.col("contributor_committee_id").alias("id"), "transaction_id", "amount", "reason")
    spent_out = spent.where("reason IS NOT NULL").select(F.lit("expenditure").alias("what"), F.col("spender_committee_id").alias("id"), "transaction_id", "amount", "reason")
    no_link = unresolved.select(F.lit("link").alias("what"), F.col("bioguide_id").alias("id"), F.lit(None).cast("string").alias("transaction_id"), F.lit(None).cast("double").alias("amount"), "reason")

    # One aggregate over each table; a distinct count is of committees, which are few.
    n, is_ = F.count("*"), lambda column, value: F.count_if(F.col(column) == value)
    good = F.col("reason").isNull()
    counters = _counted(master, source_committees=n, source_committees_short=F.count_if(F.size("cols") < 14))
    for part in (
        _counted(linkage, source_links=n, source_links_short=F.count_if(F.size("cols") < 6)),
        _counted(pas2, source_contributions=n),
        _counted(
            every, contributions_kept=F.count_if(good), committees_contributing=F.count_distinct(F.when(good, F.col("contributor_committee_id"))),
            **{f"contributions_{r}": is_("reason", r) for r in kinds.CONTRIBUTION_REASONS}, **{f"kept_{x}": F.count_if(good & (F.col("organization_type") == x)) for x in kinds.ORGANISATIONS.values()},
        ),
        _counted(committee, committees=n),
        _counted(
            resolved.select(F.lit(None).cast("string").alias("reason")).unionByName(unresolved.select("reason")),
            links_resolved=F.count_if(good), **{f"links_{r}": is_("reason", r) for r in kinds.LINK_REASONS},
        ),
        _counted(
            spent, source_expenditures=n, expenditures_kept=F.count_if(in_house), **{f"expenditures_{r}": is_("reason", r) for r in kinds.EXPENDITURE_REASONS},
            expenditures_support=F.count_if(in_house & (F.col("support_oppose") == "support")), expenditures_oppose=F.count_if(in_house & (F.col("support_oppose") == "oppose")), expenditures_unspecified=F.count_if(in_house & F.col("support_oppose").isNull()),
        ),
        _counted(breaches, limit_breaches=n),
    ):
        counters = counters.unionByName(part)
    return Money(money.contributing(committee, kept), kept.drop("reason", "short"), resolved, house, breaches, left_out.unionByName(spent_out).unionByName(no_link), counters)


@dataclass(frozen=True)
class Year:
    filings: DataFrame
    unparsed: DataFrame
    warnings: DataFrame


def parse_filings(filings: DataFrame, docs: DataFrame, legislators: DataFrame, layout: columns.Layout = columns.Layout(), latest: int = columns.LATEST_YEAR, families: set[str] | None = None) -> Year:
    """filings: rows of the index (`files.filings_from_index`) with an ordered row_no; docs: doc_id, text.

    Filers get their seat's legislator and an identifier, filings a class, a status and reasons; who stays unmatched is
    listed once with the reason that matters most."""
    matched = identity.match_seats(filings.drop("bioguide_id", "filer_id"), legislators)
    named = matched.withColumn("bioguide_id", F.col("seat_bioguide")).withColumn("filer_id", identity.filer_id(F.col("seat_bioguide"), F.col("state_district.state"), F.col("filer")))
    done = extract.outcomes(named.drop("ambiguous", "seat_bioguide"), docs, layout, latest, families)
    unmatched = identity.unmatched_reason(named.where("bioguide_id IS NULL"), legislators)
    return Year(done, extract.unparsed(done), identity.identity_warnings(unmatched))
