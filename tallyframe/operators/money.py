"""Committee money: what is kept and why not, roll-ups by donor and by member, limits, independent expenditures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe import types as kinds
from tallyframe.functions import values
from tallyframe.functions.text import blank_to_null, contains_ci, strip_unicode
from tallyframe.operators.predicates import connected, is_house


def keep_first(df: DataFrame, key: str, order: str) -> DataFrame:
    """One row of each key, the first in the order; rows with a blank or null key all stay.

    The first row is found by a map-side aggregate and kept by a semi join on the unique order column, so a key that a
    third of all rows carry doesn't gather in one task."""
    named = F.coalesce(F.col(key), F.lit("")) != ""
    first = df.where(named).groupBy(key).agg(F.min(order).alias(order)).select(order)
    return df.where(named).join(first, order, "left_semi").unionByName(df.where(~named))


def keep_last(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """One row of each key, the last in the order."""
    return df.join(df.groupBy(*keys).agg(F.max(order).alias(order)).select(order), order, "left_semi")


def committees(master: DataFrame) -> DataFrame:
    """COMMITTEES from split rows (cols, row): short rows are left out, of repeated ids the last stays."""
    get = lambda i: strip_unicode(F.element_at("cols", i + 1))
    rows = master.where(F.size("cols") >= 14).select(
        get(0).alias("committee_id"), get(1).alias("name"), blank_to_null(get(13)).alias("connected_organization_name"),
        values.label_of(blank_to_null(get(12)), kinds.ORGANISATIONS).alias("organization_type"), blank_to_null(get(12)).alias("organization_type_raw"),
        blank_to_null(get(9)).alias("committee_type"), F.lit(None).cast("string").alias("affiliation"), F.lit(kinds.PROVENANCE).alias("provenance"), "row",
    )
    return keep_last(rows, ["committee_id"], "row")


def principal_committees(links: DataFrame) -> DataFrame:
    """(candidate_id, committee_id) from split rows: the first principal committee of each candidate."""
    get = lambda i: strip_unicode(F.element_at("cols", i + 1))
    rows = links.where(F.size("cols") >= 6).where(get(5) == "P").select(get(0).alias("candidate_id"), get(3).alias("committee_id"), "row")
    return rows.groupBy("candidate_id").agg(F.min_by("committee_id", "row").alias("committee_id"))


def read_contributions(rows: DataFrame) -> DataFrame:
    """Split rows (cols, row) as contributions; short rows have only `short` set."""
    get = lambda i: F.when(~F.col("short"), strip_unicode(F.try_element_at("cols", F.lit(i + 1))))
    return rows.withColumn("short", F.size("cols") < 18).select(
        get(0).alias("contributor_committee_id"), get(15).alias("recipient_committee_id"), F.when(~F.col("short"), values.money(get(14))).alias("amount"),
        values.compact_date(get(13)).alias("date"), blank_to_null(get(4)).alias("image_number"), F.coalesce(get(17), F.lit("")).alias("transaction_id"), "short", "row",
    )


def split_contributions(rows: DataFrame, committee: DataFrame) -> DataFrame:
    """Adds `reason`: null for what is kept, else why not. Repeated transaction ids are left out first, uncounted.

    Dedup comes before the filter: an excluded first copy hides a later one."""
    short = rows.where("short").withColumn("reason", F.lit("malformed_short_row")).withColumn("organization_type", F.lit(None).cast("string"))
    whole = keep_first(rows.where("NOT short"), "transaction_id", "row")
    by = committee.select(F.col("committee_id").alias("contributor_committee_id"), "organization_type", "organization_type_raw", F.lit(True).alias("known"))
    joined = whole.join(by, "contributor_committee_id", "left")
    reason = F.when(F.col("known").isNull(), "unresolved_committee").when(~connected(F.col("organization_type_raw")), "not_connected_ssf")
    return joined.withColumn("reason", reason).select(*rows.columns, "organization_type", "reason").unionByName(short.select(*rows.columns, "organization_type", "reason"))


def reason_counts(df: DataFrame, reasons: tuple[str, ...], column: str = "reason") -> DataFrame:
    """(reason, n) of a fixed vocabulary, zeros included."""
    row = df.agg(*(F.count_if(F.col(column) == r).alias(r) for r in reasons))
    return row.select(F.explode(F.array(*(F.struct(F.lit(r).alias("reason"), F.col(r).alias("n")) for r in reasons))).alias("x")).select("x.*")


def member_recipients(links: DataFrame, needle: str) -> DataFrame:
    """(recipient_committee_id) of the members whose id holds the needle, over all cycles asked for."""
    if not needle:
        raise ValueError("a member must be named")
    return links.where(contains_ci(F.col("bioguide_id"), needle)).select(F.col("committee_id").alias("recipient_committee_id")).distinct()


def donors(contributions: DataFrame, committee: DataFrame, recipients: DataFrame, organisation_type: str | None = None) -> DataFrame:
    """(organization, organization_type, total, n_contributions): who gave to the recipients, greatest first.

    The type of an organisation is that of its first contribution; it isn't part of the key. Both tables have `cycle`."""
    given = contributions.select("cycle", "row", "contributor_committee_id", "recipient_committee_id", "amount").join(recipients, "recipient_committee_id", "left_semi")
    by = committee.select("cycle", F.col("committee_id").alias("contributor_committee_id"), "organization_type", values.org_key(F.col("connected_organization_name"), F.col("name")).alias("organization"))
    joined = given.join(by, ["cycle", "contributor_committee_id"])
    if organisation_type:
        joined = joined.where(F.col("organization_type") == organisation_type)
    rolled = joined.groupBy("organization").agg(F.sum(values.cents(F.col("amount"))).alias("total"), F.count("*").alias("n_contributions"), F.min_by("organization_type", F.struct("cycle", "row")).alias("organization_type"))
    return rolled.select("organization", "organization_type", "total", "n_contributions").orderBy(F.desc("total"), "organization")


def recipient_members(links: DataFrame) -> DataFrame:
    """(recipient_committee_id, bioguide_id): the first link of each committee, in order of cycle and row."""
    return links.groupBy(F.col("committee_id").alias("recipient_committee_id")).agg(F.min_by("bioguide_id", F.struct("cycle", "row")).alias("bioguide_id"))


def recipients_of(contributions: DataFrame, committee: DataFrame, links: DataFrame, needle: str) -> tuple[DataFrame, DataFrame]:
    """(roll-up by member, count of unattributed contributions) of the organisations whose name holds the needle."""
    org = values.org_key(F.col("connected_organization_name"), F.col("name"))
    matching = committee.where(contains_ci(org, needle)).select("cycle", F.col("committee_id").alias("contributor_committee_id"))
    given = contributions.join(matching, ["cycle", "contributor_committee_id"], "left_semi").join(recipient_members(links), "recipient_committee_id", "left")
    rolled = given.where("bioguide_id IS NOT NULL").groupBy("bioguide_id").agg(F.sum(values.cents(F.col("amount"))).alias("total"), F.count("*").alias("n_contributions"))
    return rolled.orderBy(F.desc("total"), "bioguide_id"), given.agg(F.count_if(F.col("bioguide_id").isNull()).alias("unattributed"))


def over_limit(kept: DataFrame, limit: int = kinds.CYCLE_LIMIT) -> DataFrame:
    """(contributor, recipient, total, n) of the pairs whose sum is above the limit."""
    pair = ["contributor_committee_id", "recipient_committee_id"]
    return kept.groupBy(*pair).agg(F.sum(values.cents(F.col("amount"))).alias("total"), F.count("*").alias("n_contributions")).where(F.col("total") > limit)


def contributing(committee: DataFrame, kept: DataFrame) -> DataFrame:
    """The committees that gave, with the row in which each first did; in that order."""
    first = kept.groupBy(F.col("contributor_committee_id").alias("committee_id")).agg(F.min("row").alias("first_row"))
    return committee.join(first, "committee_id").orderBy("first_row")


def expenditures(ie: DataFrame, links: DataFrame | None = None, committee: DataFrame | None = None, row: str = "delivery_no") -> DataFrame:
    """INDEPENDENT_EXPENDITURES with `reason`: kept rows of House candidates, unattributed ones too (then with a reason),
    and the others with the reason alone. links: candidate_id, bioguide_id, place; the last one of a candidate counts."""
    cell = lambda name: strip_unicode(F.coalesce(F.col(name), F.lit("")))
    raw = cell("sup_opp")
    # Rows with fewer cells than the header are marked by their source.
    short = F.col("short") if "short" in ie.columns else F.lit(False).alias("short")
    out = ie.select(
        F.col(row), short, cell("spe_id").alias("spender_committee_id"), blank_to_null(cell("spe_nam")).alias("spender_name"), blank_to_null(cell("cand_id")).alias("candidate_id"),
        blank_to_null(F.upper(cell("can_office"))).alias("office"), values.label_of(blank_to_null(F.upper(raw)), kinds.DIRECTIONS).alias("support_oppose"), blank_to_null(raw).alias("support_oppose_raw"),
        values.money(F.col("exp_amo")).alias("amount"), values.day_month_date(F.col("exp_date")).alias("date"), blank_to_null(cell("pur")).alias("purpose"),
        blank_to_null(cell("image_num")).alias("image_number"), blank_to_null(cell("tran_id")).alias("transaction_id"), F.lit(kinds.PROVENANCE_IE).alias("provenance"),
    )
    if links is not None:
        last = links.groupBy("candidate_id").agg(F.max_by("bioguide_id", "place").alias("bioguide_id"))
        out = out.join(last, "candidate_id", "left")
    if committee is not None:
        out = out.join(committee.select(F.col("committee_id").alias("spender_committee_id"), "connected_organization_name"), "spender_committee_id", "left")
    reason = F.when(F.col("short"), "malformed_short_row").when(~is_house(F.col("office")), "not_house_candidate").when(F.col("candidate_id").isNull(), "unresolved_candidate")
    return out.withColumn("reason", reason).drop("short")


def direction_counts(kept: DataFrame) -> DataFrame:
    return kept.groupBy(F.coalesce("support_oppose", F.lit("unspecified")).alias("direction")).agg(F.count("*").alias("n"), F.sum(values.cents(F.col("amount"))).alias("total"))
