"""Flat rows from filings and their bodies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe import types as kinds
from tallyframe.functions import values
from tallyframe.operators import nested
from tallyframe.operators.predicates import HoldingFilter, TradeFilter


def latest(df: DataFrame, keys: list[str], *order: str) -> DataFrame:
    """The row of each key that comes last in the order (nulls first); the last column of the order identifies rows.

    Only keys and order go through the map-side aggregate; the rows themselves are kept by a semi join on their id."""
    row = order[-1]
    last = F.max(F.struct(*(F.struct(F.col(c).isNotNull().alias("known"), F.col(c).alias("v")) for c in order)))
    ids = df.groupBy(*keys).agg(last.alias("last")).select(F.col(f"last.col{len(order)}.v").alias(row))
    return df.join(ids, row, "left_semi")


def current_filings(filings: DataFrame) -> DataFrame:
    """Entries that were loaded again count once, as last loaded; entries without a doc_id all stay."""
    blank = F.trim(F.coalesce(F.col("doc_id"), F.lit(""))) == ""
    kept = latest(filings.where(~blank), ["coverage_year", "doc_id"], "load_no", "row_no")
    return kept.unionByName(filings.where(blank))


def trades(filings: DataFrame, ptr: DataFrame, want: TradeFilter = TradeFilter()) -> DataFrame:
    """A row for each transaction of each report of transactions, with its filing.

    The transactions are filtered within their arrays, before these meet the filings: bodies without any drop out."""
    reports = filings.where((F.col("filing_type.code") == kinds.PTR_TYPE) & want.on_filing()).select("doc_id", "coverage_year", "filer_id", "filer", "bioguide_id", "state_district", "row_no")
    last = latest(ptr.select("coverage_year", "doc_id", "body_id"), ["coverage_year", "doc_id"], "body_id").select("body_id")
    placed = F.transform("transactions", lambda t, i: F.struct(i.alias("item"), t.alias("transaction")))
    kept = F.filter(placed, lambda x: x["transaction"].isNotNull() & want.on_trade(x["transaction"]))
    some = ptr.select("coverage_year", "doc_id", "body_id", kept.alias("kept")).where(F.size("kept") > 0)
    rows = reports.join(some.join(last, "body_id", "left_semi").drop("body_id"), ["coverage_year", "doc_id"])
    return rows.select(*reports.columns, F.explode("kept").alias("x")).select(*reports.columns, "x.item", "x.transaction")


def holdings(filings: DataFrame, holdings_of: DataFrame, want: HoldingFilter = HoldingFilter()) -> DataFrame:
    """A row for each Schedule A item of each annual report. holdings_of: coverage_year, doc_id, item, holding."""
    reports = filings.where((F.coalesce(F.col("filing_type.code"), F.lit("")) != kinds.PTR_TYPE) & want.on_filing()).select("doc_id", "coverage_year", "filer_id", "filer", "bioguide_id", "state_district", "row_no")
    return reports.join(holdings_of, ["coverage_year", "doc_id"]).where(want.on_holding(F.col("holding")))


def schedule_a(fd: DataFrame, want: HoldingFilter = HoldingFilter()) -> DataFrame:
    """(coverage_year, doc_id, item, holding) of the Schedule A items wanted, of the last parse of each filing.

    The bodies stay where they are read; of their items those that pass the filter meet the ids of the last parses."""
    get = lambda n: F.try_element_at("fields", F.lit(n)).alias(n)
    some = F.col("low").isNotNull() | F.col("high").isNotNull() | F.col("exact").isNotNull() | F.col("text").isNotNull()
    value = F.when(some, F.struct("low", "high", "exact", F.col("text").alias("label"))).alias("value_of_asset")
    items = nested.interval_nodes(fd, "body_id", "body", ("item", "fields"), ("A",), "value_of_asset")
    items = items.select("body_id", F.col("item_no").alias("item"), F.struct(get("asset"), get("owner"), get("asset_type"), get("income_type"), value).alias("holding")).where(want.on_holding(F.col("holding")))
    last = latest(fd.select("coverage_year", "doc_id", "body_id"), ["coverage_year", "doc_id"], "body_id")
    return items.join(last, "body_id").select("coverage_year", "doc_id", "item", "holding")


def detail(filings: DataFrame, ptr: DataFrame, fd: DataFrame, doc_id: str) -> DataFrame:
    """A filing with its body: the lowest year and the first entry of that document; a missing body is null."""
    one = filings.where(F.col("doc_id") == doc_id).orderBy("coverage_year", "row_no").limit(1)
    p = latest(ptr.where(F.col("doc_id") == doc_id), ["coverage_year", "doc_id"], "body_id").select("coverage_year", "doc_id", "transactions")
    b = latest(fd.where(F.col("doc_id") == doc_id), ["coverage_year", "doc_id"], "body_id").select("coverage_year", "doc_id", "body")
    return one.join(p, ["coverage_year", "doc_id"], "left").join(b, ["coverage_year", "doc_id"], "left")


def name_rows(legislators: DataFrame) -> DataFrame:
    """(bioguide, name, chamber, state): chamber and state of the last term listed."""
    last = F.try_element_at(F.col("terms"), F.lit(-1))
    chamber = F.when(last["type"] == "rep", "house").when(last["type"] == "sen", "senate")
    return legislators.select(F.col("id.bioguide").alias("bioguide"), values.display_name(F.col("name.official_full"), F.col("name.first"), F.col("name.last")).alias("name"), chamber.alias("chamber"), last["state"].alias("state"))


def seats(legislators: DataFrame) -> DataFrame:
    """(bioguide, last, state, district) of each House seat that a legislator held."""
    t = legislators.select(F.col("id.bioguide").alias("bioguide"), F.col("name.last").alias("last"), F.explode("terms").alias("t"))
    return t.where("t.type = 'rep' AND t.state IS NOT NULL AND t.district IS NOT NULL AND bioguide IS NOT NULL").select("bioguide", "last", F.upper("t.state").alias("state"), F.col("t.district").alias("district")).distinct()


def candidate_ids(legislators: DataFrame) -> DataFrame:
    """(bioguide, candidate_id, place) of each id that isn't blank."""
    return legislators.select(F.col("id.bioguide").alias("bioguide"), F.posexplode("id.fec").alias("place", "candidate_id")).where("trim(candidate_id) <> '' AND bioguide IS NOT NULL")


def committee_names(definitions: DataFrame) -> DataFrame:
    """(code, committee, subcommittee, congresses): House committees and, under joined codes, their subcommittees."""
    house = definitions.where("type = 'house'")
    parents = house.select(F.col("thomas_id").alias("code"), F.col("name").alias("committee"), F.lit(None).cast("string").alias("subcommittee"), "congresses")
    below = house.select("thomas_id", F.col("name").alias("committee"), "congresses", F.explode("subcommittees").alias("s"))
    subs = below.select(F.concat("thomas_id", "s.thomas_id").alias("code"), "committee", F.col("s.name").alias("subcommittee"), "congresses")
    return parents.unionByName(subs)


def memberships(membership: DataFrame, column: str = "membership") -> DataFrame:
    """(code, bioguide, party, rank, title) of a map from code to members."""
    return membership.select(F.explode(column).alias("code", "members")).select("code", F.explode("members").alias("m")).select("code", "m.bioguide", "m.party", "m.rank", "m.title")


def sparse_json(c: Column) -> Column:
    """An AMOUNT as stored: only the fields that are set."""
    return F.to_json(c)
