"""Who filed: seats to legislators, identifiers, and what stays unmatched and why."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe import types as kinds
from tallyframe.functions.text import blank_to_null, name_key, norm_name
from tallyframe.operators.reshape import candidate_ids, seats


def seat_index(legislators: DataFrame) -> DataFrame:
    """(last_key, state, district, n, seat_bioguide): the holder of a seat with that name, null where several share it."""
    keyed = seats(legislators).withColumn("last_key", norm_name(F.col("last")))
    n = F.count_distinct("bioguide")
    return keyed.groupBy("last_key", "state", "district").agg(n.alias("n"), F.when(n == 1, F.min("bioguide")).alias("seat_bioguide"))


def match_seats(filings: DataFrame, legislators: DataFrame) -> DataFrame:
    """Adds seat_bioguide and ambiguous: by surname, state and district, if just one legislator has that key.

    Reports of candidates are never matched (a challenger isn't the incumbent)."""
    index = seat_index(legislators).select(F.col("last_key").alias("seat_last"), F.col("state").alias("seat_state"), F.col("district").alias("seat_district"), "n", "seat_bioguide")
    keyed = filings.withColumn("last_key", norm_name(F.col("filer.last")))
    same = (F.col("last_key") == F.col("seat_last")) & (F.upper("state_district.state") == F.col("seat_state")) & (F.col("state_district.district") == F.col("seat_district"))
    joined = keyed.join(index, same, "left").drop("seat_last")
    candidate = F.coalesce(F.col("filing_type.code") == kinds.CANDIDATE_TYPE, F.lit(False))
    return joined.withColumn("ambiguous", F.coalesce(F.col("n") > 1, F.lit(False))).withColumn("seat_bioguide", F.when(~candidate, F.col("seat_bioguide"))).drop("last_key", "seat_state", "seat_district", "n")


def filer_id(bioguide: Column, state: Column, filer: Column) -> Column:
    """`bioguide:<id>`, else `name:<key>`."""
    key = name_key(state, filer["last"], filer["first"], filer["suffix"])
    return F.coalesce(F.concat(F.lit("bioguide:"), blank_to_null(bioguide)), F.concat(F.lit("name:"), key))


def unmatched_reason(matched: DataFrame, legislators: DataFrame) -> DataFrame:
    """Adds `reason` to filings from match_seats that have no legislator."""
    held = seats(legislators).select(F.col("state").alias("held_state"), F.col("district").alias("held_district")).distinct().withColumn("held", F.lit(True))
    same = (F.upper("state_district.state") == F.col("held_state")) & (F.col("state_district.district") == F.col("held_district"))
    joined = matched.join(held, same, "left")
    no_seat = F.col("state_district.state").isNull() | F.col("state_district.district").isNull()
    reason = (
        F.when(F.col("filing_type.code") == kinds.CANDIDATE_TYPE, "candidate")
        .when(no_seat, "no_district")
        .when(F.col("ambiguous"), "ambiguous_seat")
        .when(F.col("held"), "suspicious")
        .otherwise("unknown_seat")
    )
    return joined.withColumn("reason", reason).drop("held_state", "held_district", "held")


def full_name(filer: Column) -> Column:
    return F.concat_ws(" ", blank_to_null(filer["first"]), blank_to_null(filer["last"]), blank_to_null(filer["suffix"]))


def identity_warnings(reasoned: DataFrame, order: str = "row_no") -> DataFrame:
    """(filer_id, reason, raw_names, districts, documents, first_seen) of each unmatched filer: the reason that matters
    most, names as first seen, districts sorted, and how many documents `warning_documents` lists.

    A filer's names and districts are few; its documents aren't, so they are a table of their own."""
    rank = F.array_position(F.array(*map(F.lit, kinds.IDENTITY_PRIORITY)), F.col("reason"))
    # Names are reduced to one row each before they are gathered: a filer has few spellings, however many filings.
    named = reasoned.groupBy("filer_id", full_name(F.col("filer")).alias("raw_name")).agg(
        F.min(order).alias("seen"), F.min(rank).alias("rank"), F.count("*").alias("documents"), F.collect_set("state_district.district").alias("districts")
    )
    out = named.groupBy("filer_id").agg(
        F.min("rank").alias("rank"),
        F.transform(F.sort_array(F.collect_list(F.struct("seen", "raw_name"))), lambda x: x["raw_name"]).alias("raw_names"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_list("districts")))).alias("districts"),
        F.sum("documents").alias("documents"),
        F.min("seen").alias("first_seen"),
    )
    reason = F.element_at(F.array(*map(F.lit, kinds.IDENTITY_PRIORITY)), F.col("rank").cast("int"))
    return out.select("filer_id", reason.alias("reason"), "raw_names", "districts", "documents", "first_seen")


def warning_documents(reasoned: DataFrame, order: str = "row_no") -> DataFrame:
    """(filer_id, doc_id, order, reason): the documents of unmatched filers, to be joined by filer_id."""
    return reasoned.select("filer_id", "doc_id", order, "reason")


SHOWN_HOLDERS = 4


def report(warnings: DataFrame, reasoned: DataFrame, legislators: DataFrame) -> DataFrame:
    """(filer_id, reason, names, documents, holders): what a reader is told of each unmatched filer. holders: who held the
    seats that the filer names, at most SHOWN_HOLDERS of them."""
    named = reasoned.select("filer_id", F.upper("state_district.state").alias("state"), F.col("state_district.district").alias("district")).distinct()
    held = named.join(seat_holders(legislators).select("state", "district", F.explode("holders").alias("h")), ["state", "district"])
    shown = held.groupBy("filer_id").agg(F.slice(F.sort_array(F.collect_set("h.bioguide")), 1, SHOWN_HOLDERS).alias("holders"))
    return warnings.join(shown, "filer_id", "left").select("filer_id", "reason", F.concat_ws("; ", "raw_names").alias("names"), "documents", F.concat_ws(", ", "holders").alias("holders"))


def match_summary(matched: DataFrame, warnings: DataFrame) -> DataFrame:
    """One row: matched people, unmatched filers, and a count for each reason, zeros included."""
    counts = warnings.agg(F.count("*").alias("unmatched"), *(F.count_if(F.col("reason") == r).alias(r) for r in kinds.IDENTITY_REASONS))
    people = matched.agg(F.count_distinct("bioguide_id").alias("matched"))
    return people.join(counts)  # one row each


def seat_holders(legislators: DataFrame) -> DataFrame:
    """(state, district, holders): who held a seat, by bioguide."""
    held = seats(legislators).groupBy("state", "district", "bioguide").agg(F.min("last").alias("last"))
    return held.groupBy("state", "district").agg(F.sort_array(F.collect_list(F.struct("bioguide", "last"))).alias("holders"))


def member_links(legislators: DataFrame, principal: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(links, residual): candidate ids of each legislator with the principal committee; who has none and why.

    principal: candidate_id, committee_id. Without it every link stays unresolved."""
    ids = candidate_ids(legislators).select(F.col("bioguide").alias("bioguide_id"), "candidate_id", "place")
    without = legislators.select(F.col("id.bioguide").alias("bioguide_id")).where("bioguide_id IS NOT NULL").join(ids.select("bioguide_id").distinct(), "bioguide_id", "left_anti")
    residual = without.select("bioguide_id", F.lit(None).cast("string").alias("candidate_id"), F.lit("no_fec_id").alias("reason"))
    if principal is None:
        return ids.select("bioguide_id", "candidate_id", F.lit(None).cast("string").alias("committee_id")), residual
    joined = ids.join(principal, "candidate_id", "left")
    links = joined.where("committee_id IS NOT NULL").select("bioguide_id", "candidate_id", "committee_id", F.lit(kinds.PROVENANCE).alias("provenance"))
    lost = joined.where("committee_id IS NULL").select("bioguide_id", "candidate_id", F.lit("no_principal_committee").alias("reason"))
    return links, residual.unionByName(lost)
