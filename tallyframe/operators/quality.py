"""Invariants that every stored record must keep."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.functions import values

INVARIANTS = ("asset_type_normalised", "ticker_upper", "date_or_raw", "amount_shape")


def checks(row: Column, date_pairs: tuple[tuple[str, str], ...], amounts: tuple[str, ...], has: set[str]) -> Column:
    """The names of the invariants that a record (a struct with the fields in `has`) breaks, as an array."""
    broken = []
    if "asset_type" in has:
        broken.append(F.when(row["asset_type"].isNotNull() & (row["asset_type"] != F.upper(F.trim(row["asset_type"]))), INVARIANTS[0]))
    if "ticker" in has:
        broken.append(F.when(row["ticker"].isNotNull() & ((row["ticker"] != F.upper(row["ticker"])) | (F.trim(row["ticker"]) == "")), INVARIANTS[1]))
    for day, raw in date_pairs:
        if {day, raw} <= has:
            broken.append(F.when(row[day].isNotNull() & row[raw].isNotNull(), INVARIANTS[2]))
    for a in amounts:
        if a in has:
            broken.append(F.when(~values.amount_is_valid(row[a]), INVARIANTS[3]))
    return F.array_compact(F.array(*broken)) if broken else F.array().cast("array<string>")


def ptr_violations(flat: DataFrame) -> DataFrame:
    """(doc_id, item, invariant) of flat trades (doc_id, item, transaction)."""
    has = set(flat.schema["transaction"].dataType.names)
    found = checks(F.col("transaction"), (("transaction_date", "date_raw"), ("notification_date", "notification_date_raw")), ("amount_range",), has)
    return flat.select("doc_id", "item", F.explode(found).alias("invariant"))


def amount_violations(amounts: DataFrame) -> DataFrame:
    """(body_id, schedule, item_no, field) of line amounts that are neither a range nor exact though they have a value."""
    ok = values.amount_is_valid(F.struct("low", "high", "exact"))
    return amounts.where(~ok).select("body_id", "schedule", "item_no", "field")


def counts(violations: DataFrame) -> DataFrame:
    return violations.groupBy("invariant").agg(F.count("*").alias("n"))
