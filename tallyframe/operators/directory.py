"""Searching legislators and their committees."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.functions.text import contains_ci, fold_accents, unaccent
from tallyframe.operators.reshape import committee_names, memberships, name_rows


def _matches(needle: str) -> Column:
    name = F.lower(unaccent(F.col("name")))
    return F.coalesce(name.contains(fold_accents(needle).lower()), F.lit(False)) | contains_ci(F.col("bioguide"), needle)


def search(legislators: DataFrame, needle: str) -> DataFrame:
    """Name (regardless of case and accents) or bioguide holds the needle; by name, then bioguide."""
    return name_rows(legislators).where(_matches(needle)).orderBy("name", "bioguide")


def search_committees(legislators: DataFrame, definitions: DataFrame, membership: DataFrame, needle: str, congress: int | None = None) -> DataFrame:
    """The House committee seats of the members found; leaders (low rank) first, no rank last."""
    labels = committee_names(definitions)
    if congress is not None:
        labels = labels.where(F.coalesce(F.array_contains("congresses", congress), F.lit(True)))
    rows = name_rows(legislators).where(_matches(needle)).join(memberships(membership), "bioguide").join(labels.drop("congresses"), "code")
    return rows.orderBy("name", "bioguide", "committee", F.coalesce("subcommittee", F.lit("")), F.coalesce("rank", F.lit(1_000_000)))
