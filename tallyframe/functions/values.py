"""Dates, amounts, codes, hashes and report fields as Column expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe import types as kinds
from tallyframe.functions.text import blank_to_null, strip_unicode

EARLIEST_YEAR = 1990


def part(c: Column, pattern: str, group: int = 1) -> Column:
    """A group of the first match, null where there is none."""
    return blank_to_null(F.regexp_extract(c, pattern, group))


def _parsed(text: Column, shape: str, pattern: str) -> Column:
    """A date of the pattern; null unless the text has the shape and the calendar the day."""
    return F.try_to_timestamp(F.when(text.rlike(shape), text), F.lit(pattern)).cast("date")


def mdy_date(c: Column, latest_year: int) -> Column:
    """`M/D/YYYY` from 1990 to the latest year, else null."""
    found = _parsed(strip_unicode(c), r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}$", "M/d/yyyy")
    return F.when(F.year(found).between(EARLIEST_YEAR, latest_year), found)


def compact_date(c: Column) -> Column:
    """`MMDDYYYY`, else null."""
    return _parsed(strip_unicode(c), r"^[0-9]{8}$", "MMddyyyy")


def day_month_date(c: Column) -> Column:
    """`DD-MON-YY` of this century in any case, else null (four-digit years are rejected)."""
    return _parsed(F.initcap(strip_unicode(c)), r"^[0-9]{1,2}-[A-Za-z]{3}-[0-9]{2}$", "d-MMM-yy")


def money(c: Column) -> Column:
    """A plain decimal number; anything else, blank included, is 0."""
    t = strip_unicode(F.coalesce(c, F.lit("")))
    return F.coalesce(F.when(t.rlike(r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]{1,3})?$"), t.try_cast("double")), F.lit(0.0))


def cents(c: Column) -> Column:
    """For sums whose value doesn't depend on their order."""
    return c.cast(T.DecimalType(18, 2))


def amount_of(text: Column) -> Column:
    """The first `$lo - $hi` bucket or exact sum of a text as an AMOUNT, null where there is none."""
    number = lambda c: F.replace(c, F.lit(","), F.lit(""))
    bucket = r"\$([0-9][0-9,]*)\s*-\s*\$([0-9][0-9,]*)"
    low, high = part(text, bucket, 1), part(text, bucket, 2)
    exact = part(text, r"\$([0-9][0-9,]*(?:\.[0-9]{2})?)")
    none = lambda kind: F.lit(None).cast(kind)
    ranged = F.struct(number(low).cast("long").alias("low"), number(high).cast("long").alias("high"), none("double").alias("exact"), F.concat(F.lit("$"), low, F.lit(" - $"), high).alias("label"))
    single = F.struct(none("long").alias("low"), none("long").alias("high"), number(exact).cast("double").alias("exact"), F.concat(F.lit("$"), exact).alias("label"))
    return F.when(low.isNotNull(), ranged).when(exact.isNotNull(), single)


def amount_floor(amount: Column) -> Column:
    """The least that an AMOUNT can be: its exact value, else its lower bound."""
    return F.coalesce(amount["exact"], amount["low"].cast("double"))


def amount_is_valid(amount: Column) -> Column:
    """Whether exactly one of the two shapes is there; null amounts are valid."""
    ranged = amount["low"].isNotNull() & amount["high"].isNotNull() & amount["exact"].isNull()
    single = amount["low"].isNull() & amount["high"].isNull() & amount["exact"].isNotNull()
    return F.coalesce(amount.isNull() | ((ranged & (amount["low"] <= amount["high"])) | single), F.lit(False))


def label_of(code: Column, table: Mapping[str, str], otherwise: str | None = None) -> Column:
    """The label of a code; the raw code should be kept beside it."""
    found = F.try_element_at(F.create_map(*(F.lit(x) for pair in table.items() for x in pair)), code)
    return found if otherwise is None else F.coalesce(found, F.lit(otherwise))


def filing_label(code: Column) -> Column:
    return label_of(code, kinds.FILING_TYPES, kinds.UNKNOWN_FILING)


def family(code: Column) -> Column:
    """`ptr` or `fd`; a missing code counts as fd."""
    return F.when(F.coalesce(code, F.lit("")) == kinds.PTR_TYPE, "ptr").otherwise("fd")


def state_district(raw: Column) -> Column:
    """STATE_DISTRICT of `SSdd`: the first two characters as they are, the rest as a number or 0; null if blank."""
    rest = F.trim(raw.substr(F.lit(3), F.length(raw)))
    number = F.coalesce(F.when(rest.rlike(r"^[0-9]{1,9}$"), rest.cast("int")), F.lit(0))
    return F.when(F.coalesce(raw, F.lit("")) != "", F.struct(raw.alias("raw"), raw.substr(1, 2).alias("state"), number.alias("district")))


def ticker(asset: Column) -> Column:
    """The symbol in parentheses right before the `[TYPE]` tag, else the last one in parentheses; upper case."""
    tagged = part(asset, r"\(([^()]+)\)\s*\[[^\[\]]+\]")
    last = F.try_element_at(F.regexp_extract_all(asset, F.lit(r"\(([^()]+)\)"), F.lit(1)), F.lit(-1))
    return blank_to_null(F.upper(F.trim(F.coalesce(tagged, last))))


def type_tag(asset: Column) -> Column:
    """The first bracketed tag as it is."""
    return part(asset, r"\[([^\[\]]+)\]")


def type_code(tag: Column) -> Column:
    return blank_to_null(F.upper(F.trim(tag)))


def transaction_kind(c: Column) -> Column:
    return F.when(F.lower(c).contains("(partial)"), "S(partial)").otherwise(F.upper(F.left(F.trim(c), F.lit(1))))


def cycle_of(year: Column) -> Column:
    """The even year that a year's money belongs to."""
    return year + F.pmod(year, F.lit(2))


def congress_of(year: Column) -> Column:
    return F.floor((year - 1789) / 2).cast("int") + 1


def org_key(connected: Column, name: Column) -> Column:
    return F.coalesce(blank_to_null(connected), name)


def display_name(official: Column, first: Column, last: Column) -> Column:
    return F.coalesce(blank_to_null(official), F.trim(F.concat_ws(" ", first, last)))


def last_first(filer: Column) -> Column:
    """`Last, First` of what isn't blank."""
    return F.concat_ws(", ", blank_to_null(F.trim(filer["last"])), blank_to_null(F.trim(filer["first"])))


def sample_digits(key: Column, seed: str) -> Column:
    """16 hexadecimal digits that order keys at random, the same everywhere."""
    return F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), key), 256), 1, 16)


def snapshot(*columns: Column) -> Column:
    """A hash of a record's canonical JSON (fields in the order given, nulls written)."""
    return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)


def stratum(pdf_class: Column, code: Column) -> Column:
    return F.struct(F.coalesce(blank_to_null(pdf_class), F.lit("unknown")).alias("pdf_class"), F.when(F.coalesce(code, F.lit("")) == kinds.PTR_TYPE, "ptr").otherwise("other").alias("family"))


def visible_chars(text: Column) -> Column:
    """Characters other than white space."""
    return F.length(F.regexp_replace(text, r"(?U)\s", ""))
