"""String functions as Column expressions, with two-valued null logic where the name says so."""

from __future__ import annotations

import unicodedata
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip_unicode(c: Column) -> Column:
    """Without leading and trailing white space of any kind (`trim` takes off spaces only)."""
    return F.regexp_replace(c, r"^[\s\p{Z}\x{85}\x{1C}-\x{1F}]+|[\s\p{Z}\x{85}\x{1C}-\x{1F}]+$", "")


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def collapse_space(c: Column) -> Column:
    """NUL characters as spaces, runs of white space as one space, trimmed."""
    return F.trim(F.regexp_replace(F.translate(c, "\u0000", " "), r"(?U)\s+", " "))


def contains_ci(hay: Column, needle: str) -> Column:
    """Case-insensitive substring; a null or empty hay never matches, nor is a needle a pattern."""
    return F.coalesce((hay != "") & F.lower(hay).contains(needle.lower()), F.lit(False))


def equals_ci(value: Column, wanted: str) -> Column:
    return F.coalesce(F.upper(value) == wanted.upper(), F.lit(False))


def fold_accents(text: str) -> str:
    """NFKD without combining marks."""
    if text.isascii():
        return text
    return "".join(ch for ch in unicodedata.normalize("NFKD", text) if not unicodedata.combining(ch))


@cache
def _base_letters() -> tuple[str, str]:
    """Letters of the basic plane that decompose into one other letter with or without marks, and that letter."""
    pairs = [(ch, base) for ch in map(chr, [*range(0xA0, 0xD800), *range(0xE000, 0x10000)]) if (base := fold_accents(ch)) != ch and len(base) == 1]
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


def unaccent(c: Column) -> Column:
    """NFKD without combining marks, in generated code: letters are translated, marks of their own taken off.

    What decomposes into several letters (ligatures, Hangul syllables) stays as it is."""
    return F.regexp_replace(F.translate(c, *_base_letters()), r"\p{Mn}+", "")


def norm_name(c: Column) -> Column:
    """For name keys: without accents, trimmed, lower case; punctuation stays."""
    return F.lower(strip_unicode(unaccent(c)))


def slug(c: Column) -> Column:
    """Without accents, other than word characters as spaces, space runs as one hyphen, lower case; null is ''."""
    words = F.regexp_replace(unaccent(F.coalesce(c, F.lit(""))), r"(?U)[^\w\s]", " ")
    return F.lower(F.regexp_replace(strip_unicode(words), r"(?U)\s+", "-"))


def first_token(c: Column) -> Column:
    return F.coalesce(F.try_element_at(F.split(strip_unicode(F.coalesce(c, F.lit(""))), r"(?U)\s+"), F.lit(1)), F.lit(""))


def name_key(state: Column, last: Column, first: Column, suffix: Column) -> Column:
    """`state.last.first[.suffix]` of slugs, with `unk` for no state."""
    return F.concat_ws(".", F.lower(F.coalesce(blank_to_null(state), F.lit("unk"))), slug(last), slug(first_token(first)), blank_to_null(slug(suffix)))
