"""What a caller may ask for: years, cycles, types; and where files are."""

from __future__ import annotations

import re
from collections.abc import Iterable

FIRST_YEAR = 2008


class BadRange(ValueError):
    """A range of years that can't be served."""


def years(text: str, current: int) -> list[int]:
    """`2020`, `2018-2021` or `2018-` (to the current year), within what exists."""
    m = re.fullmatch(r"\s*(\d{4})(?:\s*(-)\s*(\d{4})?)?\s*", text)
    if not m:
        raise BadRange(f"not a year or range of years: {text!r}")
    first = int(m[1])
    last = int(m[3]) if m[3] else current if m[2] else first
    if first > last:
        raise BadRange(f"the range {text!r} runs backwards")
    if first < FIRST_YEAR or last > current:
        raise BadRange(f"years are from {FIRST_YEAR} to {current}")
    return list(range(first, last + 1))


def cycles(wanted: Iterable[int]) -> list[int]:
    """The even years that the years' money belongs to."""
    return sorted({y + y % 2 for y in wanted})


def families(text: str | None) -> set[str] | None:
    """`ptr`, `fd` or both; nothing means both."""
    if not text:
        return None
    found = {t.strip().lower() for t in text.split(",") if t.strip()}
    if bad := found - {"ptr", "fd"}:
        raise ValueError(f"unknown types: {', '.join(sorted(bad))}")
    return found


# The bulk files of a cycle, of which only the last one's name has the year in full.
BULK_FILES = {"master": "cm{0:02d}.zip", "linkage": "ccl{0:02d}.zip", "contributions": "pas2{0:02d}.zip", "expenditures": "independent_expenditure_{1}.csv"}


def bulk_name(what: str, cycle: int) -> str:
    """`cm24.zip` and the like: the name of a cycle's bulk file."""
    return BULK_FILES[what].format(cycle % 100, cycle)
