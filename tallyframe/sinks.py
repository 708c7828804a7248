"""Writing tables, manifests and text for people."""

from __future__ import annotations

import itertools
import json
from collections.abc import Iterable, Iterator, Sequence

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F


def write_partitions(df: DataFrame, path: str, *by: str) -> None:
    """Replaces exactly the partitions that df has; rows of a partition parsed again can't go stale, others stay."""
    (df.repartition(*by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path))


def write_manifest(counts: DataFrame, residual: DataFrame, path: str) -> None:
    """Counts and the reason-coded residual beside a table."""
    counts.write.mode("overwrite").json(f"{path}/counts")
    residual.write.mode("overwrite").json(f"{path}/residual")


def canonical(value) -> str:
    """JSON text with sorted keys, two spaces and an end of line: the same bytes for the same value."""
    return json.dumps(value, indent=2, sort_keys=True, ensure_ascii=False, default=str) + "\n"


def json_chunks(rows: Iterable[Row]) -> Iterator[str]:
    """The text of one JSON array, a record at a time; the same bytes as `canonical` of the whole list."""
    first = True
    for r in rows:
        record = canonical(_plain(r.asDict(recursive=True))).rstrip("\n")
        yield ("[\n" if first else ",\n") + "\n".join(f"  {line}" for line in record.split("\n"))
        first = False
    yield "[]\n" if first else "\n]\n"


def as_json(df: DataFrame, limit: int | None = None) -> Iterator[str]:
    """The rows of an ordered answer as one JSON array, record by record; the driver holds one partition at a time."""
    yield from json_chunks((df.limit(limit) if limit is not None else df).toLocalIterator())


def _plain(record: dict) -> dict:
    return {k: (_plain(v) if isinstance(v, dict) else v) for k, v in record.items()}


def shown(value) -> str:
    return "" if value is None else f"{value:.2f}" if isinstance(value, float) else str(value)


def table_lines(columns: Sequence[str], rows: Iterable[Row | Sequence], widths: Sequence[int]) -> Iterator[str]:
    """Left-aligned columns of given widths, two spaces apart, without spaces at line ends."""
    for r in itertools.chain([columns], rows):
        yield "  ".join(shown(v).ljust(w) for v, w in zip(r, widths)).rstrip() + "\n"


def as_table(df: DataFrame, limit: int | None = None) -> Iterator[str]:
    """The rows of an answer as a text table, line by line; the widths come from one aggregate."""
    df = df.limit(limit) if limit is not None else df
    text = [F.format_string("%.2f", F.col(c)) if kind in ("double", "float") else F.col(c).cast("string") for c, kind in ((f"`{c}`", k) for c, k in df.dtypes)]
    most = df.agg(*(F.max(F.length(t)).alias(f"w{i}") for i, t in enumerate(text))).first()
    yield from table_lines(df.columns, df.toLocalIterator(), [max(len(c), n or 0) for c, n in zip(df.columns, most)])


def upsert(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """The old rows with those of the new keys replaced."""
    return old.join(new.select(key).distinct(), key, "left_anti").unionByName(new)


def fingerprint(df: DataFrame) -> str:
    """A hash of a table's content that doesn't depend on the order of its rows."""
    row = F.xxhash64(*(F.col(c).cast("string") for c in sorted(df.columns)))
    total, n = df.agg(F.sum((row / F.lit(2)).cast("decimal(38,0)")), F.count("*")).first()
    return f"{total}:{n}"
