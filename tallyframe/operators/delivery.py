"""At-least-once deliveries: keep exactly one of each.

Identifiers that a producer numbers in sequence (a prefix and a number, such as `SE24.17`) need no list of what was
seen: per producer the seen numbers form a few disjoint ranges. Deliveries are taken in order of arrival; a number that
no range covers is accepted once and merged into the ranges, a covered one is surplus. Identifiers without a usable
number (hexadecimal ids and the like) are looked up exactly by key. What was seen is an ordinary table of ranges and
keys that the next batch takes up again.

Defined cases
* Identifiers are compared without surrounding white space of any kind (also no-break spaces) and regardless of case.
* The producer's serial (file_num) is compared as a number; where it isn't one, as trimmed text in upper case.
* A blank or null tran_id identifies nothing: the row is always kept. A null amndt_ind agrees with a blank one, a null
  file_num with a blank one.
* Of one expenditure in a batch the earliest received_at is kept (null last), then the lowest delivery_no. What an
  earlier batch accepted stays accepted.
* Other columns may be null, differ or have any name; they play no part.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.functions.text import strip_unicode
from tallyframe.session import ship

# Numbers of one producer that share a block form one group, so that no producer's numbers gather in one task.
BLOCK_BITS = 12

_PRODUCER = ["serial", "version", "prefix", "block"]
_EXACT = ["serial", "version", "ident"]

# state: 0 a range seen before (number..hi), 1 a delivery to be decided, 2 a surplus delivery, 3 a range seen now.
_FOLD = T.StructType(
    [
        T.StructField("serial", T.StringType()),
        T.StructField("version", T.StringType()),
        T.StructField("prefix", T.StringType()),
        T.StructField("block", T.LongType()),
        T.StructField("number", T.LongType()),
        T.StructField("hi", T.LongType()),
        T.StructField("at", T.LongType()),
        T.StructField("row", T.LongType()),
        T.StructField("state", T.IntegerType()),
    ]
)


@dataclass
class Seen:
    """What was accepted so far: disjoint ranges of sequence numbers, and exact keys."""

    ranges: DataFrame  # serial, version, prefix, block, lo, hi
    exact: DataFrame  # serial, version, ident


class RangeSet:
    """Disjoint, never adjacent ranges of integers."""

    def __init__(self) -> None:
        self.lo: list[int] = []
        self.hi: list[int] = []

    def add(self, lo: int, hi: int) -> bool:
        """Merges lo..hi into the ranges; false if it was covered already."""
        starts, ends = self.lo, self.hi
        i = bisect_right(starts, lo) - 1
        if i >= 0 and ends[i] >= hi:
            return False
        if i < 0 or ends[i] < lo - 1:
            i += 1
            starts.insert(i, lo)
            ends.insert(i, hi)
        else:
            ends[i] = hi
        j = i + 1
        while j < len(starts) and starts[j] <= ends[i] + 1:
            ends[i] = max(ends[i], ends[j])
            j += 1
        del starts[i + 1 : j], ends[i + 1 : j]
        return True


def serial_number(c: Column) -> Column:
    """A file number as a number, `2000287.0` and `0002000287` alike; other text stays text."""
    raw = F.upper(strip_unicode(F.coalesce(c, F.lit(""))))
    whole = F.regexp_extract(raw, r"^[+]?0*([0-9]+?)(?:[.]0*)?$", 1)
    # Rarer spellings (fractions, exponents) go through a decimal; the plain ones don't need to.
    decimal = F.when(raw.rlike(r"^[+-]?(?:[0-9]+[.]?[0-9]*|[.][0-9]+)(?:E[+-]?[0-9]{1,2})?$"), raw.try_cast(T.DecimalType(38, 6)))
    plain = F.regexp_replace(decimal.cast("string"), r"[.]?0+$", "")
    return F.when(whole != "", whole).otherwise(F.coalesce(F.when(decimal == 0, F.lit("0")), plain, raw))


def identify(df: DataFrame, serial: str = "file_num", ident: str = "tran_id", version: str = "amndt_ind") -> DataFrame:
    """Adds serial, version, ident (canonical), and of sequence identifiers prefix, number and block."""
    digits = F.regexp_extract("ident", r"(?:^|[^0-9])([0-9]{1,12})$", 1)
    head = F.expr("substring(ident, 1, length(ident) - length(digits))")
    # 0007 and 7 are different identifiers, so the width of a padded number is part of its prefix.
    width = F.when(digits.startswith("0"), F.length(digits)).otherwise(0)
    # Hexadecimal runs are no sequences; nearly each would be a producer of its own.
    usable = (digits != "") & ~F.col("ident").rlike(r"^[A-F0-9]{13,}$")
    return (
        df.withColumn("serial", serial_number(F.col(serial)))
        .withColumn("version", F.upper(strip_unicode(F.coalesce(F.col(version), F.lit("")))))
        .withColumn("ident", F.upper(strip_unicode(F.coalesce(F.col(ident), F.lit("")))))
        .withColumn("digits", digits)
        .withColumn("number", F.when(usable, digits.cast("long")))
        .withColumn("prefix", F.when(usable, F.concat_ws("#", head, width.cast("string"))))
        .withColumn("block", F.shiftright("number", BLOCK_BITS))
        .drop("digits")
    )


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over rows sorted by producer, then state and arrival: decides each delivery by the producer's ranges.

    Gives the deliveries out again, surplus ones with state 2, and at the end of each producer its ranges."""
    key, seen = None, RangeSet()
    arrow = pa.schema([(f.name, pa.string() if f.dataType == T.StringType() else pa.int32() if f.name == "state" else pa.int64()) for f in _FOLD])

    def ranges(rows: list) -> None:
        if key is not None and key[0] is not None:
            rows.extend((*key, lo, hi, None, None, 3) for lo, hi in zip(seen.lo, seen.hi))

    for batch in batches:
        rows: list[tuple] = []
        for r in zip(*(c.to_pylist() for c in batch.columns)):
            if r[8] == 2:
                rows.append(r)
                continue
            if (k := r[:4]) != key:
                ranges(rows)
                key, seen = k, RangeSet()
            if r[8] == 0:
                seen.add(r[4], r[5])
            else:
                rows.append(r if seen.add(r[4], r[4]) else (*r[:8], 2))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)], schema=arrow)
    last: list[tuple] = []
    ranges(last)
    if last:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*last), arrow)], schema=arrow)


def fold_ranges(known: DataFrame, seen: DataFrame | None = None) -> DataFrame:
    """Sequence deliveries (`_FOLD`, state 1) decided by ranges; `seen`: ranges of earlier batches.

    The fold runs twice: within each input partition, where all but the first delivery of a number fall out, and then
    per producer and block. So a number that a third of the rows carry sends one row of each partition through the
    shuffle; surplus rows are spread by their row id instead of their producer."""
    ship(known.sparkSession)
    order = [*_PRODUCER, "state", F.col("at").asc_nulls_last(), "row"]
    local = known.sortWithinPartitions(*order).mapInArrow(_fold, _FOLD).where("state < 3")
    if seen is not None:
        local = local.unionByName(seen.select(*_PRODUCER, F.col("lo").alias("number"), "hi", F.lit(None).cast("long").alias("at"), F.lit(None).cast("long").alias("row"), F.lit(0).alias("state")))
    spread = F.when(F.col("state") == 2, F.xxhash64("row")).otherwise(F.xxhash64(*_PRODUCER))
    return local.repartition(spread).sortWithinPartitions(*order).mapInArrow(_fold, _FOLD)


def split_deliveries(df: DataFrame, seen: Seen | None = None, at: str = "received_at", row: str = "delivery_no") -> tuple[DataFrame, Seen]:
    """(row ids of the surplus deliveries, what was seen after this batch)."""
    narrow = identify(df.select("file_num", "tran_id", "amndt_ind", F.unix_micros(F.col(at).cast("timestamp")).alias("at"), F.col(row).cast("long").alias("row")))
    named = narrow.where("ident <> ''")

    known = named.where("number IS NOT NULL").select(*_PRODUCER, "number", F.col("number").alias("hi"), "at", "row", F.lit(1).alias("state"))
    folded = fold_ranges(known, seen.ranges if seen else None)

    odd = named.where("number IS NULL")
    first = F.min(F.struct(F.col("at").isNull(), F.col("at"), F.col("row")))["row"].alias("row")
    winners = odd.groupBy(*_EXACT).agg(first)
    if seen is not None:
        winners = winners.join(seen.exact, _EXACT, "left_anti")
    exact = winners.select(*_EXACT) if seen is None else seen.exact.select(*_EXACT).unionByName(winners.select(*_EXACT))
    unaccepted = odd.select("row").join(winners.select("row"), "row", "left_anti")

    surplus = folded.where("state = 2").select("row").unionByName(unaccepted)
    ranges = folded.where("state = 3").select(*_PRODUCER, F.col("number").alias("lo"), "hi")
    return surplus.select(F.col("row").alias(row)), Seen(ranges, exact)


def surplus_deliveries(df: DataFrame, seen: Seen | None = None, at: str = "received_at", row: str = "delivery_no") -> DataFrame:
    """The row ids of all surplus deliveries."""
    return split_deliveries(df, seen, at, row)[0]


def deliver_once(df: DataFrame, seen: Seen | None = None, at: str = "received_at", row: str = "delivery_no") -> DataFrame:
    """The rows to keep, with all their columns (row ids must be unique)."""
    return df.join(surplus_deliveries(df, seen, at, row), row, "left_anti")
