"""Streams of deliveries and filings (beyond the batch queries): each micro-batch goes through the batch operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyframe.operators.delivery import Seen, identify, split_deliveries
from tallyframe.session import cut_lineage

_RANGES = "serial string, version string, prefix string, block long, lo long, hi long"
_EXACT = "serial string, version string, ident string"


# Every so many batches the state is written whole, so that reading it never goes over more batches than that.
WHOLE_EVERY = 20


def deliver_stream(deliveries: DataFrame, out: str, state: str, checkpoint: str, at: str = "received_at", row: str = "delivery_no", available_now: bool = True) -> StreamingQuery:
    """Appends each expenditure once to `out`, over all batches. What was seen is a table of ranges and keys below `state`.

    A batch reads what was seen of its own blocks and keys, and writes those alone: its cost goes with the batch, not with
    the history. A batch that is run again replaces what it had written and reads what stood before it."""

    def one(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        batch = cut_lineage(batch)
        seen = _seen(spark, state, number, batch)
        surplus, after = split_deliveries(batch, seen, at, row)
        kept = batch.join(surplus.distinct(), row, "left_anti").withColumn("batch", F.lit(number))
        kept.write.mode("overwrite").parquet(f"{out}/batch={number}")
        after.ranges.write.mode("overwrite").parquet(f"{state}/{number}/ranges")
        fresh = after.exact if seen is None else after.exact.join(seen.exact, _KEY, "left_anti")
        fresh.write.mode("overwrite").parquet(f"{state}/{number}/exact")
        if (number + 1) % WHOLE_EVERY == 0:
            ranges, exact = _newest(spark, state, number + 1)
            ranges.write.mode("overwrite").parquet(f"{state}/{number}/whole/ranges")
            exact.write.mode("overwrite").parquet(f"{state}/{number}/whole/exact")

    writer = deliveries.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


_BLOCK, _KEY = ["serial", "version", "prefix", "block"], ["serial", "version", "ident"]


def _newest(spark: SparkSession, state: str, number: int) -> tuple[DataFrame, DataFrame]:
    """(ranges, exact keys) after all batches before this one: of each block those of the last batch that touched it."""
    start = number // WHOLE_EVERY * WHOLE_EVERY if number % WHOLE_EVERY else number - WHOLE_EVERY
    read = lambda part, schema: reduce(
        DataFrame.unionByName,
        [spark.read.schema(schema).parquet(f"{state}/{n}/{'whole/' if n < start else ''}{part}").withColumn("n", F.lit(n)) for n in range(max(0, start - 1), number)],
    )
    ranges, exact = read("ranges", _RANGES), read("exact", _EXACT)
    last = ranges.groupBy(*_BLOCK).agg(F.max("n").alias("n"))
    return ranges.join(last, [*_BLOCK, "n"], "left_semi").drop("n"), exact.drop("n")


def _seen(spark: SparkSession, state: str, number: int, batch: DataFrame) -> Seen | None:
    if number == 0:
        return None
    ranges, exact = _newest(spark, state, number)
    named = identify(batch.select("file_num", "tran_id", "amndt_ind"))
    return Seen(ranges.join(named.select(*_BLOCK).distinct(), _BLOCK, "left_semi"), exact.join(named.select(*_KEY).distinct(), _KEY, "left_semi"))


def first_within(deliveries: DataFrame, key: str, at: str, delay: str) -> DataFrame:
    """The first row of each key within a watermark: bounded state for streams that repeat soon or never."""
    return deliveries.withWatermark(at, delay).dropDuplicatesWithinWatermark([key])


def windowed_counts(filings: DataFrame, at: str, delay: str, width: str) -> DataFrame:
    """Filings by class in windows of their load time; late ones count until the watermark has passed."""
    return filings.withWatermark(at, delay).groupBy(F.window(at, width), "pdf_class").agg(F.count("*").alias("n"))
