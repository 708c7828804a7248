"""A sample that stays as it is when the data grow.

Each document has a number in [0, 1) from a salted hash of its key alone, and is chosen if that is below the threshold
of its stratum. A stratum's threshold is its fixed rate, or the one it had before if that was higher: thresholds are
only ever raised. So the choice depends on the key and the stratum alone, neither on partitioning, order nor on how many
other documents there are; rows of later loads can add documents but never remove one, and a stratum that grows gives the
same share of its new documents as of its first ones.

Defined cases
* A document belongs to the stratum of its first entry (lowest load_no, then row_no), whatever later loads say.
* Blank and null keys identify nothing and are never chosen. A null load_no counts as later than all others.
* A stratum without a rate of its own has the default rate; a null stratum is a stratum of its own.
* Earlier thresholds may be given; they are never lowered. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# 15 hexadecimal digits of the hash, exact as a long.
SCALE = float(2**60)


def unit(key: Column, salt: str) -> Column:
    """A number in [0, 1) of the key alone."""
    digits = F.substring(F.sha2(F.concat(F.lit(f"{salt}:"), key), 256), 1, 15)
    return F.conv(digits, 16, 10).cast("long").cast("double") / SCALE


def first_entries(rows: DataFrame, key: str, stratum: Column, load: str = "load_no", row: str = "row_no") -> DataFrame:
    """(key, stratum, load): one row for each document. A map-side aggregate, so repeated entries don't pile up."""
    named = rows.where(F.trim(F.coalesce(F.col(key), F.lit(""))) != "")
    at = F.struct(F.col(load).isNull().alias("late"), F.col(load).alias("load"), F.col(row).alias("row"), stratum.alias("stratum"))
    return named.groupBy(key).agg(F.min(at).alias("first")).select(key, "first.stratum", F.col("first.load").alias("load"))


def rate_of(stratum: Column, rates: Mapping[str, float], default: float) -> Column:
    """The fixed rate of a stratum."""
    if not rates:
        return F.lit(float(default))
    table = F.create_map(*(F.lit(x) for pair in sorted(rates.items()) for x in (pair[0], float(pair[1]))))
    return F.coalesce(F.try_element_at(table, stratum), F.lit(float(default)))


def sample(rows: DataFrame, key: str, stratum: Column, rates: Mapping[str, float], default: float, salt: str, earlier: DataFrame | None = None) -> DataFrame:
    """(key, stratum, threshold) of the chosen documents. earlier: stratum, threshold.

    Keys above the highest of all thresholds can't be chosen and fall out before the shuffle."""
    most = max([default, *rates.values()])
    if earlier is not None:
        most = max(most, earlier.agg(F.max("threshold")).first()[0] or 0.0)
    entries = first_entries(rows.where(unit(F.col(key), salt) < most), key, stratum)
    limit = entries.withColumn("threshold", rate_of(F.col("stratum"), rates, default))
    if earlier is not None:
        # A row for each stratum, and strata are combinations of a few categories.
        before = earlier.groupBy(F.col("stratum").alias("s")).agg(F.max("threshold").alias("before"))
        limit = limit.join(F.broadcast(before), F.col("stratum").eqNullSafe(F.col("s")), "left").withColumn("threshold", F.greatest("threshold", "before"))
    return limit.where(unit(F.col(key), salt) < F.col("threshold")).select(key, "stratum", "threshold")


def thresholds(chosen: DataFrame) -> DataFrame:
    """(stratum, threshold) of a sample, to be given as `earlier` when rates change."""
    return chosen.groupBy("stratum").agg(F.max("threshold").alias("threshold"))
