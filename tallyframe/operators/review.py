"""Review of parsed filings: a stratified sample, verdicts and their staleness, a scorecard."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyframe.functions import values
from tallyframe.operators.predicates import reviewable


def select(filings: DataFrame, sample: float, seed: str = "0") -> DataFrame:
    """`ceil(sample * n)` filings of each stratum, those with the smallest hash of their doc_id; a part of them in order.

    A larger sample of the same seed holds the smaller one. sample <= 0 is empty, >= 1 is all. The size of a stratum comes
    from a count joined by value; only rows that can be among the chosen go through the ranking."""
    rows = filings.where(reviewable(F.col("parse_status"))).withColumn("stratum", values.stratum(F.col("pdf_class"), F.col("filing_type.code")))
    if sample <= 0:
        return rows.limit(0)
    if sample >= 1:
        return rows
    sizes = rows.groupBy("stratum").agg(F.count("*").alias("n")).withColumn("take", F.ceil(F.lit(sample) * F.col("n")))
    keyed = rows.join(F.broadcast(sizes), "stratum").withColumn("u", values.sample_digits(F.col("doc_id"), seed))  # a row for each stratum
    # By the law of large numbers the chosen lie below this bound; where they don't, all rows take part (exact either way).
    bound = (F.col("take") + 8 * F.sqrt("take") + 32) / F.col("n")
    near = F.conv(F.substring("u", 1, 12), 16, 10).cast("double") / float(16**12) <= bound
    enough = keyed.groupBy("stratum").agg((F.count_if(near) >= F.first("take")).alias("enough"))
    kept = keyed.join(F.broadcast(enough), "stratum").where(near | ~F.col("enough"))
    rank = F.row_number().over(Window.partitionBy("stratum").orderBy("u", "doc_id"))
    return kept.withColumn("rank", rank).where(F.col("rank") <= F.col("take")).drop("n", "take", "u", "rank", "enough").orderBy("doc_id")


def snapshot(rows: DataFrame, body: str = "body") -> Column:
    """A hash of each filing with its body (a column, if there is one): another one as soon as either changes."""
    own = sorted(c for c in rows.columns if c not in ("stratum", "snapshot", body))
    parts = [F.struct(*own).alias("filing")] + ([F.col(body).alias("body")] if body in rows.columns else [])
    return values.snapshot(*parts)


def queue(selected: DataFrame, labels: DataFrame, body: str = "body") -> DataFrame:
    """The selected filings with `state`: `open` without a verdict, `stale` if it was given for another record, `done`."""
    seen = with_labels(selected.drop("snapshot"), labels, snapshot(selected, body))
    return seen.withColumn("state", F.when(F.col("snapshot").isNull(), "open").when(F.col("stale"), "stale").otherwise("done"))


def payload(selected: DataFrame, labels: DataFrame, body: str = "body") -> DataFrame:
    """(doc_id, filing, body, verdict, state): what a reviewer is shown of each filing; a missing body or verdict is null."""
    own = [c for c in selected.columns if c not in ("stratum", "snapshot", body)]
    given = labels.select("doc_id", "snapshot", F.struct(*[c for c in labels.columns if c != "doc_id"]).alias("verdict"))
    shown = queue(selected, given, body)
    return shown.select("doc_id", F.struct(*own).alias("filing"), (F.col(body) if body in selected.columns else F.lit(None).cast("string")).alias("body"), "verdict", "state")


def with_labels(selected: DataFrame, labels: DataFrame, snapshot: Column) -> DataFrame:
    """Adds the verdict of each filing and whether it is stale: given for another snapshot of the record."""
    joined = selected.withColumn("current_snapshot", snapshot).join(labels, "doc_id", "left")
    return joined.withColumn("stale", F.col("snapshot").isNotNull() & (F.col("snapshot") != F.col("current_snapshot")))


def scorecard(labelled: DataFrame) -> DataFrame:
    """A row for each stratum and one for all: reviewed, stale, four rates over fresh verdicts, sums of wrong and missing
    entries. A rate without fresh verdicts is null."""
    reviewed = F.col("snapshot").isNotNull()
    fresh = reviewed & ~F.col("stale")
    rate = lambda c: F.try_divide(F.count_if(fresh & F.col(c)).cast("double"), F.count_if(fresh))
    total = lambda c: F.coalesce(F.sum(F.when(fresh, F.col(c))), F.lit(0))
    flat = labelled.withColumn("pdf_class_key", F.col("stratum.pdf_class")).withColumn("family_key", F.col("stratum.family")).withColumn("one", F.struct("pdf_class_key", "family_key"))
    out = flat.rollup("one").agg(
        F.grouping("one").cast("boolean").alias("overall"),
        F.count_if(reviewed).alias("n_reviewed"),
        F.count_if(F.col("stale")).alias("n_stale"),
        rate("is_fully_precise").alias("precise_rate"),
        rate("is_fully_recalled").alias("recalled_rate"),
        rate("is_metadata_accurate").alias("metadata_accurate_rate"),
        rate("is_metadata_fully_complete").alias("metadata_complete_rate"),
        total("n_incorrect_entries").alias("incorrect_entries"),
        total("n_missing_entries").alias("missing_entries"),
    )
    return out.select(F.col("one.pdf_class_key").alias("pdf_class"), F.col("one.family_key").alias("family"), *out.columns[1:])


def review_residual(filings: DataFrame, selected: DataFrame, labels: DataFrame) -> DataFrame:
    """(filings, not_reviewable, selected, unlabelled): what the scorecard doesn't speak of."""
    a = filings.agg(F.count("*").alias("filings"), F.count_if(~reviewable(F.col("parse_status"))).alias("not_reviewable"))
    b = selected.join(labels.select("doc_id", F.lit(True).alias("labelled")), "doc_id", "left").agg(F.count("*").alias("selected"), F.count_if(F.col("labelled").isNull()).alias("unlabelled"))
    return a.join(b)  # one row each


def verdict_is_valid(precise: Column, incorrect: Column, recalled: Column, missing: Column) -> Column:
    """Counts agree with their flags: none wrong exactly if precise, none missing exactly if recalled; null counts do."""
    pair = lambda flag, n: n.isNull() | ((n == 0) == flag)
    return F.coalesce(pair(precise, incorrect) & pair(recalled, missing), F.lit(False))


def latest_labels(labels: DataFrame, order: str = "at") -> DataFrame:
    """One verdict for each filing: the last one given."""
    names = [c for c in labels.columns if c != "doc_id"]
    last = labels.groupBy("doc_id").agg(F.max_by(F.struct(*names), order).alias("v"))
    return last.select("doc_id", *(F.col("v")[c].alias(c) for c in names))
