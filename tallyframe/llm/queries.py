"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyframe.llm import linkage, packing, quota, stable, tokens, truncation, variants
from tallyframe.session import cut_lineage, table


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return linkage.found(table(spark, d, "filings"), table(spark, d, "legislators_current"))


def p1_linked(spark: SparkSession, d: str) -> DataFrame:
    """All best candidates with their confidence, accepted or not."""
    return linkage.link(table(spark, d, "filings"), table(spark, d, "legislators_current"))


DIMENSIONS = {"pdf_class": F.col, "code": lambda _: F.col("filing_type.code"), "parse_status": F.col}
SAMPLE_SIZE = 1000


def _dimensions() -> dict:
    return {name: column(name) for name, column in DIMENSIONS.items()}


def p2_sample(spark: SparkSession, d: str) -> DataFrame:
    """The reviewer's sample."""
    return quota.draw(table(spark, d, "filings"), _dimensions(), table(spark, d, "sample_targets"), SAMPLE_SIZE)


def p2_report(spark: SparkSession, d: str) -> DataFrame:
    """Each target with what was available and sampled."""
    return quota.plan(table(spark, d, "filings"), _dimensions(), table(spark, d, "sample_targets"), SAMPLE_SIZE)[1]


def _stratum():
    return F.concat_ws("/", F.coalesce("pdf_class", F.lit("unknown")), F.when(F.col("filing_type.code") == "P", "ptr").otherwise("other"))


# Fixed rates: a tenth of the filings with a text layer, a fifth of the rarer classes.
RATES, OTHER_RATE = {"efiled/ptr": 0.1, "efiled/other": 0.1}, 0.2


def p3_sample(spark: SparkSession, d: str) -> DataFrame:
    return stable.sample(table(spark, d, "filings"), "doc_id", _stratum(), RATES, OTHER_RATE, "review")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return variants.found_pairs(table(spark, d, "parse_manifest"), table(spark, d, "legislators_current"))


def p5_persons(spark: SparkSession, d: str) -> DataFrame:
    """The membership behind p5_found: one row for each entry with its person."""
    return variants.persons(table(spark, d, "parse_manifest"), table(spark, d, "legislators_current"))


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    return tokens.encode(table(spark, d, "documents"))


def p9_filled(spark: SparkSession, d: str) -> DataFrame:
    return packing.fill(table(spark, d, "documents"), capacity=2048)


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return truncation.found(table(spark, d, "documents"))


def p10_rates(spark: SparkSession, d: str) -> DataFrame:
    return truncation.rates(table(spark, d, "documents"))


# ---- what must hold of the results, held against SQL over the tables


def _violations(df: DataFrame, **checks) -> DataFrame:
    """(rule, n): how many rows break each rule."""
    row = df.agg(*(F.count_if(c).alias(name) for name, c in checks.items()))
    return row.select(F.explode(F.array(*(F.struct(F.lit(n).alias("rule"), F.col(n).alias("n")) for n in checks))).alias("x")).select("x.*")


def p1_checked(spark: SparkSession, d: str) -> DataFrame:
    f, people = table(spark, d, "filings"), table(spark, d, "legislators_current")
    known = people.select(F.col("id.bioguide").alias("bioguide"), F.col("terms"))
    rows = p1_found(spark, d).join(f.select("row_no", "bioguide_id", "state_district", "coverage_year"), "row_no", "left").join(known, "bioguide", "left")
    held = F.exists("terms", lambda t: F.col("coverage_year").between(F.year(t["start"]), F.year(t["start"]) + 1))
    there = F.col("state_district.state").isNull() | F.exists("terms", lambda t: t["state"] == F.upper("state_district.state"))
    return _violations(rows, had_an_id=F.col("bioguide_id").isNotNull(), no_seat_that_year=~F.coalesce(held, F.lit(False)), another_state=~F.coalesce(there, F.lit(False)))


def p2_checked(spark: SparkSession, d: str) -> DataFrame:
    """Each target with what there is, and whether report and sample agree."""
    report, sample = p2_report(spark, d).where("dimension <> 'sample'"), p2_sample(spark, d)
    drawn = sample.select(F.explode(F.array(*(F.struct(F.lit(c).alias("dim"), F.col(c).alias("cat")) for c in DIMENSIONS))).alias("x")).select("x.*").groupBy("dim", "cat").agg(F.count("*").alias("drawn"))
    joined = report.join(F.broadcast(drawn), (F.col("dimension") == F.col("dim")) & F.col("category").eqNullSafe(F.col("cat")), "left")  # a row for each category
    return joined.select("dimension", "category", "available", "target_rows", (F.coalesce("drawn", F.lit(0)) == F.col("sampled")).alias("agrees"), (F.col("sampled") <= F.col("available")).alias("available_only"))


def p5_checked(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "parse_manifest")
    state = F.nullif(F.regexp_extract("filer_id", r"^name:([a-z]+)\.", 1), F.lit(""))
    side = lambda s: e.select(F.col("entry_no").alias(f"entry_no_{s}"), F.col("parse_run").alias(f"run_{s}"), F.nullif(state, F.lit("unk")).alias(f"state_{s}"))
    rows = p5_found(spark, d).join(side("a"), "entry_no_a", "left").join(side("b"), "entry_no_b", "left")
    return _violations(rows, another_run=~F.coalesce(F.col("run_a") == F.col("run_b"), F.lit(False)), another_state=F.coalesce(F.col("state_a") != F.col("state_b"), F.lit(False)), not_smaller_first=F.col("entry_no_a") >= F.col("entry_no_b"))


def p9_checked(spark: SparkSession, d: str) -> DataFrame:
    """(rule, n): texts, texts without tokens, and what may not be: too full, overlapping, split in vain, copies together."""
    docs, filled = table(spark, d, "documents"), cut_lineage(p9_filled(spark, d))
    texts = filled.groupBy("doc_id").agg(F.count("*").alias("pieces"), F.max("n_tokens").alias("most"), F.min("n_tokens").alias("least"))
    one = _violations(texts, texts=F.lit(True), without_tokens=F.col("most") == 0, split_in_vain=(F.col("pieces") > 1) & (F.col("most") < 2048))
    kept = filled.where("container IS NOT NULL")
    before = F.max(F.col("offset") + F.col("n_tokens")).over(Window.partitionBy("container").orderBy("offset").rowsBetween(Window.unboundedPreceding, -1))
    placed = kept.withColumn("before", before)
    two = _violations(placed, too_full=F.col("offset") + F.col("n_tokens") > 2048, overlapping=F.col("before") > F.col("offset"))
    copies = kept.select("doc_id", "container").distinct().join(docs.select("doc_id", packing.duplicate_cluster(F.col("text")).alias("cluster")), "doc_id").groupBy("container", "cluster").agg(F.count("*").alias("k"))
    return one.unionByName(two).unionByName(_violations(copies, copies_together=F.col("k") > 1))


def p10_checked(spark: SparkSession, d: str) -> DataFrame:
    """Each source with its texts, and whether the rate is that of the texts found."""
    docs = table(spark, d, "documents").select("doc_id", F.col("source").alias("s"))
    found = p10_found(spark, d).join(docs, "doc_id").groupBy("s").agg(F.count("*").alias("found"))
    rates = p10_rates(spark, d).join(F.broadcast(found), F.col("source").eqNullSafe(F.col("s")), "left")  # a row for each source
    n = F.coalesce("found", F.lit(0))
    return rates.select("source", "texts", ((F.col("cut") == n) & (F.abs(F.col("rate") - n / F.col("texts")) < 1e-5) & (F.col("at_limit") <= F.col("cut"))).alias("agrees"))


QUERIES = {f.__name__: f for f in (p1_found, p1_linked, p1_checked, p2_sample, p2_report, p2_checked, p3_sample, p5_found, p5_persons, p5_checked, p8_ids, p9_filled, p9_checked, p10_found, p10_rates, p10_checked)}
_NONE = lambda *rules: " UNION ALL ".join(f"SELECT '{r}' AS rule, 0 AS n" for r in rules)
ORACLE = {
    "p1_checked": _NONE("had_an_id", "no_seat_that_year", "another_state"),
    "p2_checked": """
WITH x AS (SELECT pdf_class, filing_type.code AS code, parse_status FROM filings),
long AS (SELECT 'pdf_class' AS dimension, pdf_class AS category FROM x UNION ALL SELECT 'code', code FROM x UNION ALL SELECT 'parse_status', parse_status FROM x),
n AS (SELECT dimension, category, count(*) AS available FROM long GROUP BY ALL)
SELECT t.dimension, t.category, coalesce(n.available, 0) AS available, round(target_share * 1000 / sum(target_share) OVER (PARTITION BY t.dimension), 6) AS target_rows, true AS agrees, true AS available_only
FROM sample_targets t LEFT JOIN n ON t.dimension = n.dimension AND t.category IS NOT DISTINCT FROM n.category
""",
    "p5_checked": _NONE("another_run", "another_state", "not_smaller_first"),
    "p9_checked": "SELECT 'texts' AS rule, count(*) AS n FROM documents UNION ALL SELECT 'without_tokens', count(*) FROM documents WHERE coalesce(text, '') = '' UNION ALL " + _NONE("split_in_vain", "too_full", "overlapping", "copies_together"),
    "p10_checked": r"SELECT source, count(*) AS texts, true AS agrees FROM documents WHERE regexp_replace(text, '[\s\p{Z}\p{Cc}\p{Cf}]', '', 'g') <> '' GROUP BY 1",
    "p3_sample": """
WITH doc AS (
  SELECT doc_id, arg_min(concat_ws('/', coalesce(pdf_class, 'unknown'), CASE WHEN filing_type.code = 'P' THEN 'ptr' ELSE 'other' END), (load_no IS NULL, coalesce(load_no, 0), row_no)) AS stratum
  FROM filings WHERE trim(coalesce(doc_id, '')) <> '' GROUP BY 1)
SELECT doc_id, stratum, CASE WHEN starts_with(stratum, 'efiled/') THEN 0.1::DOUBLE ELSE 0.2::DOUBLE END AS threshold FROM doc
WHERE CAST(('0x' || substr(sha256('review:' || doc_id), 1, 15))::BIGINT AS DOUBLE) / 1152921504606846976.0 < threshold
""",
}
