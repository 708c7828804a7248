"""Questions and parses from the command line: rows to stdout as JSON or a table, guarantee and residual to stderr.

Exit codes: 0 answered, 1 the data can't answer (nothing there), 2 bad arguments."""

from __future__ import annotations

import argparse
import os
import sys
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe import sinks
from tallyframe import types as kinds
from tallyframe.functions import values
from tallyframe.operators import directory, quality, reshape, residuals, review
from tallyframe.operators.predicates import FilingFilter, HoldingFilter, TradeFilter
from tallyframe.plans import answers, pipelines
from tallyframe.session import local_session, table
from tallyframe.sources import files, parameters


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tallyframe", description=__doc__.splitlines()[0])
    p.add_argument("--data", required=True, help="folder of the tables")
    p.add_argument("--table", action="store_true", help="a table instead of JSON")
    p.add_argument("--limit", type=int)
    verbs = p.add_subparsers(dest="verb", required=True)

    def ranged(name: str, note: str, *options: str) -> argparse.ArgumentParser:
        v = verbs.add_parser(name, help=note)
        v.add_argument("years", help="2020, 2018-2021 or 2018-")
        for o in ("--member", "--bioguide", *options):
            v.add_argument(o)
        return v

    def dated(v: argparse.ArgumentParser) -> argparse.ArgumentParser:
        v.add_argument("--since", type=date.fromisoformat)
        v.add_argument("--until", type=date.fromisoformat)
        return v

    dated(ranged("filings", "filings of some years", "--state")).add_argument("--type", dest="filing_type")
    t = dated(ranged("trades", "transactions of some years", "--ticker", "--asset", "--owner"))
    t.add_argument("--type", dest="transaction_type")
    t.add_argument("--min-amount", type=float)
    h = ranged("holdings", "Schedule A of some years", "--asset", "--owner", "--asset-type")
    h.add_argument("--min-value", type=float)
    verbs.add_parser("summary", help="counts by year").add_argument("years")
    verbs.add_parser("filing", help="one filing with its body").add_argument("doc_id")
    m = verbs.add_parser("members", help="legislators by name or id, or their seats on committees")
    m.add_argument("needle")
    m.add_argument("--committees", action="store_true")
    m.add_argument("--congress", type=int)
    m.add_argument("--year", type=int)
    d = verbs.add_parser("donors", help="who gave to a member")
    d.add_argument("member")
    d.add_argument("years")
    d.add_argument("--organization-type", choices=sorted(kinds.ORGANISATIONS.values()))
    g = verbs.add_parser("pac", help="to whom an organisation gave")
    g.add_argument("organization")
    g.add_argument("years")
    i = verbs.add_parser("inspect", help="the reviewer's queue of a year")
    i.add_argument("years")
    i.add_argument("--sample", type=float, default=0.01)
    i.add_argument("--seed", default="0")
    i.add_argument("--scorecard", action="store_true", help="what the verdicts given so far say")
    verbs.add_parser("check", help="invariants of the stored transactions").add_argument("years")
    f = verbs.add_parser("parse-money", help="bulk files of a cycle to tables")
    f.add_argument("cycle", type=int)
    c = verbs.add_parser("parse-filings", help="an index and its pages to tables")
    c.add_argument("year", type=int)
    c.add_argument("--types", help="ptr, fd or both")
    for v in (f, c):
        v.add_argument("--raw", required=True, help="folder of the raw files")
    return p


def _years(a: argparse.Namespace, rows: DataFrame, column: str, wanted: list[int], what: str) -> DataFrame:
    found, skipped = answers.require(answers.partitions(rows, column), wanted, what)
    if skipped:
        print(f"no data for {', '.join(map(str, skipped))}", file=sys.stderr)
    return rows.where(F.col(column).isin(found))


def _committee_seats(spark: SparkSession, a: argparse.Namespace) -> answers.Answer:
    congress = a.congress if a.congress is not None else (a.year - 1789) // 2 + 1 if a.year is not None else None
    paths = [os.path.join(a.data, f"committee_{x}.json") for x in ("definitions", "membership")]
    definitions, membership = files.committees(spark, *paths)
    legislators = table(spark, a.data, "legislators_current")
    rows = directory.search_committees(legislators, definitions, membership, a.needle, congress)
    return answers.Answer(rows.select("name", "bioguide", "code", "committee", "subcommittee", "rank", "title"), answers.CEILING, legislators.agg(F.count("*").alias("searched")))


def _money_tables(spark: SparkSession, a: argparse.Namespace, current: int) -> list[DataFrame]:
    wanted = parameters.cycles(parameters.years(a.years, current))
    return [_years(a, table(spark, a.data, name), "cycle", wanted, "cycle") for name in ("contributions", "committees", "member_links")]


def _inspect(spark: SparkSession, a: argparse.Namespace, filings: DataFrame) -> answers.Answer:
    current = reshape.current_filings(filings)
    chosen = review.select(current, a.sample, a.seed)
    bodies = reshape.latest(table(spark, a.data, "ptr"), ["coverage_year", "doc_id"], "body_id").select("coverage_year", "doc_id", F.col("transactions").alias("body"))
    chosen = chosen.join(bodies, ["coverage_year", "doc_id"], "left")
    path = f"{a.data}/verdicts.parquet"
    labels = review.latest_labels(spark.read.parquet(path)) if os.path.exists(path) else spark.createDataFrame([], kinds.VERDICTS)
    same, other = files.versioned(labels, kinds.LABELS_VERSION) if "schema_version" in labels.columns else (labels, labels.limit(0))
    if not other.isEmpty():
        print(f"verdicts of another version than {kinds.LABELS_VERSION} are left out", file=sys.stderr)
    same = same.drop("schema_version")
    residual = review.review_residual(current, chosen, same)
    if a.scorecard:
        return answers.Answer(review.scorecard(review.with_labels(chosen, same, review.snapshot(chosen))), answers.NONE, residual)
    return answers.Answer(review.payload(chosen, same).orderBy("doc_id"), answers.NONE, residual)


def _parse_money(spark: SparkSession, a: argparse.Namespace) -> answers.Answer:
    """Reads cm.txt, ccl.txt, itpas2.txt and the headed expenditures of a cycle; writes a partition of each table."""
    at = lambda name: os.path.join(a.raw, name)
    if missing := [n for n in ("cm.txt", "ccl.txt", "itpas2.txt", parameters.bulk_name("expenditures", a.cycle)) if not os.path.exists(at(n))]:
        raise answers.NoData(f"missing in {a.raw}: {', '.join(missing)}")
    master, linkage, pas2 = (files.pipe_rows(spark, at(n)) for n in ("cm.txt", "ccl.txt", "itpas2.txt"))
    spent = files.headed_csv(spark, at(parameters.bulk_name("expenditures", a.cycle)), files.EXPENDITURE_COLUMNS).withColumn("row", F.monotonically_increasing_id())
    m = pipelines.parse_money(master, linkage, pas2, spent, table(spark, a.data, "legislators_current"), order="row")
    for name, rows in (("contributions", m.contributions), ("committees", m.committees), ("member_links", m.links.withColumn("row", F.col("candidate_id"))), ("expenditures", m.expenditures), ("limit_breaches", m.breaches)):
        sinks.write_partitions(rows.withColumn("cycle", F.lit(a.cycle)), f"{a.data}/{name}.parquet", "cycle")
    sinks.write_manifest(m.counters, m.residual, f"{a.data}/manifest-money-{a.cycle}")
    return answers.Answer(m.counters, answers.FLOOR, m.residual.groupBy("what", "reason").agg(F.count("*").alias("n")))


def _parse_filings(spark: SparkSession, a: argparse.Namespace, current: int) -> answers.Answer:
    """Reads index.xml and pages.parquet (doc_id, text); writes a partition of filings, unparsed and identity warnings."""
    index, pages = os.path.join(a.raw, "index.xml"), os.path.join(a.raw, "pages.parquet")
    if missing := [p for p in (index, pages) if not os.path.exists(p)]:
        raise answers.NoData(f"missing: {', '.join(missing)}")
    filings = files.filings_from_index(files.index_entries(spark, index), a.year, current + 1).withColumn("row_no", F.monotonically_increasing_id())
    y = pipelines.parse_filings(filings, spark.read.parquet(pages), table(spark, a.data, "legislators_current"), latest=current + 1, families=parameters.families(a.types))
    by_year = lambda df: df.withColumn("coverage_year", F.lit(a.year))
    sinks.write_partitions(by_year(y.filings.drop("year")), f"{a.data}/parsed_filings.parquet", "coverage_year")
    sinks.write_partitions(by_year(y.unparsed), f"{a.data}/unparsed.parquet", "coverage_year")
    sinks.write_partitions(by_year(y.warnings), f"{a.data}/identity_warnings.parquet", "coverage_year")
    counts = residuals.class_counts(by_year(y.filings.drop("year")), ["coverage_year"])
    return answers.Answer(counts, answers.FLOOR, y.unparsed.groupBy("reason").agg(F.count("*").alias("n")))


def _ask(spark: SparkSession, a: argparse.Namespace, current: int) -> answers.Answer:
    if a.verb == "members":
        return _committee_seats(spark, a) if a.committees else answers.members(table(spark, a.data, "legislators_current"), a.needle)
    if a.verb == "donors":
        return answers.donors(*_money_tables(spark, a, current), a.member, a.organization_type)
    if a.verb == "pac":
        return answers.recipients(*_money_tables(spark, a, current), a.organization)
    if a.verb == "parse-money":
        return _parse_money(spark, a)
    if a.verb == "parse-filings":
        return _parse_filings(spark, a, current)
    filings = table(spark, a.data, "filings")
    if "years" in a:
        filings = _years(a, filings, "coverage_year", parameters.years(a.years, current), "filings")
    pick = lambda kind, *names: kind(**{n: getattr(a, n) for n in names})
    if a.verb == "filings":
        return answers.filings(filings, pick(FilingFilter, "member", "bioguide", "state", "filing_type", "since", "until"))
    if a.verb == "trades":
        want = pick(TradeFilter, "member", "bioguide", "ticker", "asset", "owner", "transaction_type", "since", "until", "min_amount")
        return answers.trades(reshape.current_filings(filings), table(spark, a.data, "ptr"), want)
    if a.verb == "holdings":
        want = pick(HoldingFilter, "member", "bioguide", "asset", "owner", "asset_type", "min_value")
        return answers.holdings(reshape.current_filings(filings), reshape.schedule_a(table(spark, a.data, "fd"), want), want)
    if a.verb == "inspect":
        return _inspect(spark, a, filings)
    if a.verb == "check":
        flat = reshape.trades(reshape.current_filings(filings), table(spark, a.data, "ptr"))
        return answers.Answer(quality.ptr_violations(flat), answers.FLOOR, quality.counts(quality.ptr_violations(flat)))
    if a.verb == "summary":
        return answers.summary(filings, table(spark, a.data, "unparsed_manifest"))
    one = reshape.detail(filings, table(spark, a.data, "ptr"), table(spark, a.data, "fd"), a.doc_id)
    if one.isEmpty():
        raise answers.NoData(f"no filing {a.doc_id}")
    return answers.Answer(one, answers.FLOOR, one.select(F.col("transactions").isNull().alias("no_transactions"), F.col("body").isNull().alias("no_body")))


def _flat(rows: DataFrame) -> DataFrame:
    """The columns that fit into a table, long names of assets cut for display."""
    if "transaction" in rows.columns:
        t = F.col("transaction")
        return rows.select("doc_id", "filer_id", t["transaction_date"].alias("date"), t["transaction_type"].alias("type"), t["ticker"].alias("ticker"), F.substring(t["asset"], 1, 48).alias("asset"), t["amount_range"]["label"].alias("amount"))
    if "holding" in rows.columns:
        h = F.col("holding")
        return rows.select("doc_id", "filer_id", "item", F.substring(h["asset"], 1, 48).alias("asset"), h["owner"].alias("owner"), h["asset_type"].alias("type"), h["value_of_asset"]["label"].alias("value"))
    if "verdict" in rows.columns:
        return rows.select("doc_id", F.col("filing.filer_id").alias("filer_id"), "state")
    if "filer" in rows.columns:
        return rows.select("doc_id", "coverage_year", values.last_first(F.col("filer")).alias("filer"), F.col("state_district.raw").alias("seat"), F.col("filing_type.label").alias("type"), "filing_date")
    return rows


def main(argv: list[str] | None = None, spark: SparkSession | None = None, current: int | None = None) -> int:
    try:
        a = _parser().parse_args(argv)
    except SystemExit as e:
        return 0 if e.code in (0, None) else 2
    try:
        spark = spark or local_session("cli")
        answer = _ask(spark, a, current or date.today().year)
        rows = answer.rows
        if "row_no" in rows.columns:
            rows = rows.orderBy(*[c for c in ("coverage_year", "row_no", "item") if c in rows.columns])
        for piece in sinks.as_table(_flat(rows), a.limit) if a.table else sinks.as_json(rows, a.limit):
            print(piece, end="")
        print(f"guarantee: {answer.guarantee}", file=sys.stderr)
        for r in answer.residual.collect():
            print("residual: " + ", ".join(f"{k} {v}" for k, v in r.asDict().items()), file=sys.stderr)
    except (parameters.BadRange, ValueError) as e:
        print(e, file=sys.stderr)
        return 2
    except LookupError as e:  # NoData, or files that need each other
        print(e, file=sys.stderr)
        return 1
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        print("a table isn't there; parse it first", file=sys.stderr)
        return 1
    return 0
