from datetime import date

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from tallyframe import types as kinds
from tallyframe.functions import text
from tallyframe.operators import directory, identity, lines, money, predicates, quality, residuals, reshape, review
from tallyframe.plans import answers

FILING = "row_no long, doc_id string, coverage_year int, filer struct<prefix:string,first:string,last:string,suffix:string>, filer_id string, bioguide_id string, state_district struct<raw:string,state:string,district:int>, filing_type struct<code:string,label:string>, filing_date date, pdf_class string, parse_status string, load_no int"


def filing(n, doc, first, last, seat=("TX", 5), code="O", bio=None, day=date(2024, 5, 1), cls="efiled", status="ok", load=1, year=2023, suffix=None):
    return (n, doc, year, (None, first, last, suffix), f"name:{last}", bio, seat and (f"{seat[0]}{seat[1]:02d}", *seat), (code, kinds.FILING_TYPES.get(code, "unknown")), day, cls, status, load)


@pytest.fixture(scope="module")
def filings(spark):
    return spark.createDataFrame(
        [
            filing(1, "100", "Ann", "Smith"), filing(2, "100", "Ann", "Smith", load=2, cls="scanned"), filing(3, "101", "Bob", "Núñez", ("TX", 6), "P", bio="N1"),
            filing(4, "102", "Cy", "Jones", ("TX", 6)), filing(5, "103", "Dee", "Jones", None), filing(6, "104", "Eve", "Smith", ("TX", 5), "C"),
            filing(7, "", "Fay", "Fox", ("ZZ", 1), "X", day=None, cls=None, status=None), filing(8, None, None, None, None, None, day=None, cls="missing", status="error"),
            filing(9, "105", "Guy", "Diaz", ("TX", 7)),
        ],
        FILING,
    )


@pytest.fixture(scope="module")
def legislators(spark):
    rep = lambda s, d, y=2023: Row(type="rep", state=s, district=d, start=date(y, 1, 3))
    return spark.createDataFrame(
        [
            (("S1", ["H1", "H2"]), ("Ann", "Smith", "Ann B. Smith"), [rep("TX", 5)]),
            (("S2", None), ("Al", "Smith", None), [rep("TX", 5, 2021)]),
            (("N1", ["H3", " "]), ("Robert", "Nunez", "Bob Núñez"), [rep("TX", 6)]),
            (("D1", ["H3"]), ("Guy", "Díaz", None), [rep("TX", 7), Row(type="sen", state="TX", district=None, start=date(2025, 1, 3))]),
        ],
        kinds.LEGISLATORS,
    )


def test_filters(filings):
    ids = lambda **k: [r.row_no for r in filings.where(predicates.FilingFilter(**k).on_filing()).orderBy("row_no").collect()]
    assert ids(member="smi") == [1, 2, 6] and ids(state="tx", filing_type="ptr") == [3] and ids(filing_type="fd") == [1, 2, 4, 5, 6, 7, 8, 9]
    assert ids(filing_type="x") == [7] and ids(filing_type="candidate") == [6] and ids(bioguide="n1") == [3]
    assert ids(since=date(2024, 5, 1), until=date(2024, 5, 1)) == [1, 2, 3, 4, 5, 6, 9] and ids() == list(range(1, 10))


def test_current_filings(filings):
    got = sorted(r.row_no for r in reshape.current_filings(filings).collect())
    assert got == [2, 3, 4, 5, 6, 7, 8, 9]


def test_seat_ladder(spark, filings, legislators):
    m = {r.row_no: (r.seat_bioguide, r.ambiguous) for r in identity.match_seats(filings, legislators).collect()}
    assert m[1] == (None, True) and m[3] == ("N1", False) and m[6] == (None, True) and m[9] == ("D1", False) and m[4] == (None, False)
    reasoned = identity.unmatched_reason(identity.match_seats(filings.where("bioguide_id IS NULL"), legislators), legislators)
    reasons = {r.row_no: r.reason for r in reasoned.collect()}
    assert reasons[1] == "ambiguous_seat" and reasons[4] == "suspicious" and reasons[5] == "no_district" and reasons[6] == "candidate" and reasons[7] == "unknown_seat"
    w = {r.filer_id: r for r in identity.identity_warnings(reasoned).collect()}
    assert w["name:Smith"].reason == "ambiguous_seat" and w["name:Smith"].raw_names == ["Ann Smith", "Eve Smith"] and w["name:Smith"].documents == 3
    assert w["name:Jones"].reason == "suspicious" and w["name:Jones"].districts == [6]
    s = identity.match_summary(filings, identity.identity_warnings(reasoned)).first()
    assert (s.matched, s.suspicious, s.candidate, s.ambiguous_seat) == (1, 2, 0, 1)


def test_links(spark, legislators):
    principal = spark.createDataFrame([("H1", "C1"), ("H3", "C3")], "candidate_id string, committee_id string")
    links, residual = identity.member_links(legislators, principal)
    assert sorted((r.bioguide_id, r.committee_id) for r in links.collect()) == [("D1", "C3"), ("N1", "C3"), ("S1", "C1")]
    assert sorted((r.bioguide_id, r.reason) for r in residual.collect()) == [("S1", "no_principal_committee"), ("S2", "no_fec_id")]


def test_directory(spark, legislators):
    assert [r.bioguide for r in directory.search(legislators, "NUNEZ").collect()] == ["N1"] and [r.chamber for r in directory.search(legislators, "díaz").collect()] == ["senate"]
    defs = spark.createDataFrame([("house", "Rules", "HSRU", None, [("Process", "02")]), ("senate", "Finance", "SSFI", None, [])], kinds.COMMITTEE_DEFINITIONS)
    member = spark.createDataFrame([({"HSRU": [("A", "maj", 2, None, "S1")], "HSRU02": [("A", "maj", None, "Chair", "S1")], "SSFI": [("A", "maj", 1, None, "S1")]},)], kinds.T.StructType([kinds.T.StructField("membership", kinds.MEMBERSHIP)]))
    rows = directory.search_committees(legislators, defs, member, "smith").collect()
    assert [(r.committee, r.subcommittee, r.rank) for r in rows] == [("Rules", None, 2), ("Rules", "Process", None)]


def test_contributions(spark):
    cols = lambda **k: [k.get(str(i), "") for i in range(18)]
    raw = lambda ctr, rec, amt, tran, day="10282024": cols(**{"0": ctr, "15": rec, "14": amt, "17": tran, "13": day})
    rows = spark.createDataFrame(
        [(raw("X9", "R", "10", "T1"), 1), (raw("C1", "R", "20", "T1"), 2), (raw("C1", "R", "30", ""), 3), (raw("C1", "R", "40", ""), 4), (raw("C2", "R", "50", "T2", "02302024"), 5), (["a"], 6)], "cols array<string>, row long"
    )
    master = spark.createDataFrame([(cols(**{"0": "C1", "1": "Old", "12": "L"}), 1), (cols(**{"0": "C1", "1": "Union", "12": "L", "13": "Workers"}), 2), (cols(**{"0": "C2", "1": "Ideas"}), 3), (["C3"], 4)], "cols array<string>, row long")
    cm = money.committees(master)
    assert sorted((r.committee_id, r.name, r.organization_type) for r in cm.collect()) == [("C1", "Union", "labor"), ("C2", "Ideas", None)]
    split = {r.row: (r.reason, r.amount, r.date) for r in money.split_contributions(money.read_contributions(rows), cm).collect()}
    assert set(split) == {1, 3, 4, 5, 6}  # row 2 repeats T1, though the first copy is left out
    assert split[1][0] == "unresolved_committee" and split[3] == (None, 30.0, date(2024, 10, 28)) and split[5] == ("not_connected_ssf", 50.0, None) and split[6][0] == "malformed_short_row"


def test_donors_and_limit(spark):
    con = spark.createDataFrame([("R1", "C1", 6000.0, 2024, 1), ("R1", "C2", 4000.01, 2024, 2), ("R1", "C3", 7500.0, 2024, 3), ("R2", "C1", 1.0, 2024, 4), ("R1", "C9", 5.0, 2024, 5)], "recipient_committee_id string, contributor_committee_id string, amount double, cycle int, row long")
    cm = spark.createDataFrame([("C1", "A", "Union", "labor", 2024), ("C2", "B", "Union", "trade", 2024), ("C3", "FICO", None, "corporation", 2024)], "committee_id string, name string, connected_organization_name string, organization_type string, cycle int")
    links = spark.createDataFrame([("M1", "R1", 2024, 1), ("M2", "R1", 2024, 2), ("M2", "R2", 2024, 3)], "bioguide_id string, committee_id string, cycle int, row long")
    a = answers.donors(con, cm, links, "m1")
    assert [(r.organization, r.organization_type, str(r.total), r.n_contributions) for r in a.rows.collect()] == [("Union", "labor", "10000.01", 2), ("FICO", "corporation", "7500.00", 1)]
    assert a.guarantee == answers.FLOOR and a.residual.first()[0] == 1
    assert answers.donors(con, cm, links, "nobody").guarantee == answers.NONE
    rows, lost = money.recipients_of(con, cm, links, "uni")
    assert [(r.bioguide_id, str(r.total)) for r in rows.collect()] == [("M1", "10000.01"), ("M2", "1.00")] and lost.first()[0] == 0
    assert money.over_limit(con.withColumn("contributor_committee_id", F.lit("U")), 10_000).first().recipient_committee_id == "R1"
    assert money.over_limit(con.where("row = 1"), 6000).count() == 0  # strictly above
    with pytest.raises(ValueError):
        money.member_recipients(links, "")


def test_keep_first_and_last(spark):
    df = spark.createDataFrame([("a", 2), ("a", 1), ("", 3), ("", 4), (None, 5), ("b", 6)], "k string, o long")
    assert sorted(r.o for r in money.keep_first(df, "k", "o").collect()) == [1, 3, 4, 5, 6]
    assert sorted(r.o for r in money.keep_last(df.where("k <> ''"), ["k"], "o").collect()) == [2, 6]


def test_residuals(filings):
    r = {x.coverage_year: x for x in residuals.class_counts(filings, ["coverage_year"]).collect()}[2023]
    assert (r.total, r.efiled, r.scanned, r.missing, r.not_classified, r.error) == (9, 6, 1, 1, 1, 1)
    assert r.efiled + r.scanned + r.missing + r.not_classified == r.total
    e = residuals.efiled_counts(filings).first()
    assert (e.efiled_ptr, e.efiled_other) == (1, 5)


def test_sample_is_monotone_and_stratified(spark):
    rows = spark.createDataFrame([filing(i, str(i), "A", "B", cls="efiled" if i % 3 else "scanned", code="P" if i % 4 else "O") for i in range(400)], FILING)
    small = {r.doc_id for r in review.select(rows, 0.05).collect()}
    large = {r.doc_id for r in review.select(rows.repartition(9), 0.2).collect()}
    assert small < large and len(review.select(rows, 0).collect()) == 0 and review.select(rows, 1).count() == 400
    n = {(r["pdf_class"], r["family"]): r["n"] for r in review.select(rows, 0.05).groupBy("stratum.pdf_class", "stratum.family").agg(F.count("*").alias("n")).collect()}
    assert len(n) == 4 and all(v >= 1 for v in n.values())


def test_scorecard(spark):
    rows = spark.createDataFrame([filing(i, str(i), "A", "B", cls="efiled" if i < 3 else "scanned") for i in range(5)], FILING)
    labels = spark.createDataFrame([("0", True, True, 0, 0, True, True, "s"), ("1", False, True, 2, 0, True, False, "s"), ("3", True, False, 0, 4, True, True, "old")], "doc_id string, is_fully_precise boolean, is_fully_recalled boolean, n_incorrect_entries int, n_missing_entries int, is_metadata_accurate boolean, is_metadata_fully_complete boolean, snapshot string")
    card = {(r.pdf_class, r.overall): r for r in review.scorecard(review.with_labels(review.select(rows, 1), labels, F.lit("s"))).collect()}
    assert card["efiled", False].precise_rate == 0.5 and card["efiled", False].incorrect_entries == 2 and card["scanned", False].precise_rate is None
    assert card[None, True].n_reviewed == 3 and card[None, True].n_stale == 1
    ok = labels.select(review.verdict_is_valid(F.col("is_fully_precise"), F.col("n_incorrect_entries"), F.col("is_fully_recalled"), F.col("n_missing_entries")))
    assert all(r[0] for r in ok.collect())


def test_invariants(spark):
    t = kinds.TRANSACTION
    row = lambda **k: tuple(k.get(f, None) for f in t.names)
    flat = spark.createDataFrame([("1", 0, row(asset_type="st", ticker="ko", transaction_date=date(2020, 1, 1), date_raw="x", amount_range=(1, None, None, ""))), ("1", 1, row(asset_type="ST", amount_range=(1, 2, None, "")))], kinds.T.StructType([kinds.T.StructField("doc_id", kinds.T.StringType()), kinds.T.StructField("item", kinds.T.IntegerType()), kinds.T.StructField("transaction", t)]))
    assert sorted((r.item, r.invariant) for r in quality.ptr_violations(flat).collect()) == [(0, i) for i in sorted(quality.INVARIANTS)]


def test_text_classes(spark):
    d = spark.createDataFrame([(1, "a" * 20), (2, " \n" * 50 + "x"), (3, None), (4, "")], "doc_id long, text string")
    assert {r.doc_id: r.pdf_class for r in lines.text_class(d).collect()} == {1: "efiled", 2: "scanned", 3: "missing", 4: "scanned"}


def test_partitions(filings):
    assert answers.partitions(filings, "coverage_year") == [2023] and answers.require([2023], [2022, 2023], "filings") == ([2023], [2022])
    with pytest.raises(answers.NoData):
        answers.require([], [2023], "filings")


def test_report_and_documents_of_unmatched_filers(spark, filings, legislators):
    reasoned = identity.unmatched_reason(identity.match_seats(filings.where("bioguide_id IS NULL"), legislators), legislators)
    docs = identity.warning_documents(reasoned)
    assert [r.doc_id for r in docs.where("filer_id = 'name:Smith'").orderBy("row_no").collect()] == ["100", "100", "104"]
    told = {r.filer_id: r for r in identity.report(identity.identity_warnings(reasoned), reasoned, legislators).collect()}
    assert set(told) == {r.filer_id for r in docs.collect()} and all(len(r.holders.split(", ")) <= identity.SHOWN_HOLDERS for r in told.values())


def test_accents(spark):
    names = ["Ñuñez", "Žižek", "Ａｂ", "plain", "e\u0301", "Ἀ", None, ""]
    got = spark.createDataFrame([(n,) for n in names], "n string").select(text.unaccent(F.col("n")).alias("x")).collect()
    assert [r.x for r in got] == ["Nunez", "Zizek", "Ab", "plain", "e", "Α", None, ""]


def test_queue_and_payload(spark):
    rows = spark.createDataFrame([("1", 5, "a"), ("2", 6, "b"), ("3", 7, None)], "doc_id string, coverage_year int, body string")
    given = rows.select("doc_id", review.snapshot(rows).alias("snapshot"), F.lit(True).alias("is_fully_precise")).where("doc_id < '3'")
    state = lambda r: {x.doc_id: x.state for x in review.queue(r, given.select("doc_id", "snapshot")).collect()}
    assert state(rows) == {"1": "done", "2": "done", "3": "open"}
    # A change of the body or of the filing makes a verdict stale.
    assert state(rows.withColumn("body", F.lit("a"))) == {"1": "done", "2": "stale", "3": "open"} and state(rows.withColumn("coverage_year", F.lit(5)))["2"] == "stale"
    shown = {r.doc_id: r for r in review.payload(rows, given).collect()}
    assert shown["1"].verdict.is_fully_precise and shown["3"].verdict is None and shown["2"].filing.coverage_year == 6 and shown["2"].body == "b"


def test_last_verdict_counts(spark):
    v = spark.createDataFrame([("1", 1, "x"), ("1", 2, "y"), ("2", 1, "z")], "doc_id string, at int, note string")
    assert {r.doc_id: r.note for r in review.latest_labels(v).collect()} == {"1": "y", "2": "z"}


def test_a_cluster_needs_a_shared_folder():
    from types import SimpleNamespace

    from tallyframe import session

    conf = SimpleNamespace(get=lambda *_: None)
    cluster = SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None))
    with pytest.raises(RuntimeError):
        session.shared_dir(cluster)
