from datetime import date
from itertools import combinations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyframe.operators import columns as C
from tallyframe.operators import extract as X

N = "\x00"


def doc(spark, text, doc_id="1"):
    return spark.createDataFrame([(doc_id, text)], "doc_id string, text string")


PTR = """ID Owner Asset Type Date
SP Alpha Corp (ALP) [ST] P 01/02/2020 01/05/2020 $1,001 - $15,000 gfedc
FILINg STATUS: New
Beta Holding Company With A Long Name S (partial) 02/30/2020 02/05/2020 $15,001 - gfedcb
Type Date
(BETA) [ST] $50,000
FIlINg STATuS: New
DESCRIPTION: sold part
JT Gamma LLC [OT] E 03/01/2020 03/02/2020 $894.97 gfedc
FILING STATUS: New
* For the complete list of asset type abbreviations, see
DC Not A Row [ST] P 01/02/2020 01/05/2020 $1,001 - $15,000 gfedc"""


def test_transactions(spark):
    rows, failed = X.transactions(doc(spark, PTR))
    t = [r.transaction for r in rows.orderBy("item").collect()]
    assert failed.count() == 0 and len(t) == 3
    assert (t[0].owner, t[0].ticker, t[0].asset_type, t[0].transaction_date, t[0].cap_gains_over_200) == ("SP", "ALP", "ST", date(2020, 1, 2), False)
    assert t[1].asset == "Beta Holding Company With A Long Name (BETA) [ST]" and (t[1].amount_range.low, t[1].amount_range.high) == (15001, 50000)
    assert (t[1].owner, t[1].transaction_type, t[1].transaction_date, t[1].date_raw, t[1].description, t[1].cap_gains_over_200) == ("self", "S(partial)", None, "02/30/2020", "sold part", True)
    assert t[2].amount_range.exact == 894.97


def test_documents_that_fail_as_a_whole(spark):
    broken = PTR.replace("(BETA) [ST] $50,000\n", "")
    rows, failed = X.transactions(doc(spark, broken))
    assert rows.count() == 0 and [r.reason for r in failed.collect()] == ["extract_failed"]


def test_lost_glyphs(spark):
    text = f"P{N}{N}\nAlpha (ALP) [ST] P 01/02/2020 01/05/2020 $1,001 - $15,000\nF{N * 5} S{N * 5}: New"
    t = X.transactions(doc(spark, text))[0].collect()
    assert len(t) == 1 and t[0].transaction.cap_gains_over_200 is None
    assert X.transactions(doc(spark, text.replace(N, "x")))[0].count() == 0


FD = """ScHeDule A: Assets
asset owner value
Alpha Fund [MF] SP $1,001 - $15,000 Dividends $201 - $1,000 gfedc
Trust X ⇒
Beta Bond [GS] JT $15,001 - $50,000 None gfedc
LOCATION: Austin, TX
SCheDuLe B: Transactions
None disclosed.
Asset class details appendix
ScheDule C: Earned income
University of X Spouse Salary N/A
Naborforce Spouse wage $12,000.00
schedule D: Liabilities
SP Big Bank May 2016 Mortgage on Rental Property, $100,001 - Washington, DC $250,000
SoFi Jan 2022 Student Loan $15,001 - $50,000
schedule E: Positions
Sole Director & President Acme Foundation
C : note on the above
Unknown thing
schedule F: Agreements
January 2015 State of Texas Pension from the state
08/23/2023. Currently valued
schedule G: Gifts
Friend Painting $1,200.00
schedule H: Travel
Think Tank 01/02/2020 - 01/05/2020 Washington, DC - 3 Institute Miami, FL
schedule I: Honoraria
Some Paper Article 04/22/2022 $500.00 Charity
schedule J: Compensation
Acme Inc (Dallas, TX) Legal advice
Digitally signed: someone
More text"""


@pytest.fixture(scope="module")
def items(spark):
    rows = X.schedule_items(doc(spark, FD)).collect()
    return {(r.schedule, r.item_no): r for r in rows}


def test_schedules(items):
    assert sorted({k[0] for k in items}) == list("ACDEFGHIJ")
    a1, a2 = items["A", 1].A, items["A", 2].A
    assert (a1.asset, a1.owner, a1.asset_type, a1.value_of_asset.high, a1.income_type, a1.income_amount.low) == ("Alpha Fund", "SP", "MF", 15000, "Dividends", 201)
    assert a2.asset_type == "GS" and a2.owner == "JT" and a2.value_of_asset.low == 15001 and a2.location == "Austin, TX" and a2.income_amount is None
    c1, c2 = items["C", 1].C, items["C", 2].C
    assert (c1.source, c1.income_type, c1.amount) == ("University of X", "Spouse Salary", "N/A") and (c2.source, c2.income_type) == ("Naborforce", "Spouse wage")
    d1, d2 = items["D", 1].D, items["D", 2].D
    assert (d1.creditor, d1.owner, d1.date_incurred, d1.amount_range.low, d1.amount_range.high) == ("Big Bank", "SP", "May 2016", 100001, 250000)
    assert d1.liability_type == "Mortgage on Rental Property, Washington, DC" and (d2.creditor, d2.date_incurred, d2.liability_type) == ("SoFi", "Jan 2022", "Student Loan")
    assert (items["E", 1].E.position, items["E", 1].E.organization) == ("Sole Director & President", "Acme Foundation C : note on the above") and items["E", 2].E.position is None
    f = items["F", 1].F
    assert (f.date, f.parties, f.terms) == ("January 2015", "State of Texas", "Pension from the state 08/23/2023. Currently valued")
    assert (items["G", 1].G.source, items["G", 1].G.value) == ("Friend Painting", "$1,200.00")
    h = items["H", 1].H
    assert (h.source, h.dates, h.location) == ("Think Tank Institute", "01/02/2020 - 01/05/2020", "Washington, DC - Miami, FL")
    i = items["I", 1].I
    assert (i.source, i.activity, i.date, i.amount) == ("Some Paper", "Article", "04/22/2022", "$500.00")
    assert (items["J", 1].J.source, items["J", 1].J.description) == ("Acme Inc (Dallas, TX)", "Legal advice")


def test_salvage_keeps_text(spark):
    rows = X.schedule_items(doc(spark, "Schedule D: Debts\nno date here\nnor here")).collect()
    assert sorted((r.item_no, r.D.creditor, r.D.liability_type) for r in rows) == [(1, "no date here", None), (2, "nor here", None)]


def test_merged_rows_are_reported(spark):
    text = "Schedule A: Assets\nAlpha [ST] Beta [ST] Gamma [MF] Delta [ST] gfedc\nDigitally signed"
    d = doc(spark, text)
    assert [r.reason for r in X.incomplete(d).collect()] == ["extract_failed"]
    d = doc(spark, "Schedule A: Assets\nAlpha [ST] Beta [ST] $1 - $200 gfedc\nGamma [MF] $1 - $200 gfedc\nDigitally signed")
    assert [r.reason for r in X.incomplete(d).collect()] == ["schedule_incomplete"]


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("$1 - $200 then $201 - $1,000", [(1, 200), (201, 1000)]),
        ("$100,001 - Mortgage $250,000", [(100001, 250000)]),
        ("$15,001 - Rent $201 - $50,000 $1,000", [(15001, 50000), (201, 1000)]),  # the neighbour belongs to the first
        ("Over $1,000,000 Rent $1 - $200", [None, (1, 200)]),
        ("$500 - $100", [None]),
        ("$5,001 - nothing", [None]),
        ("Fund [MF] $1,001 - Dividends $15,000 $700", [None]),  # two sums for one open range: none is made up
        ("Bank [BA] JT $100,001 - Interest $201 - $1,000", [None, (201, 1000)]),
        ("Rental [RP] $250,001 - Rent $15,001 - $500,000 $50,000", [(250001, 500000), (15001, 50000)]),
        (" ".join(["$1,001 - $15,000"] * 40) + " $9,999", [(1001, 15000)] * 40),  # ranges and a sum that belongs to none
        ("x", []),
    ],
)
def test_amount_columns(text, expected):
    assert [s.amount and (s.amount.low, s.amount.high) for s in C.amount_slots(text)] == expected


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 9), st.one_of(st.none(), st.integers(1, 9)), st.booleans()), max_size=7), st.lists(st.integers(1, 9), max_size=4), st.randoms(use_true_random=False))
def test_released_bounds_against_all_sets(rows, alone, r):
    """The walk finds the fewest and first ranges that a search over all sets finds, without its limit on their number."""
    ranges = [C.Range(i * 10, low, high) for i, (low, high, _) in enumerate(rows)]
    singles = sorted((r.randrange(0, 10 * len(rows) + 10) * 10 + 5, v) for v in alone)

    def fits(split):
        low = [x.low for i, x in enumerate(ranges) if x.high is None or i in split]
        pool = [v for _, v in sorted([*singles, *((x.at + 1, x.high) for i, x in enumerate(ranges) if i in split)])]
        return len(low) == len(pool) and all(a <= b for a, b in zip(low, pool)) and all(x.low <= x.high for i, x in enumerate(ranges) if x.high is not None and i not in split)

    closed = [i for i, x in enumerate(ranges) if x.high is not None]
    expected = next((frozenset(c) for n in range(len(closed) + 1) for c in combinations(closed, n) if fits(c)), None)
    assert C.fewest_released(ranges, singles) == expected


@pytest.mark.parametrize("line", ["filing id", "current Year to filing", "year to year", "to Preceding", "LIABILITY type", "Date Exp.", "Source (Name and Address) Brief", "S\0\0 D\0\0\0"])
def test_column_headers_are_no_rows(line):
    assert C.Layout().is_furniture(line)
    assert not C.Layout().is_furniture("Acme Filing Corp (AFC) [ST]")


@pytest.mark.parametrize(
    ("letter", "raw", "expected"),
    [
        ("C", "Foo Retirement Plan $1.00 N/A", {"source": "Foo", "income_type": "Retirement Plan", "amount": "$1.00", "amount_preceding": "N/A"}),
        ("E", "Vice President, Board Acme", {"position": "Vice President, Board", "organization": "Acme"}), ("E", "Unknown thing", {}),
        ("F", "1990 Myself & American University 401(k) plan", {"date": "1990", "parties": "Myself & American University", "terms": "401(k) plan"}), ("F", "May 2015 Pension of X", {"date": "May 2015", "parties": "Pension of X"}),
        ("G", "A $5 b", {"source": "A", "value": "$5"}), ("H", "X 01/2020 none", {"source": "X", "dates": "01/2020"}),
        ("H", "Institute 01/02/2020 - 01/05/2020 Baltimore - 3 for Policy, Inc Jacksonville - Baltimore", {"source": "Institute for Policy, Inc", "dates": "01/02/2020 - 01/05/2020", "location": "Baltimore - Jacksonville - Baltimore"}),
        ("I", "Foo 04/22/2022 $5", {"source": "Foo", "date": "04/22/2022", "amount": "$5"}), ("I", "no date $7", {"source": "no date", "amount": "$7"}), ("J", "none", {}),
    ],
)
def test_forms(letter, raw, expected):
    assert {k: v for k, v in C.PARSERS[letter](raw, C.Layout(), C.LATEST_YEAR).items() if v is not None} == expected


def test_long_rows_end_soon():
    for letter in "ABCDEFGHIJ":
        for raw in ("x" * 200_000, "a " * 20_000, "$1 " * 5_000, "01/02/2020 " * 5_000, "Director " * 5_000):
            C.PARSERS[letter](raw, C.Layout(), C.LATEST_YEAR)


def test_tag_that_wrapped_far(spark):
    """The look-ahead has no limit on what stands before the tag."""
    text = "Schedule A: x\nAlpha Fund $1,001 - $15,000 None\n" + "and its very long name " * 6 + "[MF]\nDigitally signed"
    rows = X.schedule_items(doc(spark, text)).collect()
    assert len(rows) == 1 and rows[0].A.asset_type == "MF" and rows[0].A.value_of_asset.low == 1001


def test_lines_as_rows(spark):
    lines = spark.createDataFrame([("1", i, ln) for i, ln in enumerate(FD.split("\n"))], "doc_id string, line_no int, line string").repartition(5)
    key = lambda rows: sorted((r.schedule, r.item_no, r.raw_text) for r in rows.collect())
    assert key(X.schedule_items(X.documents(lines))) == key(X.schedule_items(doc(spark, FD)))


def test_empty_input(spark):
    empty = spark.createDataFrame([(1, None), (2, ""), (3, "\n\r\n")], "doc_id long, text string")
    for d in (empty, empty.limit(0)):
        assert X.transactions(d)[0].count() == 0 and X.transactions(d)[1].count() == 0 and X.schedule_items(d).count() == 0 and X.incomplete(d).count() == 0


def test_outcomes(spark):
    code = "filing_type struct<code:string,label:string>"
    f = spark.createDataFrame([("1", ("O", "")), ("2", ("P", "")), ("3", ("O", "")), ("4", ("X", "")), ("5", ("O", "")), ("6", ("Q", "")), ("7", ("P", "")), ("8", ("A", "")), ("9", ("O", "")), ("10", (None, None))], f"doc_id string, {code}")
    odd = "schedule B: trades\nAlpha [ST] SP 02/30/2020 P $1 - $200 gfedc\nschedule A: assets\nBeta [ST] Gamma [MF] $1 - $200 gfedc\nDelta [ST] $1 - $200 gfedc"
    texts = {"1": FD, "2": PTR.replace("FILING STATUS: New\n", ""), "3": "x" * 30, "4": "y" * 30, "6": "z" * 30, "7": PTR, "8": odd, "9": "x"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id string, text string")
    out = {r.doc_id: (r.pdf_class, r.parse_status, r.reasons) for r in X.outcomes(f, docs).collect()}
    assert out == {
        "1": ("efiled", "ok", []), "2": (None, "error", ["extract_failed"]), "3": (None, "error", ["extract_failed"]), "4": ("efiled", "ok", []), "5": ("missing", "ok", ["missing"]), "6": ("efiled", "ok", ["unknown_type"]),
        "7": ("efiled", "ok", ["date_out_of_range"]), "8": ("efiled", "ok", ["date_out_of_range", "schedule_incomplete"]), "9": ("scanned", "ok", ["scanned"]), "10": ("missing", "ok", ["missing", "unknown_type"]),
    }
    only = {r.doc_id: (r.pdf_class, r.parse_status, r.reasons) for r in X.outcomes(f, docs, families={"ptr"}).collect()}
    assert only["1"] == (None, "ok", []) and only["7"] == out["7"] and X.unparsed(X.outcomes(f, docs)).count() == 10
