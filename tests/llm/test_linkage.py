from datetime import date

import numpy as np
import pytest
from pyspark.sql import Row

from tallyframe.llm import linkage as K

FILING = "row_no long, filer struct<prefix:string,first:string,last:string,suffix:string>, bioguide_id string, state_district struct<raw:string,state:string,district:int>, filing_type struct<code:string,label:string>, coverage_year int, bioguide string, pattern string"
LEG = "id struct<bioguide:string,fec:array<string>>, name struct<first:string,last:string,official_full:string>, terms array<struct<type:string,state:string,district:int,start:date>>, extra string"


def person(bio, first, last, official=None, state="TX", district=5, years=(2019, 2021)):
    return ((bio, None), (first, last, official), [Row(type="rep", state=state, district=district, start=date(y, 1, 3)) for y in years], "x")


def filing(n, first, last, suffix=None, state="TX", district=5, year=2020, code="O", bio=None):
    return (n, (None, first, last, suffix), bio, state and (f"{state}{district:02d}", state, district), (code, ""), year, "clash", "clash")


@pytest.fixture(scope="module")
def legislators(spark):
    rows = [
        person("W1", "Robert", "Wainscott", "Bob J. Wainscott"), person("S1", "Donald", "Preteeddos", "Donald Preteeddos, Sr.", years=(2013,)), person("J1", "Donald", "Preteeddos", "Donnie Preteeddos, Jr."),
        person("G1", "Rosario", "Geandyxing-Coantuen", None, "CA", 32), person("K1", "Robert", "Wainscott", None, "CA", 1), person("N1", None, None), ((None, None), (None, None, None), None, "x"),
    ]
    return spark.createDataFrame(rows, LEG)


CASES = [
    (filing(1, "Bob", "Wainscott"), "W1"), (filing(2, "WAINSCOTT, ROBT. J.", ""), "W1"), (filing(3, "R. Jude", "Wainscot"), "W1"), (filing(4, "Robert K.", "Wainscott"), None),
    (filing(5, "Alice", "Wainscott"), None), (filing(6, "Donald", "Preteeddos", "Jr."), "J1"), (filing(7, "Donald", "Preteeddos", "Sr."), None), (filing(8, "Donald", "Preteeddos", None, year=2014), "S1"),
    (filing(9, "Charo", "Coantuen", state="CA", district=0), "G1"), (filing(10, "Bob", "Wainscott", state=None), None), (filing(11, "Bob", "Wainscott", year=2010), None), (filing(12, "Bob", "Wainscott", state="NY"), None),
    (filing(13, None, None), None), (filing(14, "Bob", "Wainscott", bio="W1"), None), (filing(15, "Bob", "Wainscott", district=9), "W1"), (filing(16, "Bob", "Wainscott"), "W1"), (filing(17, "x" * 100_000, "y" * 100_000), None),
]


def test_matches(spark, legislators):
    table = spark.createDataFrame([f for f, _ in CASES], FILING)
    got = {r.row_no: r.bioguide for r in K.found(table, legislators).collect()}
    assert got == {f[0]: bio for f, bio in CASES if bio}


def test_join_path_finds_the_same(spark, legislators, monkeypatch):
    table = spark.createDataFrame([f for f, _ in CASES if f[0] != 17], FILING)
    a = sorted((r.row_no, tuple(map(tuple, r.candidates))) for r in K.candidates(table, legislators).collect())
    monkeypatch.setattr(K, "MAX_INDEXED", 0)
    b = sorted((r.row_no, tuple(map(tuple, r.candidates))) for r in K.candidates(table, legislators).collect())
    assert a == b and a


@pytest.mark.parametrize("indexed", [K.MAX_INDEXED, 0])
def test_two_damaged_letters_of_a_long_surname(spark, legislators, monkeypatch, indexed):
    monkeypatch.setattr(K, "MAX_INDEXED", indexed)
    table = spark.createDataFrame([filing(1, "Robert", "Weinscitt"), filing(2, "Robert", "Wainscott"), filing(3, "Robert", "Weinscitz")], FILING)
    assert {r.row_no: [c.bioguide for c in r.candidates] for r in K.candidates(table, legislators).collect()} == {1: ["W1"], 2: ["W1"]}


def test_the_model_decides_without_the_check(spark, small):
    """The check that follows changes no decision of the model, which doesn't know it."""
    filings, known = spark.read.parquet(f"{small}/filings.parquet"), spark.read.parquet(f"{small}/legislators_current.parquet")
    with_check, alone = (sorted((r.row_no, r.bioguide) for r in K.link(filings, known, check=c).where("accepted").collect()) for c in (True, False))
    assert with_check == alone and len(alone) > 10


def test_vocabulary_is_bounded(spark, legislators, monkeypatch):
    monkeypatch.setattr(K, "MOST_NAMES", 1)
    assert {"robert", "donald", "rosario"} & K.vocabulary(legislators).formal


def test_empty_tables(spark, legislators):
    assert K.found(spark.createDataFrame([], FILING), legislators).count() == 0
    assert K.found(spark.createDataFrame([CASES[0][0]], FILING), spark.createDataFrame([], LEG)).count() == 0


def test_label_model_learns_accuracies():
    """Votes drawn from known accuracies: the posterior separates the classes, and correlated voters are joined."""
    r = np.random.default_rng(5)
    n, m = 20_000, len(K.VOTERS)
    y = r.random(n) < 0.6
    accuracy = np.linspace(0.65, 0.95, m)
    right = r.random((n, m)) < accuracy
    v = np.where(right == y[:, None], 1, -1)
    v[r.random((n, m)) < 0.2] = 0
    v[:, 3] = v[:, 2]
    patterns, at, counts = np.unique(v, axis=0, return_inverse=True, return_counts=True)
    model = K.LabelModel()
    q = model.fit([tuple(int(x) for x in p) for p in patterns], counts.tolist())
    assert ((q[at.reshape(-1)] > 0.5) == y).mean() > 0.93
    assert any(set(f) >= {2, 3} for f in model.factors)


def test_patterns_round_trip():
    v = (1, 0, -1, 1, 1, 0, 0, -1, 1, 0, 1)
    assert K.decode(K.encode(v)) == v
