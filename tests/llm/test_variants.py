import random
from datetime import date

import pytest
from pyspark.sql import Row

from tallyframe.llm import graph, names, variants
from tallyframe.llm.names import alike

ENTRY = "entry_no long, parse_run int, filer_id string, raw_names array<string>, districts array<int>, doc_ids array<string>, node string, state string, name string"
LEG = "id struct<bioguide:string,fec:array<string>>, name struct<first:string,last:string,official_full:string>, terms array<struct<type:string,state:string,district:int,start:date>>"


@pytest.fixture(scope="module")
def legislators(spark):
    return spark.createDataFrame([(("R1", None), ("Ignacio", "Relveeram", "Ignacio N. Relveeram"), [Row(type="rep", state="CA", district=1, start=date(2019, 1, 3))])], LEG)


def entry(n, key, *raw, run=1, districts=(1,)):
    return (n, run, f"name:{key}" if key else None, list(raw) if raw else None, list(districts) if districts is not None else None, None, "clash", "clash", "clash")


def pairs(spark, legislators, rows):
    return sorted(tuple(r) for r in variants.found_pairs(spark.createDataFrame(rows, ENTRY), legislators).collect())


def test_spellings_of_one_person(spark, legislators):
    rows = [
        entry(1, "ca.relveeram.ignacio", "IGNACIO RELVEERAM"), entry(2, "ca.relveeram.i", "I Relveeram", "I. Rélveeram"), entry(3, "ca.relv-eeram.nacho", "Nacho Relv-Eeram"),
        entry(4, "ca..relveeram", "Relveeram, Ignacio N."), entry(5, "ca.ignacio.relveeram", "Relveeram Ignacio"), entry(6, "ca.relveeran.ignacio", "Ignacio Relveeran"), entry(7, "unk.relveeram.ignacio", "Ignacio Relveeram", districts=None),
        entry(8, "ca.relveeram.patrick", "Patrick Relveeram"), entry(9, "ca.relveeram.p-c", "P.C. Relveeram"), entry(10, "ny.relveeram.ignacio", "Ignacio Relveeram", run=2), entry(11, "ca.relveeram-jie.i", "I. Noel Relveeram-Jie"),
    ]
    one, two = [1, 2, 3, 4, 5, 6, 7, 11], [8, 9]
    expected = sorted([(a, b) for a in one for b in one if a < b] + [(8, 9)])
    assert pairs(spark, legislators, rows) == expected and two


def test_relatives_stay_apart(spark, legislators):
    rows = [
        entry(1, "fl.brualli.lloyd.sr", "Lloyd Brualli Sr."), entry(2, "fl.brualli.lloyd.jr", "Lloyd R. Brualli Jr."), entry(3, "fl.bruali.lloyd.jr", "Lloyd Bruali Jr."), entry(4, "fl.brualli.l.sr", "L. Merle Brualli Sr."),
        entry(5, "fl.brualli.lucy", "Lucy Brualli"), entry(6, "fl.brualli.lloyd", "Lloyd R. Brualli"),
    ]
    assert pairs(spark, legislators, rows) == [(1, 4), (2, 3), (2, 6), (3, 6)]


def test_odd_entries(spark, legislators):
    rows = [entry(1, None), entry(2, "ca..", ""), entry(3, "ca.x.", None and "", None and ""), entry(4, "garbage", "  "), entry(5, "ca.stone.ann", "Ann Stone", districts=None), entry(6, "ca.stone.annie", "Ann Stone"), entry(7, "ca.long.a", "A " + "x" * 50_000)]
    assert pairs(spark, legislators, rows) == [(5, 6)]
    assert pairs(spark, legislators, []) == []


def test_many_entries_of_one_name(spark, legislators):
    """A name that most entries bear is compared once."""
    rows = [entry(i, "ca.relveeram.ignacio", "Ignacio Relveeram") for i in range(300)] + [entry(1000, "ca.relveram.nacho", "Nacho Relveram")]
    got = pairs(spark, legislators, rows)
    assert len(got) == 301 * 300 // 2


def test_components_against_union_find(spark):
    r = random.Random(3)
    edges = [(r.randrange(200), r.randrange(200)) for _ in range(150)] + [(i, i + 1) for i in range(300, 340)]
    parent = list(range(400))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    got = graph.components(spark.range(400), spark.createDataFrame(edges, "a long, b long"))
    assert {x.id: x.component for x in got.collect()} == {i: find(i) for i in range(400)}
    assert graph.components(spark.range(3), spark.createDataFrame([], "a long, b long")).count() == 3


def test_two_damaged_letters(spark, legislators):
    """One near each end of a long surname, so that neither end is whole; a damaged first letter of an unknown given name."""
    rows = [
        entry(1, "tx.holviddett.lloyd", "Lloyd Holviddett"), entry(2, "tx.hiolviddwtt.lloyd", "Lloyd Hiolviddwtt"), entry(3, "tx.hiolviddett.l-dale", "L. Dale Hiolviddett"),
        entry(4, "tx.arnold.lucy", "Lucy Arnold"), entry(5, "tx.aronld.lucy", "Lucy Aronld"), entry(6, "ut.stone.qorvunim", "Qorvunim Stone"), entry(7, "ut.stone.xorvunim", "Xorvunim Stone"),
    ]
    assert pairs(spark, legislators, rows) == [(1, 2), (1, 3), (2, 3), (4, 5), (6, 7)]


def test_near_pairs_against_all_pairs(spark):
    """Two-letter deletions, sorted runs across batches and tasks: the same pairs as comparing all."""
    r = random.Random(11)
    base = ["holviddett", "arnold", "stone", "maickuissiski", "ng", "o" * 60]
    forms = set(base)
    for _ in range(250):
        w = list(r.choice(base))
        for _ in range(r.randrange(1, 4)):
            i = r.randrange(len(w))
            w[i : i + 1] = r.choice([[], [w[i], r.choice("abcxyz")], [r.choice("abcxyz")], w[i : i + 2][::-1]])
            w = w or ["x"]
        forms.add("".join(w))
    got = {tuple(x) for x in variants.near_pairs(spark.createDataFrame([(f,) for f in sorted(forms)], "form string").repartition(3)).collect()}
    assert got == {(a, b) for a in forms for b in forms if a == b or alike(a, b)}
    assert variants.near_pairs(spark.createDataFrame([], "form string")).count() == 0


def test_hot_key(spark, monkeypatch):
    """A run of one key that goes over many batches."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        forms = ["stonewall"] + [f"stonewall{c}" for c in "abcdefghijklmnopqrstuvwxyz"]
        got = variants.near_pairs(spark.createDataFrame([(f,) for f in forms], "form string")).count()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == len(forms) ** 2


@pytest.mark.parametrize(
    ("a", "b", "same"),
    [("Ann B. Stone", "Stone, Ann", True), ("I Relveeram", "Ignacio Rel Veeram", True), ("Wm. Stone", "William Q. Stonne", True), ("Ann Stone", "Bob Stone", False), ("Ann Stone", "Ann Carver", False)],
)
def test_alignment(a, b, same):
    known = names.GivenNames({"ann", "bob", "ignacio", "william"}, {})
    read = lambda x: names.read_name(x, "", None, known) if "," in x else names.read_name(*x.rsplit(" ", 2 if "Rel " in x else 1)[:1], " ".join(x.rsplit(" ", 2 if "Rel " in x else 1)[1:]), None, known)
    cost = names.align(read(a), read(b))
    assert (cost <= names.ALIGNED) == same and cost == pytest.approx(names.align(read(b), read(a)))


def test_persons_are_the_classes_of_the_pairs(spark, legislators):
    rows = [entry(1, "ca.relveeram.ignacio", "Ignacio Relveeram"), entry(2, "ca.relveeran.ignacio", "Ignacio Relveeran"), entry(3, "ca.stone.ann", "Ann Stone")]
    who = {r.entry_no: r.person for r in variants.persons(spark.createDataFrame(rows, ENTRY), legislators).collect()}
    assert who[1] == who[2] != who[3]
