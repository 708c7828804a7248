from datetime import date

import pytest
from pyspark.sql import functions as F

from tallyframe import types as kinds
from tallyframe.functions import text, values


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(f(F.col("x")).alias("y")).first()[0]


@pytest.mark.parametrize(("raw", "slug"), [("O'Brien-Smith", "o-brien-smith"), ("  Núñez  Jr. ", "nunez-jr"), (None, ""), ("", ""), ("Łódź", "łodz")])
def test_slug(spark, raw, slug):
    assert one(spark, raw, text.slug) == slug


def test_name_key(spark):
    df = spark.createDataFrame([("TX", "García López", "Ana María", "Jr."), (None, "Li", "", None), ("", "Li", None, "")], "s string, l string, f string, x string")
    assert [r[0] for r in df.select(text.name_key(*(F.col(c) for c in "slfx"))).collect()] == ["tx.garcia-lopez.ana.jr", "unk.li.", "unk.li."]


@pytest.mark.parametrize(("raw", "day"), [("2/9/2024", date(2024, 2, 9)), ("02/30/2024", None), ("13/1/2024", None), ("1/1/24", None), ("1/1/1989", None), ("1/1/2031", None), (None, None), (" 1/2/2020 ", date(2020, 1, 2))])
def test_mdy(spark, raw, day):
    assert one(spark, raw, lambda c: values.mdy_date(c, 2030)) == day


@pytest.mark.parametrize(("raw", "day"), [("28-OCT-24", date(2024, 10, 28)), ("28-oct-24", date(2024, 10, 28)), ("31-NOV-24", None), ("28-OCT-2024", None), ("", None)])
def test_day_month(spark, raw, day):
    assert one(spark, raw, values.day_month_date) == day


def test_compact_date_and_money(spark):
    assert one(spark, "02292024", values.compact_date) == date(2024, 2, 29) and one(spark, "02302024", values.compact_date) is None and one(spark, "2292024", values.compact_date) is None
    assert [one(spark, x, values.money) for x in ("12.5", " -3 ", "", None, "1d", "nan", "1_0", "1e2")] == [12.5, -3.0, 0.0, 0.0, 0.0, 0.0, 0.0, 100.0]


def test_ticker_and_tags(spark):
    assert [one(spark, x, values.ticker) for x in ("(The) (ko) [ST]", "Foo Inc", "A (b) (C)", None)] == ["KO", None, "C", None]
    assert one(spark, "Foo [st]", lambda c: values.type_code(values.type_tag(c))) == "ST"
    assert [one(spark, x, values.transaction_kind) for x in ("S (partial)", "purchase", "s")] == ["S(partial)", "P", "S"]


def test_amounts(spark):
    a = one(spark, "was $1,001 - $15,000 in", values.amount_of)
    assert (a.low, a.high, a.exact, a.label) == (1001, 15000, None, "$1,001 - $15,000")
    assert one(spark, "$894.97", values.amount_of).exact == 894.97 and one(spark, "none", values.amount_of) is None
    df = spark.createDataFrame([((1, 2, None, "a"),), ((None, None, 3.0, "b"),), ((1, None, None, "c"),), ((2, 1, None, "d"),), ((1, 2, 3.0, "e"),), (None,)], kinds.T.StructType([kinds.T.StructField("a", kinds.AMOUNT)]))
    assert [r[0] for r in df.select(values.amount_is_valid(F.col("a"))).collect()] == [True, True, False, False, False, True]
    assert [r[0] for r in df.select(values.amount_floor(F.col("a"))).collect()] == [1.0, 3.0, 1.0, 2.0, 3.0, None]


def test_seats_codes_calendar(spark):
    assert tuple(one(spark, "TX5x", values.state_district)) == ("TX5x", "TX", 0) and tuple(one(spark, "DC 00", values.state_district)) == ("DC 00", "DC", 0) and one(spark, "", values.state_district) is None
    assert one(spark, "Q", values.filing_label) == "unknown" and one(spark, None, values.family) == "fd" and one(spark, "P", values.family) == "ptr"
    assert [one(spark, y, values.cycle_of, "int") for y in (2023, 2024)] == [2024, 2024] and one(spark, 2024, values.congress_of, "int") == 118


def test_two_valued_text_matches(spark):
    assert [one(spark, x, lambda c: text.contains_ci(c, "a%")) for x in ("xA%y", "ab", "", None)] == [True, False, False, False]
    assert one(spark, "  x\t", text.strip_unicode) == "x" and one(spark, "a\x00\x00 b\n", text.collapse_space) == "a b"
