import json
import random

import pytest
from pyspark.sql import functions as F

from tallyframe.operators import nested

FD = "body_id long, body string, extra string, kind string, pre int"
PTR = "body_id long, transactions array<struct<owner:string,asset:string,amount_range:struct<low:bigint,high:bigint,exact:double,label:string>>>"


def keys(spark, bodies, ptr=()):
    fd = spark.createDataFrame([(i, b, "x", "clash", 9) for i, b in bodies], FD)
    rows = nested.line_item_keys(fd, spark.createDataFrame(list(ptr), PTR)).collect()
    return sorted((r[0], r[1], r[2]) for r in rows)


def test_shapes_of_bodies(spark):
    a = {"asset": "x"}
    bodies = [
        (1, json.dumps({"schedules": {"A": [a, None, a], "b": None, "C": {"items": [a, None], "note": "n"}, "D": a}})),
        (2, json.dumps({"pages": [{"page": 1, "schedules": {"A": [a]}}, {"page": 2, "schedules": {"a": [a, a]}}, {"page": 3, "schedules": {}}]})),
        (3, json.dumps(json.dumps({"schedules": {"e": [a]}}))),
        (4, "﻿" + json.dumps({"schedules": {"A": [a]}})),
        (5, '{"schedules": {"A": [{"asset": "cut'),
        (6, None),
        (7, "   "),
        (8, "null"),
        (9, "{}"),
    ]
    assert keys(spark, bodies) == [
        (1, "A", 1), (1, "A", 2), (1, "C", 1), (1, "D", 1), (2, "A", 1), (2, "A", 2), (2, "A", 3), (3, "E", 1), (4, "A", 1),
    ]


def test_repeated_keys_and_ids_and_null_ids_stay_apart(spark):
    two = '{"schedules": {"A": [{"asset": "x"}], "A": [{"asset": "y"}]}}'
    one = '{"schedules": {"A": [{"asset": "z"}]}}'
    rows = keys(spark, [(1, two), (1, one)]) + []
    assert rows == [(1, "A", 1), (1, "A", 1), (1, "A", 2)]
    fd = spark.createDataFrame([(None, one, "", "", 0), (None, one, "", "", 0)], FD)
    got = nested.line_item_keys(fd, spark.createDataFrame([], PTR)).collect()
    assert [(r[0], r[2]) for r in got] == [(None, 1), (None, 1)]


def test_transactions_and_empty_tables(spark):
    t = ("SP", "Foo [ST]", (1001, 15000, None, "$1,001 - $15,000"))
    assert keys(spark, [], [(5, [t, None, t]), (6, None), (7, [])]) == [(5, "PTR", 1), (5, "PTR", 2)]
    assert keys(spark, []) == []


def test_intervals_contain(spark):
    body = json.dumps({"schedules": {"A": [{"asset": "x", "value_of_asset": {"low": 1, "high": 200, "label": "$1 - $200"}}, {"asset": "y"}], "B": [{"asset": "z"}]}})
    fd = spark.createDataFrame([(1, body, "", "", 0)], FD)
    nodes = nested.interval_nodes(fd, "body_id", "body", ("body", "schedule", "item", "amount")).collect()
    by = {(n.kind, n.pre): n for n in nodes}
    root = next(n for n in nodes if n.kind == "body")
    assert all(root.pre < n.pre and root.post > n.post for n in nodes if n is not root)
    a, b = sorted((n for n in nodes if n.kind == "schedule"), key=lambda n: n.pre)
    inside = lambda s: [n for n in nodes if n.kind == "item" and s.pre < n.pre and s.post > n.post]
    assert (a.label, len(inside(a)), b.label, len(inside(b))) == ("A", 2, "B", 1)
    amount = next(n for n in nodes if n.kind == "amount")
    holder = [n for n in inside(a) if n.pre < amount.pre and n.post > amount.post]
    assert len(holder) == 1 and (amount.low, amount.high) == (1, 200)
    assert len({n.pre for n in nodes}) == len(by) == len({n.post for n in nodes})


@pytest.mark.parametrize(
    ("value", "expected"),
    [
        ((("low", 1), ("high", 200), ("label", "x")), (1, 200, None, "x")),
        ((("low", "1,001"), ("high", "15,000")), (1001, 15000, None, None)),
        ((("exact", 12.5),), (None, None, 12.5, None)),
        ("$1 - $200", (1, 200, None, "$1 - $200")),
        ("$12,000.50", (None, None, 12000.5, "$12,000.50")),
        ("N/A", (None, None, None, "N/A")),
        (7, (None, None, 7.0, "7")),
    ],
)
def test_amounts_in_any_shape(value, expected):
    assert nested.read_amount(value) == expected


def test_line_tables(spark):
    body = json.dumps({"schedules": {"A": [{"asset": "x", "income_type": ["Rent", "None"], "value_of_asset": "$1 - $200", "income_amount": {"exact": 5.5}}], "D": [{"creditor": "Bank", "amount_range": {"low": "1", "high": "2"}}]}})
    fd, ptr = spark.createDataFrame([(1, body, "", "", 0)], FD), spark.createDataFrame([], PTR)
    items = {(r.schedule, r.item_no): r for r in nested.line_items(fd, ptr).collect()}
    assert items["A", 1].name == "x" and items["A", 1].income_type == "Rent; None" and items["D", 1].name == "Bank"
    amounts = {(r.schedule, r.item_no, r.field): (r.low, r.high, r.exact) for r in nested.line_amounts(fd, ptr).collect()}
    assert amounts == {("A", 1, "value_of_asset"): (1, 200, None), ("A", 1, "income_amount"): (None, None, 5.5), ("D", 1, "amount_range"): (1, 2, None)}


def test_long_and_deep_bodies(spark):
    wide = json.dumps({"schedules": {"A": [{"asset": "x" * 50}] * 5000}})
    deep = '{"schedules": {"A": ' + "[" * 3000 + "]" * 3000 + "}}"
    got = keys(spark, [(1, wide), (2, deep), (3, '{"schedules": {"A": [{"asset": "z"}]}}')])
    assert sum(k[0] == 1 for k in got) == 5000 and (3, "A", 1) in got
    assert F is not None


def test_bodies_that_break_parsers(spark):
    """NaN isn't JSON; huge, fractional and odd numbers keep their text; depth and wrapping have no bound."""
    deep = "[" * 5000 + "1" + "]" * 5000
    wrapped = '{"A":[{"asset":"x"}]}'
    for _ in range(7):
        wrapped = json.dumps(wrapped)
    rows = [
        (1, '{"A":[{"asset":"x","value_of_asset":NaN}]}'), (2, '{"A":[{"asset":"x","value_of_asset":{"low":1e30,"high":2}}]}'), (3, '{"A":[{"asset":"x","income_amount":' + "9" * 5000 + "}]}"),
        (4, '{"A":[{"asset":"x","value_of_asset":{"low":"$1,000.75","high":"$2,000.00","label":"odd"}}]}'), (5, f'{{"A":[{{"asset":{deep}}},{{"asset":"y"}}]}}'), (6, wrapped), (7, '{"pages":' * 3000 + '{"A":[{}]}' + "}" * 3000),
        (8, '{"A":[{}]} x'), (9, "[" * 5000), (10, '{"A":[{"amount":Infinity}]}'), (11, '{"A":[{"amount":1e999}]}'), (12, "[" * 4000 + "1,]" + "]" * 3999),
    ]
    fd = spark.createDataFrame([(i, b, "clash") for i, b in rows], "body_id long, body string, doc string")
    none = spark.createDataFrame([], PTR)
    keys = sorted((r.body_id, r.schedule, r.item_no) for r in nested.line_item_keys(fd, none).collect())
    assert keys == [(2, "A", 1), (3, "A", 1), (4, "A", 1), (5, "A", 1), (5, "A", 2), (6, "A", 1), (7, "A", 1), (11, "A", 1)]
    amounts = {r.body_id: (r.low, r.high, r.exact, r.text) for r in nested.line_amounts(fd, none).collect()}
    assert amounts == {2: (None, 2, None, '{"low": 1e+30, "high": 2}'), 3: (None, None, None, "inf"), 4: (None, 2000, None, "odd"), 11: (None, None, None, "inf")}


def test_the_parser_for_deep_bodies():
    for text in ('{"a":[1,{"b":[]},{}],"a":"x\\"y","c":-1.5e3,"d":null}', "[]", "{}", ' [true , false] ', '"s"', "3"):
        assert nested._deep(text) == json.loads(text, object_pairs_hook=tuple)
    for text in ("", "[1", "{1:2}", '{"a"}', "[1,]", "[1 2]", '{"a":1,}', "]", "[}", '{"a":}', "nul", "[1] 2", "01x"):
        with pytest.raises(ValueError):
            nested._deep(text)


def test_containment_of_random_trees():
    """The sweep finds what the intervals say."""
    r = random.Random(7)
    for _ in range(50):
        tree = {"schedules": {k: [{"asset": "x", "amount": {"low": 1, "high": 2}} for _ in range(r.randrange(4))] + ([None] if r.random() < 0.5 else []) for k in "ABC"}, "pages": [{"A": [{"amount": "$5"}]}]}
        t = nested.Traversal({"schedule", "item", "amount"})
        t.body(1, 1, nested._load(json.dumps(tree)))
        for n in nested.contained(t.rows, {"item", "amount"}):
            holders = [x for x in t.rows if x[3] < n[3] and x[4] > n[4]]
            assert [x[5] for x in holders if x[2] == "schedule"] == [n[11]]
            inside = sorted(x[3] for x in t.rows if x[2] == "item" and any(s[2] == "schedule" and s[5] == n[11] and s[3] < x[3] and s[4] > x[4] for s in t.rows))
            own = n[3] if n[2] == "item" else next(x[3] for x in holders if x[2] == "item")
            assert n[12] == inside.index(own) + 1
