import random
from datetime import datetime, timedelta

from hypothesis import given, settings
from hypothesis import strategies as st

from tallyframe.operators import delivery as D

SCHEMA = "delivery_no long, received_at timestamp, file_num string, tran_id string, amndt_ind string, serial string, number string, row string"
T0 = datetime(2024, 1, 1)


def table(spark, rows):
    return spark.createDataFrame([(n, T0 + timedelta(minutes=m) if m is not None else None, f, t, a, "clash", "clash", "clash") for n, m, f, t, a in rows], SCHEMA)


def brute(rows):
    key = lambda r: ((r[2] or "").strip().upper().split(".")[0].lstrip("0") or "0", (r[3] or "").strip().upper(), (r[4] or "").strip().upper())
    best = {}
    for r in rows:
        if key(r)[1] and (key(r) not in best or (r[1] is None, r[1], r[0]) < (best[key(r)][1] is None, best[key(r)][1], best[key(r)][0])):
            best[key(r)] = r
    return sorted(r[0] for r in rows if key(r)[1] and best[key(r)] is not r)


def test_spellings_of_one_expenditure(spark):
    rows = [
        (1, 5, "2000287", "SE24.1", "N"), (2, 3, "2000287.0", " se24.1 ", "n "), (3, 9, "0002000287", "SE24.1\t", " N"), (4, 1, "2000287", "SE24.1", "A1"),
        (5, 1, "2000287", "SE24.01", "N"), (6, 1, "2000287", "", "N"), (7, 1, "2000287", "  ", "N"), (8, 1, "2000287", None, "N"), (9, 1, "2000288", "SE24.1", "N"),
    ]
    assert sorted(r[0] for r in D.surplus_deliveries(table(spark, rows)).collect()) == [1, 3]
    kept = D.deliver_once(table(spark, rows))
    assert sorted(r.delivery_no for r in kept.collect()) == [2, 4, 5, 6, 7, 8, 9] and kept.columns == table(spark, rows).columns


def test_against_brute_force(spark):
    r = random.Random(7)
    ids = ["SE24.%d" % i for i in range(1, 40)] + ["IE-SUP-%04d" % i for i in range(1, 30)] + ["E2%018X" % i for i in range(20)] + ["A7", "77", "007", "", " ", None, "x"]
    rows = [(n, r.choice([None, *range(50)]), r.choice(["200", "0200", "200.0", "201", None, ""]), r.choice(ids), r.choice(["N", "n", "A1", None, " "])) for n in range(2500)]
    rows += [(10_000 + n, 7, "999", "HOT.1", "N") for n in range(1200)]  # a third of all under one identifier
    got = sorted(x[0] for x in D.surplus_deliveries(table(spark, rows).repartition(7)).collect())
    assert got == brute(rows)


def test_batches_take_up_what_was_seen(spark):
    first = [(1, 1, "5", "A.1", "N"), (2, 2, "5", "A.2", "N"), (3, 3, "5", "A.2", "N"), (4, 3, "5", "EABCDEF0123456789", "N")]
    surplus, seen = D.split_deliveries(table(spark, first))
    assert [r[0] for r in surplus.collect()] == [3]
    assert [(r.lo, r.hi) for r in seen.ranges.collect()] == [(1, 2)]
    second = [(5, 0, "5", "A.1", "N"), (6, 9, "5", "A.3", "N"), (7, 9, "5", "A.5", "N"), (8, 9, "5", "eabcdef0123456789 ", "N")]
    surplus, after = D.split_deliveries(table(spark, second), seen)
    assert sorted(r[0] for r in surplus.collect()) == [5, 8]
    assert sorted((r.lo, r.hi) for r in after.ranges.collect()) == [(1, 3), (5, 5)]
    assert after.exact.count() == 1


def test_empty_table(spark):
    assert D.surplus_deliveries(table(spark, [])).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 60), max_size=80))
def test_ranges_stay_disjoint(numbers):
    seen, ranges = set(), D.RangeSet()
    for n in numbers:
        assert ranges.add(n, n) == (n not in seen)
        seen.add(n)
    covered = [x for lo, hi in zip(ranges.lo, ranges.hi) for x in range(lo, hi + 1)]
    assert covered == sorted(seen)
    assert all(b > a + 1 for a, b in zip(ranges.hi, ranges.lo[1:]))


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 60), st.integers(0, 12)), max_size=40))
def test_ranges_merge_ranges(pairs):
    seen, ranges = set(), D.RangeSet()
    for lo, size in pairs:
        new = set(range(lo, lo + size + 1))
        assert ranges.add(lo, lo + size) == (not new <= seen)
        seen |= new
    assert [x for lo, hi in zip(ranges.lo, ranges.hi) for x in range(lo, hi + 1)] == sorted(seen)
