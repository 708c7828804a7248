import itertools

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyframe.llm import quota, stable

TARGETS = "dimension string, category string, target_share double, min_rows int"


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.floats(0.01, 1), st.integers(0, 8), st.integers(0, 60)), min_size=1, max_size=6), st.integers(0, 100))
def test_largest_remainder(rows, size):
    shares, floors, available = map(list, zip(*rows))
    q = quota.largest_remainder(size, shares, floors, available)
    assert all(0 <= x <= a for x, a in zip(q, available))
    low = [min(f, a) for f, a in zip(floors, available)]
    if sum(low) <= size:
        assert sum(q) == min(size, sum(available)) and all(x >= f for x, f in zip(q, low))
    ideal = [size * s / sum(shares) for s in shares]
    if all(f <= i <= a - 1 for f, i, a in zip(low, ideal, available)):
        assert all(abs(x - i) < 1 for x, i in zip(q, ideal))


def test_cells_meet_margins():
    r = np.random.default_rng(0)
    counts = r.integers(20, 60, (4, 5, 2))
    margins = [np.array([25, 25, 30, 20]), np.array([10, 20, 30, 20, 20]), np.array([60, 40])]
    x = quota.fit_cells(counts, margins)
    assert (x <= counts).all() and (x >= 0).all()
    for a, m in enumerate(margins):
        assert (x.sum(axis=tuple(b for b in range(3) if b != a)) == m).all()


def filings(spark, n=3000):
    rows = [(i, f"d{i // 2}", ("efiled", "scanned", None)[i % 3] if i % 50 else "rare", "P" if i % 4 else "O", i % 5, "clash", "clash", 0) for i in range(n)]
    return spark.createDataFrame(rows, "row_no long, doc_id string, pdf_class string, code string, load_no int, u string, rank string, quota int")


def test_sample(spark):
    targets = spark.createDataFrame([("pdf_class", "efiled", 0.5, 5), ("pdf_class", "rare", 0.3, 80), ("pdf_class", None, 0.2, 5), ("code", "P", 0.4, 5), ("code", "O", 0.5, 5), ("code", "none", 0.1, 4), ("unused", "x", 1.0, 1)], TARGETS)
    dims = {"pdf_class": F.col("pdf_class"), "code": F.col("code")}
    rows = filings(spark)
    got = quota.draw(rows.repartition(7), dims, targets, 200).collect()
    assert len(got) == 200 and got and {r.row_no for r in got} == {r.row_no for r in quota.draw(rows, dims, targets, 200).collect()}
    report = {(r.dimension, r.category): r for r in quota.plan(rows, dims, targets, 200)[1].collect()}
    assert report["pdf_class", "rare"].sampled == 60 and report["pdf_class", "rare"].below_minimum and report["pdf_class", "rare"].available == 60
    assert report["code", "none"].sampled == 0 and report["code", "none"].shortfall > 0 and ("unused", "x") not in report
    assert sum(r.sampled for (d, _), r in report.items() if d == "code") == 200
    # Within a cell the rows with the smallest keys are taken.
    key = {r.row_no: r.k for r in rows.select("row_no", F.sha2(F.concat_ws(":", F.lit("0"), F.col("row_no").cast("string")), 256).alias("k")).collect()}
    cell = {r.row_no: (r.pdf_class, r.code) for r in rows.select("row_no", "pdf_class", "code").collect()}
    chosen = {r.row_no for r in got}
    for c in set(map(cell.get, chosen)):
        inside = sorted((key[n], n) for n in cell if cell[n] == c)
        k = sum(n in chosen for _, n in inside)
        assert all(n in chosen for _, n in inside[:k])


def test_sample_of_nothing(spark):
    targets = spark.createDataFrame([("code", "P", 1.0, 5)], TARGETS)
    dims = {"code": F.col("code")}
    assert quota.draw(filings(spark).limit(0), dims, targets, 10).count() == 0
    assert quota.draw(filings(spark), dims, targets.limit(0), 10).count() == 0
    assert {r.dimension: r.shortfall for r in quota.plan(filings(spark).limit(0), dims, targets, 10)[1].collect()} == {"sample": 10, "code": 10}


def test_report_of_size_and_of_what_stands_in_the_way(spark):
    """`error` occurs only without a class, and of those too few are wanted."""
    rows = spark.createDataFrame([(i, None if i % 10 == 0 else "efiled", "error" if i % 10 == 0 else "ok") for i in range(1000)], "row_no long, pdf_class string, status string")
    targets = spark.createDataFrame([("pdf_class", "efiled", 0.95, 0), ("pdf_class", None, 0.05, 0), ("status", "ok", 0.8, 0), ("status", "error", 0.2, 0)], TARGETS)
    dims = {"pdf_class": F.col("pdf_class"), "status": F.col("status")}
    report = {(r.dimension, r.category): r for r in quota.plan(rows, dims, targets, 200)[1].collect()}
    total = report["sample", None]
    assert total.sampled == quota.draw(rows, dims, targets, 200).count() and total.shortfall == 200 - total.sampled
    short = {k: r.limited_by for k, r in report.items() if r.shortfall and k != ("sample", None)}
    assert sum(r.shortfall for r in report.values()) == 30 + total.shortfall
    assert short and all(why == {"efiled": "status=ok", "error": "pdf_class=None"}[c] for (_, c), why in short.items())


@settings(max_examples=25, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=8, max_size=8), st.integers(0, 9), st.randoms(use_true_random=False))
def test_cells_against_the_exact_optimum(cells, size, r):
    """Over all allocations of 2 x 2 x 2 cells none is nearer to the margins."""
    counts = np.array(cells).reshape(2, 2, 2)
    margins = [np.array(quota.largest_remainder(size, [r.random() + 0.1, r.random() + 0.1], [0, 0], counts.sum(axis=tuple(b for b in range(3) if b != a)).tolist())) for a in range(3)]
    off = lambda x: sum(np.abs(margins[a] - x.sum(axis=tuple(b for b in range(3) if b != a))).sum() for a in range(3))
    best = min(off(np.array(x).reshape(2, 2, 2)) for x in itertools.product(*(range(c + 1) for c in cells)))
    assert off(quota.fit_cells(counts, margins)) == best


RATES = {"efiled": 0.1, "scanned": 0.3}


def chosen(rows, **k):
    args = {"rates": RATES, "default": 0.2, "salt": "s", "earlier": None} | k
    return {r.doc_id: r.stratum for r in stable.sample(rows, "doc_id", F.coalesce("pdf_class", F.lit("none")), args["rates"], args["default"], args["salt"], args["earlier"]).collect()}


def test_stays_when_data_grow(spark):
    rows = filings(spark)
    before = {}
    for load in range(5):
        now = chosen(rows.where(F.col("load_no") <= load).repartition(load + 2))
        assert before.items() <= now.items()
        before = now
    assert before == chosen(rows.orderBy(F.rand(1))) and before == chosen(rows.union(rows))
    assert chosen(rows, salt="t") != before


def test_a_small_stratum_that_grows_keeps_its_rate(spark):
    rows = spark.range(10_010).select(F.col("id").alias("row_no"), F.concat(F.lit("d"), F.col("id").cast("string")).alias("doc_id"), F.lit("efiled").alias("pdf_class"), (F.col("id") >= 10).cast("int").alias("load_no"))
    later = [d for d in chosen(rows) if int(d[1:]) >= 10]
    assert 900 < len(later) < 1100


def test_keys_that_identify_nothing(spark):
    rows = spark.createDataFrame([(1, None, "a", 1), (2, " ", "a", None), (3, "x", None, None), (4, "x", "b", 1)], "row_no long, doc_id string, pdf_class string, load_no int")
    assert chosen(rows, rates={}, default=1.0) == {"x": "b"} and chosen(rows.limit(0)) == {}


def test_thresholds_are_never_lowered(spark):
    rows = filings(spark)
    first = chosen(rows)
    earlier = stable.thresholds(stable.sample(rows, "doc_id", F.coalesce("pdf_class", F.lit("none")), RATES, 0.2, "s"))
    assert {r.stratum: r.threshold for r in earlier.collect()} == {"efiled": 0.1, "scanned": 0.3, "none": 0.2, "rare": 0.2}
    lower, higher = chosen(rows, rates={}, default=0.01, earlier=earlier), chosen(rows, rates={"efiled": 0.5}, default=0.01, earlier=earlier)
    assert lower == first and first.items() < higher.items()
