import random
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyframe.llm import packing as P


def brute_bins(sizes, clusters, capacity):
    """Best fit decreasing, straight from its definition."""
    bins = []
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        fits = [b for b in bins if b[0] >= sizes[i] and clusters[i] not in b[1]]
        if fits:
            best = min(b[0] for b in fits)
            b = next(b for b in fits if b[0] == best)
        else:
            bins.append(b := [capacity, set()])
        b[0] -= sizes[i]
        b[1].add(clusters[i])
    return len(bins)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 64), st.integers(0, 12)), max_size=60))
def test_packs_like_best_fit(items):
    sizes, clusters = [s for s, _ in items], [c for _, c in items]
    rows = P.pack(sizes, [None] * len(items), clusters, list(range(len(items))), 64)
    used, held = defaultdict(int), defaultdict(list)
    for i, piece, b, offset, n in rows:
        assert offset == used[b] and piece == 0 and n == sizes[i]
        used[b] += n
        held[b].append(clusters[i])
    assert all(u <= 64 for u in used.values()) and all(len(set(h)) == len(h) for h in held.values())
    assert sorted(r[0] for r in rows) == list(range(len(items)))
    assert len(used) == brute_bins(sizes, clusters, 64)


def test_long_items_and_conflicts():
    rows = P.pack([150, 10, 0], ["a", "b", "a"], [1, 2, 3], [0, 1, 2], 64, {"a": frozenset({"b"}), "b": frozenset({"a"})})
    assert sorted((i, k, n) for i, k, _, _, n in rows) == [(0, 0, 64), (0, 1, 64), (0, 2, 22), (1, 0, 10)]
    bins = defaultdict(set)
    for i, _, b, _, _ in rows:
        bins[b].add(i)
    assert all(len(v) == 1 for v in bins.values())


def test_copies_of_one_text_spread():
    r = random.Random(2)
    n = 3000
    clusters = [7 if i % 3 == 0 else None for i in range(n)]
    rows = P.pack([r.randint(20, 60) for _ in range(n)], ["s"] * n, clusters, list(range(n)), 256)
    per = defaultdict(int)
    for i, _, b, _, _ in rows:
        per[b] += clusters[i] == 7
    assert max(per.values()) == 1 and len(rows) == n


@pytest.mark.parametrize("share", [50_000, 40])
def test_tables(spark, share):
    texts = ["word " * (i % 90 + 1) for i in range(150)] + [None, "", "  ", "long " * 5000] + ["copy of this"] * 30
    df = spark.createDataFrame([(i % 180, "src" if i % 2 else None, t, 5) for i, t in enumerate(texts)], "doc_id long, source string, text string, n_tokens int")
    out = P.fill(df, 256, share=share).collect()
    used = defaultdict(int)
    for r in out:
        if r.container is not None:
            used[r.container] += r.n_tokens
    assert max(used.values()) <= 256
    whole = [r for r in out if r.container is None]
    assert len(whole) == 2 and all(r.n_tokens == 0 for r in whole)
    copies = [r.container for r in out if 154 <= r.doc_id < 180]
    assert len(set(copies)) == len(copies)
    report = P.fill_report(P.fill(df, 256, share=share), 256).first()
    assert report.containers == len(used) and report.tokens == sum(used.values())
    assert P.fill(df.limit(0), 256).count() == 0
