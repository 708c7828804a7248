import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyframe.llm import tokens as K

tokenizers = pytest.importorskip("tokenizers")
ODD = [
    "", None, " ", "  a", "a  b \n c", "\x1c\x1d a\x1e b", "é́ ñandú 日本語のテキスト 한국어 🎉🎉👨‍👩‍👧", "a​b   x　y", "'s don't we'll I'M", "<|endoftext|> a <|endoftext|>", "﻿abc \x00\x01",
    "\x00\x01 \x00\x01", "a" * 5000, "ab" * 3000, "\t\t x\r\n\r\n  y ", "1234567890 12,345.67 ½ ² ٣٤", "᠎ x᠎ y \u0085 z", " " * 50 + "x" + " " * 7,
]


@pytest.fixture(scope="module")
def path():
    p = K.default_path()
    return p


@pytest.fixture(scope="module")
def reference(path):
    t = tokenizers.Tokenizer.from_file(path)
    t.encode_special_tokens = True
    return lambda texts: [e.ids for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def own(pairs, texts):
    ids, ends = pairs.encode(texts)
    return [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:])]


def test_odd_texts(path, reference):
    pairs = K.BytePairs(path)
    assert own(pairs, ODD) == reference(ODD) == own(pairs, ODD)
    assert pairs.counts(ODD).tolist() == [len(x) for x in reference(ODD)]


def test_random_texts(path, reference):
    r, pool = random.Random(0), list(" \t\n\r\x0b\x1c\x85\xa0 　ab'sZé日1２½.,-_́‍🎉")
    texts = ["".join(r.choice(pool) for _ in range(r.randint(0, 60))) for _ in range(3000)]
    assert own(K.vocabulary(path), texts) == reference(texts)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=5))
def test_any_text(texts):
    texts = [t.encode("utf-8", "ignore").decode("utf-8") for t in texts]
    t = tokenizers.Tokenizer.from_file(K.default_path())
    t.encode_special_tokens = True
    assert own(K.vocabulary(K.default_path()), texts) == [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]


def test_tables_begin_anew(path, reference, monkeypatch):
    monkeypatch.setattr(K, "MOST_PIECES", 10)
    pairs = K.BytePairs(path)
    for part in (ODD, ["some words that are new here and there"] * 3, ODD):
        assert own(pairs, part) == reference(part)


def test_rank_queue():
    r, q = random.Random(1), K.RankQueue()
    want = [r.randrange(50_000) for _ in range(2000)]
    for i, x in enumerate(want):
        q.push(x, i)
    got = []
    while (x := q.first()) >= 0:
        got += [x] * len(q.buckets.pop(x))
    assert got == sorted(want)


def test_tables(spark, reference):
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(ODD)] + [(0, "again", "clash"), (None, "no id", None)], "doc_id long, text string, ids string")
    got = sorted(((r.doc_id, r.ids) for r in K.encode(df).collect()), key=str)
    want = sorted([*enumerate(reference(ODD)), (0, reference(["again"])[0]), (None, reference(["no id"])[0])], key=str)
    assert got == want
    assert K.encode(df.limit(0)).count() == 0
    n = K.token_counts(df, ["doc_id"]).collect()
    assert sum(r.n_tokens for r in n) == sum(len(x) for _, x in want)
