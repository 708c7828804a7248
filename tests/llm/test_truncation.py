import random
from collections import Counter

import pyarrow as pa
import pytest

from tallyframe.llm import truncation as K

H = {("", "label"): {"schedule": 9}, ("s", "cents"): {"$": 9}, ("s", "closer"): {"hkw": 9}, ("s", "item"): {"check the index": 5, "scan 9999": 4, "thank A": 3}, ("s", "shape"): {"A 99 of 99": 9, "cc: records desk": 4}}


@pytest.mark.parametrize(
    ("text", "kind"),
    [
        ("It is done.", "firm"), ("It is done (sic).", "firm"), ('He said "done."', "firm"), ("It is done. 📄", "firm"), ("It is do", "open"), ("It is", "open"), ("It cost $35,167.", "open"), ("It cost $1 - $35,167.", "firm"),
        ("A gift from Gerald I.", "open"), ("It is listed under Schedule A.", "firm"), ("row $1 - $200 hkw", "firm"), ("row $1 - $2", "open"), ("done.\n- check the index", "firm"), ("done.\n- check the in", "open"),
        ("done.\n* scan 99", "open"), ("done.\n* thank Ann", "weak"), ("x\nPage 10 of 12", "weak"), ("x\ncc: records", "open"), ("Bye.\n\nSincerely,\nAnn B. Stone", "weak"), ("Every reg…", "open"), ("Every reg (more)", "open"),
        ("Every reg�", "open"), ("Every &am", "open"), ("It is done.  \r\n​", "firm"), ("Does it?", "firm"), ("listed un-\nder Sche-\r\ndule E.", "firm"),
    ],
)
def test_endings(text, kind):
    assert K.ending(text, "s", H)[0] == kind


def test_lengths():
    t = 'é<&"\n\r\n🎉'
    n = K.lengths(t)
    assert n["characters"] == 8 and n["utf8_bytes"] == len(t.encode()) and n["utf16_units"] == 9 and n["newlines_lf"] == 7 and n["newlines_crlf"] == 9
    assert n["entities"] == 8 + 3 + 4 and n["entities_undone"] == 8 and K.lengths("a&amp;b")["entities_undone"] == 3


def corpus(n=1500, seed=1):
    """Sentences; `long` cuts at 120 UTF-8 bytes, `short` never cuts, `mid` loses the end of some in transfer."""
    r = random.Random(seed)
    words = "the clerk filed a notice über every ledger and nobody noticed that its sum was wrong again".split()
    sentence = lambda: (" ".join(r.choice(words) for _ in range(r.randint(5, 14))).capitalize() + ".")
    rows, cut = [], set()
    for i in range(n):
        source = ("long", "short", "mid")[i % 3]
        text = " ".join(sentence() for _ in range(r.randint(1, 4)))
        if source == "long":
            b = text.encode()[:120]
            short = b.decode("utf-8", "ignore")
            if short != text and not short.rstrip().endswith("."):
                cut.add(i)
            text = short
        elif source == "mid" and r.random() < 0.1:
            at = r.randrange(3, len(text))
            if not text[:at].rstrip().endswith("."):
                cut.add(i)
            text = text[:at]
        rows.append((i, source, text, "clash", "clash"))
    return rows, cut


def test_corpus(spark):
    rows, cut = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string, ending string, cut string")
    got = {r.doc_id for r in K.found(docs.repartition(5)).collect()}
    assert len(got & cut) / len(got) > 0.98 and len(got & cut) / len(cut) > 0.98
    rates = {r.source: r for r in K.rates(docs).collect()}
    assert rates["short"].cut == 0 and "utf8_bytes 120" in rates["long"].limits and rates["mid"].limits is None


def test_no_cases(spark):
    rows = [(1, "a", None), (2, "a", ""), (3, None, " \n​"), (4, None, "cut he"), (5, "a", "x" * 300_000), (4, None, "cut he")]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    assert sorted(r.doc_id for r in K.found(docs).collect()) == [4, 4, 5]
    assert {r.source: r.texts for r in K.rates(docs).collect()} == {"a": 1, None: 2}
    assert K.found(docs.limit(0)).count() == 0 and K.rates(docs.limit(0)).count() == 0


def test_counts_do_not_depend_on_partitions():
    """Words that are rare in each partition count in full."""
    texts = ["the total F is\nsee F", "F of it\nF", "an F here", "F", "w" * 90 + " F x"] * 3

    def sums(parts):
        out = Counter()
        for part in parts:
            for b in K._count(iter([pa.record_batch([pa.array(["s"] * len(part)), pa.array(part)], names=["source", "text"])])):
                for r in b.to_pylist():
                    out[r["kind"], r["key"], "n"] += r["n"]
                    out[r["kind"], r["key"], "total"] += r["total"]
        return +out

    whole = sums([texts])
    assert whole["closer", "F", "total"] == 21 and whole["closer", "w" * 41, "total"] == 3
    assert sums([[t] for t in texts]) == whole


@pytest.mark.parametrize("parts", [1, 40, 400])
def test_habits_do_not_depend_on_partitions(spark, small, parts):
    docs = spark.read.parquet(f"{small}/documents.parquet").repartition(parts)
    habits = K.line_habits(docs)
    assert habits == HABITS.setdefault("first", habits) and ("clerk_fd_page", "closer") in habits


HABITS: dict = {}


def test_labels_and_cents_are_learned(spark):
    """A letter after `Annexe` stands without a point or ends texts, one after a given name doesn't; sums have cents."""
    texts = [f"See Annexe {x} and Annexe {x}. It was signed by Ann {x}. Stone for $1,{n:03d}.50 in all." for n in range(20) for x in "BCD"] + ["It is in Annexe B."] * 9
    docs = spark.createDataFrame([(i, "s", t) for i, t in enumerate(texts)] + [(900, "s", "It was paid to Ann B."), (901, "s", "The sum was $35,167."), (902, "s", "It follows from Annexe E.")], "doc_id long, source string, text string")
    habits = K.line_habits(docs)
    assert set(habits["", "label"]) == {"annexe"} and ("s", "cents") in habits
    assert sorted(r.doc_id for r in K.found(docs).collect()) == [900, 901]


def test_long_tokens_and_long_last_lines(spark):
    """A token of a million characters beside a closer; a closing line longer than a shape that is kept as it is."""
    closing = "Prepared by the office of the clerk for the record of the proceedings of the committee in its session no 12"
    assert len(closing) > K.LONGEST_SHAPE
    rows = [(i, "s", "x" * (1_000_000 if i < 4 else 100) + f" is the sum.\n{closing}") for i in range(40)] + [(99, "s", "It is the sum.\n" + closing[:90])]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    assert [r.doc_id for r in K.found(docs).collect()] == [99]
    assert K.last_segment("a" * 1000 + "; the end" + "b" * 600) == "the end" + "b" * 600 and K.last_words("a b c d e") == "b c d e"


def test_long_items_that_break_off(spark):
    """Items of any length teach their shape; one that breaks off in the middle is cut."""
    long = "send the signed copy of the amended statement to the office of the clerk together with every receipt for the quarter"
    rows = [(i, "s", f"Please do this.\n- check the index\n- {long}\n- check the index") for i in range(40)] + [(99, "s", f"Please do this.\n- check the index\n- {long[:95]}")]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    assert len(long) > K.LONGEST_SHAPE and K.ending(rows[-1][2], "s", K.line_habits(docs)) == ("open", "unknown item")
    assert [r.doc_id for r in K.found(docs).collect()] == [99]
