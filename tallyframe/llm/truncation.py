"""Texts that were cut: which, by which hidden limit, and how often in each source.

Three passes, each over all texts:
1. What whole lines look like in each source is counted: last words that nearly always end a line (`closers`), shapes
   of list items that another line follows, shapes of last segments that recur as closing lines, words that a lone letter
   follows as their label ("Part B"), and whether sums of money are given with cents.
2. Each ending is inspected with that: it is `open` (breaks off), `weak` (whole as far as can be seen, but could be the
   beginning of something longer, as a name is), or `firm`. The text's length is taken again under alternative
   encodings, entity escaping, JSON escaping and newline conversion, with and without a mark of truncation.
3. Lengths are grouped by source and measure; a length at which far more open endings lie than at its neighbours is a
   hidden storage limit. At a limit also weak endings count as cut, if most of them are there because of the limit.

Defined cases
* Null, empty and blank texts (also those of invisible characters only) are no cases: neither cut nor whole.
* White space, control and invisible characters at the end are ignored, as are emoji after a whole ending.
* A null source is a source of its own.
* Shares of a source decide, not absolute counts, except that a habit needs HABIT_LINES lines and a limit LIMIT_DOCS
  open endings. The counts are over all texts and whole texts, and their sums don't depend on how the texts are parted.
* Texts, lines, words and list items may be of any length. A word of more than LONGEST_CLOSER characters is no closer.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tallyframe.session import cut_lineage, ship

# From which share of a source's texts a closer, an item shape and a closing shape count, and how often a closer must end
# a line; which share of the uses of a word before a lone letter must show that the letter is no initial.
CLOSER_SHARE, CLOSER_RATE, ITEM_SHARE, SHAPE_SHARE, LABEL_RATE = 0.01, 0.9, 0.0005, 0.01, 0.03
# A habit must also be this share of all of its kind (line ends, items, lone letters) in a source. So of each kind there
# are at most 1 / BOUND habits (2 / SHAPE_SHARE closing shapes, as a text gives two at most), however many texts.
BOUND = 0.0003
# Below so many lines no habit is taken for one; a shape with longer forms so many times as frequent is their beginning.
HABIT_LINES, LONGER_TIMES = 4, 3
LIMIT_DOCS, LIMIT_SHARE, LIMIT_TIMES, NEIGHBOURS = 6, 0.001, 6.0, 20
# A longer shape is told by its beginning and a hash of the whole.
LONGEST_SHAPE = 80
# Of a longer word only its beginning matters, as a word that a closer may be a piece of.
LONGEST_CLOSER = 40

# Marks that say that more text followed.
MARKS = re.compile(r"(?:…|\.\.\.|�|\[(?:\.\.\.|…|more|truncated|cont(?:inued|\.)?)\]|\((?:more|cont(?:inued|\.)?|truncated|\.\.\.|…)\)|>>|»»|&(?:[a-z]{1,5}|#[0-9x]{0,5}))$", re.I)

_TERMINAL = re.compile(r"[.?!。？！][\"'”’»)\]]*$")
_ITEM = re.compile(r"\s*[-*•]\s+(\S.*)")
_LONE = re.compile(r" ([^\W\d_])(\.?)(?=[\s,;:)]|$)")
_INITIAL = re.compile(r"(?:(\w+)\s+)?\b([^\W\d_])\.$")
_SUM = re.compile(r"(?<!- )\$[0-9]{1,3}(?:,[0-9]{3})+(\.[0-9]{2})?(?![0-9]|\s*-)")
_DOLLARS = re.compile(r"(?<!- )\$[0-9]{1,3}(?:,[0-9]{3})+\.$")
_WRAPPED, _SPACES = re.compile(r"(?<=[^\W\d_])-\s*[\r\n]+\s*"), re.compile(r"\s+")
_NO_CLOSER = re.compile(r"[0-9,;:\-]|^&")
_SEGMENT = re.compile(r"&amp;|;|\n|[.?!]\s")
_PART = re.compile(r"[^\W\d_][^\W_]*|[0-9]+")
_NAMES = re.compile("\x01(?:[.'’\\-\\s]*\x01)*\\.?")
_NAME_WORD = re.compile(r"[\"(“]?[^\W\d_][\w.,'’\-]*[\")”]?")


def name_like(line: str) -> bool:
    """A few capitalised words."""
    words = line.split()
    return 0 < len(words) <= 7 and all(_NAME_WORD.fullmatch(w) and w.lstrip("\"(“")[0].isupper() for w in words)


def shape(line: str) -> str:
    """Lower-case words as they are, capitalised words and names as one mark, digits as nines."""

    def mask(m: re.Match) -> str:
        w = m[0]
        return "9" * len(w) if w[0].isdigit() else "\x01" if w[0].isupper() else w

    return _NAMES.sub("A", _PART.sub(mask, line.strip()))


def _bare(text: str) -> str:
    """Without white space, control and other invisible characters at the end."""
    end = len(text)
    while end and (text[end - 1].isspace() or unicodedata.category(text[end - 1]) in ("Cc", "Cf", "Zs", "Zl", "Zp")):
        end -= 1
    return text[:end]


def _unadorned(text: str) -> str:
    """Without emoji at the end."""
    end = len(text)
    while end and (unicodedata.category(text[end - 1]) in ("So", "Sk", "Mn", "Cf", "Cs") or text[end - 1].isspace()):
        end -= 1
    return text[:end]


def without_mark(text: str) -> tuple[str, bool]:
    """(text before a mark of truncation, whether there was one)."""
    bare = _bare(text)
    if m := MARKS.search(bare):
        return bare[: m.start()], True
    return bare, False


def last_line(text: str) -> str:
    return text[max(text.rfind("\n"), text.rfind("\r")) + 1 :].strip()


def last_segment(text: str) -> str:
    """What follows the last separator of the last line, or all of it."""
    line = last_line(text)
    at = 0
    for m in _SEGMENT.finditer(line):
        if m.end() < len(line):
            at = m.end()
    return line[at:].strip()


def last_words(text: str, n: int = 4) -> str:
    """The text's end from its last n words on, with hyphenated line breaks undone."""
    head = text.rsplit(None, n)
    tail = text[len(head[0]) :] if len(head) > n else text
    return _SPACES.sub(" ", _WRAPPED.sub("", tail)).strip()


def word_before(text: str, at: int) -> str:
    """The word that ends at a place, in lower case."""
    start = at
    while start and (text[start - 1].isalnum() or text[start - 1] == "_"):
        start -= 1
    return text[start:at].lower()


def shape_key(line: str) -> str:
    """The shape of a line; of a long one its beginning and a hash of the whole."""
    s = shape(line)
    return s if len(s) <= LONGEST_SHAPE else f"{s[:LONGEST_SHAPE]}\x02{blake2b(s.encode('utf-8', 'surrogatepass'), digest_size=8).hexdigest()}"


def closing_shapes(text: str) -> set[str]:
    """Shapes of the last line and of its last segment."""
    return {shape_key(x) for x in (last_line(text), last_segment(text))}


# ---------------------------------------------------------------- pass 1

_STAT = T.StructType([T.StructField("source", T.StringType()), T.StructField("kind", T.StringType()), T.StructField("key", T.StringType()), T.StructField("n", T.LongType()), T.StructField("total", T.LongType())])
_STAT_ARROW = pa.schema([("source", pa.string()), ("kind", pa.string()), ("key", pa.string()), ("n", pa.int64()), ("total", pa.int64())])
_FLUSH, _FLUSH_LETTERS = 200_000, 20_000_000


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts whose sums don't depend on how the texts are parted: each word is given out, however rare."""
    ends: Counter = Counter()
    words: dict = {}
    other: Counter = Counter()
    lone: dict = defaultdict(lambda: [0, 0])  # lone letters after a word without and with a point; sums with cents and without
    letters = 0  # of shapes, which may be of any length

    def flush() -> pa.RecordBatch:
        rows = [(s, "closer", w, n, words[s][w]) for (s, w), n in ends.items()] + [(s, k, x, n, 0) for (s, k, x), n in other.items()]
        # Words that ended no line here still count for those that end one elsewhere.
        rows += [(s, "closer", w[: LONGEST_CLOSER + 1], 0, n) for s, c in words.items() for w, n in c.items() if (s, w) not in ends]
        rows += [(s, "cents" if w == "$" else "label", w, n[0], sum(n)) for (s, w), n in lone.items()]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _STAT_ARROW)], schema=_STAT_ARROW)

    for batch in batches:
        for source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if not text or not (text := _bare(text)):
                continue
            other[source, "docs", ""] += 1
            lines = text.splitlines()
            words.setdefault(source, Counter()).update(text.split())
            for line in lines:
                if w := line.rsplit(None, 1)[-1:]:
                    if len(w[0]) <= LONGEST_CLOSER and not _TERMINAL.search(w[0]) and not _NO_CLOSER.search(w[0]):
                        ends[source, w[0]] += 1
                        other[source, "all closer", ""] += 1
            for line in lines[:-1]:
                if m := _ITEM.fullmatch(line):
                    other[source, "item", s := shape(m[1])] += 1
                    other[source, "all item", ""] += 1
                    letters += len(s)
            if not _TERMINAL.search(text):
                for s in closing_shapes(text):
                    if not _may_be_piece(s):
                        other[source, "shape", s] += 1
                        letters += len(s)
            for m in _LONE.finditer(text):
                if m[1].isupper() and (w := word_before(text, m.start())):
                    # No initial if it stands without a point or where a text ends. Words are those of all sources.
                    lone["", w[:LONGEST_CLOSER]][bool(m[2]) and m.end() < len(text)] += 1
                    other["", "all label", ""] += 1
            if "$" in text:
                for m in _SUM.finditer(text):
                    lone[source, "$"][not m[1]] += 1
        if len(ends) + len(other) + len(lone) + sum(map(len, words.values())) > _FLUSH or letters > _FLUSH_LETTERS:
            yield flush()
            ends, words, other, letters, lone = Counter(), {}, Counter(), 0, defaultdict(lambda: [0, 0])
    if other:
        yield flush()


def _may_be_piece(key: str) -> bool:
    """Words and names alone may be a piece of a sentence, and an open bracket is a piece of anything."""
    return not re.search(r"[^A-Za-z\s'’]", key) or not _balanced(key.partition("\x02")[0])


def line_habits(docs: DataFrame) -> dict:
    """{(source, kind): keys}: closers, item shapes, closing shapes, labels (of all sources, under '') and cents.

    Counted over all texts; what passes is a bounded number of keys for each source and kind (see BOUND), and
    sources are few, so that the habits are small enough to be collected and sent."""
    ship(docs.sparkSession)
    stats = docs.select("source", "text").mapInArrow(_count, _STAT).groupBy("source", "kind", "key").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    stats = cut_lineage(stats)  # read four times below
    # The number of texts, line ends, items and lone letters: a row for each source.
    total = lambda kind: F.sum(F.when(F.col("kind") == kind, F.col("n")).otherwise(0))
    counts = stats.where("kind = 'docs' OR kind LIKE 'all %'").groupBy(F.col("source").alias("s")).agg(total("docs").alias("docs"), total("all closer").alias("ends"), total("all item").alias("items"), total("all label").alias("lone"))
    kept = stats.where("n > 0 AND kind IN ('closer', 'item', 'shape', 'label', 'cents')").join(F.broadcast(counts), F.col("source").eqNullSafe(F.col("s")))
    n, kind = F.col("n"), F.col("kind")
    often = (
        F.when(kind == "closer", (n >= CLOSER_SHARE * F.col("docs")) & (n >= BOUND * F.col("ends")) & (n >= CLOSER_RATE * F.col("total")))
        .when(kind == "item", (n >= ITEM_SHARE * F.col("docs")) & (n >= BOUND * F.col("items")))
        .when(kind == "shape", n >= SHAPE_SHARE * F.col("docs"))
        .when(kind == "label", (n >= LABEL_RATE * F.col("total")) & (n >= BOUND * F.col("lone")))
        .otherwise(n >= 0.5 * F.col("total"))
    )
    kept = kept.where(often & ((n >= HABIT_LINES) | (kind == "item"))).select("source", "kind", "key", "n")
    # What is but the beginning of words from inside of lines is no closer: the pieces that cutting leaves.
    ends = kept.where("kind = 'closer'").select(F.col("source").alias("s"), F.col("key").alias("k"))  # at most 1 / share for each source
    inner = stats.where("kind = 'closer' AND n < 0.5 * total AND length(key) > 1")
    begun = inner.select("source", "total", F.explode(F.transform(F.sequence(F.lit(1), F.least(F.length("key") - 1, F.lit(LONGEST_CLOSER))), lambda i: F.substring("key", F.lit(1), i))).alias("key"))
    longer = begun.join(F.broadcast(ends), F.col("source").eqNullSafe(F.col("s")) & (F.col("key") == F.col("k"))).groupBy("s", "k").agg(F.sum("total").alias("longer"))
    pieces = kept.join(longer, F.col("source").eqNullSafe(F.col("s")) & (F.col("key") == F.col("k")) & (F.col("kind") == "closer"), "left")
    kept = pieces.where("longer IS NULL OR longer < n")
    habits: dict = {}
    for source, kind, key, n in kept.select("source", "kind", "key", "n").collect():
        habits.setdefault((source, kind), {})[key] = n
    for (_, kind), keys in habits.items():
        if kind == "shape":
            for key in [k for k, n in keys.items() if sum(m for x, m in keys.items() if _continues(k, x)) >= LONGER_TIMES * n]:
                del keys[key]
    return habits


def _balanced(line: str) -> bool:
    return all(line.count(a) == line.count(b) for a, b in ("()", "[]", "{}"))


def known_closing(text: str, shapes) -> bool:
    """Whether the text ends in a closing line. A last number may be shorter than the known ones if its length varies."""
    for s in closing_shapes(text):
        if s in shapes or (s.endswith("9") and f"{s}9" in shapes and f"{s}99" in shapes):
            return True
    return False


def _continues(short: str, long: str) -> bool:
    """Whether the longer shape goes on where the shorter one ends, by more than digits of its last number. Shapes that
    are told by a hash go on nowhere."""
    long = long.partition("\x02")[0]
    return len(long) > len(short) and long.startswith(short) and not (short.endswith("9") and not long[len(short) :].strip("9"))


# ---------------------------------------------------------------- pass 2

FIRM, WEAK, OPEN = "firm", "weak", "open"


def ending(text: str, source, habits: dict) -> tuple[str, str]:
    """(FIRM, WEAK or OPEN, why) of a text that isn't blank."""
    body, marked = without_mark(text)
    if marked:
        return OPEN, "mark"
    plain = _unadorned(body)
    if not plain:
        return FIRM, "no letters"
    closers = habits.get((source, "closer"), ())
    word = body.rsplit(None, 1)[-1]
    if word in closers:
        return FIRM, "closer"
    line = last_line(plain)
    opener = last_line(plain[: len(plain) - len(line)].rstrip())
    if opener.endswith(",") and len(opener) <= 40 and len(line) <= 60 and name_like(line):
        return WEAK, "signature"
    if m := _ITEM.fullmatch(line):
        if _TERMINAL.search(plain):
            return FIRM, "item sentence"
        s, known = shape(m[1]), habits.get((source, "item"), ())
        if s in known:
            return (WEAK if s.endswith("A") else FIRM), "item"
        if known_closing(plain, habits.get((source, "shape"), ())):
            return FIRM, "closing line"
        # An item of no known shape is whole, unless known ones begin like it or it stands alone among sentences.
        return (OPEN if not known or any(k.startswith(s) for k in known) else WEAK), "unknown item"
    if _TERMINAL.search(plain):
        tail = last_words(plain)
        if (m := _INITIAL.search(tail)) and m[2].isupper() and (m[1] or "").lower()[:LONGEST_CLOSER] not in habits.get(("", "label"), ()):
            return OPEN, "initial"
        if (source, "cents") in habits and _DOLLARS.search(tail):
            return OPEN, "amount"
        return FIRM, "sentence"
    if known_closing(plain, habits.get((source, "shape"), ())):
        return WEAK, "closing line"
    return OPEN, "inside"


def lengths(text: str) -> dict[str, int]:
    """Lengths of the text as systems count them."""
    n = len(text)
    wide = text.encode("utf-8", "surrogatepass")
    astral = 0 if text.isascii() else sum(ch > "￿" for ch in text)
    lines = text.count("\n")
    returns = text.count("\r\n")
    entity = 4 * text.count("&") + 3 * (text.count("<") + text.count(">"))
    quotes = text.count('"')
    escaped = quotes + text.count("\\") + lines + text.count("\t") + text.count("\r")
    return {
        "characters": n,
        "utf8_bytes": len(wide),
        "utf16_units": n + astral,
        "entities": n + entity,
        "entities_quotes": n + entity + 5 * quotes + 4 * text.count("'"),
        "entities_undone": n - 4 * text.count("&amp;") - 3 * (text.count("&lt;") + text.count("&gt;")) - 5 * text.count("&quot;"),
        "json": n + escaped,
        "json_utf8": len(wide) + escaped,
        "newlines_crlf": n + lines - returns,
        "newlines_crlf_utf8": len(wide) + lines - returns,
        "newlines_lf": n - returns,
    }


MEASURES = tuple(lengths(""))

_ENDING = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("source", T.StringType()), T.StructField("ending", T.StringType()), T.StructField("why", T.StringType()), T.StructField("sizes", T.ArrayType(T.IntegerType()))])
_ENDING_ARROW = pa.schema([("doc_id", pa.int64()), ("source", pa.string()), ("ending", pa.string()), ("why", pa.string()), ("sizes", pa.list_(pa.int32()))])


def endings(docs: DataFrame, habits: dict) -> DataFrame:
    """(doc_id, source, ending, why, sizes): sizes holds each measure of the text and then of the text without a mark."""
    ship(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(habits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for batch in batches:
            rows = []
            for doc_id, source, text in zip(*(c.to_pylist() for c in batch.columns)):
                if not text or not _bare(text):
                    continue
                kind, why = ending(text, source, known)
                sizes = list(lengths(text).values())
                # Without a mark: the text itself, so that each list has the same length.
                sizes += list(lengths(without_mark(text)[0]).values()) if why == "mark" else sizes
                rows.append((doc_id, source, kind, why, [min(x, 2**31 - 1) for x in sizes]))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _ENDING_ARROW)], schema=_ENDING_ARROW)

    return docs.select("doc_id", "source", "text").mapInArrow(run, _ENDING)


# ---------------------------------------------------------------- pass 3


def limits(seen: DataFrame) -> DataFrame:
    """(source, measure, size, n_open, weak_cut): the hidden limits; measure is an index into sizes.

    weak_cut: whether far more weak endings are at the limit than its neighbours would let expect."""
    sized = seen.select("source", "ending", F.posexplode("sizes").alias("measure", "size"))
    is_open, is_weak = F.col("ending") == OPEN, F.col("ending") == WEAK
    at = sized.groupBy("source", "measure", "size").agg(F.count_if(is_open).alias("n_open"), F.count_if(is_weak).alias("n_weak"))
    near = Window.partitionBy("source", "measure").orderBy("size").rangeBetween(-NEIGHBOURS, NEIGHBOURS)
    around = lambda c: (F.sum(c).over(near) - F.col(c)) / (2 * NEIGHBOURS)
    docs = seen.groupBy(F.col("source").alias("s")).agg(F.count("*").alias("docs"))
    marked = at.withColumn("open_near", around("n_open")).withColumn("weak_near", around("n_weak"))
    enough = (F.col("n_open") >= LIMIT_DOCS) & (F.col("n_open") >= LIMIT_SHARE * F.col("docs")) & (F.col("n_open") >= LIMIT_TIMES * F.greatest("open_near", F.lit(0.5)))
    return (
        marked.join(F.broadcast(docs), F.col("source").eqNullSafe(F.col("s")))  # one row for each source
        .where(enough)
        .select("source", "measure", "size", "n_open", ((F.col("n_weak") >= LIMIT_DOCS) & (F.col("n_weak") > 3 * F.col("weak_near"))).alias("weak_cut"))
    )


def _hits(seen: DataFrame, rows: list[tuple], name: str) -> DataFrame:
    """Adds the column `name`: which of the limits (source, measure, size) each text hits."""
    spark = seen.sparkSession
    known = spark.createDataFrame([r[:3] for r in rows], "s string, measure int, size int")
    known = known.groupBy("s").agg(F.array_sort(F.collect_set(F.struct("measure", "size"))).alias("limits"))
    joined = seen.join(F.broadcast(known), F.col("source").eqNullSafe(F.col("s")), "left")
    hit = F.filter("limits", lambda x: F.try_element_at("sizes", x["measure"] + 1) == x["size"])
    return joined.withColumn(name, F.coalesce(hit, F.array().cast("array<struct<measure:int,size:int>>"))).drop("s", "limits")


def main_limits(seen: DataFrame) -> dict:
    """{source: [(measure, size, texts)]}: the fewest limits that explain the open endings at limits, greatest first.

    Works on the counts of the combinations of limits that texts hit, of which there are few."""
    combined = seen.where((F.col("ending") == OPEN) & (F.size("hits") > 0)).groupBy("source", "hits").count().collect()
    by: dict = {}
    for source, hits, n in combined:
        by.setdefault(source, []).append(({(h["measure"], h["size"]) for h in hits}, n))
    out: dict = {}
    for source, left in by.items():
        while left:
            score: Counter = Counter()
            for hits, n in left:
                for h in hits:
                    score[h] += n
            best, n = min(score.items(), key=lambda x: (-x[1], x[0]))
            if n < LIMIT_DOCS:
                break
            out.setdefault(source, []).append((*best, n))
            left = [(hits, n) for hits, n in left if best not in hits]
    return out


def judged(docs: DataFrame) -> tuple[DataFrame, dict]:
    """(each text that isn't blank with its ending, `hits` and `cut`; the main limits of each source)."""
    seen = cut_lineage(endings(docs, line_habits(docs)))
    # At most 1 / LIMIT_SHARE limits for each source and measure.
    at = [tuple(r) for r in limits(seen).select("source", "measure", "size", "weak_cut").collect()]
    main = main_limits(_hits(seen, at, "hits"))
    chosen = {(source, m, size) for source, found in main.items() for m, size, _ in found}
    out = _hits(_hits(seen, [r for r in at if r[:3] in chosen], "hits"), [r for r in at if r[3] and r[:3] in chosen], "weak_hits")
    cut = (F.col("ending") == OPEN) | ((F.col("ending") == WEAK) & (F.size("weak_hits") > 0))
    return out.withColumn("cut", cut).drop("sizes", "weak_hits"), main


def found(docs: DataFrame) -> DataFrame:
    """(doc_id) of the texts that were cut."""
    return judged(docs)[0].where("cut").select("doc_id")


def rates(docs: DataFrame) -> DataFrame:
    """(source, texts, cut, rate, at_limit, limits): how often each source cuts texts, and by which limits."""
    seen, main = judged(docs)
    per = seen.groupBy("source").agg(F.count("*").alias("texts"), F.count_if("cut").alias("cut"), F.count_if(F.col("cut") & (F.size("hits") > 0)).alias("at_limit"))

    def say(measure: int, size: int, n: int) -> str:
        return f"{MEASURES[measure % len(MEASURES)]} {size}{' and a mark' if measure >= len(MEASURES) else ''}: {n}"

    shown = docs.sparkSession.createDataFrame([(source, "; ".join(say(*x) for x in found)) for source, found in main.items()], "s string, limits string")
    joined = per.join(F.broadcast(shown), F.col("source").eqNullSafe(F.col("s")), "left")
    return joined.select("source", "texts", "cut", F.round(F.col("cut") / F.col("texts"), 6).alias("rate"), "at_limit", "limits")
