"""Variant spellings of names: which entries of a list of typed names mean the same person.

Entries are read into names (see names.py). Entries of one run and state that have surname forms within the accepted
edit distance (found by symmetric-delete keys over the distinct forms, of up to two letters) are aligned by the optimal
assignment of their tokens; a link needs a low cost of the alignment, and that no middle name, suffix or given name is
another one. Links between entries whose names are written out are strong and joined into persons
(connected components). An entry that could mean several people (an initial, an ambiguous nickname, no state, no
suffix beside relatives with one) is weak: it joins the one person whose evidence (middle name, suffix, districts) is
best, and nobody in a tie. Legislators take part as well-spelled names that variants can meet at.

Defined cases
* Entries are compared within one parse_run and state; `unk` and no state are no state.
* Entries with equal names (after reading) are one node: a name that a third of all entries bear is compared once.
* An entry without any readable name, or without a given name, is linked to nobody.
* Null raw_names, districts or doc_ids are empty ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tallyframe.llm.graph import components
from tallyframe.llm.linkage import vocabulary
from tallyframe.llm.names import AGREE, ALIGNED, CONFLICT, PERHAPS, SUFFIXES, GivenNames, Name, _tokens, align, alike, compare_given, compare_middle, compare_suffix, compare_surname, fold, form_keys, read_name
from tallyframe.session import cut_lineage, ship

# A packed name: given|middles|surnames|suffix, each a list of words. initials, free: what a given name can begin with, and
# whether it is none that is known (then it may begin with anything).
_NODE = T.StructType(
    [
        T.StructField("entry_no", T.LongType()),
        T.StructField("state", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("weak", T.BooleanType()),
        T.StructField("forms", T.ArrayType(T.StringType())),
        T.StructField("initials", T.ArrayType(T.StringType())),
        T.StructField("free", T.BooleanType()),
    ]
)
_NODE_ARROW = pa.schema([("entry_no", pa.int64()), ("state", pa.string()), ("name", pa.string()), ("weak", pa.bool_()), ("forms", pa.list_(pa.string())), ("initials", pa.list_(pa.string())), ("free", pa.bool_())])


def pack(n: Name) -> str:
    return "|".join((" ".join(n.given), " ".join(n.middles), " ".join(n.surnames), n.suffix or ""))


def unpack(text: str, given_names: GivenNames) -> Name:
    given, middles, surnames, suffix = (tuple(p.split()) for p in text.split("|"))
    means = [given_names.stands_for(g) for g in given if len(g) > 1]
    both = frozenset.intersection(*means) if means and frozenset.intersection(*means) else frozenset().union(*means)
    return Name(given, middles, surnames, suffix[0] if suffix else None, both)


def read_entry(filer_id: str | None, raw_names: list[str | None] | None, given_names: GivenNames) -> tuple[str | None, Name]:
    """(state, name) of an entry: the identifier tells where the surname begins, the raw names all the rest."""
    state, last, suffix = None, "", None
    if filer_id and filer_id.startswith("name:"):
        parts = filer_id[5:].split(".")
        state = parts[0] if parts[0] not in ("unk", "") else None
        last = parts[1] if len(parts) > 1 else ""
        suffix = parts[3] if len(parts) > 3 else None
    sur = [t for t in last.split("-") if t]
    best = Name()
    for raw in raw_names or []:
        if not raw or not raw.strip():
            continue
        if "," in raw and not sur:
            name = read_name(raw, "", suffix, given_names)
        else:
            words = raw.split()
            while len(words) > 1 and "".join(_tokens(fold(words[-1]))) in SUFFIXES:
                gen = words.pop()
                suffix = suffix or fold(gen).strip(".")
            left, cut = len(sur), len(words)
            while cut > 1 and left > 0:
                cut -= 1
                left -= max(1, len(_tokens(fold(words[cut]))))
            if not sur:
                cut = len(words) - 1
            name = read_name(" ".join(words[:cut]), " ".join(words[cut:]), suffix, given_names)
        # The fullest spelling speaks for the entry: most middle names, then the longest ones.
        if (len(name.given), len(name.middles), sum(map(len, name.middles))) > (len(best.given), len(best.middles), sum(map(len, best.middles))) or not best.surnames:
            best = name
    return state, best


_ENTRY = T.StructType([*_NODE, T.StructField("run", T.IntegerType()), T.StructField("districts", T.ArrayType(T.IntegerType()))])


def _nodes(given_names: GivenNames):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, at = [], []
            for i, (entry_no, filer_id, raw_names) in enumerate(zip(*(c.to_pylist() for c in batch.columns[:3]))):
                state, name = read_entry(filer_id, raw_names, given_names)
                if name.given and name.surnames:
                    rows.append(_node(entry_no, state, name))
                    at.append(i)
            if rows:
                passed = [batch.column(k).take(pa.array(at, pa.int32())) for k in (3, 4)]
                yield pa.RecordBatch.from_arrays([*(pa.array(c, f.type) for c, f in zip(zip(*rows), _NODE_ARROW)), *passed], names=_ENTRY.names)

    return run


def _node(entry_no, state, name: Name):
    weak = name.initial_only or len(name.means) > 1 or state is None
    return entry_no, state, pack(name), weak, sorted(name.surname_forms()), sorted(name.initials), not name.means and not name.initial_only


def entry_nodes(entries: DataFrame, given_names: GivenNames) -> DataFrame:
    """entries: entry_no, filer_id, raw_names, parse_run, districts -> `_ENTRY`."""
    narrow = entries.select(F.col("entry_no").cast("long"), "filer_id", "raw_names", F.col("parse_run").cast("int"), F.col("districts").cast("array<int>"))
    return narrow.mapInArrow(_nodes(given_names), _ENTRY)


def _legislator_nodes(given_names: GivenNames):
    from tallyframe.llm.linkage import read_person

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for bioguide, first, last, official, terms in zip(*(c.to_pylist() for c in batch.columns)):
                p = read_person(bioguide, first, last, official, terms, given_names)
                if p and p.name.given and p.name.surnames:
                    rows.append(_node(None, (p.state or "").lower() or None, p.name))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _NODE_ARROW)], schema=_NODE_ARROW)

    return run


_EDGE = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType()), T.StructField("strong", T.BooleanType()), T.StructField("score", T.DoubleType()), T.StructField("suffix_open", T.BooleanType())])
_EDGE_ARROW = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("strong", pa.bool_()), ("score", pa.float64()), ("suffix_open", pa.bool_())])


def judge(x: Name, y: Name, weak: bool) -> tuple[bool, float, bool] | None:
    """(strong, score, whether just one has a suffix) if the names can be one person's, else null.

    The alignment decides; the check that follows is that nothing names another person."""
    surname, given = compare_surname(x, y), compare_given(x, y)
    cost = align(x, y, surname, given)
    if cost > ALIGNED:
        return None
    middle, suffix = compare_middle(x, y), compare_suffix(x, y)
    if surname < PERHAPS or given < PERHAPS or middle == CONFLICT or suffix == CONFLICT:
        return None
    score = (2.0 if middle >= PERHAPS else 0.0) + (1.0 if suffix == AGREE else 0.0) + (1.0 if given == AGREE else 0.0) + (0.5 if surname == AGREE else 0.0) + (1 - cost) / 4
    open_suffix = suffix != AGREE
    return not weak and given == AGREE and not open_suffix, score, open_suffix


def _judge_pairs(given_names: GivenNames):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict[str, Name] = {}

        def name(text: str) -> Name:
            if (n := memo.get(text)) is None:
                if len(memo) > 200_000:
                    memo.clear()
                n = memo[text] = unpack(text, given_names)
            return n

        for batch in batches:
            rows = []
            for a, b, name_a, name_b, weak in zip(*(c.to_pylist() for c in batch.columns)):
                if (j := judge(name(name_a), name(name_b), weak)) is not None:
                    rows.append((a, b, *j))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _EDGE_ARROW)], schema=_EDGE_ARROW)

    return run


def near_pairs(forms: DataFrame) -> DataFrame:
    """(form_a, form_b): all pairs of surname forms (column `form`, each form once) that are alike, in both orders, and each
    form with itself.

    A form meets others at the hashes of its keys, sorted; forms under one key are those that are up to two letters longer
    than it, a number that the alphabet bounds. What is shuffled: the keys of each form once, and the pairs that meet."""

    ship(forms.sparkSession)

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            forms = batch.column(0).to_pylist()
            for at in range(0, len(forms), 500):
                some = forms[at : at + 500]
                yield pa.RecordBatch.from_arrays([pa.array(some, pa.string()), pa.array([sorted(form_keys(f)) for f in some], pa.list_(pa.string()))], names=["form", "keys"])

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pairs within runs of one key; most keys have one form alone, which costs nothing here."""
        last, group = None, []

        def pairs(found: list[tuple[str, str]]) -> None:
            some = sorted(set(group))
            found.extend((a, b) for i, a in enumerate(some) for b in some[i + 1 :] if abs(len(a) - len(b)) <= 2)

        for batch in batches:
            key = batch.column(0).to_numpy()
            if not len(key):
                continue
            cuts = np.flatnonzero(np.diff(key, prepend=key[0] - 1, append=key[-1] + 1))
            several = np.flatnonzero(np.diff(cuts) > 1).tolist()
            found: list[tuple[str, str]] = []
            ends = {0, len(cuts) - 2}  # the first run may go on from the batch before, the last one into the next
            for k in sorted(ends.union(several)):
                lo, hi = int(cuts[k]), int(cuts[k + 1])
                if k in ends and key[lo] == last:
                    group += batch.column(1)[lo:hi].to_pylist()
                else:
                    if len(group) > 1:
                        pairs(found)
                    last, group = key[lo], batch.column(1)[lo:hi].to_pylist()
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*found)], names=["form_a", "form_b"])
        found = []
        if len(group) > 1:
            pairs(found)
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*found)], names=["form_a", "form_b"])

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(a, b) for a, b in zip(*(c.to_pylist() for c in batch.columns)) if alike(a, b)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows)], names=["form_a", "form_b"])

    keyed = forms.select("form").mapInArrow(keys, "form string, keys array<string>").select("form", F.explode("keys").alias("key")).select(F.xxhash64("key").alias("key"), "form")
    met = keyed.repartition("key").sortWithinPartitions("key").mapInArrow(runs, "form_a string, form_b string").distinct()
    near = met.mapInArrow(check, "form_a string, form_b string")
    both = F.explode(F.array(F.struct("form_a", "form_b"), F.struct(F.col("form_b").alias("form_a"), F.col("form_a").alias("form_b"))))
    return near.select(both.alias("x")).select("x.*").unionByName(forms.select(F.col("form").alias("form_a"), F.col("form").alias("form_b")))


def _meet(nodes: DataFrame, given_names: GivenNames) -> DataFrame:
    """Judged pairs of nodes with surname forms that are alike: within a state, and of those without a state with all.

    Pairs whose given names can't begin alike, or with other suffixes or middle initials, fall out as soon as they meet;
    whatever `judge` accepts gets there. A name goes along, so nothing is looked up afterwards."""
    suffix, middle = F.element_at(F.split("name", r"\|"), 4), F.substring_index(F.element_at(F.split("name", r"\|"), 2), " ", 1)
    spelled = nodes.select("node", "run", "state", F.struct("node", "name", "weak", "initials", "free", suffix.alias("suffix"), middle.alias("middle")).alias("who"), F.explode("forms").alias("form"))
    # Spread over all tasks, however few bytes the forms are: what is made of each costs more than reading it.
    tasks = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    near = near_pairs(cut_lineage(spelled.select("form").repartition(tasks, "form").distinct()))
    left = spelled.select("run", "state", F.col("who").alias("a"), F.col("form").alias("form_a")).join(near, "form_a").select("run", "state", "a", F.col("form_b").alias("form"))
    right = spelled.select("run", "state", F.col("who").alias("b"), "form")
    given = F.col("a.free") | F.col("b.free") | F.arrays_overlap("a.initials", "b.initials")
    open_suffix = (F.col("a.suffix") == "") | (F.col("b.suffix") == "") | (F.col("a.suffix") == F.col("b.suffix"))
    one, other = F.col("a.middle"), F.col("b.middle")
    middles = (one == "") | (other == "") | (F.left(one, F.lit(1)) == F.left(other, F.lit(1))) | ((F.length(one) > 1) & (F.length(other) > 1))
    likely = given & open_suffix & middles
    pick = [F.col("a.node").alias("a"), F.col("b.node").alias("b"), F.col("a.name").alias("name_a"), F.col("b.name").alias("name_b"), (F.col("a.weak") | F.col("b.weak")).alias("weak")]
    within = left.where("state IS NOT NULL").join(right, ["run", "state", "form"]).where((F.col("a.node") < F.col("b.node")) & likely).select(*pick)
    stateless = left.where("state IS NULL").drop("state").join(right, ["run", "form"])
    across = stateless.where((F.col("a.node") != F.col("b.node")) & (F.col("state").isNotNull() | (F.col("a.node") < F.col("b.node"))) & likely).select(*pick)
    return within.unionByName(across).distinct().mapInArrow(_judge_pairs(given_names), _EDGE)


def _node_id(*columns: str) -> Column:
    return F.xxhash64(*(F.coalesce(F.col(c).cast("string"), F.lit("\u0001")) for c in columns))


def persons(entries: DataFrame, legislators: DataFrame) -> DataFrame:
    """(entry_no, run, person): entries with the same person mean the same one."""
    ship(entries.sparkSession)
    given_names = vocabulary(legislators)
    read = cut_lineage(entry_nodes(entries, given_names).withColumn("node", _node_id("run", "state", "name")))

    # One node for each name in a run and state. Its districts are at most those that a state has. What the name means is
    # read the same way from all entries, and from entries before legislators.
    people = legislators.select("id.bioguide", "name.first", "name.last", "name.official_full", "terms").mapInArrow(_legislator_nodes(given_names), _NODE)
    # Legislators meet the entries of every run; the runs are a handful.
    runs = [r[0] for r in read.select("run").distinct().collect()]
    known = people.withColumn("run", F.explode(F.array(*(F.lit(r) for r in runs)).cast("array<int>"))) if runs else people.withColumn("run", F.lit(None).cast("int"))
    known = known.withColumn("node", _node_id("run", "state", "name")).withColumn("districts", F.array().cast("array<int>"))
    traits = F.min(F.struct(F.col("entry_no").isNull(), "weak", "forms", "initials", "free"))
    nodes = read.unionByName(known).groupBy("node", "run", "state", "name").agg(traits.alias("t"), F.array_distinct(F.flatten(F.collect_set(F.coalesce("districts", F.array().cast("array<int>"))))).alias("districts"))
    nodes = cut_lineage(nodes.select("node", "run", "state", "name", "t.weak", "t.forms", "t.initials", "t.free", "districts"))

    edges = cut_lineage(_meet(nodes, given_names))
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"), "strong", "score", "suffix_open"))

    # Without a suffix beside one with: weak, as relatives share the rest of the name.
    traits = nodes.select(F.col("node").alias("id"), "weak", "districts", F.element_at(F.split("name", r"\|"), 4).alias("suffix"))
    unsure = both.where("suffix_open").join(traits.where("suffix = ''").select(F.col("id").alias("a")), "a", "left_semi").select(F.col("a").alias("id"), F.lit(True).alias("open")).distinct()
    traits = cut_lineage(traits.join(unsure, "id", "left").select("id", "districts", (F.col("weak") | F.coalesce("open", F.lit(False))).alias("weak")))

    sure = traits.where("NOT weak").select("id")
    links = edges.where("strong").join(sure.withColumnRenamed("id", "a"), "a", "left_semi").join(sure.withColumnRenamed("id", "b"), "b", "left_semi")
    whole = cut_lineage(components(sure, links))

    # Weak nodes: the best person among the strong neighbours, if there is just one best.
    t = lambda side: traits.select(F.col("id").alias(side), F.col("weak").alias(f"weak_{side}"), F.col("districts").alias(f"districts_{side}"))
    reach = both.join(t("a"), "a").join(t("b"), "b").where("weak_a")
    common = F.when(F.arrays_overlap("districts_a", "districts_b"), 0.75).otherwise(0.0)
    offers = reach.where("NOT weak_b").join(whole.withColumnRenamed("id", "b"), "b").groupBy("a", "component").agg(F.max(F.col("score") + common).alias("score"))
    order = Window.partitionBy("a").orderBy(F.desc("score"), "component")
    ranked = offers.withColumn("rank", F.row_number().over(order)).withColumn("next", F.lead("score").over(order))
    joined = cut_lineage(ranked.where("rank = 1 AND (next IS NULL OR score - next >= 0.5)").select(F.col("a").alias("id"), "component"))

    # Weak nodes that no strong one knows: joined among themselves where they agree.
    rest = cut_lineage(traits.where("weak").select("id").join(offers.select(F.col("a").alias("id")).distinct(), "id", "left_anti"))
    among = edges.join(rest.withColumnRenamed("id", "a"), "a", "left_semi").join(rest.withColumnRenamed("id", "b"), "b", "left_semi")
    alone = components(rest, among)
    lost = offers.select(F.col("a").alias("id")).distinct().join(joined, "id", "left_anti").select("id", F.col("id").alias("component"))
    person = whole.unionByName(joined).unionByName(alone).unionByName(lost)
    return read.select("entry_no", "run", "node").join(person.withColumnRenamed("id", "node"), "node").select("entry_no", "run", F.col("component").alias("person"))


def found_pairs(entries: DataFrame, legislators: DataFrame) -> DataFrame:
    """(entry_no_a, entry_no_b), smaller first: all pairs of entries of a run that mean the same person."""
    who = cut_lineage(persons(entries, legislators))
    a, b = who.withColumnRenamed("entry_no", "entry_no_a"), who.withColumnRenamed("entry_no", "entry_no_b")
    same = (a["person"] == b["person"]) & a["run"].eqNullSafe(b["run"]) & (a["entry_no_a"] < b["entry_no_b"])
    return a.join(b, same).select("entry_no_a", "entry_no_b")
