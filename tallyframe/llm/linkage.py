"""Matching entities across sources without keys: filings to legislators by noisy attributes, with a confidence.

Candidates come from a symmetric-delete index over surnames, which covers all that `compare_surname` accepts. On each
candidate many heuristic matching functions vote (match, no match, abstain). A generative model is fitted to the counts
of all vote patterns by expectation maximisation, which begins with the plain majority: it learns how often each function
votes what on true and on false candidates, and joins functions whose votes stay correlated given the class into one
factor. Its posterior is the confidence, and a candidate is accepted from one half on. An exact check follows: the best
candidate is named only if nothing rules it out (another given name, middle name or suffix); the fit knows nothing of it.

Defined cases
* Filings with a bioguide_id aren't looked at; repeated entries each get their own row.
* A filing with null names, or whose coverage_year is null, matches nobody.
* Where no state is given, the name decides; two equally good legislators give no match.
* Empty tables give empty results; other columns may hold anything.
"""

from __future__ import annotations

import itertools
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.llm.names import AGREE, CONFLICT, PERHAPS, UNKNOWN, GivenNames, Name, alignment_cost, alike, compare_given, compare_middle, compare_suffix, compare_surname, fold, form_keys, learn_nicknames, read_name
from tallyframe.session import cut_lineage, ship

# The index over the smaller side is sent to all workers only up to so many persons; beyond, candidates are joined.
MAX_INDEXED = 50_000
# The vocabulary of given names is a model that is fitted to at most so many names, the most frequent ones.
MOST_NAMES = 100_000

VOTERS = ("surname_same", "surname_near", "given_full", "given_initial", "middle", "suffix", "district", "state", "filing_kind", "alignment", "only_one")
# Filing types of sitting members, and of candidates.
MEMBER_TYPES, CANDIDATE_TYPES = {"O", "P", "A"}, {"C"}


@dataclass(frozen=True)
class Person:
    bioguide: str
    name: Name
    state: str | None
    terms: tuple[tuple[int, int | None], ...]  # (start year, district)
    full_known: bool  # whether the official name, and with it the suffix, is known

    def held(self, year: int) -> bool:
        return any(start <= year <= start + 1 for start, _ in self.terms)


def read_person(bioguide, first, last, official, terms, given_names: GivenNames) -> Person | None:
    """A legislator; the official name adds the suffix, a middle initial and the name in daily use."""
    terms = [t for t in terms or [] if t and t["start"]]
    if not bioguide or not terms:
        return None
    base = read_name(first, last, None, given_names)
    whole, _, suffix = (official or "").partition(",")
    daily = fold(whole).replace(".", " ").split()
    extra = [t for t in daily[1:] if len(t) == 1]
    name = read_name(first, last, suffix, given_names)
    given = tuple(dict.fromkeys([*base.given, *daily[:1]]))
    name = Name(given, base.middles or tuple(extra[:1]), base.surnames, name.suffix, base.means | (given_names.stands_for(base.given[0]) if base.given else frozenset()))
    return Person(bioguide, name, terms[-1]["state"], tuple((t["start"].year, t["district"]) for t in terms), bool(official))


def vocabulary(legislators: DataFrame) -> GivenNames:
    """Formal given names and nicknames as the legislators table has them (first names, and official against first)."""
    first = F.lower(F.try_element_at(F.split(F.trim("name.first"), r"[\s.]+"), F.lit(1)))
    daily = F.lower(F.try_element_at(F.split(F.trim("name.official_full"), r"[\s.]+"), F.lit(1)))
    rows = legislators.select(first.alias("formal"), daily.alias("daily")).where("length(formal) > 1").groupBy("formal", "daily").count().orderBy(F.desc("count"), "formal", "daily").limit(MOST_NAMES).collect()
    return GivenNames({fold(r[0]) for r in rows}, learn_nicknames((fold(r[0]), fold(r[1])) for r in rows))


def near_forms(one: DataFrame, other: DataFrame) -> DataFrame:
    """(form_a, form_b): all pairs of surname forms of the two tables (column `form`, each form once) that are alike.

    What is shuffled: a hash for each key of each form, and the pairs that share one."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            forms = batch.column(0).to_pylist()
            for at in range(0, len(forms), 500):
                some = forms[at : at + 500]
                yield pa.RecordBatch.from_arrays([pa.array(some, pa.string()), pa.array([sorted(form_keys(f)) for f in some], pa.list_(pa.string()))], names=["form", "keys"])

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(a, b) for a, b in zip(*(c.to_pylist() for c in batch.columns)) if alike(a, b)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows)], names=["form_a", "form_b"])

    def keyed(forms: DataFrame, name: str) -> DataFrame:
        return forms.select("form").mapInArrow(keys, "form string, keys array<string>").select(F.col("form").alias(name), F.explode("keys").alias("key")).select(name, F.xxhash64("key").alias("key"))

    met = keyed(one, "form_a").join(keyed(other, "form_b"), "key").where("form_a <> form_b").select("form_a", "form_b").distinct()
    same = one.select("form").join(other.select("form"), "form").select(F.col("form").alias("form_a"), F.col("form").alias("form_b"))
    return met.mapInArrow(check, "form_a string, form_b string").union(same)


def _hashes(keys) -> array:
    """Of 32 bits: keys that share one by chance are told apart by comparing the surnames."""
    return array("I", (zlib.crc32(key.encode("utf-8", "surrogatepass")) for key in keys))


class PersonIndex:
    """Sorted hashes of the keys beside the persons that have them: 8 bytes a key."""

    def __init__(self, persons: list[Person]):
        self.persons = persons
        hashes, owners = array("I"), array("I")
        for i, p in enumerate(persons):
            found = _hashes(p.name.keys())
            hashes.extend(found)
            owners.extend([i] * len(found))
        order = np.argsort(np.array(hashes, np.uint32), kind="stable")
        self.hashes, self.owners = np.array(hashes, np.uint32)[order], np.array(owners, np.uint32)[order]
        self.memo: dict[Name, list[int]] = {}

    def near(self, name: Name) -> list[int]:
        """Persons whose surname shares a key with the name's and isn't another one."""
        if (found := self.memo.get(name)) is None:
            if len(self.memo) > 200_000:
                self.memo.clear()
            keys = np.array(_hashes(name.keys()), np.uint32)
            starts, ends = np.searchsorted(self.hashes, keys, "left"), np.searchsorted(self.hashes, keys, "right")
            ids = sorted({int(i) for s, e in zip(starts, ends) if s < e for i in self.owners[s:e]})
            found = self.memo[name] = [i for i in ids if compare_surname(name, self.persons[i].name) != CONFLICT]
        return found


def _sign(level: int, plus: int = PERHAPS) -> int:
    return 1 if level >= plus else -1 if level == CONFLICT else 0


def votes(name: Name, state: str | None, year: int, district: int | None, code: str | None, p: Person, rivals: int) -> tuple[int, ...]:
    """One vote of each of VOTERS: 1 match, -1 no match, 0 abstain."""
    surname, given = compare_surname(name, p.name), compare_given(name, p.name)
    suffix = compare_suffix(name, p.name)
    if name.suffix and p.name.suffix is None and p.full_known:
        suffix = CONFLICT
    seats = {d for start, d in p.terms if start <= year <= start + 1}
    cost = alignment_cost(name, p.name)
    return (
        1 if surname == AGREE else 0,
        _sign(surname),
        1 if given == AGREE else -1 if given == CONFLICT else 0,
        1 if name.initials & p.name.initials else -1 if name.given and p.name.given else 0,
        _sign(compare_middle(name, p.name)),
        1 if suffix == AGREE and name.suffix else -1 if suffix == CONFLICT else 0,
        0 if not district else 1 if district in seats else -1 if district not in {d for _, d in p.terms} else 0,
        0 if not state else 1 if state == p.state else -1,
        1 if code in MEMBER_TYPES else -1 if code in CANDIDATE_TYPES else 0,
        1 if cost <= 0.35 else -1 if cost >= 0.7 else 0,
        1 if rivals == 1 else 0,
    )


def ruled_out(v: tuple[int, ...]) -> bool:
    """The exact check: another given name, middle name, generation suffix or state is another person."""
    named = dict(zip(VOTERS, v))
    return any(named[k] < 0 for k in ("surname_near", "given_full", "given_initial", "middle", "suffix", "state"))


def encode(v: tuple[int, ...]) -> int:
    code = 0
    for x in v:
        code = code * 3 + x + 1
    return code


def decode(code: int) -> tuple[int, ...]:
    out = []
    for _ in VOTERS:
        code, x = divmod(code, 3)
        out.append(x - 1)
    return tuple(reversed(out))


class LabelModel:
    """Two classes; the votes of a factor (one voter, or some that are correlated) are categorical in each class."""

    def __init__(self, rounds: int = 100, smooth: float = 0.5, correlated: float = 0.5):
        self.rounds, self.smooth, self.correlated = rounds, smooth, correlated
        self.factors: list[tuple[int, ...]] = []

    def _em(self, v: np.ndarray, n: np.ndarray, q: np.ndarray) -> np.ndarray:
        codes = [(*np.unique(v[:, f], axis=0, return_inverse=True), len(f)) for f in map(list, self.factors)]
        for _ in range(self.rounds):
            pi = (n @ q + self.smooth) / (n.sum() + 2 * self.smooth)
            log = np.full(len(n), np.log(pi) - np.log1p(-pi))
            for values, at, width in codes:
                at = at.reshape(-1)
                k = len(values)
                one = np.bincount(at, n * q, k) + self.smooth
                none = np.bincount(at, n * (1 - q), k) + self.smooth
                if width == 1:  # a few imagined votes of a voter that is mostly right, which matter for few candidates only
                    one += np.where(values[:, 0] > 0, 3.0, np.where(values[:, 0] < 0, 0.3, 1.0))
                    none += np.where(values[:, 0] > 0, 1.0, np.where(values[:, 0] < 0, 3.0, 1.0))
                log += (np.log(one / one.sum()) - np.log(none / none.sum()))[at]
            new = 1 / (1 + np.exp(-np.clip(log, -30, 30)))
            if np.abs(new - q).max() < 1e-6:
                return new
            q = new
        return q

    def fit(self, patterns: list[tuple[int, ...]], counts: list[int]) -> np.ndarray:
        """The posterior of a match for each pattern. As many patterns as occur, whatever the number of candidates."""
        v, n = np.array(patterns), np.array(counts, dtype=float)
        # Start: the majority.
        start = v.sum(axis=1) / len(VOTERS)
        q = 0.5 + 0.45 * np.clip(start * 2, -1, 1)
        self.factors = [(j,) for j in range(v.shape[1])]
        q = self._em(v, n, q)
        group = list(range(v.shape[1]))
        for a, b in itertools.combinations(range(v.shape[1]), 2):
            if group[a] != group[b] and self._residual(v[:, a], v[:, b], n, q) > self.correlated:
                group = [group[a] if g == group[b] else g for g in group]
        self.factors = [tuple(j for j, g in enumerate(group) if g == x) for x in dict.fromkeys(group)]
        return self._em(v, n, q)

    @staticmethod
    def _residual(a: np.ndarray, b: np.ndarray, n: np.ndarray, q: np.ndarray) -> float:
        """Correlation of two voters that the class doesn't explain."""
        worst = 0.0
        for w in (n * q, n * (1 - q)):
            if (total := w.sum()) < 30:
                continue
            da, db = a - (w @ a) / total, b - (w @ b) / total
            spread = np.sqrt((w @ da**2) * (w @ db**2))
            if spread > 1e-9:
                worst = max(worst, abs(w @ (da * db)) / spread)
        return worst


_PAIR = T.StructType([T.StructField("row_no", T.LongType()), T.StructField("candidates", T.ArrayType(T.StructType([T.StructField("bioguide", T.StringType()), T.StructField("pattern", T.LongType())])))])
_ARROW = pa.schema([("row_no", pa.int64()), ("candidates", pa.list_(pa.struct([("bioguide", pa.string()), ("pattern", pa.int64())])))])


def _score(given_names: GivenNames, near):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict = {}
        for batch in batches:
            rows, found = [], []
            for row_no, first, last, suffix, state, year, district, code, extra in zip(*(c.to_pylist() for c in batch.columns)):
                if year is None:
                    continue
                if (name := memo.get((first, last, suffix))) is None:
                    if len(memo) > 200_000:
                        memo.clear()
                    name = memo[first, last, suffix] = read_name(first, last, suffix, given_names)
                state = (state or "").upper() or None
                people = [p for p in near(name, extra) if (state is None or p.state == state) and p.held(year)]
                if people:
                    rows.append(row_no)
                    found.append([{"bioguide": p.bioguide, "pattern": encode(votes(name, state, year, district, code, p, len(people)))} for p in people])
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(found, _ARROW.field(1).type)], schema=_ARROW)

    return run


def candidates(filings: DataFrame, legislators: DataFrame) -> DataFrame:
    """(row_no, candidates[bioguide, pattern of votes]) of each filing without bioguide_id that has a candidate."""
    spark = filings.sparkSession
    ship(spark)
    given_names = vocabulary(legislators)
    narrow = filings.where("bioguide_id IS NULL").select(
        "row_no", F.col("filer.first").alias("first"), F.col("filer.last").alias("last"), F.col("filer.suffix").alias("suffix"),
        F.col("state_district.state").alias("state"), "coverage_year", F.col("state_district.district").alias("district"), F.col("filing_type.code").alias("code"),
    )
    people = legislators.select("id.bioguide", "name.first", "name.last", "name.official_full", F.transform("terms", lambda t: F.struct(t["state"].alias("state"), t["district"].alias("district"), t["start"].alias("start"))).alias("terms"))
    if people.limit(MAX_INDEXED + 1).count() <= MAX_INDEXED:
        read = (read_person(*r, given_names) for r in people.collect())
        sent = spark.sparkContext.broadcast(PersonIndex(sorted((p for p in read if p), key=lambda p: p.bioguide)))

        def near(name, _):
            index = sent.value
            return [index.persons[i] for i in index.near(name)]

        return narrow.withColumn("extra", F.lit(None).cast("string")).mapInArrow(_score(given_names, near), _PAIR)
    return _joined_candidates(narrow, people, given_names)


def _joined_candidates(narrow: DataFrame, people: DataFrame, given_names: GivenNames) -> DataFrame:
    """The same by a join on the keys, for more persons than fit into one index."""

    def spelled(side: DataFrame, name: str) -> DataFrame:
        """The rows once for each surname form, read in Arrow batches."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                forms = [sorted(read_name(first, last, None, given_names).surname_forms()) for first, last in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(forms, pa.list_(pa.string()))], names=[*batch.schema.names, "forms"])

        ordered = side.select("first", "last", *(c for c in side.columns if c not in ("first", "last")))
        return ordered.mapInArrow(run, T.StructType([*ordered.schema, T.StructField("forms", T.ArrayType(T.StringType()))])).withColumn(name, F.explode("forms")).drop("forms")

    # The keys are made of the distinct forms only; what is alike is joined back.
    left = spelled(narrow, "form_a")
    right = spelled(people, "form_b").select("form_b", F.struct("bioguide", "first", "last", "official_full", "terms").alias("person"))
    # A filing gathers the candidates of its own seat and year only, however many people bear the surname.
    held = F.exists("person.terms", lambda t: F.col("coverage_year").between(F.year(t["start"]), F.year(t["start"]) + 1))
    state = F.nullif(F.upper("state"), F.lit(""))
    there = state.isNull() | (state == F.element_at(F.filter("person.terms", lambda t: t["start"].isNotNull()), -1)["state"])
    one, other = (cut_lineage(side.select(F.col(c).alias("form")).distinct()) for side, c in ((left, "form_a"), (right, "form_b")))
    pairs = left.join(near_forms(one, other), "form_a").join(right, "form_b").where(held & there).groupBy(*narrow.columns).agg(F.collect_set("person").alias("extra"))

    def near(name, extra):
        found = (read_person(*p.values(), given_names) for p in sorted(extra, key=lambda p: p["bioguide"]))
        return [p for p in found if p and compare_surname(name, p.name) != CONFLICT]

    return pairs.select(*narrow.columns, "extra").mapInArrow(_score(given_names, near), _PAIR)


def link(filings: DataFrame, legislators: DataFrame, check: bool = True) -> DataFrame:
    """(row_no, bioguide, confidence, accepted): the best candidate of each filing that has one.

    Without the check the model alone decides."""
    spark = filings.sparkSession
    pairs = cut_lineage(candidates(filings, legislators))
    # As many rows as there are patterns of votes.
    seen = pairs.select(F.explode("candidates").alias("c")).groupBy("c.pattern").count().orderBy("pattern").collect()
    if not seen:
        return spark.createDataFrame([], "row_no long, bioguide string, confidence double, accepted boolean")
    patterns = [decode(r[0]) for r in seen]
    posterior = LabelModel().fit(patterns, [r[1] for r in seen])
    table = {r[0]: (float(p), not (check and ruled_out(v))) for r, p, v in zip(seen, posterior, patterns)}
    sent = spark.sparkContext.broadcast(table)
    out = T.StructType([T.StructField("row_no", T.LongType()), T.StructField("bioguide", T.StringType()), T.StructField("confidence", T.DoubleType()), T.StructField("accepted", T.BooleanType())])

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for batch in batches:
            rows = []
            for row_no, found in zip(*(c.to_pylist() for c in batch.columns)):
                ranked = sorted(((known[c["pattern"]][1], known[c["pattern"]][0], c["bioguide"]) for c in found), key=lambda x: (-x[0], -x[1], x[2]))
                fits, p, who = ranked[0]
                alone = len(ranked) == 1 or ranked[1][:2] != ranked[0][:2]
                rows.append((row_no, who, p, fits and alone and p >= 0.5))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.string(), pa.float64(), pa.bool_()))], names=out.names)

    return pairs.mapInArrow(best, out)


def found(filings: DataFrame, legislators: DataFrame) -> DataFrame:
    """(row_no, bioguide) of the accepted matches."""
    return link(filings, legislators).where("accepted").select("row_no", "bioguide")
