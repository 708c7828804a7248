"""Deeply nested records as flat node tables that are linked by interval containment.

A body is a JSON tree. One depth-first traversal numbers each of its nodes: `pre` counts nodes as they are entered,
`post` as they are left. Node a holds node d exactly if a.pre < d.pre and a.post > d.post, so the tables of the node
types (schedule, item, amount) need no keys but (doc, pre, post) to lead back to the body, the schedule and the place.
A body never leaves the batch that it is read in: its nodes are linked there, by one sweep over their intervals.

Defined cases
* A body that is null, blank, unreadable as a whole, or JSON null has no nodes. NaN and Infinity aren't JSON.
* A byte-order mark before the body, and a body that is a JSON string holding JSON (however often), are unwrapped first.
* A schedule is any single-letter key of a wrapper object (`schedules`, an element of `pages`, the body itself), in
  either case. Its value may be a list, an object with `items`, one item, or null (no items).
* Null list elements are no items and aren't counted; repeated keys of one object are all kept.
* Bodies may be nested to any depth, and numbers may be of any size: bounds are whole numbers of 64 bits, and an amount
  that has none (a fraction, a number too large) keeps its text.
* Every row is a body of its own, also where body_id is null or repeated: `doc` numbers the rows of the input.
"""

from __future__ import annotations

import json
import math
import re
from collections import Counter
from collections.abc import Generator, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.session import ship

# schedule and item_no: the schedule that holds a node, and the number in it of the item that the node is or lies in.
NODE_SCHEMA = T.StructType(
    [
        T.StructField("doc", T.LongType()),
        T.StructField("body_id", T.LongType()),
        T.StructField("kind", T.StringType()),
        T.StructField("pre", T.IntegerType()),
        T.StructField("post", T.IntegerType()),
        T.StructField("label", T.StringType()),
        T.StructField("fields", T.MapType(T.StringType(), T.StringType())),
        T.StructField("low", T.LongType()),
        T.StructField("high", T.LongType()),
        T.StructField("exact", T.DoubleType()),
        T.StructField("text", T.StringType()),
        T.StructField("schedule", T.StringType()),
        T.StructField("item_no", T.IntegerType()),
    ]
)

# The fields of a line item that hold an amount.
AMOUNT_FIELDS = ("value_of_asset", "income_amount", "income_preceding", "amount_range", "amount", "amount_preceding")

_MONEY = re.compile(r"\$?\s*(-?[0-9][0-9,]*(?:\.[0-9]+)?)")
_RANGE = re.compile(r"\s*\$?\s*([0-9][0-9,]*)\s*-\s*\$?\s*([0-9][0-9,]*)\s*")


class Unreadable(ValueError):
    """The body can't be read as a whole."""


def _no_number(text: str):
    raise ValueError(f"{text} isn't JSON")


_TOKEN = re.compile(r'[ \t\r\n]*(?:([{}\[\],:])|("[^"\\]*(?:\\.[^"\\]*)*")|(-?[0-9][0-9.eE+-]*|true|false|null))', re.S)
_CLOSES = {"{": "}", "[": "]"}


def _deep(body: str):
    """The value of a body that is nested deeper than the ordinary parser can go; the open containers are a list."""
    stack: list[tuple[str, list]] = []
    at, wanted, key = 0, "value", None
    while True:
        if not (m := _TOKEN.match(body, at)):
            raise ValueError("no JSON")
        at, (mark, text, plain) = m.end(), m.groups()
        if wanted == "key":
            if text is None or not (colon := _TOKEN.match(body, at)) or colon[1] != ":":
                if mark == "}" and not stack[-1][1]:
                    wanted = "more"  # an empty object
                else:
                    raise ValueError("no key")
            else:
                at, wanted = colon.end(), "value"
                stack[-1][1].append([json.loads(text), None])
                continue
        elif wanted == "more" and mark == ",":
            wanted = "key" if stack[-1][0] == "{" else "value"
            continue
        elif wanted in ("value", "first") and mark in _CLOSES:
            stack.append((mark, []))
            wanted = "key" if mark == "{" else "first"
            continue
        if mark is not None:
            if wanted not in ("more", "first") or not stack or mark != _CLOSES[stack[-1][0]]:
                raise ValueError("out of place")
            kind, inside = stack.pop()
            value = tuple((k, v) for k, v in inside) if kind == "{" else inside
        elif wanted in ("value", "first"):
            value = json.loads(text or plain)
        else:
            raise ValueError("out of place")
        if not stack:
            if body[at:].strip(" \t\r\n"):
                raise ValueError("more than one value")
            return value
        if stack[-1][0] == "{":
            stack[-1][1][-1][1] = value
        else:
            stack[-1][1].append(value)
        wanted = "more"


def _parse(body: str):
    """Objects become tuples of pairs (so that repeated keys stay), arrays lists."""
    try:
        return json.loads(body, object_pairs_hook=tuple, parse_constant=_no_number)
    except RecursionError:
        return _deep(body)
    except ValueError as e:
        if "integer string" not in str(e):
            raise
        return json.loads(body, object_pairs_hook=tuple, parse_constant=_no_number, parse_int=float)  # digits beyond all bounds


def _load(body: str):
    while True:
        try:
            value = _parse(body.strip().lstrip("\ufeff"))
        except (ValueError, RecursionError) as e:
            raise Unreadable(str(e)) from None
        if not isinstance(value, str):
            return value
        body = value  # shorter by its quotes at least


_MOST = 2**63


def _whole(value) -> int | None:
    """A whole number of 64 bits, or null."""
    if isinstance(value, bool) or value is None:
        return None
    if isinstance(value, str) and (m := _MONEY.fullmatch(value.strip())):
        value = float(m[1].replace(",", "")) if "." in m[1] else int(m[1].replace(",", "")[:400])
    if isinstance(value, float) and math.isfinite(value) and value == math.floor(value):
        value = int(value)
    return value if isinstance(value, int) and -_MOST <= value < _MOST else None


def _real(value) -> float | None:
    if isinstance(value, bool) or value is None:
        return None
    if isinstance(value, str) and (m := _MONEY.fullmatch(value.strip())):
        value = float(m[1].replace(",", ""))
    try:
        found = float(value) if isinstance(value, (int, float)) else math.inf
    except OverflowError:
        return None
    return found if math.isfinite(found) else None


def _plain(value):
    """What json.dumps writes as the value was."""
    if isinstance(value, tuple):
        return {k: _plain(v) for k, v in value}
    return [_plain(v) for v in value] if isinstance(value, list) else value


def read_amount(value) -> tuple[int | None, int | None, float | None, str | None]:
    """(low, high, exact, text) of an amount in any of its shapes: an object, a range or a sum as text, a number.

    text: the label, the text itself, or the JSON of an object without a label of which a value can't be read."""
    if isinstance(value, tuple):
        d = dict(value)
        label = d.get("label")
        low, high, exact = _whole(d.get("low")), _whole(d.get("high")), _real(d.get("exact"))
        if not isinstance(label, str):
            lost = any(d.get(k) is not None and v is None for k, v in (("low", low), ("high", high), ("exact", exact)))
            try:
                label = json.dumps(_plain(value), ensure_ascii=False) if lost else None
            except RecursionError:
                label = None
        return low, high, exact, label
    if isinstance(value, str):
        if m := _RANGE.fullmatch(value):
            return _whole(m[1]), _whole(m[2]), None, value
        return None, None, _real(value), value
    return None, None, _real(value), None if value is None else _scalar(value)


def _scalar(value) -> str | None:
    if value is None or isinstance(value, str):
        return value
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, list):
        return "; ".join(s for s in map(_scalar, value) if s is not None)
    if isinstance(value, tuple):
        return None
    return str(value)


class Traversal:
    """Numbers the nodes of one body after another and keeps those of the wanted kinds.

    Whatever can be nested without bound is a generator that yields what is to be entered next, so that the open nodes
    are a list instead of the interpreter's stack. letters: the schedules to look into (the others are only numbered);
    item_amount: the field whose amount the items themselves carry."""

    def __init__(self, kinds: set[str], letters: frozenset[str] | None = None, item_amount: str | None = None):
        self.kinds, self.letters, self.item_amount, self.rows = kinds, letters, item_amount, []

    def body(self, doc: int, body_id: int | None, value) -> None:
        self.doc, self.body_id, self.pre, self.post = doc, body_id, 0, 0
        entered = [self.wrapper("body", value)]
        while entered:
            below = next(entered[-1], None)
            if below is None:
                entered.pop()
            else:
                entered.append(below)

    def emit(self, kind: str, pre: int, label: str | None, fields=None, amount=(None, None, None, None)) -> None:
        if kind in self.kinds:
            self.rows.append((self.doc, self.body_id, kind, pre, self.post, label, fields, *amount))

    def enter(self) -> int:
        self.pre += 1
        return self.pre

    def leave(self) -> None:
        self.post += 1

    def rest(self, value) -> None:
        """A node whose own kind is of no interest, and all below it: they only count."""
        n, left = 0, [value]
        while left:
            n += 1
            v = left.pop()
            if type(v) is tuple:
                left.extend(x for _, x in v)
            elif type(v) is list:
                left.extend(v)
        self.pre += n
        self.post += n

    def wrapper(self, kind: str, value) -> Generator:
        pre = self.enter()
        if isinstance(value, tuple):
            named = dict(value)
            letter = named.get("schedule", named.get("letter"))
            if isinstance(letter, str) and _is_letter(letter) and "items" in named:
                yield self.schedule(letter, value)
            else:
                for key, v in value:
                    if _is_letter(key):
                        yield self.schedule(key, v)
                    elif isinstance(v, (tuple, list)):
                        yield self.wrapper("wrapper", v)
                    else:
                        self.rest(v)
        elif isinstance(value, list):
            for v in value:
                yield self.wrapper("page", v)
        self.leave()
        self.emit(kind, pre, None)

    def schedule(self, letter: str, value) -> Generator:
        pre = self.enter()
        if isinstance(value, str) and value.lstrip()[:1] in ("[", "{"):
            try:
                value = _load(value)
            except Unreadable:
                value = None
        if self.letters is None or letter.upper() in self.letters:
            yield self.items(value)
        else:
            self.rest(value)
        self.leave()
        self.emit("schedule", pre, letter.upper())

    def items(self, value) -> Generator:
        if isinstance(value, list):
            for v in value:
                if isinstance(v, list):
                    yield self.items(v)
                elif v is None:
                    self.rest(v)
                else:
                    self.item(v)
        elif isinstance(value, tuple):
            keys = [k for k, _ in value]
            if "items" in keys:
                for k, v in value:
                    if k == "items":
                        yield self.items([v] if isinstance(v, tuple) else v)
                    else:
                        self.rest(v)
            elif keys and all(k.isdigit() for k in keys):
                yield self.items([v for _, v in value])
            else:
                self.item(value)
        else:
            self.rest(value)

    def item(self, value) -> None:
        pre = self.enter()
        fields, amount = None, (None, None, None, None)
        if type(value) is tuple:
            detail = "amount" in self.kinds
            for key, v in value:
                kind = type(v)
                if key == self.item_amount:
                    amount = read_amount(v)
                if detail and key in AMOUNT_FIELDS and v is not None:
                    below = self.pre + 1
                    self.rest(v)
                    self.emit("amount", below, key, None, read_amount(v))
                elif kind is tuple or kind is list:
                    self.rest(v)
                else:
                    self.pre += 1
                    self.post += 1
            if "fields" in self.kinds:
                fields = [(k, s) for k, s in {k: _scalar(v) for k, v in value}.items() if s is not None]
        elif "fields" in self.kinds:
            fields = [("raw_text", _scalar(value) or "")]
        self.leave()
        self.emit("item", pre, None, fields, amount)


def contained(nodes: list[tuple], kinds: set[str]) -> Iterator[tuple]:
    """The nodes of one body that lie in a schedule, and the schedules, with the schedule's label and the item's number.

    In `pre` order, the nodes whose `post` isn't passed yet are those that hold the next one: its schedule and its item
    are the innermost of them."""
    number: Counter = Counter()
    held: list[tuple] = []  # (post, label of the schedule, number of the item)
    for n in sorted(nodes, key=lambda n: n[3]):
        while held and held[-1][0] < n[4]:
            held.pop()
        label, item_no = held[-1][1:] if held else (None, None)
        if n[2] == "schedule":
            label, item_no = n[5], None
        elif n[2] == "item" and label is not None:
            number[label] += 1
            item_no = number[label]
        held.append((n[4], label, item_no))
        if n[2] in kinds and (label is not None or n[2] not in ("item", "amount")):
            yield (*n, label, item_no)


def _is_letter(key: str) -> bool:
    return len(key) == 1 and key.isascii() and key.isalpha() or key.upper() == "PTR"


_ARROW = pa.schema(
    [
        ("doc", pa.int64()),
        ("body_id", pa.int64()),
        ("kind", pa.string()),
        ("pre", pa.int32()),
        ("post", pa.int32()),
        ("label", pa.string()),
        ("fields", pa.map_(pa.string(), pa.string())),
        ("low", pa.int64()),
        ("high", pa.int64()),
        ("exact", pa.float64()),
        ("text", pa.string()),
        ("schedule", pa.string()),
        ("item_no", pa.int32()),
    ]
)


def interval_nodes(bodies: DataFrame, body_id: str, body: str, kinds: tuple[str, ...] = ("schedule", "item", "amount", "fields"), letters: tuple[str, ...] | None = None, item_amount: str | None = None) -> DataFrame:
    """The nodes of all bodies with their interval labels and what holds them, `NODE_SCHEMA`.

    kinds: the node types to give out (`body`, `page`, `schedule`, `item`, `amount`); with `fields`, items carry their
    scalar fields. letters: the schedules wanted, all if null. item_amount: an amount field that items carry in
    low, high, exact and text. All nodes are numbered whatever is given out. One pass
    without a shuffle."""
    ship(bodies.sparkSession)
    wanted = set(kinds)
    read = wanted | {"schedule", "item"}
    only = None if letters is None else frozenset(letters)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        doc = (TaskContext.get().partitionId() << 40) if TaskContext.get() else 0
        for batch in batches:
            rows: list[tuple] = []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                doc += 1
                text = text.as_py()
                if text is None or not text.strip():
                    continue
                try:
                    value = _load(text)
                except Unreadable:
                    continue
                t = Traversal(read, only, item_amount)
                t.body(doc, key, value)
                rows.extend(contained(t.rows, wanted))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _ARROW)], schema=_ARROW)

    narrow = bodies.select(F.col(body_id).cast("long").alias("body_id"), F.col(body).cast("string").alias("body"))
    return narrow.mapInArrow(run, NODE_SCHEMA)


def ptr_bodies(ptr: DataFrame) -> DataFrame:
    """Transaction reports in the shape of the other bodies: one schedule named PTR."""
    wrapped: Column = F.concat(F.lit('{"schedules":{"PTR":'), F.to_json("transactions", {"ignoreNullFields": "true"}), F.lit("}}"))
    return ptr.select("body_id", F.when(F.col("transactions").isNotNull(), wrapped).alias("body"))


def report_nodes(fd: DataFrame, ptr: DataFrame, kinds: tuple[str, ...]) -> DataFrame:
    bodies = fd.select("body_id", "body").unionByName(ptr_bodies(ptr))
    return interval_nodes(bodies, "body_id", "body", kinds)


def line_item_keys(fd: DataFrame, ptr: DataFrame) -> DataFrame:
    """(body_id, schedule, item_no) of each line item of both kinds of report."""
    return report_nodes(fd, ptr, ("item",)).select("body_id", "schedule", "item_no")


def line_items(fd: DataFrame, ptr: DataFrame) -> DataFrame:
    """One row for each line item: its place and its fields, whatever their type in the body was."""
    items = report_nodes(fd, ptr, ("item", "fields"))
    get = lambda *names: F.coalesce(*(F.try_element_at("fields", F.lit(n)) for n in names))
    return items.select(
        "body_id",
        "schedule",
        "item_no",
        get("asset", "source", "creditor", "organization").alias("name"),
        get("owner").alias("owner"),
        get("asset_type", "liability_type").alias("item_type"),
        get("income_type").alias("income_type"),
        get("transaction_type", "position").alias("role"),
        get("transaction_date", "date_incurred", "date_raw").alias("date_text"),
        get("raw_text", "description").alias("raw_text"),
    )


def line_amounts(fd: DataFrame, ptr: DataFrame) -> DataFrame:
    """One row for each amount of a line item: the item's place, the field, bounds, exact value and text."""
    amounts = report_nodes(fd, ptr, ("amount",))
    return amounts.select("body_id", "schedule", "item_no", F.col("label").alias("field"), "low", "high", "exact", "text")
