"""Report pages to records: each document's lines are classified, grouped into rows and split into columns.

A document is complete in itself and is one row of (doc_id, text), so it is read as a whole inside the Arrow batch that it
comes in: no shuffle, no window over lines. Decoding PDF files is a source's business; lines that come as rows of their own
are put together first (`documents`, one shuffle by document).

Defined cases
* A null text is no document; an empty one has no rows.
* Lines are compared without surrounding spaces and with tabs as spaces.
* doc_id keeps its type; documents under one doc_id are read one by one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import asdict

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe import types as kinds
from tallyframe.operators import columns as C
from tallyframe.operators import lines as L
from tallyframe.operators.predicates import in_scope
from tallyframe.session import ship

_DOC = "doc_id"


def _arrow(kind: T.DataType) -> pa.DataType:
    if isinstance(kind, T.StructType):
        return pa.struct([(f.name, _arrow(f.dataType)) for f in kind])
    if isinstance(kind, T.ArrayType):
        return pa.list_(_arrow(kind.elementType))
    return {T.StringType: pa.string(), T.LongType: pa.int64(), T.IntegerType: pa.int32(), T.DoubleType: pa.float64(), T.BooleanType: pa.bool_(), T.DateType: pa.date32()}[type(kind)]


def _plain(values: dict) -> dict:
    return {k: asdict(v) if isinstance(v, C.Amount) else v for k, v in values.items()}


def documents(lines: DataFrame) -> DataFrame:
    """(doc_id, text) of (doc_id, line_no, line): a document's lines are one group, as its text is one value."""
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("line_no", "line"))), lambda x: x["line"])
    return lines.groupBy(_DOC).agg(F.concat_ws("\n", ordered).alias("text"))


def text_lines(text: str) -> list[str]:
    return [ln.replace("\t", " ").strip(" ") for ln in re.split(r"\r\n|[\n\r]", text)]


# ---------------------------------------------------------------- schedules of annual reports


class ReportReader:
    """The schedules of one annual report from its lines."""

    def __init__(self, layout: C.Layout, latest: int = C.LATEST_YEAR):
        self.layout, self.latest = layout, latest
        find = lambda pattern: re.compile(pattern, re.I)
        box, low = layout.box, r"\$[\d,]+\s*-"
        self.heading, self.none_line, self.trailer = find(layout.heading), find(layout.none_line), find(layout.trailer)
        self.detail, self.comment = find(f"{layout.location}|{layout.description}"), find(layout.comment)
        self.low, self.tag, self.boxed = re.compile(low), re.compile(r"\[[A-Za-z0-9]+\]"), re.compile(rf"\S.*\b{box}\s*$")
        # A holding's columns begin behind its tag or behind the arrow of a sub-holding.
        self.valued = re.compile(rf"\[[A-Za-z0-9]+\]\s*(?:(?:SP|DC|JT)\b\s*)?(?:\$|None\b|Undetermined\b|Over\b)|⇒.*{low}")
        self.only_tag, self.ends_boxed = re.compile(r"[^$]*\[[A-Za-z0-9]{2}\][^$]*$"), re.compile(rf"\b{box}\s*$")
        self.trade = find(r"\d{1,2}/\d{1,2}/\d{4}\s+(?:S \(partial\)|[PSE])\b")
        self.incurred, self.year, self.opens = re.compile(C.DATE_INCURRED), re.compile(C.BARE_YEAR), re.compile(C.RANGE_START)
        self.agreed, self.trip, self.dollar = find(rf"\s*{C.LEADING_DATE}(?![.,])"), find(C.TRIP_DATES), re.compile(C.DOLLAR)

    def segments(self, lines: list[str]) -> tuple[dict[str, list[str]], bool]:
        """(content lines of each schedule, whether there was any heading).

        A heading opens a schedule, and one that comes again goes on with it. The trailer ends it, and so does any line
        after `none disclosed` where no row came before. Column headers and the marker itself are left out."""
        found: dict[str, list[str]] = {}
        letter, none, rows, headed = None, False, 0, False
        for line in lines:
            if not line:
                continue
            if m := self.heading.search(line):
                letter, none, rows, headed = m[1].upper(), False, 0, True
            elif letter is None:
                continue
            elif self.trailer.search(line) or (none and not rows):
                letter = None
            elif self.none_line.search(line):
                none = True
            elif not self.layout.is_furniture(line):
                rows += 1
                found.setdefault(letter, []).append(line)
        return found, headed

    def starts(self, letter: str, line: str, following: str) -> bool:
        """Whether a line begins an item of its schedule; one line of look-ahead where a holding's tag wrapped."""
        if letter == "A":
            if self.detail.search(line):
                return False
            if self.boxed.search(line) or self.valued.search(line):
                return True
            if not self.low.search(line) or line.startswith("$"):
                return False
            return not self.tag.search(line) or (self.only_tag.match(following) is not None and not self.ends_boxed.search(following))
        if letter == "B":
            return self.trade.search(line) is not None
        if letter == "D":
            return self.incurred.search(line) is not None or (self.year.search(line) is not None and self.opens.search(line) is not None)
        if letter == "E":
            return not self.comment.search(line)
        if letter in "FHI":
            return {"F": self.agreed.match, "H": self.trip.search, "I": self.dollar.search}[letter](line) is not None
        return True

    def rows(self, letter: str, lines: list[str]) -> tuple[list[str], bool]:
        """(the text of each item, whether no line began one and each is kept as an item of text alone).

        Lines before the first start are one leading item: no line is lost."""
        begins = [self.starts(letter, line, after) for line, after in zip(lines, [*lines[1:], ""])]
        if not any(begins):
            return list(lines), True
        cuts = sorted({0, *(i for i, b in enumerate(begins) if b)})
        return [" ".join(lines[lo:hi]) for lo, hi in zip(cuts, [*cuts[1:], len(lines)])], False

    def items(self, letter: str, lines: list[str]) -> Iterator[dict]:
        """The columns of each item of a schedule, with its text."""
        rows, salvaged = self.rows(letter, lines)
        for raw in rows:
            text = C.scrub(raw)
            first = C.FIRST_COLUMN.get(letter)
            fields = ({first: text} if first else {}) if salvaged else _plain(C.PARSERS[letter](raw, self.layout, self.latest))
            yield {**fields, "raw_text": text}

    def problem(self, letter: str, lines: list[str], items: list[dict]) -> str | None:
        """`extract_failed` if far fewer items came out than the tags let expect, `schedule_incomplete` if rows ran together."""
        if letter not in ("A", "B"):
            return None
        if L.has_collapsed(len(items), sum(len(C.tags(ln)) for ln in lines)):
            return "extract_failed"
        return "schedule_incomplete" if any(C.real_codes(x["raw_text"] or "") >= 2 for x in items) else None


def _read(docs: DataFrame, fields: list[T.StructField], each) -> DataFrame:
    """One pass over (doc_id, text): each(text) gives rows of the fields."""
    ship(docs.sparkSession)
    key = docs.schema[_DOC]
    arrow = [_arrow(f.dataType) for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            where, rows = [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                if text is not None:
                    for row in each(text):
                        where.append(i)
                        rows.append(row)
            if rows:
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(where, pa.int32())), *(pa.array(c, t) for c, t in zip(zip(*rows), arrow))], names=[_DOC, *(f.name for f in fields)])

    return docs.select(_DOC, "text").mapInArrow(run, T.StructType([T.StructField(_DOC, key.dataType), *fields]))


def transaction_rows(docs: DataFrame, layout: C.Layout = C.Layout(), latest: int = C.LATEST_YEAR) -> DataFrame:
    """(doc_id, item, transaction, reason): each row of each report of transactions; of a report that fails as a whole one
    row with the reason alone.

    The number of rows must be that of the status lines; otherwise nothing of the document is given out."""
    fields = [T.StructField("item", T.IntegerType()), T.StructField("transaction", kinds.TRANSACTION), T.StructField("reason", T.StringType())]
    reader = C.PtrReader(layout, latest)

    def each(text: str) -> Iterator[tuple]:
        rows, wanted = reader.read(text_lines(text))
        good = [(i, r) for i, r in enumerate(rows) if r is not None]
        if len(good) != wanted:
            yield None, None, "extract_failed"
        else:
            for i, r in good:
                yield i, _plain(r), None

    return _read(docs, fields, each)


def transactions(docs: DataFrame, layout: C.Layout = C.Layout(), latest: int = C.LATEST_YEAR) -> tuple[DataFrame, DataFrame]:
    """((doc_id, item, transaction), (doc_id, reason) of documents that failed as a whole)."""
    rows = transaction_rows(docs, layout, latest)
    return rows.where("reason IS NULL").select(_DOC, "item", "transaction"), rows.where("reason IS NOT NULL").select(_DOC, "reason")


def schedule_rows(docs: DataFrame, layout: C.Layout = C.Layout(), latest: int = C.LATEST_YEAR, letters: str = "ABCDEFGHIJ") -> DataFrame:
    """(doc_id, schedule, item_no, A .. J, raw_text, reason): each item, its columns in the struct of its letter; and each
    schedule that is incomplete as a row with the reason alone. Only the letters wanted are split into columns."""
    fields = [
        T.StructField("schedule", T.StringType()), T.StructField("item_no", T.IntegerType()), *(T.StructField(letter, schema) for letter, schema in kinds.SCHEDULES.items()),
        T.StructField("raw_text", T.StringType()), T.StructField("reason", T.StringType()),
    ]
    reader, names = ReportReader(layout, latest), list(kinds.SCHEDULES)

    def each(text: str) -> Iterator[tuple]:
        for letter, lines in sorted(reader.segments(text_lines(text))[0].items()):
            if letter not in letters:
                continue
            items = list(reader.items(letter, lines))
            for no, x in enumerate(items, 1):
                yield letter, no, *(x if n == letter else None for n in names), x["raw_text"], None
            if reason := reader.problem(letter, lines, items):
                yield letter, None, *(None for _ in names), None, reason

    return _read(docs, fields, each)


def schedule_items(docs: DataFrame, layout: C.Layout = C.Layout(), latest: int = C.LATEST_YEAR, letters: str = "ABCDEFGHIJ") -> DataFrame:
    """(doc_id, schedule, item_no, A .. J, raw_text): each item."""
    return schedule_rows(docs, layout, latest, letters).where("reason IS NULL").drop("reason")


def incomplete(docs: DataFrame, layout: C.Layout = C.Layout()) -> DataFrame:
    """(doc_id, schedule, reason): schedules with fewer items than their type tags let expect, or rows that ran together."""
    return schedule_rows(docs, layout, letters="AB").where("reason IS NOT NULL").select(_DOC, "schedule", "reason")


# ---------------------------------------------------------------- the parse of a year


def readings(docs: DataFrame, layout: C.Layout = C.Layout(), latest: int = C.LATEST_YEAR) -> DataFrame:
    """(doc_id, pdf_class, ptr_failed, ptr_odd_date, headed, fd_failed, fd_odd_date, fd_incomplete): what each document is
    as a report of transactions and as an annual report. A row for each document, whatever its length."""
    flags = ("ptr_failed", "ptr_odd_date", "headed", "fd_failed", "fd_odd_date", "fd_incomplete")
    fields = [T.StructField("pdf_class", T.StringType()), *(T.StructField(f, T.BooleanType()) for f in flags)]
    ptr, fd = C.PtrReader(layout, latest), ReportReader(layout, latest)

    def each(text: str) -> Iterator[tuple]:
        if L.count_visible(text) < L.EFILED_CHARS:
            yield ("scanned", *(False for _ in flags))
            return
        lines = text_lines(text)
        rows, wanted = ptr.read(lines)
        good = [r for r in rows if r is not None]
        found, headed = fd.segments(lines)
        read = {letter: list(fd.items(letter, found[letter])) for letter in "AB" if letter in found}
        problems = {fd.problem(letter, found[letter], items) for letter, items in read.items()}
        odd_ptr = any(r["date_raw"] or r["notification_date_raw"] for r in good)
        odd_fd = any(x.get("transaction_date_raw") for x in read.get("B", ()))
        yield "efiled", len(good) != wanted, odd_ptr, headed, "extract_failed" in problems, odd_fd, "schedule_incomplete" in problems

    return _read(docs, fields, each)


def outcomes(filings: DataFrame, docs: DataFrame, layout: C.Layout = C.Layout(), latest: int = C.LATEST_YEAR, families: set[str] | None = None) -> DataFrame:
    """Adds pdf_class, parse_status and reasons (an array, in order) to filings (doc_id, filing_type). docs: doc_id, text,
    one row for each document.

    `missing` and `scanned` filings have no body and are ok. A report of transactions fails as a whole; an annual report
    without any heading fails, other kinds may have none; a filing that failed has no class. Odd dates and rows that ran
    together leave the filing ok with a reason. Filings out of scope aren't looked into. The filings meet one narrow row of
    each document; the texts stay where they are read."""
    seen = readings(docs, layout, latest)
    seen = seen.select(F.col(_DOC).cast("string").alias("__doc"), *(F.col(c).alias(f"__{c}") for c in seen.columns[1:]))
    f = filings.drop("pdf_class", "parse_status", "reasons").join(seen, F.col(_DOC).cast("string") == F.col("__doc"), "left")
    code = F.coalesce(F.col("filing_type.code"), F.lit(""))
    ptr = code == kinds.PTR_TYPE
    scope = in_scope(code, families)
    klass = F.coalesce(F.col("__pdf_class"), F.lit("missing"))
    efiled = klass == "efiled"
    headless = code.isin(*kinds.ANNUAL_TYPES) & ~F.col("__headed")
    failed = F.coalesce(scope & efiled & F.when(ptr, F.col("__ptr_failed")).otherwise(F.col("__fd_failed") | headless), F.lit(False))
    whole = scope & efiled & ~failed
    reasons = F.array_compact(
        F.array(
            F.when(scope & ~efiled, klass),
            F.when(failed, "extract_failed"),
            F.when(scope & ~code.isin(*kinds.FILING_TYPES), "unknown_type"),
            F.when(whole & F.when(ptr, F.col("__ptr_odd_date")).otherwise(F.col("__fd_odd_date")), "date_out_of_range"),
            F.when(whole & ~ptr & F.col("__fd_incomplete"), "schedule_incomplete"),
        )
    )
    out = f.withColumn("pdf_class", F.when(scope & ~failed, klass)).withColumn("parse_status", F.when(failed, "error").otherwise("ok")).withColumn("reasons", reasons)
    return out.drop(*(c for c in out.columns if c.startswith("__")))


def unparsed(outcome: DataFrame) -> DataFrame:
    """(doc_id, reason): an entry for each reason of each filing."""
    return outcome.select(_DOC, F.explode("reasons").alias("reason"))
