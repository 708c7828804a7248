"""Lines that fail to parse, apart from the sound ones and with the reason.

Each line is cut into cells; a cell is a row of (line, column, value). The rule table (feed, column, kind of format) is
joined to the cells, the validations are evaluated, errors are aggregated per line, and the sound lines are the anti
join of all lines with the lines that have an error.

Defined cases
* A null line counts as an empty one: a single empty field, so its column count is wrong.
* Lines of an unknown or null feed can't be loaded: reason `unknown_feed`.
* Fields of any length are handled: the patterns are possessive and never recurse.
* A line is identified by line_no together with its feed and text. A line that was received twice under one line_no is
  reported once; its sound copies are all loaded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The columns of the two feeds in order.
IE_COLUMNS = [
    "cand_id", "cand_name", "spe_id", "spe_nam", "ele_type", "can_office_state", "can_office_dis", "can_office",
    "cand_pty_aff", "exp_amo", "exp_date", "agg_amo", "sup_opp", "pur", "pay", "file_num", "amndt_ind", "tran_id",
    "image_num", "receipt_dat", "fec_election_yr", "prev_file_num", "dissem_dt",
]
FD_COLUMNS = ["prefix", "last", "first", "suffix", "filing_type", "state_dst", "year", "filing_date", "doc_id"]
FEED_COLUMNS = {"ie_csv": IE_COLUMNS, "fd_index": FD_COLUMNS}

# Which format each checked column has.
RULES = {
    "ie_csv": {
        "cand_id": "candidate", "can_office": "office", "can_office_dis": "two_digits", "exp_amo": "amount", "agg_amo": "amount",
        "exp_date": "day_mon", "receipt_dat": "day_mon", "dissem_dt": "day_mon", "sup_opp": "direction", "file_num": "digits",
        "amndt_ind": "amendment", "tran_id": "transaction", "fec_election_yr": "four_digits",
    },
    "fd_index": {"filing_type": "letter", "state_dst": "seat", "year": "four_digits", "filing_date": "mdy", "doc_id": "digits"},
}
PATTERNS = {
    "candidate": r"\s*|[HSP][A-Za-z0-9]{8}",
    "office": r"[HSP]",
    "two_digits": r"[0-9]{2}",
    "amount": r"-?[0-9]++(?:\.[0-9]{1,2})?",
    "direction": r"[SO]|\s*",
    "digits": r"[0-9]++",
    "amendment": r"N|A[0-9]?",
    "transaction": r"[A-Za-z0-9-]++",
    "four_digits": r"[0-9]{4}",
    "letter": r"[A-Z]",
    "seat": r"\s*|[A-Z]{2}[0-9]{2}",
}
MONTHS = ["JAN", "FEB", "MAR", "APR", "MAY", "JUN", "JUL", "AUG", "SEP", "OCT", "NOV", "DEC"]

_FIELD = r'(?:"[^"]*+(?:""[^"]*+)*+"|[^",]*+)'


def _matches(value: Column, pattern: str) -> Column:
    return value.rlike(rf"\A(?:{pattern})\z")


def day_exists(year: Column, month: Column, day: Column) -> Column:
    """Whether the date is one of the calendar; the arguments are numbers or null."""
    leap = ((year % 4 == 0) & (year % 100 != 0)) | (year % 400 == 0)
    long = F.when(month.isin(4, 6, 9, 11), 30).when(month == 2, F.when(leap, 29).otherwise(28)).otherwise(31)
    return F.coalesce(month.between(1, 12) & (day >= 1) & (day <= long) & (year >= 1), F.lit(False))


def day_mon_ok(value: Column) -> Column:
    """Blank, or an existing DD-MON-YY date in upper case (of this century)."""
    shape = r"\A([0-9]{2})-(" + "|".join(MONTHS) + r")-([0-9]{2})\z"
    part = lambda n: F.regexp_extract(value, shape, n)
    month = F.array_position(F.array(*map(F.lit, MONTHS)), part(2))
    number = lambda n: F.nullif(part(n), F.lit("")).cast("int")
    return _matches(value, r"\s*") | day_exists(number(3) + 2000, month, number(1))


def mdy_ok(value: Column) -> Column:
    """Blank, or an existing M/D/YYYY date."""
    shape = r"\A([0-9]{1,2})/([0-9]{1,2})/([0-9]{4})\z"
    number = lambda n: F.nullif(F.regexp_extract(value, shape, n), F.lit("")).cast("int")
    return _matches(value, r"\s*") | day_exists(number(3), number(1), number(2))


def cell_ok(kind: Column, value: Column) -> Column:
    """Whether the value has the format of that kind. Each pattern is a literal, compiled once."""
    out = F.when(kind == "day_mon", day_mon_ok(value)).when(kind == "mdy", mdy_ok(value))
    for name, pattern in PATTERNS.items():
        out = out.when(kind == name, _matches(value, pattern))
    return out.otherwise(F.lit(True))


def rule_table(spark: SparkSession) -> DataFrame:
    """(feed, column_no from 0, column_name, kind). As many rows as the feeds have checked columns."""
    rows = [(feed, FEED_COLUMNS[feed].index(name), name, kind) for feed, kinds in RULES.items() for name, kind in kinds.items()]
    return spark.createDataFrame(rows, "rule_feed string, column_no int, column_name string, kind string")


def _cut(feed: Column, text: Column) -> Column:
    """struct(cells, structure) of a line: unquoted values, and null, `quoting`, `column_count` or `unknown_feed`."""
    raw = F.coalesce(text, F.lit(""))
    quoted_ok = raw.rlike(rf"\A{_FIELD}(?:,{_FIELD})*+\z")
    found = F.regexp_extract_all(F.concat(F.lit(","), raw), F.lit(f",({_FIELD})"), F.lit(1))
    plain = F.transform(found, lambda c: F.when(c.startswith('"'), F.replace(c.substr(F.lit(2), F.length(c) - 2), F.lit('""'), F.lit('"'))).otherwise(c))
    csv = feed == "ie_csv"
    cells = F.when(csv, F.when(quoted_ok, plain)).when(feed == "fd_index", F.split(raw, "\t", -1))
    wanted = F.when(csv, len(IE_COLUMNS)).otherwise(len(FD_COLUMNS))

    def judged(c: Column) -> Column:
        known = F.coalesce(feed.isin(*FEED_COLUMNS), F.lit(False))
        return F.struct(c.alias("cells"), F.when(~known, "unknown_feed").when(c.isNull(), "quoting").when(F.size(c) != wanted, "column_count").alias("structure"))

    # Bound by the lambda, so that a line is cut once however often its cells are referred to.
    return F.transform(F.array(cells), judged)[0]


def with_cells(lines: DataFrame, feed: str = "feed", text: str = "line_text") -> DataFrame:
    """Adds `cells` and `structure`, see `_cut`. The generator keeps filters on them from cutting the line again."""
    cut = lines.select("*", F.explode(F.array(_cut(F.col(feed), F.col(text)))).alias("__cut"))
    return cut.select(*(F.col(c) for c in lines.columns if c not in ("cells", "structure")), "__cut.cells", "__cut.structure")


_LINE = ["line_no", "mark"]


def _mark() -> Column:
    return F.xxhash64("feed", "line_text", F.length("line_text")).alias("mark")


def cell_errors(lines: DataFrame) -> DataFrame:
    """(line_no, mark, structure, column_no, column_name, value): each cell that breaks its format, and each line of
    broken structure as one row with the structure alone.

    A line is read and cut once; its cells become rows, which meet the rules."""
    whole = F.struct(F.lit(-1).alias("column_no"), F.lit(None).cast("string").alias("value"))
    cells = F.transform("cut.cells", lambda v, i: F.struct(i.alias("column_no"), v.alias("value")))
    cut = lines.select("line_no", _mark(), "feed", F.explode(F.array(_cut(F.col("feed"), F.col("line_text")))).alias("cut"))
    parts = cut.select(*_LINE, "feed", F.col("cut.structure").alias("structure"), F.explode(F.when(F.col("cut.structure").isNull(), cells).otherwise(F.array(whole))).alias("part"))
    parts = parts.select(*_LINE, "feed", "structure", "part.column_no", "part.value")
    rules = F.broadcast(rule_table(lines.sparkSession))  # its size is that of RULES, whatever the data
    joined = parts.join(rules, (parts["feed"] == rules["rule_feed"]) & (parts["column_no"] == rules["column_no"]), "left")
    bad = F.col("structure").isNotNull() | (F.col("kind").isNotNull() & ~cell_ok(F.col("kind"), F.col("value")))
    return joined.where(bad).select(*_LINE, "structure", parts["column_no"], "column_name", "value")


def failures(lines: DataFrame) -> DataFrame:
    """(line_no, mark, reason, errors): each line that can't be loaded, with the first reason that holds.

    errors: `column=value` of each bad cell in column order, whole values, null for broken structure."""
    pair = F.when(F.col("structure").isNull(), F.struct("column_no", F.concat_ws("=", "column_name", "value").alias("shown")))
    bad = cell_errors(lines).groupBy(*_LINE).agg(F.max("structure").alias("structure"), F.transform(F.array_sort(F.collect_set(pair)), lambda x: x["shown"]).alias("errors"))
    return bad.select(*_LINE, F.coalesce("structure", F.lit("bad_value")).alias("reason"), F.when(F.col("structure").isNull(), F.col("errors")).alias("errors"))


def rejected(lines: DataFrame) -> DataFrame:
    """(line_no, reason)."""
    return failures(lines).select("line_no", "reason")


def sound_rows(lines: DataFrame, feed: str) -> DataFrame:
    """The loadable lines of one feed as typed columns, beside line_no and file_name."""
    own = lines.where(F.col("feed") == feed)
    bad = cell_errors(own).select(*(F.col(c).alias(f"bad_{c}") for c in _LINE)).distinct()
    cut = with_cells(own.select("line_no", "file_name", "feed", "line_text", _mark()))
    ok = cut.join(bad, (F.col("line_no").eqNullSafe(F.col("bad_line_no"))) & (F.col("mark") == F.col("bad_mark")), "left_anti")
    return ok.select("line_no", "file_name", *(typed(F.col("cells")[i], RULES[feed].get(c)).alias(c) for i, c in enumerate(FEED_COLUMNS[feed])))


def typed(value: Column, kind: str | None) -> Column:
    """A sound cell in the type of its kind; blank is null in typed columns, other text stays as it was."""
    text = F.nullif(F.trim(value), F.lit(""))
    if kind == "amount":
        return text.try_cast("decimal(18,2)")
    if kind == "day_mon":
        shape = r"\A([0-9]{2})-([A-Z]{3})-([0-9]{2})\z"
        month = F.array_position(F.array(*map(F.lit, MONTHS)), F.regexp_extract(text, shape, 2))
        iso = F.format_string("20%s-%02d-%s", F.regexp_extract(text, shape, 3), month, F.regexp_extract(text, shape, 1))
        return F.when(text.isNotNull(), iso.try_cast("date"))
    if kind == "mdy":
        return F.try_to_timestamp(text, F.lit("M/d/yyyy")).cast("date")
    if kind in ("four_digits", "two_digits"):
        return text.try_cast("int")
    return value
