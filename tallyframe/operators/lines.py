"""Text lines: splitting, headings filled forward (a window within a document), classes and guards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyframe.functions.values import visible_chars

EFILED_CHARS = 20


def split_lines(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, line_no from 0, line) of each text; null texts have no lines."""
    return docs.where(F.col(text).isNotNull()).select(key, F.posexplode(F.split(text, r"\r\n|[\n\r]")).alias("line_no", "line"))


def in_order(key: str = "doc_id"):
    return Window.partitionBy(key).orderBy("line_no")


def so_far(key: str = "doc_id"):
    return in_order(key).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def segments(lines: DataFrame, heading: Column, key: str = "doc_id") -> DataFrame:
    """Adds `segment`: the last heading (a label or null for each line) at or before a line."""
    return lines.withColumn("heading", heading).withColumn("segment", F.last("heading", ignorenulls=True).over(so_far(key)))


def text_class(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, chars, pdf_class): `efiled` from EFILED_CHARS visible characters on, `scanned` below, `missing` without text."""
    chars = visible_chars(F.col(text))
    return docs.select(key, chars.alias("chars"), F.when(F.col(text).isNull(), "missing").when(chars >= EFILED_CHARS, "efiled").otherwise("scanned").alias("pdf_class"))


def count_visible(text: str) -> int:
    """Characters other than white space, of one text."""
    return sum(map(len, text.split()))


def has_collapsed(items: int, tags: int) -> bool:
    """Too few items for the type tags seen: one for three or more, or no more than half of four or more."""
    return (items == 1 and tags >= 3) or (items * 2 <= tags and tags >= 4)
