"""Readers of raw and stored files. Schemas are always given, never inferred (identifiers have leading zeros)."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Callable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe import types as kinds
from tallyframe.functions import values
from tallyframe.functions.text import contains_ci, strip_unicode
from tallyframe.operators.rowcheck import IE_COLUMNS
from tallyframe.session import ship

# The elements of an index entry.
INDEX_FIELDS = ("Prefix", "Last", "First", "Suffix", "FilingType", "StateDst", "Year", "FilingDate", "DocID")
# The columns of the headed file of independent expenditures.
EXPENDITURE_COLUMNS = IE_COLUMNS
# Line ends as they occur in the bulk files, once decoded.
LINE_ENDS = r"\r\n|[\n\r\u000b\u000c\u001c-\u001e\u0085]"


def index_entries(spark: SparkSession, path: str, row_tag: str = "Member") -> DataFrame:
    """Index entries of XML files as text columns; an absent or empty element is an empty string."""
    schema = T.StructType([T.StructField(n, T.StringType()) for n in INDEX_FIELDS])
    raw = spark.read.schema(schema).option("rowTag", row_tag).xml(path)
    return raw.select(*(F.coalesce(strip_unicode(F.col(n)), F.lit("")).alias(n) for n in INDEX_FIELDS))


def filings_from_index(entries: DataFrame, year: int, latest_year: int) -> DataFrame:
    """FILINGS columns of index entries that have a DocID (identity and classes are added later)."""
    code = F.col("FilingType")
    none = F.lit(None).cast("string")
    named = entries.where("DocID <> ''")
    filer = F.struct(F.nullif("Prefix", F.lit("")).alias("prefix"), F.col("First").alias("first"), F.col("Last").alias("last"), F.nullif("Suffix", F.lit("")).alias("suffix"))
    folder = F.when(values.family(code) == "ptr", "ptr").otherwise("fd")
    return named.select(
        F.col("DocID").alias("doc_id"), F.lit(year).alias("year"), filer.alias("filer"), none.alias("filer_id"), none.alias("bioguide_id"),
        values.state_district(F.col("StateDst")).alias("state_district"), F.struct(code.alias("code"), values.filing_label(code).alias("label")).alias("filing_type"),
        values.mdy_date(F.col("FilingDate"), latest_year).alias("filing_date"), F.format_string("raw/clerk/%d/%s/%s.pdf", F.lit(year), folder, F.col("DocID")).alias("source_pdf"),
        none.alias("pdf_class"), none.alias("parse_status"),
    )


def targets(entries: DataFrame, doc_ids: DataFrame | None = None, member: str | None = None) -> DataFrame:
    """(doc_id, code, year) of the documents to fetch: all, those listed (doc_id), or those of filers whose name holds a text."""
    wanted = entries.where("DocID <> ''")
    if member:
        wanted = wanted.where(contains_ci(F.concat_ws(" ", "Prefix", "First", "Last", "Suffix"), member))
    out = wanted.select(F.col("DocID").alias("doc_id"), F.col("FilingType").alias("code"), F.expr("try_cast(Year AS INT)").alias("year"))
    return out if doc_ids is None else out.join(doc_ids.select("doc_id").distinct(), "doc_id", "left_semi")


def content_hashes(spark: SparkSession, path: str) -> DataFrame:
    """(path, size, sha256) of files, for the record of what was fetched."""
    return spark.read.format("binaryFile").load(path).select("path", F.col("length").alias("size"), F.sha2("content", 256).alias("sha256"))


def pipe_rows(spark: SparkSession, path: str) -> DataFrame:
    """(cols, row) of Latin-1 files with `|` between fields, without header or quoting; blank lines are skipped.

    A large file is read by many tasks. `row` orders the rows of one file as they stand in it: the place of the part that a
    task reads, the line within what the task reads, and the piece of a line with rarer line ends."""
    raw = spark.read.text(path).select("value", F.col("_metadata.file_block_start").alias("start"))
    line = F.decode(F.col("value").cast("binary"), "ISO-8859-1")  # the text source keeps the bytes as they are
    within = F.monotonically_increasing_id().bitwiseAND(F.lit(2**30 - 1))
    parts = raw.select("start", within.alias("within"), F.posexplode(F.split(line, LINE_ENDS)).alias("piece", "line")).where("trim(line) <> ''")
    row = F.shiftleft(F.shiftright("start", 16), 36) + F.shiftleft("within", 6) + F.least("piece", F.lit(63))
    return parts.select(F.split("line", r"\|", -1).alias("cols"), row.cast("long").alias("row"))


def headed_csv(spark: SparkSession, path: str, columns: list[str], line_ends_in_cells: bool = False) -> DataFrame:
    """Text columns of CSV files by header name, quoted commas included; missing columns are empty, rows with too few cells
    have `short` set. Large files are read by many tasks, unless cells may hold line ends."""
    reader = lambda: spark.read.option("header", True).option("multiLine", line_ends_in_cells).option("escape", '"')
    header = reader().csv(path).columns
    schema = T.StructType([*(T.StructField(c, T.StringType()) for c in header), T.StructField("_corrupt", T.StringType())])
    # Without pruning, as a parser that reads some cells only can't tell that others are missing.
    raw = reader().schema(schema).option("columnPruning", False).option("columnNameOfCorruptRecord", "_corrupt").csv(path)
    last = F.col(header[-1])
    short = F.col("_corrupt").isNotNull() & last.isNull()
    return raw.select(*(F.col(c) if c in header else F.lit("").alias(c) for c in columns), short.alias("short"))


def json_array(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """Records of files that hold one JSON array each; absent fields are null."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def body_files(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """(doc_id, body) of one JSON file per document, in one scan; the file's stem is the document."""
    raw = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file"), "value")
    return raw.select(F.regexp_replace("file", r"\.json$", "").alias("doc_id"), F.from_json("value", schema).alias("body"))


def legislators(spark: SparkSession, *paths: str) -> tuple[DataFrame, bool]:
    """(current and historical legislators as one table, whether any file was found).

    `part` keeps the order of the files. A file that is absent or no JSON is skipped."""
    parts = []
    for i, path in enumerate(paths):
        try:
            one = json_array(spark, path, kinds.LEGISLATORS).where("id.bioguide IS NOT NULL").withColumn("part", F.lit(i))
            if not one.isEmpty():
                parts.append(one)
        except AnalysisException:
            continue
    if not parts:
        return spark.createDataFrame([], T.StructType([*kinds.LEGISLATORS, T.StructField("part", T.IntegerType())])), False
    return reduce(DataFrame.unionByName, parts), True


def committees(spark: SparkSession, definitions: str, membership: str) -> tuple[DataFrame, DataFrame]:
    """(definitions, membership): one is of no use without the other, so both must be there."""
    found = []
    for path, read in ((definitions, lambda p: json_array(spark, p, kinds.COMMITTEE_DEFINITIONS)), (membership, lambda p: membership_map(spark, p))):
        try:
            found.append(read(path))
        except AnalysisException:
            raise LookupError(f"no committees without {path}") from None
    return found[0], found[1]


def membership_map(spark: SparkSession, path: str) -> DataFrame:
    """(membership) of a file with a JSON map from committee codes to members."""
    return spark.read.text(path, wholetext=True).select(F.from_json("value", kinds.MEMBERSHIP).alias("membership"))


def versioned(df: DataFrame, version: int, column: str = "schema_version") -> tuple[DataFrame, DataFrame]:
    """(rows of this version, rows of another): stored forms aren't migrated."""
    same = F.coalesce(F.col(column) == version, F.lit(False))
    return df.where(same), df.where(~same)


def page_lines(spark: SparkSession, path: str, decode: Callable[[bytes], list[str]]) -> DataFrame:
    """(doc_id, line_no, line, problem) of documents, by a decoder from bytes to text lines.

    No PDF library is needed here: the decoder is the caller's. What it raises is kept as `problem`."""
    ship(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for name, content in zip(*(c.to_pylist() for c in batch.columns)):
                doc = name.rsplit("/", 1)[-1].rsplit(".", 1)[0]
                try:
                    rows += [(doc, i, line, None) for i, line in enumerate(decode(content))]
                except Exception as e:  # noqa: BLE001 - any failure of a decoder concerns this document alone
                    rows.append((doc, None, None, str(e) or type(e).__name__))
            if rows:
                columns = list(zip(*rows))
                yield pa.RecordBatch.from_arrays([pa.array(columns[0]), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.string()), pa.array(columns[3], pa.string())], names=["doc_id", "line_no", "line", "problem"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, "doc_id string, line_no int, line string, problem string")


def zip_member(content: bytes, name: str) -> bytes:
    """One member of an archive; an error names it if it is missing."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        if name not in z.namelist():
            raise LookupError(f"the archive holds no {name}")
        return z.read(name)


def fetch_plan(wanted: DataFrame, manifest: DataFrame, listing: DataFrame) -> DataFrame:
    """(doc_id, action): recorded as not found: `not_found`; on disk in the recorded size: `skipped`; on disk and not
    recorded: `backfilled`; else `fetch`. manifest: doc_id, status, size; listing: doc_id, size."""
    m = manifest.select("doc_id", F.col("status").alias("m_status"), F.col("size").alias("m_size"))
    on_disk = listing.select("doc_id", F.col("size").alias("d_size"))
    joined = wanted.join(m, "doc_id", "left").join(on_disk, "doc_id", "left")
    action = F.when(F.col("m_status") == "not_found", "not_found").when(F.col("d_size") == F.col("m_size"), "skipped").when(F.col("d_size").isNotNull() & F.col("m_status").isNull(), "backfilled").otherwise("fetch")
    return joined.select("doc_id", action.alias("action"))
