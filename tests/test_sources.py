import hashlib
import io
import json
import zipfile
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tallyframe import sinks
from tallyframe import types as kinds
from tallyframe.operators import rowcheck
from tallyframe.sources import files, parameters
from tallyframe.streaming import deliveries

XML = """<FinancialDisclosure>
<Member><Prefix>Hon.</Prefix><Last>O'Neil</Last><First>Ann</First><Suffix/><FilingType>P</FilingType><StateDst>TX05</StateDst><Year>2024</Year><FilingDate>5/1/2025</FilingDate><DocID>0012</DocID></Member>
<Member><Last>Li</Last><First>Bo</First><FilingType>Q</FilingType><StateDst></StateDst><Year>2024</Year><FilingDate></FilingDate><DocID>9001</DocID></Member>
<Member><Last>None</Last><First>X</First><FilingType>O</FilingType><StateDst>CA01</StateDst><Year>2024</Year><FilingDate>1/1/2024</FilingDate></Member>
</FinancialDisclosure>"""


def test_xml_index(spark, tmp_path):
    (tmp_path / "i.xml").write_text(XML)
    entries = files.index_entries(spark, str(tmp_path / "i.xml"))
    rows = {r.doc_id: r for r in files.filings_from_index(entries, 2024, 2026).collect()}
    assert set(rows) == {"0012", "9001"} and rows["0012"].source_pdf == "raw/clerk/2024/ptr/0012.pdf" and tuple(rows["0012"].state_district) == ("TX05", "TX", 5)
    assert rows["9001"].filing_type.label == "unknown" and rows["9001"].filing_date is None and rows["9001"].state_district is None
    assert files.targets(entries).count() == 2 and [r.doc_id for r in files.targets(entries, member="o'neil").collect()] == ["0012"]
    assert [r.doc_id for r in files.targets(entries, spark.createDataFrame([("9001",), ("9001",), ("7",)], "doc_id string")).collect()] == ["9001"]
    assert files.content_hashes(spark, str(tmp_path / "i.xml")).first().sha256 == hashlib.sha256(XML.encode()).hexdigest()


def test_pipe_and_csv(spark, tmp_path):
    (tmp_path / "p.txt").write_bytes("C1|Peña|\r\n\n|short".encode("latin-1"))
    rows = files.pipe_rows(spark, str(tmp_path / "p.txt")).orderBy("row").collect()
    assert [r.cols for r in rows] == [["C1", "Peña", ""], ["", "short"]]
    # Rows keep their order over many tasks, and rarer line ends end a line.
    many = "".join(f"{i}|x\x85{i}b|y\n" if i % 50 == 0 else f"{i}|x\n" for i in range(40_000))
    (tmp_path / "many.txt").write_bytes(many.encode("latin-1"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        rows = files.pipe_rows(spark, str(tmp_path / "many.txt"))
        assert rows.rdd.getNumPartitions() > 2
        found = [r.cols[0] for r in rows.orderBy("row").collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert found == [x for i in range(40_000) for x in ([str(i), f"{i}b"] if i % 50 == 0 else [str(i)])]
    (tmp_path / "c.csv").write_text('a,b,c\n1,"x, ""y""\nz",3\n4,5\n')
    got = files.headed_csv(spark, str(tmp_path / "c.csv"), ["a", "b", "missing"], line_ends_in_cells=True).collect()
    assert [tuple(r) for r in got] == [("1", 'x, "y"\nz', "", False), ("4", "5", "", True)]
    (tmp_path / "d.csv").write_text('a,b,c\n1,"x, y",3\n4,5\n')
    assert [tuple(r) for r in files.headed_csv(spark, str(tmp_path / "d.csv"), ["c", "b"]).collect()] == [("3", "x, y", False), (None, "5", True)]


def test_json_and_bodies(spark, tmp_path):
    (tmp_path / "f.json").write_text(json.dumps([{"doc_id": "1", "year": 2021, "filer": {"first": "A", "last": "B"}}]))
    r = files.json_array(spark, str(tmp_path / "f.json"), kinds.FILINGS).first()
    assert r.doc_id == "1" and r.bioguide_id is None
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "77.json").write_text(json.dumps({"transactions": [{"asset": "x", "amount_range": {"low": 1, "high": 2}}]}))
    b = files.body_files(spark, str(tmp_path / "b"), kinds.PTR_BODY).first()
    assert b.doc_id == "77" and b.body.transactions[0].amount_range.high == 2
    (tmp_path / "m.json").write_text(json.dumps({"HSRU": [{"bioguide": "S1", "rank": 1}]}))
    assert files.membership_map(spark, str(tmp_path / "m.json")).first().membership["HSRU"][0].bioguide == "S1"


def test_pages_and_plans(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "5.pdf").write_bytes(b"a\nb")
    (tmp_path / "d" / "6.pdf").write_bytes(b"\xff\xfe")
    got = {(r.doc_id, r.line_no, r.line, r.problem is not None) for r in files.page_lines(spark, str(tmp_path / "d"), lambda b: b.decode("utf-8").split("\n")).collect()}
    assert got == {("5", 0, "a", False), ("5", 1, "b", False), ("6", None, None, True)}
    want = spark.createDataFrame([("1",), ("2",), ("3",), ("4",), ("5",)], "doc_id string")
    manifest = spark.createDataFrame([("1", "not_found", None), ("2", "ok", 10), ("3", "ok", 10)], "doc_id string, status string, size long")
    disk = spark.createDataFrame([("2", 10), ("3", 9), ("4", 1)], "doc_id string, size long")
    assert {r.doc_id: r.action for r in files.fetch_plan(want, manifest, disk).collect()} == {"1": "not_found", "2": "skipped", "3": "fetch", "4": "backfilled", "5": "fetch"}


def test_parameters():
    assert parameters.years("2019-2021", 2026) == [2019, 2020, 2021] and parameters.years("2025-", 2026) == [2025, 2026] and parameters.cycles([2023, 2024, 2025]) == [2024, 2026]
    for bad in ("2021-2019", "1999", "x", "2030"):
        with pytest.raises(parameters.BadRange):
            parameters.years(bad, 2026)
    assert parameters.families("ptr, FD") == {"ptr", "fd"} and parameters.families("") is None and parameters.bulk_name("master", 2024) == "cm24.zip" and parameters.bulk_name("expenditures", 2024) == "independent_expenditure_2024.csv"
    with pytest.raises(ValueError):
        parameters.families("abc")


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(2023, 1), (2024, 2)], "year int, x int")
    sinks.write_partitions(df, str(tmp_path / "t"), "year")
    sinks.write_partitions(spark.createDataFrame([(2024, 9)], "year int, x int"), str(tmp_path / "t"), "year")
    back = spark.read.parquet(str(tmp_path / "t"))
    assert sorted((r.year, r.x) for r in back.collect()) == [(2023, 1), (2024, 9)]
    rows = [{"x": 1, "year": 2023}, {"x": 2, "year": 2024}]
    assert "".join(sinks.as_json(df.orderBy("x"))) == sinks.canonical(rows) and "".join(sinks.as_json(df.limit(0))) == sinks.canonical([])
    text = "".join(sinks.as_table(spark.createDataFrame([("x", 1.5, None), (None, None, 1234.0)], "a string, bb double, c double")))
    assert text == "a  bb    c\nx  1.50\n         1234.00\n"
    sinks.write_manifest(df, df.limit(1), str(tmp_path / "m"))
    assert spark.read.json(str(tmp_path / "m" / "counts")).count() == 2 and spark.read.json(str(tmp_path / "m" / "residual")).count() == 1
    assert sinks.fingerprint(df) == sinks.fingerprint(df.repartition(3)) != sinks.fingerprint(df.limit(1))
    assert sorted(r.x for r in sinks.upsert(df, spark.createDataFrame([(2023, 7)], "year int, x int"), "year").collect()) == [2, 7]


def test_stream_of_deliveries(spark, tmp_path, monkeypatch):
    """Over six batches, with the state written whole after each second one: each expenditure once."""
    monkeypatch.setattr(deliveries, "WHOLE_EVERY", 2)
    schema = "delivery_no long, received_at timestamp, file_num string, tran_id string, amndt_ind string"
    src = tmp_path / "in"
    rows = [[(1, "A.1"), (2, "A.1"), (3, "A.2")], [(4, "A.2"), (5, "A.3"), (6, ""), (7, "xyz")], [(8, "A.1"), (9, "XYZ ")], [(10, "B.7"), (11, "A.4")], [(12, "A.4"), (13, "abc"), (14, "B.7")], [(15, "xyz"), (16, "A.9000"), (17, "abc")]]
    for batch in rows:
        spark.createDataFrame([(n, None, "7", t, "N") for n, t in batch], schema).coalesce(1).write.mode("append").parquet(str(src))
        q = deliveries.deliver_stream(spark.readStream.schema(schema).parquet(str(src)), str(tmp_path / "out"), str(tmp_path / "state"), str(tmp_path / "check"))
        q.awaitTermination(120)
    assert sorted(r.delivery_no for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [1, 3, 5, 6, 7, 10, 11, 13, 16]
    # A batch writes the blocks it touched alone.
    assert {r.prefix for r in spark.read.parquet(str(tmp_path / "state" / "2" / "ranges")).collect()} == {"A.#0"}


def test_rules_cover_the_columns(spark):
    table = rowcheck.rule_table(spark)
    assert table.count() == sum(map(len, rowcheck.RULES.values())) and table.select(F.max("column_no")).first()[0] == 22


def test_legislators_and_committees(spark, tmp_path):
    one = [{"id": {"bioguide": "A1", "fec": ["H1"]}, "name": {"first": "A", "last": "B"}, "terms": []}]
    (tmp_path / "now.json").write_text(json.dumps(one))
    (tmp_path / "old.json").write_text("no JSON")
    rows, found = files.legislators(spark, *(str(tmp_path / n) for n in ("now.json", "old.json", "none.json")))
    assert found and [(r.id.bioguide, r.part) for r in rows.collect()] == [("A1", 0)]
    rows, found = files.legislators(spark, str(tmp_path / "none.json"))
    assert not found and rows.count() == 0 and "part" in rows.columns
    (tmp_path / "d.json").write_text(json.dumps([{"type": "house", "name": "Rules", "thomas_id": "HSRU"}]))
    with pytest.raises(LookupError):
        files.committees(spark, str(tmp_path / "d.json"), str(tmp_path / "none.json"))


def test_archives_and_versions(spark):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        z.writestr("cm.txt", "C1|x")
    assert files.zip_member(buffer.getvalue(), "cm.txt") == b"C1|x"
    with pytest.raises(LookupError):
        files.zip_member(buffer.getvalue(), "none.txt")
    same, other = files.versioned(spark.createDataFrame([(1,), (2,), (None,)], "schema_version int"), 1)
    assert same.count() == 1 and other.count() == 2


def test_streams_of_filings(spark, tmp_path):
    """Windows of load times, and the first of each key within a watermark."""
    schema = "doc_id string, pdf_class string, loaded_at timestamp"
    rows = [("1", "efiled", datetime(2024, 1, 1, 10)), ("1", "efiled", datetime(2024, 1, 1, 10, 5)), ("2", "scanned", datetime(2024, 1, 1, 12)), ("3", "efiled", datetime(2024, 1, 3))]
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "in"))
    source = lambda: spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    for name, df, mode in (("n", deliveries.windowed_counts(source(), "loaded_at", "1 hour", "1 day"), "complete"), ("f", deliveries.first_within(source(), "doc_id", "loaded_at", "1 hour"), "append")):
        q = df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
        q.awaitTermination(120)
    assert sorted((r.pdf_class, r.n) for r in spark.table("n").collect()) == [("efiled", 1), ("efiled", 2), ("scanned", 1)]
    assert sorted(r.doc_id for r in spark.table("f").collect()) == ["1", "2", "3"]
