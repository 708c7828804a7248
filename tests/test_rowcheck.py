from tallyframe.operators import rowcheck as R

GOOD = 'H9TX84257,"LUILDYSUND, ROSARIO",C97800332,Two Rivers,G,TX,02,H,PARTY,422.04,25-OCT-24,3483.24,S,"5"" banner, big",Group,9000004,A,IE-SUP-0200,2024,02-NOV-24,2024,,'
FD = "Hon.\tSmith\tAnn\tJr.\tP\tTX05\t2024\t2/29/2024\t10001"
SCHEMA = "line_no long, file_name string, feed string, line_text string, cells string, mark string, structure string"


def lines(spark, rows):
    return spark.createDataFrame([(n, "f", feed, text, "clash", "clash", "clash") for n, feed, text in rows], SCHEMA)


def swap(i, value, line=GOOD):
    cells = ["H9TX84257", '"LUILDYSUND, ROSARIO"', *line.split('ROSARIO",')[1].split(",")]
    del cells
    parts, out = line.split(","), None
    del parts, out
    from csv import reader, writer
    from io import StringIO

    row = next(reader([line]))
    row[i] = value
    s = StringIO()
    writer(s, lineterminator="").writerow(row)
    return s.getvalue()


def test_reasons_in_order(spark):
    rows = [
        (1, "ie_csv", GOOD),
        (2, "ie_csv", GOOD + '"'),
        (3, "ie_csv", GOOD.replace('ROSARIO"', 'ROSARIO" est.')),
        (4, "ie_csv", GOOD.replace("Two Rivers", 'Two "Rivers"')),
        (5, "ie_csv", GOOD + ","),
        (6, "ie_csv", "---- end of page ----"),
        (7, "ie_csv", ""),
        (8, "ie_csv", None),
        (9, "ie_csv", swap(9, "1,200")),
        (10, "ie_csv", swap(10, "29-FEB-23")),
        (11, "ie_csv", swap(10, "29-FEB-24")),
        (12, "ie_csv", swap(17, "")),
        (13, "ie_csv", swap(9, "-48")),
        (14, "ie_csv", swap(9, "48.123")),
        (15, "ie_csv", swap(16, "A12")),
        (16, "ie_csv", swap(0, "")),
        (17, "fd_index", FD),
        (18, "fd_index", FD.replace("2/29/2024", "2/29/2023")),
        (19, "fd_index", FD.replace("TX05", "")),
        (20, "fd_index", FD + "\t"),
        (21, "fd_index", FD.replace("Ann", '"Ann')),
        (22, "other", "x"),
        (23, None, None),
    ]
    got = {r.line_no: r.reason for r in R.rejected(lines(spark, rows)).collect()}
    assert got == {
        2: "quoting", 3: "quoting", 4: "quoting", 5: "column_count", 6: "column_count", 7: "column_count", 8: "column_count", 9: "bad_value", 10: "bad_value",
        12: "bad_value", 14: "bad_value", 15: "bad_value", 18: "bad_value", 20: "column_count", 22: "unknown_feed", 23: "unknown_feed",
    }


def test_typed_rows_and_errors(spark):
    table = lines(spark, [(1, "ie_csv", GOOD), (1, "ie_csv", GOOD), (2, "ie_csv", swap(9, "x")), (3, "fd_index", FD)])
    ok = R.sound_rows(table, "ie_csv").collect()
    assert len(ok) == 2 and str(ok[0].exp_amo) == "422.04" and str(ok[0].exp_date) == "2024-10-25" and ok[0].pur == '5" banner, big' and ok[0].dissem_dt is None
    fd = R.sound_rows(table, "fd_index").collect()[0]
    assert (fd.last, fd.year, str(fd.filing_date), fd.doc_id) == ("Smith", 2024, "2024-02-29", "10001")
    bad = [r for r in R.failures(table).collect() if r.line_no == 2]
    assert bad[0].errors == ["exp_amo=x"]


def test_very_long_lines_and_empty_tables(spark):
    long_cell = GOOD.replace("Two Rivers", '"' + 'a""' * 200_000 + '"')
    many = "," * 200_000
    got = {r.line_no: r.reason for r in R.rejected(lines(spark, [(1, "ie_csv", long_cell), (2, "ie_csv", many), (3, "ie_csv", '"' * 100_001)])).collect()}
    assert got == {2: "column_count", 3: "quoting"}
    assert R.rejected(lines(spark, [])).count() == 0 and R.sound_rows(lines(spark, []), "ie_csv").count() == 0
