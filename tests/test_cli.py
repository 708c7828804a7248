import json

from tallyframe.cli import main


def run(spark, capsys, small, *args):
    code = main(["--data", small, *args], spark, 2026)
    out = capsys.readouterr()
    return code, out.out, out.err


def test_answers(spark, capsys, small):
    code, out, err = run(spark, capsys, small, "--limit", "3", "filings", "2014-2024", "--type", "fd")
    rows = json.loads(out)
    assert code == 0 and 0 < len(rows) <= 3 and all(r["filing_type"]["code"] != "P" for r in rows) and "guarantee: at least these" in err and "residual: " in err
    code, out, err = run(spark, capsys, small, "--table", "trades", "2014-", "--asset", "corp")
    assert code == 0 and out.splitlines()[0].split()[:2] == ["doc_id", "filer_id"] and "at most these" in err
    code, out, _ = run(spark, capsys, small, "--table", "summary", "2020")
    assert code == 0 and len(out.splitlines()) == 2
    assert run(spark, capsys, small, "members", "e")[0] == 0
    code, out, err = run(spark, capsys, small, "--table", "holdings", "2014-", "--asset", "bond")
    assert code == 0 and out.splitlines()[0].split() == ["doc_id", "filer_id", "item", "asset", "owner", "type", "value"] and len(out.splitlines()) > 1
    code, out, err = run(spark, capsys, small, "--table", "inspect", "2014-", "--sample", "0.1")
    assert code == 0 and "open" in out and "unlabelled" in err
    code, out, _ = run(spark, capsys, small, "inspect", "2014-", "--sample", "0.1", "--scorecard")
    assert code == 0 and any(r["overall"] and r["n_reviewed"] == 0 for r in json.loads(out))
    assert run(spark, capsys, small, "check", "2014-")[0] == 0


def row(width, **cells):
    return "|".join(cells.get(f"c{i}", "") for i in range(width))


def test_money_from_raw_files(spark, capsys, small, tmp_path):
    """Bulk files to tables, then who gave to a member and to whom an organisation gave."""
    data, raw = tmp_path / "data", tmp_path / "raw"
    data.mkdir()
    raw.mkdir()
    (data / "legislators_current.parquet").symlink_to(f"{small}/legislators_current.parquet")
    who = spark.read.parquet(f"{small}/legislators_current.parquet").selectExpr("id.bioguide AS b", "explode(id.fec) AS f").where("f LIKE 'H%'").orderBy("b").first()
    (raw / "cm.txt").write_text("\n".join([row(15, c0="C1", c1="Acme PAC", c12="C", c13="Acme"), row(15, c0="C2", c1="Odd PAC", c12="X"), "C3|short"]))
    (raw / "ccl.txt").write_text("\n".join([row(7, c0=who.f, c3="R1", c5="P"), row(7, c0=who.f, c3="R2", c5="A"), "short"]))
    (raw / "itpas2.txt").write_text("\n".join([row(20, c0="C1", c14="500", c15="R1", c17="t1"), row(20, c0="C1", c14="900", c15="R1", c17="t1"), row(20, c0="C1", c14="11000", c15="R1"), row(20, c0="C2", c14="7", c15="R1", c17="t2"), row(20, c0="C9", c14="7", c15="R1", c17="t3"), "C1|short"]))
    (raw / "independent_expenditure_2024.csv").write_text(f"cand_id,can_office,sup_opp,exp_amo,spe_id,tran_id\n{who.f},H,S,5.00,C1,x1\n,H,O,1.00,C1,x2\nS1,S,S,1.00,C1,x3\nH1,H\n")
    code, out, err = run(spark, capsys, str(data), "parse-money", "2024", "--raw", str(raw))
    n = {r["counter"]: r["n"] for r in json.loads(out)}
    assert code == 0 and (n["source_contributions"], n["contributions_kept"], n["contributions_unresolved_committee"], n["contributions_not_connected_ssf"], n["contributions_malformed_short_row"], n["limit_breaches"]) == (6, 2, 1, 1, 1, 1)
    assert (n["expenditures_kept"], n["expenditures_unresolved_candidate"], n["expenditures_not_house_candidate"], n["expenditures_malformed_short_row"], n["source_committees_short"], n["source_links_short"]) == (2, 1, 1, 1, 1, 1)
    code, out, err = run(spark, capsys, str(data), "donors", who.b, "2023-2024")
    assert code == 0 and [(r["organization"], r["n_contributions"]) for r in json.loads(out)] == [("Acme", 2)] and "at least these" in err
    code, out, _ = run(spark, capsys, str(data), "pac", "acme", "2024")
    assert code == 0 and [(r["bioguide_id"], r["n_contributions"]) for r in json.loads(out)] == [(who.b, 2)]
    assert run(spark, capsys, str(data), "donors", who.b, "2010")[0] == 1
    assert run(spark, capsys, str(data), "parse-money", "2022", "--raw", str(raw))[0] == 1


def test_filings_from_raw_files(spark, capsys, small, tmp_path):
    data, raw = tmp_path / "data", tmp_path / "raw"
    data.mkdir()
    raw.mkdir()
    (data / "legislators_current.parquet").symlink_to(f"{small}/legislators_current.parquet")
    member = "<Member><Last>Zz</Last><First>Ann</First><FilingType>{}</FilingType><StateDst>TX05</StateDst><Year>2024</Year><FilingDate>5/1/2025</FilingDate><DocID>{}</DocID></Member>"
    (raw / "index.xml").write_text("<x>" + "".join(member.format(t, i) for t, i in (("P", 1), ("O", 2), ("O", 3), ("Q", 4))) + "</x>")
    spark.createDataFrame([("1", "SP Alpha (ALP) [ST] P 01/02/2020 01/05/2020 $1,001 - $15,000 gfedc\nFILING STATUS: New"), ("2", "no headings in this text at all"), ("4", "a text that is long enough")], "doc_id string, text string").write.parquet(str(raw / "pages.parquet"))
    code, out, err = run(spark, capsys, str(data), "parse-filings", "2024", "--raw", str(raw))
    assert code == 0 and [(r["total"], r["efiled"], r["missing"], r["error"]) for r in json.loads(out)] == [(4, 2, 1, 1)]
    assert sorted((r.doc_id, r.reason) for r in spark.read.parquet(str(data / "unparsed.parquet")).collect()) == [("2", "extract_failed"), ("3", "missing"), ("4", "unknown_type")]
    assert run(spark, capsys, str(data), "parse-filings", "2024", "--raw", str(data))[0] == 1
    assert run(spark, capsys, str(data), "parse-filings", "2024", "--raw", str(raw), "--types", "abc")[0] == 2


def test_committee_seats(spark, capsys, small, tmp_path):
    (tmp_path / "legislators_current.parquet").symlink_to(f"{small}/legislators_current.parquet")
    bio = spark.read.parquet(f"{small}/legislators_current.parquet").selectExpr("id.bioguide AS b").where("b IS NOT NULL").orderBy("b").first().b
    assert run(spark, capsys, str(tmp_path), "members", bio, "--committees")[0] == 1
    (tmp_path / "committee_definitions.json").write_text(json.dumps([{"type": "house", "name": "Rules", "thomas_id": "HSRU", "congresses": [117], "subcommittees": [{"name": "Sub", "thomas_id": "02"}]}]))
    (tmp_path / "committee_membership.json").write_text(json.dumps({"HSRU": [{"bioguide": bio, "rank": 2}], "HSRU02": [{"bioguide": bio, "rank": 1}]}))
    code, out, _ = run(spark, capsys, str(tmp_path), "members", bio, "--committees")
    assert code == 0 and [(r["code"], r["subcommittee"]) for r in json.loads(out)] == [("HSRU", None), ("HSRU02", "Sub")]
    assert json.loads(run(spark, capsys, str(tmp_path), "members", bio, "--committees", "--year", "2015")[1]) == []


def test_exit_codes(spark, capsys, small):
    assert run(spark, capsys, small, "filings", "2008")[0] == 1
    assert run(spark, capsys, small, "filing", "none such")[0] == 1
    assert run(spark, capsys, small, "filings", "1990")[0] == 2
    assert run(spark, capsys, small, "unknown")[0] == 2
    assert main([]) == 2
