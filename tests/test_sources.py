"""Readers on small files in the shapes that are published."""

import gzip
import json

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import store
from ledgerloom.sources import charges, columns, cost_files, roster, texts
from ledgerloom.streaming import arrivals

META = "hospital_name,last_updated_on,version,location_name,hospital_address,type_2_npi,license_number|KS,setting\n"
VALUES = 'Alpha Hospital,2024-07-01,2.0,Alpha,"1 Main, Town, KS 66000",1234567890|1987654321,"""77|MO""",BOTH\n'
TALL = "description,code|1,code|1|type,code|2,code|2|type,standard_charge|gross,payer_name,plan_name,standard_charge|negotiated_dollar,count\n"


def found(spark, path):
    lines = charges.read_lines(spark, str(path))
    heads = charges.headers(lines)
    return charges.charges(lines, heads), charges.metadata(heads), heads


def test_delimited_files(spark, tmp_path):
    (tmp_path / "386006309_tall.csv").write_text(META + VALUES + "\n" + TALL + 'MRI,70551,CPT,0610,RC,"$1,200.00",Aetna,PPO,900,3.9\n"CT, head",,,,,100,N/A,,,\n,,,,,5,,,,\n')
    (tmp_path / "1669348991_tab.csv").write_text((TALL + "MRI,70551,CPT,,,10,Cigna,HMO,7,\n").replace(",", "\t"))
    (tmp_path / "wide.csv").write_text(META + VALUES + "description,code|1,standard_charge|gross,standard_charge|Acme|PPO|negotiated_dollar,standard_charge|Acme|PPO|methodology,median_amount|Acme|PPO,standard_charge|Best|HMO|negotiated_percentage,additional_generic_notes\nA,1,10,5,fee,4,50,n\nB,2,20,,,,,n\nC,3,30,NA,,,25,\n")
    (tmp_path / "ray.csv").write_text("CDM Item Number,Service Description,Gross Charge,Payer Negotiated Charge: Aetna (Plan: Gold)\n9,X-ray,40,30\n")
    (tmp_path / "other.csv").write_text("Some Vendor\nItem,Gross Charge\n1,2\n")
    with gzip.open(tmp_path / "zipped.csv.gz", "wt") as f:
        f.write(TALL + "Gz,1,CPT,,,1,P,Q,2,\n")
    (tmp_path / "latin.csv").write_bytes((TALL + "Café ’s,1,CPT,,,1,P,Q,2,\n").encode("cp1252"))
    rows, meta, heads = found(spark, tmp_path)
    got = {}
    for r in rows.collect():
        got.setdefault(r.source_file, []).append(r)
    assert {k: len(v) for k, v in got.items()} == {"386006309_tall.csv": 2, "1669348991_tab.csv": 1, "wide.csv": 4, "ray.csv": 1, "zipped.csv.gz": 1, "latin.csv": 1}
    mri = next(r for r in got["386006309_tall.csv"] if r.code == "70551")
    assert (mri.description, mri.code_type, mri.additional_codes, float(mri.gross_charge), float(mri.negotiated_dollar), mri["count"]) == ("MRI", "CPT", "RC:0610", 1200.0, 900.0, 3)
    ct = next(r for r in got["386006309_tall.csv"] if r.code is None)
    assert (ct.description, ct.payer_name) == ("CT, head", None)
    wide = sorted((r.description, r.payer_name, r.plan_name, r.additional_notes) for r in got["wide.csv"] if r.payer_name)
    assert wide == [("A", "Acme", "PPO", "n"), ("A", "Best", "HMO", "n"), ("C", "Best", "HMO", None)]
    assert [r.description for r in got["wide.csv"] if r.payer_name is None] == ["B"]
    assert (got["ray.csv"][0].payer_name, got["ray.csv"][0].plan_name, float(got["ray.csv"][0].negotiated_dollar)) == ("Aetna", "Gold", 30.0)
    assert got["latin.csv"][0].description == "Café ’s"
    m = {r.source_file: r for r in meta.collect()}
    assert "other.csv" not in m
    a = m["386006309_tall.csv"]
    assert (a.hospital_name, a.ein, a.primary_npi, a.npis, a.license_number, a.license_state, a.layout) == ("Alpha Hospital", "386006309", "1234567890", ["1234567890", "1987654321"], "77", "KS", "tall")
    assert m["1669348991_tab.csv"].primary_npi == "1669348991" and m["1669348991_tab.csv"].hospital_name is None and m["wide.csv"].layout == "wide"
    limited = charges.charges(charges.read_lines(spark, str(tmp_path)), heads, limit=1).groupBy("source_file").count()
    assert {r[0]: r[1] for r in limited.collect()}["wide.csv"] == 2  # one item, two payers
    ledger = store.outcomes(charges.listing(spark, str(tmp_path)).select("source_file"), heads, rows, spark.createDataFrame([("ray.csv", 1)], "source_file string, charge_count int"))
    status = {r.source_file: r.status for r in ledger.collect()}
    assert status["other.csv"] == "failed" and status["ray.csv"] == "skipped" and status["wide.csv"] == "loaded"


def test_profile_of_a_very_large_file(spark, tmp_path):
    (tmp_path / "small.csv").write_text("a;b\n1;2\n")
    with open(tmp_path / "large.csv", "wb") as f:
        f.write(b"a\tb\tc\n" + b"1\t2\t3\n" * 200_000)
        f.truncate(3_000_000_001)  # a hole, which takes no disk
    with gzip.open(tmp_path / "zipped.csv.gz", "wt") as f:
        f.write("a|b|c|d\n" * 100_000)
    got = {r.path.rsplit("/", 1)[1]: (r.encoding, r.delimiter, r.columns) for r in charges.profiles(spark, str(tmp_path)).collect()}
    (tmp_path / "large.csv").unlink()
    assert got == {"small.csv": ("UTF-8", ";", 2), "large.csv": ("UTF-8", "\t", 3), "zipped.csv.gz": ("UTF-8", "|", 4)}


def test_rows_wider_than_the_head(spark, tmp_path, monkeypatch):
    """The header lies below the head that is looked at, and is wider than it; 40 codes."""
    monkeypatch.setattr(charges, "HEAD_BYTES", 64)
    codes = [f"code|{k}" for k in range(1, 41)]
    header = ["description", *[x for c in codes for x in (c, f"{c}|type")], "standard_charge|gross"]
    row = ['"MRI, ""open"" and\nlong"', *[x for k in range(1, 41) for x in (f"c{k}", "T")], "7"]
    for name, sep in (("comma.csv", ","), ("tab.csv", "\t"), ("semicolon.csv", ";")):
        lines = [sep.join(x) for x in (["a", "note that is long enough to fill the head of this file", ""], header, row, ["CT", "1", "", "", "2", "T"])]
        (tmp_path / name).write_text("\n".join(lines) + "\n")
    lines = charges.read_lines(spark, str(tmp_path))
    found = charges.charges(lines, charges.headers(lines)).collect()
    assert len(found) == 6
    for r in found:
        if r.code == "c1":
            assert r.description == 'MRI, "open" and long' and float(r.gross_charge) == 7
            assert r.additional_codes == ";".join(f"T:c{k}" for k in range(2, 41))
        else:
            assert (r.description, r.code, r.gross_charge) == ("CT", "1", None)


def test_vendor_names_as_an_argument(spark):
    rows = [("v", 0, ["Artikel", "Preis"]), ("v", 1, ["MRI", "7"])]
    lines = spark.createDataFrame(rows, "source_file string, line long, row array<string>")
    assert charges.headers(lines).count() == 0
    own = charges.ALIASES | {"artikel": "description", "preis": "standard_charge|gross"}
    found = charges.charges(lines, charges.headers(lines, own)).collect()
    assert [(r.description, float(r.gross_charge)) for r in found] == [("MRI", 7.0)]


def test_header_after_a_preamble(spark):
    rows = [("eight", k, ["text", str(k)]) for k in range(8)] + [("nine", k, ["text", str(k)]) for k in range(9)]
    rows += [("none", 0, ["", " "]), ("none", 1, ["a", "b"])]
    for name in ("eight", "nine"):
        rows += [(name, 20, ["", "\u00a0"]), (name, 21, ["Description", "code|1"]), (name, 22, ["description", "code|1"])]
    heads = charges.headers(spark.createDataFrame(rows, "source_file string, line long, row array<string>")).collect()
    assert [(h.source_file, h.header_line, h.meta_header, h.meta_values) for h in heads] == [("eight", 21, ["text", "6"], ["text", "7"])]


def test_encodings():
    assert charges.detect_encoding("h".encode("utf-16")) == "UTF-16"
    assert charges.detect_encoding("hello there".encode("utf-16-le")) == "UTF-16LE"
    assert charges.detect_encoding("é".encode()[:1]) == "UTF-8"  # a split character at the end
    assert charges.detect_encoding(b"caf\xe9 and more") == "windows-1252"
    assert [charges.detect_delimiter(x) for x in ("a,b", "a\tb\tc,d", "a;b", "a|b,c", "")] == [",", "\t", ";", ",", ","]


def test_json_files(spark, tmp_path):
    item = {"description": "MRI", "code_information": [{"code": "1", "type": "CPT"}, {"code": "2", "type": "RC"}], "standard_charges": [{"gross_charge": 10.5, "modifiers": ["x", "y"], "payers_information": [{"payer_name": "N/A", "standard_charge_dollar": 7}, {"payer_name": "B"}]}, {"gross_charge": 3}]}
    doc = {"hospital_name": "H", "hospital_address": ["a", "b"], "license_information": {"license_number": "9", "state": "ks"}, "standard_charge_information": [item, {"description": "no charges"}]}
    (tmp_path / "386006309_a.json").write_text("﻿" + json.dumps(doc))
    (tmp_path / "b.json").write_text('{"unrelated": 1}')
    raw = charges.read_json(spark, str(tmp_path))
    rows = charges.json_charges(raw).collect()
    assert sorted((r.payer_name or "", str(r.negotiated_dollar)) for r in rows) == [("", "None"), ("B", "None"), ("N/A", "7.00")]
    assert rows[0].additional_codes == "RC:2" and {r.modifiers for r in rows} == {"x;y", None}
    meta = charges.json_metadata(raw).collect()
    assert [(m.ein, m.hospital_address, m.license_state) for m in meta] == [("386006309", "a; b", "KS")]


def test_amounts_of_json_files(spark, tmp_path):
    """Amounts are read as they stand, as numbers or strings, without a seek for each."""
    given = ["10.50", "123456789012.345", "0.12499999999999999999", "1.5e3", "-2", '"$1,200.00"', '" 7 "', '"n/a"', '""', "null", "true", '{"a": 1}', "[3]", "1e40", "12345678901234567890123456789012345678901234"]
    items = ", ".join(f'{{"code_information": [{{"code": "{k:02d}"}}], "standard_charges": [{{"gross_charge": {x}, "payers_information": [{{"standard_charge_percentage": {x}}}]}}]}}' for k, x in enumerate(given))
    (tmp_path / "a.json").write_text(f'{{"hospital_name": "H", "standard_charge_information": [{items}]}}')
    raw = charges.read_json(spark, str(tmp_path))
    assert "gross_charge:variant" in raw.schema.simpleString() and "standard_charge_percentage:variant" in raw.schema.simpleString()
    rows = sorted(charges.json_charges(raw).collect(), key=lambda r: r.code)
    assert [str(r.gross_charge) for r in rows] == ["10.50", "123456789012.35", "0.12", "1500.00", "-2.00", "1200.00", "7.00", *["None"] * 8]
    assert [str(r.negotiated_percentage) for r in rows[:4]] == ["10.5000", "None", "0.1250", "1500.0000"]


def test_roster(spark, tmp_path):
    (tmp_path / "pos.csv").write_text("﻿prvdr_num,PRVDR_CTGRY_CD,FAC_NAME,STATE_CD,PGM_TRMNTN_CD,ZIP_CD\n170001,01,A,KS,00,67214-1234\n170002,01,B,,08,1\n170003,03,C,KS,00,\n210001,01,D,MD,00,\n,01,E,KS,00,\n")
    raw = roster.read_roster(spark, str(tmp_path / "pos.csv"))
    assert sorted(r.ccn for r in roster.ingest(raw, "KS").collect()) == ["170001"]
    both = {r.ccn: r.state for r in roster.ingest(raw, "Kansas", active_only=False).collect()}
    assert both == {"170001": "KS", "170002": "KS"}
    assert tuple(roster.load_statistics(raw, "KS").first()) == (5, 3, 2, 1)
    twice = spark.createDataFrame([("170001", "01", "Z", "00"), ("170001", "01", "A", "00"), ("170001", "03", "B", "00")], "PRVDR_NUM string, PRVDR_CTGRY_CD string, FAC_NAME string, PGM_TRMNTN_CD string").coalesce(1)
    assert [(r.ccn, r.name) for r in roster.ingest(twice).collect()] == [("170001", "A")]
    with pytest.raises(ValueError, match="columns"):
        columns.pick(raw, ["nothing"])
    with pytest.raises(ValueError, match="empty"):
        roster.known_only(raw, raw.where("false"))


def test_small_sources(spark, tmp_path):
    (tmp_path / "w.json").write_text(json.dumps({"hospitals": {"170001": {"web": "https://a.org"}, "2": {"website": "b.org"}}}))
    assert sorted(map(tuple, roster.websites(spark, str(tmp_path / "w.json")).collect())) == [("000002", "b.org"), ("170001", "https://a.org")]
    (tmp_path / "d.txt").write_text("one\ntwo")
    assert [tuple(r) for r in texts.read_documents(spark, str(tmp_path)).collect()] == [("d.txt", "one\ntwo")]
    x = spark.createDataFrame([("1", "170001", "a"), ("1", "170002", "b"), ("", "3", "c")], "NPI string, CCN string, Name string")
    assert [(r.npi, r.ccn, r.ccns) for r in roster.crosswalk(x.coalesce(1), "feed").collect()] == [("1", "170001", 2)]


def test_cost_files(spark, tmp_path):
    names = [str(tmp_path / f"HOSP10_2023_{n}.CSV") for n in ("RPT", "NMRC", "ALPHA")]
    for name, body in zip(names, ("7,1,170001,x,4,01/01/2023,12/31/2023,06/01/2024\n8,1\nbad\n", "7,G300000,00300,00100,1000.5\n7,G300000,00300,00100,\n9,S3,1,1\nx,G,1,1,1\n", "7,S200001,00100,00100,Name\n7,S2,1,1,N/A\n"), strict=True):
        with open(name, "w") as f:
            f.write(body)
    v = cost_files.read_vintage(spark, names, 2023)
    r = {x.rpt_rec_num: x for x in v["reports"].collect()}
    assert set(r) == {7, 8} and r[7].ccn == "170001" and str(r[7].fy_end) == "2023-12-31" and r[8].ccn is None
    assert [(x.rpt_rec_num, float(x.value)) for x in v["numeric"].collect()] == [(7, 1000.5)]
    assert [x.value for x in v["alpha"].collect()] == ["Name"]
    with pytest.raises(ValueError, match="numeric"):
        cost_files.member_roles(names[:1])


def test_store(spark, tmp_path):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    assert sorted(map(tuple, store.upsert(old, spark.createDataFrame([(2, "z"), (2, "c"), (3, "d")], "k int, v string").coalesce(1), ["k"]).collect())) == [(1, "a"), (2, "c"), (3, "d")]
    path = str(tmp_path / "t")
    assert store.read_current(spark, path, "k int, v string").count() == 0
    store.write_version(old, path)
    store.write_version(old.limit(1), path)
    assert store.read_current(spark, path, "k int, v string").count() == 1
    store.write_sheet(old.withColumn("n", F.lit(None).cast("string")), str(tmp_path / "s"))
    sheet = store.read_sheet(spark, str(tmp_path / "s"))
    assert sheet.columns == ["k", "v", "n"] and sheet.count() == 2
    run = store.run_record(spark, "pos", "failed", 1, 0, __import__("datetime").datetime(2024, 1, 1), "m" * 600).first()
    assert run.status == "failed" and len(run.message) == 512
    s = spark.createDataFrame([("386006309_a.csv", "1", None, None, 5), ("1669348991_b.csv", None, None, None, 5)], "source_file string, ein string, primary_npi string, npis array<string>, charge_count long")
    fixed = {r.source_file: (r.ein, r.primary_npi) for r in store.repaired(s).collect()}
    assert fixed == {"386006309_a.csv": ("386006309", None), "1669348991_b.csv": (None, "1669348991")}
    assert {r.source_file: (r.ein, r.primary_npi) for r in store.with_file_npis(s).collect()} == {"386006309_a.csv": ("1", None), "1669348991_b.csv": (None, "1669348991")}


def test_arrivals(spark, tmp_path):
    landing, target, mark = (str(tmp_path / x) for x in ("in", "out", "mark"))
    rows = lambda *xs: spark.createDataFrame(list(xs), "source_file string, x int").coalesce(1)
    rows(("a", 1), ("b", 1)).write.parquet(f"{landing}/1")
    arrivals.ingest_available(arrivals.arrivals(spark, landing, "source_file string, x int"), target, mark)
    rows(("a", 2), ("a", 3)).write.parquet(f"{landing}/2")
    arrivals.ingest_available(arrivals.arrivals(spark, landing, "source_file string, x int"), target, mark)
    got = sorted((r.source_file, r.x) for r in spark.read.parquet(target).collect())
    assert got == [("a", 2), ("a", 3), ("b", 1)]
