"""Counted loads, repairs of facts, and arrivals of real files with retry."""

import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import text as T
from ledgerloom.operators import loads, store
from ledgerloom.plans.files import QUERIES, SQL
from ledgerloom.streaming import arrivals

from .conftest import DATA, rows_of
from .test_batch import HEAD, put


def test_roster_counts(spark, tmp_path):
    rows = [("170001", "01", "A", "KS", "00", 1), ("170001", "01", "B", "KS", "00", 2), ("170002", "01", "C", "KS", "08", 3), ("290001", "01", "D", "MO", "00", 4), (None, "01", "E", "KS", "00", 5), ("170003", "03", "F", "KS", "00", 6), (None, None, None, None, None, 7)]
    raw = spark.createDataFrame(rows, "PRVDR_NUM string, PRVDR_CTGRY_CD string, FAC_NAME string, STATE_CD string, PGM_TRMNTN_CD string, kind int")
    found = loads.load_roster(raw, f"{tmp_path}/a", "KS", order=F.col("kind"))
    assert found == {"read": 7, "matched": 4, "active": 3, "without_ccn": 1, "loaded": 1}
    assert [(r.ccn, r.name) for r in spark.read.parquet(f"{tmp_path}/a").collect()] == [("170001", "B")]
    assert loads.load_roster(raw, f"{tmp_path}/b", "ALL", False)["loaded"] == 3
    assert set(loads.load_roster(raw.limit(0), f"{tmp_path}/c").values()) == {0}


def test_service_area_counts(spark, tmp_path):
    rows = [("170001", "66044", "12", 1), ("170001", "66044", "99", 2), ("170001", "66045", "*", 3), ("999999", "66044", "5", 4), ("999999", "66045", "5", 5), ("?", "66044", "5", 6), (None, None, None, 7)]
    raw = spark.createDataFrame(rows, "CCN string, ZIP string, CASES string, n int")
    known = spark.createDataFrame([("170001", "x")], "ccn string, zip5 string")
    found = loads.load_service_area(raw, known, f"{tmp_path}/a", "2024", "feed", F.col("n"))
    assert found == {"read": 7, "unusable": 2, "unknown": 2, "unknown_ccns": 1, "repeated": 1, "suppressed": 1, "loaded": 2}
    assert {(r.zip5, r.cases) for r in spark.read.parquet(f"{tmp_path}/a").collect()} == {("66044", 12), ("66045", None)}
    assert loads.load_service_area(raw, None, f"{tmp_path}/b", "2024", "feed", F.col("n"))["loaded"] == 4
    with pytest.raises(ValueError, match="roster is empty"):
        loads.load_service_area(raw, known.limit(0), f"{tmp_path}/c", "2024", "feed")


@pytest.mark.parametrize("sep", [",", "|", "\t"])
def test_cost_report_counts(spark, tmp_path, sep):
    text = {"RPT": "7,1,170001,x,2\n7,1,170001,x,3\n8,1,170002,x,2\nbad\n", "NMRC": "7,G3,00100,00100,1.5\n9,G3,00100,00100,2\n8,G3,00200,00100,x\nshort,1\n", "ALPHA": "8,S2,00100,00100,text\n9,S2,00100,00100,t\n"}
    for role, body in text.items():
        (tmp_path / f"HOSP_{role}.CSV").write_text(body.replace(",", sep))
    found = loads.load_cost_reports(spark, [f"file://{tmp_path}/HOSP_{r}.CSV" for r in text], 2024, f"{tmp_path}/out")
    assert found == {"reports": 3, "repeated_reports": 1, "numeric": 1, "orphan_numeric": 1, "alpha": 1, "orphan_alpha": 1}
    assert {r.ccn for r in spark.read.parquet(f"{tmp_path}/out/reports").collect()} == {"170001", "170002"}


def test_counts_take_one_scan(spark, tmp_path, monkeypatch):
    """The source is read once: an accumulator counts the rows that pass."""
    seen = spark.sparkContext.accumulator(0)

    def passed(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    raw = spark.range(100).selectExpr("lpad(cast(170000 + id as string), 6, '0') as PRVDR_NUM", "'01' as PRVDR_CTGRY_CD", "'00' as PGM_TRMNTN_CD", "'KS' as STATE_CD").mapInArrow(passed, "PRVDR_NUM string, PRVDR_CTGRY_CD string, PGM_TRMNTN_CD string, STATE_CD string")
    assert loads.load_roster(raw, f"{tmp_path}/a")["loaded"] == 100 and seen.value == 100


def test_repair_of_facts(spark, tmp_path):
    good, bad = "480000001_good_standardcharges.csv", "1669348991_bad_standardcharges.csv"
    sources = spark.createDataFrame([(good, "480000001", None, 5), (bad, "166934899", None, 7)], "source_file string, ein string, primary_npi string, charge_count long")
    facts = sources.select("source_file", "ein", F.explode(F.sequence(F.lit(1), "charge_count")).alias("x"))
    target = f"{tmp_path}/facts"
    arrivals.replace_files(target)(facts, 0)
    before = {p: p.stat().st_mtime_ns for p in Path(target).rglob("*.parquet")}
    assert loads.repair(spark, sources, target, f"{tmp_path}/s0")[1] == {"sources": 1, "rows": 7, "changed": 0}
    only, _ = loads.repair(spark, sources, target, f"{tmp_path}/s1", apply=True, sources_only=True)
    assert {(r.source_file, r.ein, r.primary_npi) for r in only.collect()} == {(good, "480000001", None), (bad, None, "1669348991")}
    assert {p: p.stat().st_mtime_ns for p in Path(target).rglob("*.parquet")} == before
    _, done = loads.repair(spark, sources, target, f"{tmp_path}/s2", apply=True)
    assert done == {"sources": 1, "rows": 7, "changed": 7}
    rows = {(r.source_file, r.ein, r.x) for r in spark.read.parquet(target).collect()}
    assert rows == {(good, "480000001", x) for x in range(1, 6)} | {(bad, None, x) for x in range(1, 8)}
    after = {p: p.stat().st_mtime_ns for p in Path(target).rglob("*.parquet")}
    assert {p for p in before if good in str(p)} == {p for p in after if good in str(p) and after[p] == before[p]}
    loads.apply_fact_repairs(spark, f"{tmp_path}/s2", target)  # again, as after a run that ended halfway
    assert spark.read.parquet(target).count() == 12
    assert loads.repair(spark, only, target, f"{tmp_path}/s3", apply=True)[1] == {"sources": 0, "rows": 0, "changed": 0}


def test_arrivals_with_retry(spark, tmp_path):
    """Files without rows, damaged or of no bytes are loaded once they are there as they should."""
    landing = tmp_path / "in"
    landing.mkdir()
    body = lambda n: (HEAD + "".join(f"d{k},c{k},CPT,P,{k}.5\n" for k in range(n))).encode()
    at = [f"file://{tmp_path}/{x}" for x in ("in", "facts", "ledger", "mark", "scratch")]
    assert arrivals.load_arrived(spark, *at).isEmpty()  # nothing has landed
    put(landing, "0.csv", HEAD.encode())
    assert [r.status for r in arrivals.load_arrived(spark, *at).collect()] == ["empty"]  # no facts so far
    os.remove(landing / "0.csv")
    run = lambda: {r.source_file: (r.status, r.rows) for r in loads_of().collect()}
    loads_of = lambda: arrivals.load_arrived(spark, *at)
    for name, content in (("a.csv", body(3)), ("b.csv", HEAD.encode()), ("c.csv.gz", b"nonsense"), ("d.csv", b"")):
        put(landing, name, content)
    assert run() == {"0.csv": ("empty", 0), "a.csv": ("loaded", 3), "b.csv": ("empty", 0), "c.csv.gz": ("failed", 0)}
    kept = {p: p.stat().st_mtime_ns for p in (tmp_path / "facts").rglob("*a.csv/*.parquet")}
    import gzip

    for name, content in (("b.csv", body(4)), ("c.csv.gz", gzip.compress(body(5))), ("d.csv", body(6)), ("e.csv", body(2))):
        put(landing, name, content)
    want = {"0.csv": ("empty", 0), "a.csv": ("loaded", 3), "b.csv": ("loaded", 4), "c.csv.gz": ("loaded", 5), "d.csv": ("loaded", 6), "e.csv": ("loaded", 2)}
    assert run() == want and run() == want
    assert spark.read.parquet(at[1]).count() == 20
    assert {p: os.stat(p).st_mtime_ns for p in kept} == kept  # what was loaded is not written again


def test_files_are_written_for_rows_only(spark, tmp_path):
    rows = spark.range(0, 40, 1, 4).where("id >= 10").withColumnRenamed("id", "n")  # the first partition has none
    store.write_files(rows, f"{tmp_path}/out", "a", header=True)
    store.write_files(rows.where("n < 0"), f"{tmp_path}/out", "b", header=True)
    found = sorted(Path(store.files_of(f"{tmp_path}/out", "a")).glob("*.csv"))
    assert len(found) == 3 and all(len(p.read_text().splitlines()) == 11 for p in found)
    assert os.path.isdir(store.files_of(f"{tmp_path}/out", "b")) and not list(Path(f"{tmp_path}/out").glob("kind=b/*.csv"))
    assert spark.read.option("header", True).csv(f"{tmp_path}/out/kind=a").count() == 30


@pytest.mark.parametrize("name", ["arrived_charge_files", "charge_batch"])
def test_a_table_whose_first_split_has_no_rows(spark, duck, name):
    """A Parquet file of several splits has its rows in one that may not be the first."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40k")
    try:
        found = QUERIES[name](spark, f"{DATA}/sf0.001")
        rows = found.collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    want = duck("sf0.001").sql(SQL[name])
    assert rows_of(found.columns, rows) == rows_of(want.columns, want.fetchall())


@pytest.fixture(scope="module")
def odd_tables(duck, tmp_path_factory):
    """Rows that share part, order and line, the first of which counts, and parts whose keys
    have more digits than a ZIP."""
    root, con = tmp_path_factory.mktemp("odd"), duck("sf0.001")
    again = "select * replace ((l_suppkey + 1) % 10 as l_suppkey) from lineitem union all select * replace (l_quantity + 1 as l_quantity) from lineitem where l_linenumber <> 2"
    long = "select * replace (100000 + l_partkey % 20 as l_partkey) from lineitem union all select * replace (10000 as l_partkey, 3 as l_linenumber) from lineitem where l_partkey < 9 union all select * replace (1000000 + l_partkey % 9 as l_partkey) from lineitem"
    con.execute("set threads = 1")
    con.execute(f"copy (select * from lineitem union all {again} union all {long}) to '{root}/lineitem.parquet' (format parquet)")
    con.execute(f"copy supplier to '{root}/supplier.parquet' (format parquet)")
    return root


@pytest.mark.parametrize("name", ["crosswalk_first", "service_area_cells", "service_area_load"])
def test_ties_and_long_keys(spark, odd_tables, name):
    import duckdb

    con = duckdb.connect()
    con.execute("set threads = 1")  # of rows that tie, the first in the file
    for table in ("lineitem", "supplier"):
        con.execute(f"create view {table} as select * from read_parquet('{odd_tables}/{table}.parquet')")
    found, want = QUERIES[name](spark, str(odd_tables)), con.sql(SQL[name])
    assert rows_of(found.columns, found.collect()) == rows_of(want.columns, want.fetchall())


def test_cells_are_read_as_by_the_general_functions(spark):
    cells = ["170001", "17A001", "17a001", "1", "12345", "123456", "1234567", "123456789", " 7 ", "1 7", "", "0", "00", "12.0", "12.9", "-3", "1,200", "+4", "*", "n/a", "x", "1e3", "1234567890", "99999999999", "12345\n", None]
    df = spark.createDataFrame([(c,) for c in cells], "c string")
    c = F.col("c")
    pairs = [(T.ccn_cell(c), T.ccn(c)), (T.ccn_cell(c, strict=True), T.strict_ccn(c)), (T.zip_cell(c), T.strict_zip5(c)), (T.count_cell(c), T.parse_count(c))]
    for fast, general in pairs:
        assert df.where(~fast.eqNullSafe(general)).collect() == []


@pytest.mark.parametrize("name", ["link_charges", "link_method_counts", "gap_totals"])
def test_parts_whose_numbers_are_cut(spark, duck, tmp_path, name):
    """The view cuts keys of seven digits, so parts share a number and a file's name."""
    con = duck("sf0.001")
    con.execute(f"copy (from part union all select * replace (100000 + p_partkey as p_partkey) from part union all select * replace (1000000 + p_partkey as p_partkey, p_name || ' ' || p_partkey % 90 as p_name) from part) to '{tmp_path}/part.parquet' (format parquet)")
    con.execute(f"create or replace view part as select * from read_parquet('{tmp_path}/part.parquet')")
    found, want = QUERIES[name](spark, str(tmp_path)), con.sql(SQL[name])
    assert rows_of(found.columns, found.collect()) == rows_of(want.columns, want.fetchall())
