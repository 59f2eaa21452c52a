"""Column functions on the values that matter."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import names, ratios, states
from ledgerloom.functions import text as T


def one(spark, column_of, *values):
    rows = spark.createDataFrame([(v,) for v in values], "x string").coalesce(1)
    return [r[0] for r in rows.select(column_of(F.col("x"))).collect()]


@pytest.mark.parametrize(
    ("f", "pairs"),
    [
        (T.clean_str, {"  a   b\t": "a b", "\x00x\x07": "x", "   ": None, None: None, "y" * 20_005: "y" * 20_000}),
        (T.clean_text, {"n/a": None, "None": None, " Aetna ": "Aetna"}),
        (T.to_int, {"3.9": 3, "-3.9": -3, "1,234": 1234, "1d": None, "NaN": None, "x": None}),
        (T.ccn, {"7": "000007", "17 0027": "170027", "1a": "1A", "1234567": "1234567", "": None}),
        (T.strict_ccn, {"170027": "170027", "17z300": "17Z300", "1234567": None, "AB1234": None}),
        (T.zip5, {"67214-1234": "67214", "123": "00123", "": None}),
        (T.strict_zip5, {"672141234": "67214", "1234567": None, "123": "00123"}),
        (T.phone, {"1-785-555-0199": "7855550199", "(316) 555-0100": "3165550100", "x": None}),
        (T.slug, {"St. Luke's  Hospital": "st-luke-s-hospital", "": ""}),
        (names.name_key, {"The St. Luke’s Hospital, Inc.": "ST LUKES HOSPITAL", "": ""}),
        (names.system_key, {"Saint Lukes Hospital": "SAINT LUKES", "Community Hospital of Onaga": "ONAGA", "HCA Florida": "HCA FLORIDA", "Mercy Hospital": "MERCY", "Hospital": None, "ABC": None}),
        (names.canonical_name, {"anmed (2).zip": "anmed", "a/b/X.csv.gz": "x", "report-2.csv": "report-2", "y (1).csv": "y"}),
        (names.readable_name, {"a_b-c.json.zip": "a b c.json", "d/x.csv": "x"}),
        (names.file_ein, {"386006309_x.csv": "386006309", "24-0795959_x.csv": "240795959", "334038167-1669348991_x.csv": "334038167", "1669348991_x.csv": None, "ab12cd-386006309_x.csv": "386006309"}),
        (names.file_npi, {"334038167-1669348991_x.csv": "1669348991", "386006309_x.csv": None}),
        (names.file_ccn, {"ccn-170027_x.json": "170027", "170027_x.json": None}),
        (names.site_root, {"https://www.Example.org/a": "example.org", "example.org:80/x": "example.org", "": "", None: ""}),
        (states.ccn_state, {"170027": "KS", "990000": None}),
    ],
)
def test_strings(spark, f, pairs):
    assert one(spark, f, *pairs) == list(pairs.values())


def test_values(spark):
    assert [str(x) for x in one(spark, T.to_decimal, "$1,234.50", "NA", "x", "1d")] == ["1234.50", "None", "None", "None"]
    day = dt.date(2024, 7, 1)
    assert one(spark, T.parse_date, "20240701", "2024-07-01T10:00", "7/1/2024", "July") == [day, day, day, None]
    assert [tuple(r) for r in one(spark, T.parse_count, "*", "", "0", "12", "x")] == [(None, True), (None, True), (0, False), (12, False), (None, True)]
    assert one(spark, lambda c: T.round_half_up(c.cast("double")), "2.5", "-2.5", "1.4") == [3.0, -2.0, 1.0]
    assert one(spark, lambda c: T.word_start(c, "hca"), "HCA Houston", "healthcare", "x-hca") == [True, False, True]
    assert one(spark, T.is_yes, "Yes", " x ", "no", None) == [True, True, False, False]
    assert one(spark, T.parse_amount, "$1,234.567", "*", "", "0", "x") == [Decimal("1234.57"), None, None, Decimal("0.00"), None]
    odd = [" a  b ", "plain words", "", None, "x\x00y", "caf\u00e9", "a\u00a0b", "y" * 20_005, "N/A", "$1,234.50", "12", "12.5", " 7 ", "1e3", "-4", "12345678901234567"]
    assert one(spark, T.clean_cell, *odd) == one(spark, T.clean_str, *odd)
    assert one(spark, T.cell_decimal, *odd) == one(spark, T.to_decimal, *odd)
    assert one(spark, states.ccn_state, "490001", "500001", "510001", "520001", "530001", "170001") == ["VA", "WA", "WV", "WI", "WY", "KS"]
    assert states.resolve_state("kansas") == "KS"
    with pytest.raises(KeyError):
        states.resolve_state("Atlantis")


def test_similarity(spark):
    rows = spark.createDataFrame([("Mercy Medical Center", "Mercy Hospital"), ("Community Hospital", "Community Hospital"), ("", "x")], "a string, b string")
    assert [r[0] for r in rows.select(names.name_similarity("a", "b")).collect()] == [1.0, 1.0, 0.0]


def test_urls(spark):
    rows = spark.createDataFrame([("/f.csv",), ("f.csv",), ("https://o.org/f.csv",), ("//o.org/f.csv",)], "u string")
    got = [r[0] for r in rows.select(names.absolute_url(F.col("u"), F.lit("https://h.org/d/cms-hpt.txt"))).collect()]
    assert got == ["https://h.org/f.csv", "https://h.org/d/f.csv", "https://o.org/f.csv", "https://o.org/f.csv"]
    url = spark.range(1).select(names.search_url(F.lit("A & B"), F.lit("Onaga"), F.lit("KS"))).first()[0]
    assert url.startswith("https://www.google.com/search?q=%22A+%26+B%22+Onaga+KS+price+transparency")


def test_ratios(spark):
    values = {c: None for c in ratios.INPUTS} | {"netpatrev": 1_000_000, "opexp": 900_000, "total_current_assets": 500_000, "total_current_liabilities": 250_000, "ipbeddays_adultped": 18_250, "availbeddays_adultped": 36_500, "ipdischarges_adultped": 3_650, "total_paid_hours": 2_500_000, "depreciation_expense": 10, "accum_depr_buildings": 50}
    row = spark.createDataFrame([tuple(None if v is None else float(v) for v in values.values())], ", ".join(f"{c} double" for c in values)).select(*ratios.ratio_columns()).first().asDict()
    assert len(row) == len(ratios.NAMES) == 25
    assert row["operating_margin_pct"] == pytest.approx(10) and row["current_ratio"] == 2 and row["occupancy_pct"] == 50
    assert row["average_length_of_stay"] == 5 and row["total_ftes"] == pytest.approx(2_500_000 / 2080) and row["average_age_of_plant"] == 5
    assert row["return_on_assets_pct"] is None and row["quick_ratio"] is None
