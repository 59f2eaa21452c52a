"""Provider roster, service-area cells, NPI crosswalk and web sites."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.states import EVERYWHERE, ccn_state, resolve_state
from ..operators.store import latest
from .columns import pick, read_strings, resolve

# Codes of the provider roster.
HOSPITAL_CATEGORY, ACTIVE = "01", "00"
SUBTYPES = {
    "01": "Short-term (Acute Care)", "02": "Long-term", "03": "Religious Non-medical Health Care Institution",
    "04": "Psychiatric", "05": "Rehabilitation", "06": "Childrens", "07": "Distinct Part Psychiatric Unit",
    "08": "Distinct Part Rehabilitation Unit", "09": "Short-term (Critical Access Hospital)", "10": "Alcohol/Drug",
}
OWNERSHIP = {
    "01": "Voluntary Nonprofit - Church", "02": "Voluntary Nonprofit - Private", "03": "Voluntary Nonprofit - Other",
    "04": "Proprietary - Individual", "05": "Proprietary - Corporation", "06": "Proprietary - Partnership",
    "07": "Proprietary - Other", "08": "Government - Federal", "09": "Government - State", "10": "Government - County",
    "11": "Government - City", "12": "Government - City/County", "13": "Government - Hospital District",
    "14": "Government - Other",
}

AREA_SPELLINGS = {
    "ccn": ["MEDICARE_PROV_NUM", "MEDICARE PROVIDER NUMBER", "PROVIDER_NUMBER", "PROVIDER NUMBER", "PRVDR_NUM", "CCN"],
    "zip5": ["ZIP_CD_OF_RESIDENCE", "ZIP CODE OF RESIDENCE", "ZIP_CODE", "ZIP", "ZIP_CD"],
    "cases": ["TOTAL_CASES", "CASES"],
    "days": ["TOTAL_DAYS_OF_CARE", "TOTAL_DAYS", "DAYS"],
    "charges": ["TOTAL_CHARGES", "CHARGES"],
}


def hospitals(raw: DataFrame, *keep: str) -> DataFrame:
    """Normalized rows of raw roster records, with the raw columns to ``keep``."""
    get = lambda name: pick(raw, [name], required=False)
    ccn, subtype = T.ccn(get("PRVDR_NUM")), F.coalesce(T.clean_str(get("PRVDR_CTGRY_SBTYP_CD")), F.lit(""))
    ownership, ended = T.clean_str(get("GNRL_CNTL_TYPE_CD")), T.clean_str(get("PGM_TRMNTN_CD"))
    blank = F.lit("")
    return raw.select(
        *keep,
        F.coalesce(ccn, blank).alias("ccn"),
        F.coalesce(T.clean_str(get("FAC_NAME")), blank).alias("name"),
        F.coalesce(T.clean_str(get("PRVDR_CTGRY_CD")), blank).alias("provider_category_code"),
        subtype.alias("provider_subtype_code"),
        T.coded(subtype, SUBTYPES, "Other/Unknown").alias("provider_subtype"),
        T.clean_str(get("ST_ADR")).alias("address"),
        T.clean_str(get("CITY_NAME")).alias("city"),
        F.coalesce(F.upper(T.clean_str(get("STATE_CD"))), ccn_state(ccn)).alias("state"),
        T.zip5(get("ZIP_CD")).alias("zip5"),
        T.clean_str(get("CNTY_NAME")).alias("county"),
        T.phone(get("TEL_NUM")).alias("phone"),
        ownership.alias("ownership_code"),
        T.coded(ownership, OWNERSHIP).alias("ownership_type"),
        T.to_double(get("CRTFD_BED_CNT")).try_cast("int").alias("certified_bed_count"),
        T.parse_date(get("CRTFCTN_DT")).alias("certification_date"),
        ended.alias("termination_code"),
        F.coalesce(ended == ACTIVE, F.lit(False)).alias("is_active"),
        F.coalesce(T.clean_str(get("SSA_STATE_CD")), F.substring(ccn, 1, 2)).alias("ssa_state_code"),
        T.clean_str(get("FIPS_STATE_CD")).alias("fips_state_code"),
    )


def in_state(rows: DataFrame, state: str) -> DataFrame:
    """Rows of a state (by code or name); ``ALL`` and its like keep every row."""
    return rows if state.strip().upper() in EVERYWHERE else rows.where(F.col("state") == resolve_state(state))


def ingest(raw: DataFrame, state: str = "ALL", active_only: bool = True, order: Column | None = None) -> DataFrame:
    """Hospitals of raw roster records: category 01, with a CCN, the last row of each.

    ``order`` says which row is the last; without it, their order in the file does."""
    marked = raw.withColumn("_SEQ", order if order is not None else F.monotonically_increasing_id())
    rows = hospitals(marked, "_SEQ").where((F.col("provider_category_code") == HOSPITAL_CATEGORY) & (F.col("ccn") != ""))
    rows = in_state(rows, state)
    rows = rows.where("is_active") if active_only else rows
    return latest(rows, ["ccn"], "_SEQ").drop("_SEQ")


def load_statistics(raw: DataFrame, state: str = "ALL") -> DataFrame:
    """One row: records read, hospitals, in the state, active among them."""
    rows = hospitals(raw)
    match = F.lit(True) if state.strip().upper() in EVERYWHERE else F.col("state") == resolve_state(state)
    is_hospital = (F.col("provider_category_code") == HOSPITAL_CATEGORY) & (F.col("ccn") != "")
    return rows.agg(F.count("*").alias("read"), F.count_if(is_hospital).alias("hospitals"), F.count_if(is_hospital & match).alias("matched"), F.count_if(is_hospital & match & F.col("is_active")).alias("active"))


def area_cells(raw: DataFrame, edition: str | Column, order: Column | None = None) -> DataFrame:
    """``(ccn, zip5, edition, c, d, charges, _seq)`` of every row of a service-area feed; a bad
    CCN or ZIP is null.  ``edition`` is a column where the feed holds several."""
    marks = {"_SEQ": order if order is not None else F.monotonically_increasing_id(), "_ROW_EDITION": F.lit(edition) if isinstance(edition, str) else edition}
    rows = resolve(raw.withColumns(marks), AREA_SPELLINGS | {"edition": ["_ROW_EDITION"], "_seq": ["_SEQ"]}, ("ccn", "zip5", "cases"))
    cell = lambda name: F.col(name).cast("string")
    return rows.select(
        T.ccn_cell(cell("ccn"), strict=True).alias("ccn"), T.zip_cell(cell("zip5")).alias("zip5"), "edition",
        T.count_cell(cell("cases")).alias("c"), T.count_cell(cell("days")).alias("d"), T.parse_amount("charges").alias("charges"), "_seq",
    )


def area_columns(first: DataFrame, source: str, *keep: str) -> DataFrame:
    """Cells of ``first(ccn, zip5, edition, _r)`` as they are stored."""
    return first.select("ccn", "zip5", "edition", F.col("_r.c.value").alias("cases"), F.col("_r.d.value").alias("days"), F.col("_r.charges").alias("charges"), F.col("_r.c.suppressed").alias("suppressed"), F.lit(source).alias("source"), *keep)


def service_area(raw: DataFrame, edition: str | Column, source: str, order: Column | None = None) -> DataFrame:
    """Cells of a service-area feed; of repeated (ccn, zip5) of an edition the first counts."""
    cells = area_cells(raw, edition, order).where("ccn is not null and zip5 is not null")
    return area_columns(cells.groupBy("ccn", "zip5", "edition").agg(F.min_by(F.struct("c", "d", "charges"), "_seq").alias("_r")), source)


def known_only(cells: DataFrame, roster: DataFrame) -> DataFrame:
    """Cells of hospitals in the roster; an empty roster is an error, not an empty result."""
    if roster.limit(1).isEmpty():
        raise ValueError("the roster is empty; load hospitals first")
    return cells.join(roster.select("ccn").distinct(), "ccn", "left_semi")


def crosswalk(raw: DataFrame, source: str, order: Column | None = None) -> DataFrame:
    """``(npi, ccn, name, source, ccns)``: the first CCN of each NPI, and how many it has."""
    spellings = {"npi": ["NPI"], "ccn": ["CCN"], "name": ["NAME", "ORGANIZATION_NAME"], "_seq": ["_SEQ"]}
    rows = resolve(raw.withColumn("_SEQ", order if order is not None else F.monotonically_increasing_id()), spellings, ("npi", "ccn"))
    rows = rows.select(T.clean_cell(F.col("npi").cast("string")).alias("npi"), T.ccn_cell(F.col("ccn").cast("string")).alias("ccn"), T.clean_cell(F.col("name").cast("string")).alias("name"), "_seq").where("npi is not null and ccn is not null")
    out = rows.groupBy("npi").agg(F.min_by("ccn", "_seq").alias("ccn"), F.min_by("name", "_seq").alias("name"), F.count_distinct("ccn").alias("ccns"))
    return out.withColumn("source", F.lit(source))


def websites(spark: SparkSession, path: str) -> DataFrame:
    """``(ccn, website)`` of profile maps: ``{hospitals: {ccn: {web | website}}}`` or bare."""
    raw = spark.read.option("recursiveFileLookup", True).text(path, wholetext=True)
    entry = "map<string,struct<web:string,website:string>>"
    nested = F.from_json("value", f"hospitals {entry}")["hospitals"]
    each = raw.select(F.explode(F.coalesce(nested, F.from_json("value", entry))).alias("ccn", "p"))
    return each.select(T.ccn("ccn").alias("ccn"), T.clean_str(F.coalesce("p.web", "p.website")).alias("website")).where("website is not null")


def read_roster(spark: SparkSession, path: str) -> DataFrame:
    return read_strings(spark, path)
