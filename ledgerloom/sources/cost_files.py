"""Cost-report files: reports, numeric cells and text cells of one vintage.

The three members of a vintage are told apart by their names; each is one scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from .charges import detect_delimiter

# Parts of the members' names.
ROLES = {"report": ("RPT",), "numeric": ("NMRC", "NUMERIC"), "alpha": ("ALPHA",)}


def member_roles(names: list[str]) -> dict[str, str]:
    """The one file of each role; a missing or doubled role is an error."""
    out: dict[str, str] = {}
    for role, marks in ROLES.items():
        hits = [n for n in names if any(m in n.rsplit("/", 1)[-1].upper() for m in marks)]
        if len(hits) != 1:
            raise ValueError(f"expected one {role} file, found {hits or 'none'} among {names}")
        out[role] = hits[0]
    return out


def reports(lines: DataFrame, vintage: int, source: str, delimiter: str = ",") -> DataFrame:
    """``lines(value)`` of a report file: the raw line and the fields decoded from it.

    Lines whose first field is no integer are dropped; short lines give nulls.
    ``row_seq`` follows the file, which is read as one run of partitions in order."""
    rows = lines.withColumn("row_seq", F.monotonically_increasing_id())
    return decoded(rows.select(F.lit(vintage).alias("vintage_year"), "row_seq", F.col("value").alias("raw_line"), F.lit(source).alias("source_zip")), delimiter)


def decoded(rows: DataFrame, delimiter: str = ",") -> DataFrame:
    """Fields of ``raw_line``, again whenever the decoding changes."""
    keep = [c for c in rows.columns if c not in ("rpt_rec_num", "ccn", "status_code", "fy_begin", "fy_end", "proc_date")]
    f = F.transform(F.split("raw_line", rf"\Q{delimiter}\E"), lambda x: F.trim(F.translate(x, '"', "")))
    get = lambda k: F.get(f, F.lit(k))
    out = rows.select(*keep, get(0).try_cast("long").alias("rpt_rec_num"), T.ccn(get(2)).alias("ccn"), T.clean_str(get(4)).alias("status_code"), T.parse_date(get(5)).alias("fy_begin"), T.parse_date(get(6)).alias("fy_end"), T.parse_date(get(7)).alias("proc_date"))
    return out.where("rpt_rec_num is not null")


def cells(raw: DataFrame, vintage: int, numeric: bool) -> DataFrame:
    """``raw(c0 .. c4)`` of a cell file; rows of fewer fields or without a record number go."""
    value = T.to_decimal("c4", "decimal(20,4)") if numeric else T.clean_text("c4")
    rows = raw.where("c0 is not null and c1 is not null and c2 is not null and c3 is not null")
    out = rows.select(F.lit(vintage).alias("vintage_year"), F.trim("c0").try_cast("long").alias("rpt_rec_num"), F.monotonically_increasing_id().alias("row_seq"), F.trim("c1").alias("wksht_cd"), F.trim("c2").alias("line_num"), F.trim("c3").alias("clmn_num"), value.alias("value"))
    return out.where("rpt_rec_num is not null and value is not null")


def delimiter_of(spark: SparkSession, path: str) -> str:
    """What separates a member's fields, by its first line; a comma for an empty file."""
    first = spark.read.text(path).first()
    return detect_delimiter((first and first[0]) or "")


def read_vintage(spark: SparkSession, paths: list[str], vintage: int) -> dict[str, DataFrame]:
    """``reports``, ``numeric`` and ``alpha`` of the members, whatever separates their fields."""
    roles = member_roles(paths)
    sep = {role: delimiter_of(spark, p) for role, p in roles.items()}
    scan = lambda role: spark.read.schema("c0 string, c1 string, c2 string, c3 string, c4 string").csv(roles[role], sep=sep[role])
    return {
        "reports": reports(spark.read.text(roles["report"]), vintage, roles["report"], sep["report"]),
        "numeric": cells(scan("numeric"), vintage, True),
        "alpha": cells(scan("alpha"), vintage, False),
    }
