"""Cost reports: from sparse cells to named metrics to ratios."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import ratios

REPORT = ("vintage_year", "rpt_rec_num")


def latest_reports(reports: DataFrame, seq: str = "row_seq") -> DataFrame:
    """The last row of each (vintage, record number), in file order."""
    whole = F.struct(F.col(seq), *[F.col(c) for c in reports.columns if c not in (*REPORT, seq)])
    last = reports.groupBy(*REPORT).agg(F.max_by(whole, F.col(seq)).alias("r"))
    return last.select(*REPORT, "r.*").select(reports.columns)


def duplicate_reports(reports: DataFrame) -> DataFrame:
    return reports.groupBy(*REPORT).agg((F.count("*") - 1).alias("superseded")).where("superseded > 0")


def orphans(cells: DataFrame, reports: DataFrame) -> DataFrame:
    return cells.join(reports.select(*REPORT).distinct(), list(REPORT), "left_anti")


def last_cells(cells: DataFrame, by: tuple[str, ...] = REPORT, seq: str = "row_seq") -> DataFrame:
    """The last value of each placeable cell: codes are compared as numbers.

    A partial maximum decides, so no window is needed."""
    placed = cells.withColumns({"clmn": F.col("clmn_num").try_cast("int"), "line": F.col("line_num").try_cast("int")}).where("clmn is not null and line is not null and value is not null")
    return placed.groupBy(*by, "wksht_cd", "clmn", "line").agg(F.max_by("value", seq).alias("value"))


def _entries(crosswalk: DataFrame, alpha: bool, include_disabled: bool) -> DataFrame:
    rows = crosswalk.where((F.col("metric_type") == "alpha") == F.lit(alpha))
    if not include_disabled:
        rows = rows.where("enabled")
    start = F.col("line_start").try_cast("int")
    end = F.coalesce(F.col("line_end").try_cast("int"), start)
    return rows.select("metric", "wksht_cd", F.col("clmn_num").try_cast("int").alias("clmn"), start.alias("line_start"), end.alias("line_end"))


def numeric_metrics(cells: DataFrame, crosswalk: DataFrame, include_disabled: bool = False, by: tuple[str, ...] = REPORT) -> DataFrame:
    """Sums of the cells in each metric's range of lines; no row where none was filed.

    The crosswalk is a code table of a few hundred rows; Spark broadcasts it by size."""
    entries = _entries(crosswalk, False, include_disabled)
    inside = F.col("line").between(F.col("line_start"), F.col("line_end"))
    hits = last_cells(cells, by).join(entries, ["wksht_cd", "clmn"]).where(inside)
    return hits.groupBy(*by, "metric").agg(F.sum("value").alias("value_numeric"))


def alpha_metrics(cells: DataFrame, crosswalk: DataFrame, include_disabled: bool = False, by: tuple[str, ...] = REPORT) -> DataFrame:
    """Text of the one cell of each metric."""
    entries = _entries(crosswalk, True, include_disabled).withColumnRenamed("line_start", "line")
    return last_cells(cells, by).join(entries, ["wksht_cd", "clmn", "line"]).select(*by, "metric", F.col("value").cast("string").alias("value_text"))


def metric_values(numeric: DataFrame, alpha: DataFrame, crosswalk: DataFrame, include_disabled: bool = False) -> DataFrame:
    """All metrics in one long table: a number or a text."""
    n = numeric_metrics(numeric, crosswalk, include_disabled).withColumns({"value_numeric": F.col("value_numeric").cast("decimal(20,4)"), "value_text": F.lit(None).cast("string")})
    a = alpha_metrics(alpha, crosswalk, include_disabled).withColumn("value_numeric", F.lit(None).cast("decimal(20,4)"))
    return n.unionByName(a)


def wide(metrics: DataFrame, by: tuple[str, ...] = REPORT) -> DataFrame:
    """One column for each input of the ratios; null where a report has no such metric."""
    return metrics.groupBy(*by).pivot("metric", list(ratios.INPUTS)).agg(F.first("value_numeric"))


def report_ratios(metrics: DataFrame, by: tuple[str, ...] = REPORT) -> DataFrame:
    """``(report, ratio, value)`` of every ratio that can be computed."""
    columns = wide(metrics, by).select(*by, *ratios.ratio_columns())
    return columns.unpivot(list(by), list(ratios.NAMES), "ratio", "value").where("value is not null")
