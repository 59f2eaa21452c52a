"""Loads that count what they read, skip and write in the scan that loads it.

Counts travel with the groups of a load and are summed by an observation in the stage that
writes.  Spark counts a task of that stage once, however often it runs; an observation in a
stage before a shuffle could count rows again after an executor is lost."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.names import file_ein, file_npi
from ..functions.states import EVERYWHERE, resolve_state
from ..sources import cost_files, roster
from . import store


def write_counted(rows: DataFrame, target: str, counts: dict[str, Column], keep: Column | None = None, drop: tuple[str, ...] = ()) -> dict[str, int]:
    """Write the rows that ``keep`` chooses as a new table, and return ``counts`` of all of them.

    An empty table gives zeros.  The counts are one row; nothing else reaches the driver."""
    watch = Observation()
    seen = rows.observe(watch, *[F.coalesce(c, F.lit(0)).cast("long").alias(name) for name, c in counts.items()])
    (seen if keep is None else seen.where(keep)).drop(*drop).write.parquet(target)
    return {k: v or 0 for k, v in watch.get.items()}


def _grouped(rows: DataFrame, keys: list[str], first: Column, marks: dict[str, Column]) -> DataFrame:
    """Rows of ``(kind, keys, ...)`` as one row for each kind and keys, with ``first`` of its rows
    and a count of each mark; a partial aggregate, so a kind of very many rows is no hot task."""
    return rows.groupBy("kind", *keys).agg(first.alias("_r"), *[F.count_if(m).alias(f"_{name}") for name, m in marks.items()])


def load_roster(raw: DataFrame, target: str, state: str = "ALL", active_only: bool = True, order: Column | None = None) -> dict[str, int]:
    """Write the hospitals that ``roster.ingest`` finds, and count records ``read``, hospitals
    ``matched`` by state, ``active`` among them, those ``without_ccn``, and rows ``loaded``.

    Of repeated CCNs the last row is loaded.  Null cells are no hospital, no CCN, not active."""
    rows = roster.hospitals(raw.withColumn("_SEQ", order if order is not None else F.monotonically_increasing_id()), "_SEQ")
    match = F.lit(True) if state.strip().upper() in EVERYWHERE else F.coalesce(F.col("state") == resolve_state(state), F.lit(False))
    hospital = (F.col("provider_category_code") == roster.HOSPITAL_CATEGORY) & match
    wanted = hospital & F.col("is_active") if active_only else hospital
    kind = F.when(wanted & (F.col("ccn") != ""), "kept").when(wanted, "no ccn").otherwise("other")
    marks = {"read": F.lit(True), "matched": hospital, "active": hospital & F.col("is_active")}
    rest = [c for c in rows.columns if c not in ("ccn", "_SEQ")]
    rows = rows.withColumns({"kind": kind, "key": F.when(kind == "kept", F.col("ccn"))})
    groups = _grouped(rows, ["key"], F.max_by(F.struct(*rest), "_SEQ"), marks)
    counts = {m: F.sum(f"_{m}") for m in marks} | {"without_ccn": F.sum(F.when(F.col("kind") == "no ccn", F.col("_read"))), "loaded": F.count_if(F.col("kind") == "kept")}
    columns = groups.select(F.col("key").alias("ccn"), "_r.*", "kind", *[f"_{m}" for m in marks])
    return write_counted(columns, target, counts, F.col("kind") == "kept", ("kind", *[f"_{m}" for m in marks]))


def load_service_area(raw: DataFrame, known: DataFrame | None, target: str, edition: str | Column, source: str, order: Column | None = None) -> dict[str, int]:
    """Write the first cell of each hospital and ZIP of an edition, and count rows ``read``, ``unusable`` (no
    CCN or no ZIP), ``unknown`` (of hospitals that are not in ``known(ccn)``) and the
    ``unknown_ccns``, ``repeated`` cells, and of those ``loaded`` the ``suppressed``.

    Without ``known`` every hospital is; an empty one is an error, not an empty load."""
    cells = roster.area_cells(raw, edition, order)
    if known is None:
        cells = cells.withColumn("_k", F.lit(True))
    else:
        if known.limit(1).isEmpty():
            raise ValueError("the roster is empty; load hospitals first")
        cells = cells.join(known.select("ccn", F.lit(True).alias("_k")).distinct(), "ccn", "left")
    kind = F.when(F.col("ccn").isNull() | F.col("zip5").isNull(), "unusable").when(F.col("_k").isNull(), "unknown").otherwise("kept")
    rows = cells.withColumns({"kind": kind, "ccn": F.when(kind != "unusable", F.col("ccn")), "zip5": F.when(kind == "kept", F.col("zip5")), "edition": F.when(kind == "kept", F.col("edition"))})
    groups = _grouped(rows, ["ccn", "zip5", "edition"], F.min_by(F.struct("c", "d", "charges"), "_seq"), {"n": F.lit(True)})
    of = lambda k: F.sum(F.when(F.col("kind") == k, F.col("_n")))
    kept = F.col("kind") == "kept"
    counts = {
        "read": F.sum("_n"), "unusable": of("unusable"), "unknown": of("unknown"), "unknown_ccns": F.count_if(F.col("kind") == "unknown"),
        "repeated": F.sum(F.when(kept, F.col("_n") - 1)), "suppressed": F.count_if(kept & F.col("suppressed")), "loaded": F.count_if(kept),
    }
    return write_counted(roster.area_columns(groups, source, "kind", "_n"), target, counts, kept, ("kind", "_n"))


def load_cost_reports(spark: SparkSession, paths: list[str], vintage: int, target: str) -> dict[str, int]:
    """Write ``reports``, ``numeric`` and ``alpha`` of a vintage below ``target``, each in one scan
    of its member, and count what is loaded, ``repeated_reports`` (a record number that came
    before) and the cells of record numbers without a report, ``orphan_numeric`` and
    ``orphan_alpha``, which are not loaded.

    Cells without a value, short rows and rows without a record number are neither."""
    v = cost_files.read_vintage(spark, paths, vintage)
    out = write_counted(v["reports"], f"{target}/reports", {"reports": F.count("*")})
    ids = spark.read.parquet(f"{target}/reports").groupBy("rpt_rec_num").agg(F.count("*").alias("_n"))
    out |= write_counted(ids, f"{target}/report_ids", {"repeated_reports": F.sum(F.col("_n") - 1)})
    known = spark.read.parquet(f"{target}/report_ids").select("rpt_rec_num", F.lit(True).alias("_known"))
    for role in ("numeric", "alpha"):
        cells, have = v[role].join(known, "rpt_rec_num", "left"), F.col("_known").isNotNull()
        out |= write_counted(cells, f"{target}/{role}", {role: F.count_if(have), f"orphan_{role}": F.count_if(~have)}, have, ("_known",))
    return out


def run_of(spark: SparkSession, source: str, counts: dict[str, int], read: str | tuple[str, ...], loaded: str | tuple[str, ...], started: datetime, **more: str) -> DataFrame:
    """The provenance row of a counted load; all counts are its message."""
    total = lambda names: sum(counts[n] for n in ((names,) if isinstance(names, str) else names))
    return store.run_record(spark, source, "loaded", total(read), total(loaded), started, "; ".join(f"{k} {v}" for k, v in sorted(counts.items())), **more)


# --- repairs ----------------------------------------------------------------------------


def with_repairs(sources: DataFrame) -> DataFrame:
    """Sources whose EIN disagrees with their file's name get the name's EIN, and its NPI
    if they have none; all others stay as they are."""
    wrong = ~F.col("ein").eqNullSafe(file_ein("source_file"))
    return sources.withColumns({"ein": F.when(wrong, file_ein("source_file")).otherwise(F.col("ein")), "primary_npi": F.when(wrong, F.coalesce("primary_npi", file_npi("source_file"))).otherwise(F.col("primary_npi"))})


def stage_fact_repairs(facts: DataFrame, sources: DataFrame, staged: str) -> dict[str, int]:
    """Write the facts of the files whose sources need a repair to ``staged``, with the EIN that
    the file's name gives, and count the ``rows`` and those that ``changed``.

    ``facts`` are stored by file (``partitionBy`` with ``source_file``): only partitions of
    those files are read.  ``sources`` are as they were before their own repair."""
    fixes = store.repair_identifiers(sources).select("source_file").distinct()
    rows = facts.join(fixes, "source_file", "left_semi").withColumns({"_old": F.col("ein"), "ein": file_ein("source_file")})
    return write_counted(rows.select(*facts.columns, "_old"), staged, {"rows": F.count("*"), "changed": F.count_if(~F.col("ein").eqNullSafe(F.col("_old")))}, drop=("_old",))


def apply_fact_repairs(spark: SparkSession, staged: str, target: str, by: tuple[str, ...] = ("bucket", "source_file")) -> None:
    """Put the staged facts in the place of their partitions; no other partition is touched.

    A run that is ended halfway is repeated from ``staged``, which holds whole partitions."""
    rows = spark.read.parquet(staged)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(target)


def repair(spark: SparkSession, sources: DataFrame, facts_path: str, staged: str, apply: bool = False, sources_only: bool = False) -> tuple[DataFrame, dict[str, int]]:
    """The repaired sources and what is done: ``sources`` that are wrong, fact ``rows`` of their
    files, and those that ``changed``.  Without ``apply`` nothing is written, and ``rows`` is
    what the sources say; ``sources_only`` leaves facts as they are."""
    plan = store.repair_identifiers(sources).agg(F.count("*").alias("n"), F.coalesce(F.sum("charge_count"), F.lit(0)).alias("rows")).first()
    found = {"sources": plan["n"], "rows": plan["rows"], "changed": 0}
    if not apply:
        return sources, found
    if not sources_only and plan["n"]:
        found |= stage_fact_repairs(spark.read.parquet(facts_path), sources, staged)
        apply_fact_repairs(spark, staged, facts_path)
    return with_repairs(sources), found

