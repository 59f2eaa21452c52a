"""Loads into stored tables: upserts, replacements, merges, run and file ledgers.

Each function returns the table's new content; ``write_version`` stores it beside the old
one, so readers never see half a load and the version before stays."""

from __future__ import annotations

from datetime import datetime, timezone
from functools import reduce
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import file_ein, file_npi


def latest(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """One row for each key: the last by ``order``; a partial maximum, not a window.

    ``order`` should tell the rows of a key apart; of rows that are last together any one
    counts."""
    rest = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(order)).alias("_r")).select(*keys, "_r.*").select(rows.columns)


def upsert(stored: DataFrame, incoming: DataFrame, keys: list[str], order: str | None = None) -> DataFrame:
    """Incoming rows replace stored rows of the same key; others stay.

    Of incoming rows of one key the last by ``order`` counts; without it, the last as they
    are read, so ``incoming`` should then be a scan."""
    new = latest(incoming, keys, order) if order else latest(incoming.withColumn("_seq", F.monotonically_increasing_id()), keys, "_seq")
    return stored.join(new.select(*keys), keys, "left_anti").unionByName(new.select(stored.columns))


def replace_groups(stored: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """All stored rows of an incoming group go, all incoming rows come: by file, by
    (edition, ccn), by vintage or by document."""
    return stored.join(incoming.select(*keys).distinct(), keys, "left_anti").unionByName(incoming.select(stored.columns))


def with_charge_counts(sources: DataFrame, charges: DataFrame) -> DataFrame:
    counts = charges.groupBy("source_file").agg(F.count("*").alias("_n"))
    out = sources.join(counts, "source_file", "left")
    return out.withColumn("charge_count", F.coalesce("_n", F.lit(0)).cast("long")).select(sources.columns)


def not_loaded(files: DataFrame, sources: DataFrame) -> DataFrame:
    """Files without loaded rows; a file that gave none is tried again."""
    return files.join(sources.where("charge_count > 0").select("source_file"), "source_file", "left_anti")


def outcomes(files: DataFrame, headers: DataFrame, counts: DataFrame, sources: DataFrame) -> DataFrame:
    """A row for each file: loaded, skipped (loaded before), failed (no data header) or
    empty, with its rows and the reason."""
    out = files.join(headers.select("source_file", F.lit(True).alias("_h")).distinct(), "source_file", "left")
    out = out.join(counts.groupBy("source_file").agg(F.count("*").alias("rows")), "source_file", "left")
    out = out.join(sources.where("charge_count > 0").select("source_file", F.lit(True).alias("_s")).distinct(), "source_file", "left")
    status = F.when(F.col("_s"), "skipped").when(F.col("_h").isNull(), "failed").when(F.coalesce("rows", F.lit(0)) == 0, "empty").otherwise("loaded")
    reason = F.when(status == "failed", "no data header").when(status == "skipped", "loaded before").when(status == "empty", "no rows").otherwise("")
    return out.select("source_file", status.alias("status"), F.coalesce("rows", F.lit(0)).alias("rows"), reason.alias("reason"))


def merge_plan(target: DataFrame, source: DataFrame) -> DataFrame:
    """For each file of the other store: add, or skip_duplicate."""
    have = target.select("source_file", F.lit(True).alias("_t")).distinct()
    out = source.join(have, "source_file", "left")
    return out.select("source_file", "charge_count", F.when(F.col("_t").isNull(), "add").otherwise("skip_duplicate").alias("action"))


def ordered_plan(plan: DataFrame, n: int | None = None) -> DataFrame:
    """A merge plan, or repairs, with the largest files first."""
    out = plan.orderBy(F.desc("charge_count"), "source_file")
    return out if n is None else out.limit(n)


def merge(target: DataFrame, source: DataFrame, key: str = "source_file") -> DataFrame:
    """The target with the other store's files that it lacks, for any table with the key.

    ``key`` is one file; for facts pass both stores' facts: present files are left out."""
    return target.unionByName(source.join(target.select(key).distinct(), key, "left_anti").select(target.columns))


def run_record(spark: SparkSession, source: str, status: str, read: int, loaded: int, started: datetime, message: str = "", state: str | None = None, edition: str | None = None) -> DataFrame:
    """A provenance row; also for runs that fail."""
    from ..schemas import INGESTION_RUNS

    row = (uuid4().hex, source, state, edition, read, loaded, started, datetime.now(timezone.utc).replace(tzinfo=None), status, message[:512])
    return spark.createDataFrame([row], INGESTION_RUNS)


def write_version(df: DataFrame, path: str, partition_by: list[str] | None = None) -> str:
    """Write a new version below ``path`` and return its folder; the last one is current."""
    version = f"{path.rstrip('/')}/v={datetime.now(timezone.utc):%Y%m%dT%H%M%S%f}"
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    writer.parquet(version)
    return version


def read_current(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The newest complete version, or an empty table."""
    jvm = spark._jvm  # Hadoop's file systems, so any store that Spark reads will do
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    found = sorted(s.getPath().toString() for s in fs.listStatus(root) if fs.exists(jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS"))) if fs.exists(root) else []
    return spark.read.schema(schema).parquet(found[-1]) if found else spark.createDataFrame([], schema)


def write_sheet(df: DataFrame, path: str) -> None:
    """A worklist as CSV with a header and no nulls, in as many part files as it has
    partitions; ``read_sheet`` reads them as one."""
    df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in df.columns]).write.option("header", True).csv(path)


def read_sheet(spark: SparkSession, path: str) -> DataFrame:
    """A worklist back as strings, names trimmed and lower-cased."""
    raw = spark.read.option("header", True).option("emptyValue", "").csv(path)
    return raw.toDF(*[c.strip().lower() for c in raw.columns])


def rename_files(spark: SparkSession, path: str, old: str, new: str) -> None:
    """Files of a folder whose names end in ``old`` get the ending ``new``; names only."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    root = hadoop.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in fs.listStatus(root):
        at = status.getPath()
        if at.getName().endswith(old):
            fs.rename(at, hadoop.Path(root, at.getName().removesuffix(old) + new))


def files_of(root: str, kind: str) -> str:
    """The folder in which ``write_files`` puts the files of a kind."""
    return f"{root}/kind={kind}"


def write_files(rows: DataFrame, root: str, kind: str, **options: str | bool) -> None:
    """Rows as the CSV files of a kind below ``root``, none of them without a row.

    Spark writes a file for a first partition without rows, of a header only, which a reader
    would take for a file that came empty; a writer by folder opens files for rows only."""
    rows.withColumn("kind", F.lit(kind)).write.mode("append").partitionBy("kind").options(**options).csv(root)
    hadoop = rows.sparkSession._jvm.org.apache.hadoop.fs
    at = hadoop.Path(files_of(root, kind))  # a kind without rows has an empty folder
    at.getFileSystem(rows.sparkSession._jsc.hadoopConfiguration()).mkdirs(at)


def union_all(*tables: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, tables)


def counts_by(df: DataFrame, *by: str) -> DataFrame:
    return df.groupBy(*by).agg(F.count("*").alias("rows"))


def repair_identifiers(sources: DataFrame) -> DataFrame:
    """Sources whose stored EIN or NPI disagrees with the file name, with what it says."""
    out = sources.select("source_file", "ein", "primary_npi", "charge_count", file_ein("source_file").alias("file_ein"), file_npi("source_file").alias("file_npi"))
    return out.where(~F.col("ein").eqNullSafe(F.col("file_ein")))


def repaired(sources: DataFrame) -> DataFrame:
    """Sources with EINs as their file names say, and NPIs filled where there were none."""
    return sources.withColumns({"ein": file_ein("source_file")} | _filled_npis())


def _filled_npis() -> dict[str, Column]:
    none = (F.size(F.coalesce("npis", F.array().cast("array<string>"))) == 0) & F.col("primary_npi").isNull()
    npi = file_npi("source_file")
    return {"primary_npi": F.when(none, npi).otherwise(F.col("primary_npi")), "npis": F.when(none & npi.isNotNull(), F.array(npi)).otherwise(F.col("npis"))}


def with_file_npis(sources: DataFrame) -> DataFrame:
    """Sources that lack every NPI get the one of their file name; others stay."""
    return sources.withColumns(_filled_npis())
