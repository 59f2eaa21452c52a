"""Files loaded more than once: groups, totals, the copy to keep, pruning."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import beside
from ..functions.names import canonical_name, has_counter
from ..functions.text import share


def groups(sources: DataFrame, min_rows: int = 1) -> DataFrame:
    """Sources that share an identifier (EIN, else NPI) and a row count."""
    key = F.coalesce("ein", "primary_npi")
    rows = sources.where(key.isNotNull() & (F.coalesce("charge_count", F.lit(0)) >= min_rows)).withColumn("key", key)
    out = rows.groupBy("key", "charge_count").agg(
        F.count("*").alias("copies"),
        F.count_distinct("hospital_name").alias("names"),
        F.count_distinct(canonical_name("source_file")).alias("canonical_names"),
    )
    return out.where("copies > 1").withColumn("redundant_rows", (F.col("copies") - 1) * F.col("charge_count")).withColumn("is_redownload", F.col("canonical_names") == 1)


def ordered(found: DataFrame, n: int | None = None) -> DataFrame:
    """Groups with most redundant rows first."""
    out = found.orderBy(F.desc("redundant_rows"), "key", "charge_count")
    return out if n is None else out.limit(n)


def keepers(sources: DataFrame) -> DataFrame:
    """Every source of a duplicate group by its place among equal download names: the one
    without a counter, then the shortest, then the first by name is kept."""
    key = F.coalesce("ein", "primary_npi")
    rows = sources.where(key.isNotNull() & (F.col("charge_count") > 0)).select("source_file", "charge_count", key.alias("key"), canonical_name("source_file").alias("canonical"))
    w = Window.partitionBy("key", "charge_count", "canonical").orderBy(has_counter("source_file").cast("int"), F.length("source_file"), "source_file")
    return rows.withColumn("place", F.row_number().over(w)).withColumn("keep", F.col("place") == 1)


def totals(sources: DataFrame) -> DataFrame:
    """One row: redundant files and rows, and how many of them are re-downloads."""
    redundant = groups(sources).agg(F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("redundant_files"), F.coalesce(F.sum("redundant_rows"), F.lit(0)).alias("redundant_rows"))
    again = keepers(sources).where("not keep").agg(F.count("*").alias("redownload_files"), F.coalesce(F.sum("charge_count"), F.lit(0)).alias("redownload_rows"))
    loaded = sources.agg(F.coalesce(F.sum("charge_count"), F.lit(0)).alias("loaded_rows"))
    out = beside(redundant, again, loaded)
    return out.withColumn("per_facility_rows", F.col("redundant_rows") - F.col("redownload_rows")).withColumn("redundant_share", share(F.col("redundant_rows"), F.col("loaded_rows")))


def prune(sources: DataFrame, charges: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(sources, charges, removed files) without re-downloads; facility copies stay.

    Pruning what is pruned removes nothing.
    """
    doomed = keepers(sources).where("not keep").select("source_file", "charge_count")
    names = doomed.select("source_file")
    return sources.join(names, "source_file", "left_anti"), charges.join(names, "source_file", "left_anti"), doomed
