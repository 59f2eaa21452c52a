"""Hospitals without data: by system, alone, by state; files without a hospital."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import beside
from ..functions.names import search_url, source_state, system_key
from ..functions.text import share
from .linkage import by_name, probable


def covered_ccns(sources: DataFrame, hospitals: DataFrame) -> DataFrame:
    """CCNs with a file that has rows: linked, or by a unique name even when unlinked."""
    full = sources.where("charge_count > 0")
    linked = full.where("ccn is not null").select("ccn")
    named = by_name(full.where("ccn is null"), hospitals).select("ccn")
    return linked.unionByName(named).distinct()


def unattributed(sources: DataFrame, hospitals: DataFrame) -> DataFrame:
    full = sources.where("charge_count > 0 and ccn is null")
    rest = full.join(by_name(full, hospitals).select("source_file"), "source_file", "left_anti")
    return rest.select("source_file", "hospital_name", source_state(F.col("license_state"), F.col("hospital_address")).alias("state"), "charge_count")


def remaining(hospitals: DataFrame, covered: DataFrame) -> DataFrame:
    """Active hospitals without data, with their brand."""
    rows = hospitals.where("is_active").withColumn("state", F.upper(F.coalesce("state", F.lit("??"))))
    return rows.join(covered, "ccn", "left_anti").withColumn("system", system_key("name"))


def publishing(sources: DataFrame) -> DataFrame:
    """Brand of each file with rows, and the first such file by name."""
    rows = sources.where("charge_count > 0").select(system_key("hospital_name").alias("system"), "source_file").where("system is not null")
    return rows.groupBy("system").agg(F.min("source_file").alias("known_source"))


def systems(gaps: DataFrame, known: DataFrame | None = None, min_size: int = 2) -> DataFrame:
    """Brands with several hospitals left: how many, in which states, three examples.

    Examples come from distinct names by rank, so no brand is gathered whole."""
    named = gaps.where("system is not null")
    sizes = named.groupBy("system").agg(F.count("*").alias("remaining"), F.array_sort(F.collect_set("state")).alias("states")).where(F.col("remaining") >= min_size)
    place = Window.partitionBy("system").orderBy("name")
    firsts = named.select("system", "name").distinct().withColumn("n", F.row_number().over(place)).where("n <= 3")
    examples = firsts.groupBy("system").agg(F.array_sort(F.collect_list("name")).alias("examples"))
    out = sizes.join(examples, "system")
    if known is None:
        return out
    return out.join(known, "system", "left").withColumn("already_publishing", F.col("known_source").isNotNull())


def independents(gaps: DataFrame, clusters: DataFrame) -> DataFrame:
    return gaps.join(clusters.select("system"), "system", "left_anti")


def state_coverage(hospitals: DataFrame, covered: DataFrame) -> DataFrame:
    rows = hospitals.where("is_active").select("ccn", F.upper(F.coalesce("state", F.lit("??"))).alias("state"))
    rows = rows.join(covered.select("ccn", F.lit(1).alias("c")), "ccn", "left")
    out = rows.groupBy("state").agg(F.count("*").alias("total"), F.count("c").alias("covered"))
    return out.select("state", "total", "covered", (F.col("total") - F.col("covered")).alias("remaining"), share(F.col("covered"), F.col("total")).alias("pct"), (F.col("covered") == 0).alias("not_started"))


def gap_report(hospitals: DataFrame, sources: DataFrame, min_size: int = 2) -> dict[str, DataFrame]:
    """The gap question: every sheet of the report and its totals."""
    covered = covered_ccns(sources, hospitals)
    gaps = remaining(hospitals, covered)
    clusters = systems(gaps, publishing(sources), min_size)
    states = state_coverage(hospitals, covered)
    lost = unattributed(sources, hospitals)
    matches = probable(lost, gaps)
    recoverable = matches.dropDuplicates(["source_file"]).agg(F.coalesce(F.sum("charge_count"), F.lit(0)).alias("recoverable_rows"))
    facts = states.agg(F.sum("total").alias("hospitals"), F.sum("covered").alias("covered"), F.sum("remaining").alias("remaining"), F.count_if("not_started").alias("states_not_started"))
    return {
        "systems": clusters.orderBy(F.desc("already_publishing"), F.desc("remaining"), "system"),
        "independents": independents(gaps, clusters).withColumn("search", search_url(F.col("name"), F.col("city"), F.col("state"))).orderBy("state", "name", "ccn"),
        "coverage": states.orderBy("pct", "state"),
        "unattributed": lost.orderBy(F.desc("charge_count"), "source_file"),
        "probable": matches.orderBy(F.desc("charge_count"), F.desc("score"), "source_file", "ccn"),
        "totals": beside(facts, recoverable),
    }
