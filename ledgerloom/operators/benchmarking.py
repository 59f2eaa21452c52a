"""Peer benchmarks that disclose no peer: rank and rounded quartiles, never extremes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import round_half_up
from . import ranks

MIN_COHORT, MIN_COHORT_FOR_QUARTILES, PRECISION = 5, 11, 2
#: The only cohorts that may be asked for, so that overlapping ones cannot isolate a hospital.
COHORTS = {"state_peer_type": ("state", "provider_subtype"), "national_peer_type": ("provider_subtype",), "state_all": ("state",)}


def cohort(key: str) -> tuple[str, ...]:
    if key not in COHORTS:
        raise ValueError(f"unknown cohort {key!r}; known are {', '.join(COHORTS)}")
    return COHORTS[key]


def _left_out(table: str, place: Column, n: Column, q: float) -> Column:
    """Quantile of the cohort without the value at ``place`` (from 0), where ``table`` has
    the few order statistics around the quantile as a map of place to value."""
    at = (n - 2) * F.lit(q)
    low = F.floor(at).cast("int")
    skip = lambda k: k + F.when(k >= place, 1).otherwise(0)
    pick = lambda k: F.try_element_at(F.col(table), skip(k))
    a = pick(low)
    return a + (at - low) * (F.coalesce(pick(low + 1), a) - a)


def _percent(share: Column) -> Column:
    return F.floor(share * 100 + 0.5).cast("int")


def peer_benchmark(rows: DataFrame, by: tuple[str, ...], value: str = "value", min_cohort: int = MIN_COHORT, min_quartiles: int = MIN_COHORT_FOR_QUARTILES, precision: int = PRECISION) -> DataFrame:
    """Each row against the other rows of its cohort.

    Equal values count half in the rank.  Quartiles leave the row itself out: its place in
    the cohort's order tells which of a few order statistics they interpolate, so no
    cohort is gathered or sorted in one task.  Fewer than ``min_cohort`` peers give nothing;
    fewer than ``min_quartiles`` peers, or peers that are all equal, give a rank only.
    """
    keys = list(by)
    x = F.col(value).cast("double")
    known = rows.where(x.isNotNull() & ~F.isnan(x)).withColumn("_x", x)
    counts = ranks.counted(known, keys, F.col("_x"))
    places = ranks.placed(counts, keys).select(*keys, F.col("x").alias("_x"), F.col("same").alias("_same"), F.col("below").alias("_below"))
    sizes = counts.groupBy(*keys).agg(F.sum("same").alias("_n"), F.count("*").alias("_kinds"))
    wanted = F.array(*[F.floor((F.col("n") - 2) * F.lit(q)) + k for q in (0.25, 0.5, 0.75) for k in (0, 1, 2)])
    marks = ranks.at_places(counts, keys, wanted).groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct(F.col("place").cast("int"), "x"))).alias("_at"))
    out = ranks.joined(ranks.joined(known, places, [*keys, "_x"]), ranks.joined(sizes, marks, keys, "left"), keys)
    peers = F.col("_n") - 1
    rank = _percent((F.col("_below") + (F.col("_same") - 1) / 2) / F.nullif(peers, F.lit(0)))
    place = F.col("_below").cast("int")
    # without the row itself all peers are equal: one value, or two of which the row is one alone
    uniform = (F.col("_kinds") == 1) | ((F.col("_kinds") == 2) & (F.col("_same") == 1))
    state = F.when(peers < min_cohort, "none").when((peers < min_quartiles) | uniform, "rank_only").otherwise("band")
    out = out.withColumn("disclosure", state).withColumn("cohort_size", peers)
    band = lambda q: F.when(F.col("disclosure") == "band", round_half_up(_left_out("_at", place, F.col("_n"), q), precision))
    return out.select(
        *rows.columns, "cohort_size", "disclosure", F.when(F.col("disclosure") != "none", rank).alias("percentile_rank"),
        band(0.25).alias("p25"), band(0.5).alias("p50"), band(0.75).alias("p75"),
    )


def owners(orgs: DataFrame) -> DataFrame:
    """``orgs(org, ccn)`` checked: a CCN of two organisations is an error."""
    twice = orgs.groupBy("ccn").agg(F.count_distinct("org").alias("n")).where("n > 1").limit(1).collect()
    if twice:
        raise ValueError(f"ccn {twice[0][0]} belongs to several organisations")
    return orgs


def org_summary(rows: DataFrame, orgs: DataFrame, org: str, value: str = "value") -> DataFrame:
    """An organisation's own rows whole, each with its position among all rows outside it.

    An organisation without an entry gets nothing."""
    own = owners(orgs).where(F.col("org") == org).select("ccn").distinct()
    mine, others = rows.join(own, "ccn", "left_semi"), rows.join(own, "ccn", "left_anti")
    x = F.col(value).cast("double")
    # one table of values: peers weigh one, own values nothing, so both get their places
    both = others.select(x.alias("v"), F.lit(1).alias("w")).unionByName(mine.select(x.alias("v"), F.lit(0).alias("w"))).withColumn("all", F.lit(True))
    counts = ranks.counted(both, ["all"], F.col("v"), F.col("w"))
    peers = counts.where("same > 0")
    facts = peers.agg(F.coalesce(F.sum("same"), F.lit(0)), F.min("x"), F.max("x")).first()
    quartiles = ranks.quantiles(peers, ["all"], {"p25": 0.25, "p50": 0.5, "p75": 0.75}).first() or {}
    n, total = facts[0], rows.count()
    level = "none" if n < MIN_COHORT else "rank_only" if n < MIN_COHORT_FOR_QUARTILES or facts[1] == facts[2] else "band"
    places = ranks.placed(counts, ["all"]).select(F.col("x").alias("_place"), F.col("same").alias("_same"), F.col("below").alias("_below"))
    found = mine.withColumn("_x", x).join(places, F.col("_x") == F.col("_place"), "left")
    state = F.when(F.col("_same").isNull(), "none").otherwise(level)
    rank = F.when(state != "none", _percent((F.col("_below") + F.col("_same") / 2) / max(n, 1)))
    band = lambda k: F.when(state == "band", round_half_up(F.lit(quartiles[k] if quartiles else None).cast("double"), PRECISION))
    return found.select(*rows.columns, F.lit(total).cast("long").alias("rank_of"), F.lit(n).cast("long").alias("peer_count"), state.alias("disclosure"), rank.alias("percentile_rank"), band("p25").alias("p25"), band("p50").alias("p50"), band("p75").alias("p75"))
