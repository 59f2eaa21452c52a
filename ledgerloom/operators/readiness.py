"""Scores of a readiness assessment: items, dimensions, indexes, placement, targets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import round_half_up

LOW, HIGH = 1.0, 5.0
SELF_WEIGHT, OBJECTIVE_WEIGHT = 0.7, 0.3
GATE_DIMENSION, GATE_SCORE, TARGETS = "D4", 50, 2
#: Items of a questionnaire, which is a parameter: more is an error.
MOST_ITEMS = 1000


def item_score(kind: Column, value: Column, correct: Column) -> Column:
    """An answer on the scale 1 to 5: a scenario is right or wrong, a ladder of 1 to 4 is
    stretched, a Likert answer is held inside the scale; null where nothing is said."""
    number = value.try_cast("double")
    chosen = F.exists(correct, lambda k: F.upper(k) == F.upper(F.trim(value)))
    scenario = F.when(number.isNotNull(), F.when(number >= HIGH, HIGH).otherwise(LOW)).otherwise(F.when(chosen, HIGH).when(F.trim(value) != "", LOW))
    return F.when(kind == "scenario", scenario).when(kind == "ladder", 1 + (number - 1) * 4 / 3).when(number.isNotNull(), F.least(F.lit(HIGH), F.greatest(F.lit(LOW), number)))


def scored_items(responses: DataFrame, items: DataFrame) -> DataFrame:
    """Every item of every respondent with its score, null where N/A or unanswered.

    ``responses(respondent, item, value string, na boolean)``; ``items(item, dimension,
    kind, objective boolean, correct array<string>)``, at most ``MOST_ITEMS``.
    """
    listed = [r[0] for r in items.select("item").distinct().orderBy("item").limit(MOST_ITEMS + 1).collect()]
    if len(listed) > MOST_ITEMS:
        raise ValueError(f"a questionnaire has at most {MOST_ITEMS} items")
    people = responses.select("respondent").distinct()
    asked = people.select("respondent", F.explode(F.array(*map(F.lit, listed)).cast("array<string>")).alias("item"))
    said = responses.select("respondent", "item", "value", "na")
    rows = asked.join(said, ["respondent", "item"], "left").join(items, "item")
    value = F.when(F.coalesce("na", F.lit(False)), F.lit(None)).otherwise(F.col("value"))
    return rows.select("respondent", "item", "dimension", "objective", item_score(F.col("kind"), value, F.col("correct")).alias("score"))


def dimension_scores(scored: DataFrame) -> DataFrame:
    """Mean of each dimension: self-report and objective items are blended 70 to 30 where
    both exist; more than half missing makes a dimension insufficient."""
    own, facts = F.avg(F.when(~F.col("objective"), F.col("score"))), F.avg(F.when(F.col("objective"), F.col("score")))
    out = scored.groupBy("respondent", "dimension").agg(own.alias("own"), facts.alias("facts"), F.count("score").alias("answered"), F.count("*").alias("total"))
    raw = F.when(F.col("own").isNotNull() & F.col("facts").isNotNull(), SELF_WEIGHT * F.col("own") + OBJECTIVE_WEIGHT * F.col("facts")).otherwise(F.coalesce("own", "facts"))
    return out.select("respondent", "dimension", F.round(raw, 6).alias("raw"), round_half_up(F.round((raw - LOW) / (HIGH - LOW) * 100, 6)).cast("int").alias("score"), ((F.col("answered") == 0) | (F.col("total") - F.col("answered") > F.col("total") / 2)).alias("insufficient"), "answered", "total")


def indexes(scores: DataFrame, dimensions: DataFrame) -> DataFrame:
    """``ici`` (weighted mean of individual dimensions over the weights available) and
    ``oei`` (the organisational one).  ``dimensions(dimension, axis, weight,
    prerequisite_rank)``."""
    rows = scores.join(dimensions, "dimension")
    mine = (F.col("axis") == "individual") & F.col("score").isNotNull()
    ici = F.try_divide(F.sum(F.when(mine, F.col("weight") * F.col("score"))), F.sum(F.when(mine, F.col("weight"))))
    oei = F.max(F.when(F.col("axis") == "organizational", F.col("score")))
    gate = F.max(F.when((F.col("dimension") == GATE_DIMENSION) & (F.col("score") < GATE_SCORE), 1).otherwise(0)) == 1
    return rows.groupBy("respondent").agg(round_half_up(F.round(ici, 6)).cast("int").alias("ici"), oei.alias("oei"), gate.alias("gated"))


def placed(index: DataFrame, ici_threshold: float = 60, oei_threshold: float = 60) -> DataFrame:
    """Placement by both indexes, thresholds included; a failed governance gate lowers
    ``frontier`` to ``emergent``."""
    high, org = F.coalesce(F.col("ici") >= ici_threshold, F.lit(False)), F.coalesce(F.col("oei") >= oei_threshold, F.lit(False))
    plain = F.when(high & org, "frontier").when(high, "blocked_agency").when(org, "emergent").otherwise("early")
    out = index.withColumn("placement_ungated", plain)
    return out.withColumn("placement", F.when(F.col("gated") & (plain == "frontier"), "emergent").otherwise(plain))


def targets(scores: DataFrame, dimensions: DataFrame) -> DataFrame:
    """At most two dimensions to work on: the gated one, then those below 50 in order of
    prerequisites, then the lowest."""
    rows = scores.join(dimensions.where("axis = 'individual'"), "dimension").where("score is not null and not insufficient")
    low = F.col("score") < GATE_SCORE
    forced = (F.col("dimension") == GATE_DIMENSION) & low
    rank = F.coalesce("prerequisite_rank", F.lit(99))
    order = Window.partitionBy("respondent").orderBy(F.when(forced, 0).when(low, 1).otherwise(2), F.when(low, rank).otherwise(F.col("score")), rank, "dimension")
    return rows.withColumn("place", F.row_number().over(order)).where(F.col("place") <= TARGETS).select("respondent", "place", "dimension", "score")


def readiness(responses: DataFrame, items: DataFrame, dimensions: DataFrame, ici_threshold: float = 60, oei_threshold: float = 60) -> dict[str, DataFrame]:
    scores = dimension_scores(scored_items(responses, items))
    return {"dimensions": scores, "placements": placed(indexes(scores, dimensions), ici_threshold, oei_threshold), "targets": targets(scores, dimensions)}
