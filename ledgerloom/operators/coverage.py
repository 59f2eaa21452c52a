"""What is held for hospitals and files that match a name."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import beside
from ..functions.text import word_start


def per_ccn(sources: DataFrame) -> DataFrame:
    return sources.where("ccn is not null").groupBy("ccn").agg(F.count("*").alias("source_count"), F.coalesce(F.sum("charge_count"), F.lit(0)).alias("charge_rows"))


def hospital_coverage(hospitals: DataFrame, sources: DataFrame, pattern: str | None = None, state: str | None = None) -> DataFrame:
    """Hospitals with their files counted; those without any stay, with 0."""
    rows = hospitals
    if pattern:
        rows = rows.where(F.lower("name").contains(pattern.strip().lower()) & word_start(F.col("name"), pattern))
    if state:
        rows = rows.where(F.col("state") == state.upper())
    out = rows.select("ccn", "name", "state").join(per_ccn(sources), "ccn", "left")
    zero = F.lit(0).cast("long")
    return out.select("ccn", "name", "state", F.coalesce("source_count", zero).alias("source_count"), F.coalesce("charge_rows", zero).alias("charge_rows")).withColumn("covered", F.col("source_count") > 0)


def file_classes(sources: DataFrame, pattern: str | None = None) -> DataFrame:
    """Files as ``linked``, ``shared`` (an unlinked copy of a linked sibling's dataset:
    same EIN and row count) or ``missing``."""
    rows = sources.withColumn("charge_count", F.coalesce("charge_count", F.lit(0)))
    linked = rows.where("ccn is not null and ein is not null and charge_count > 0")
    siblings = linked.groupBy("ein", "charge_count").agg(F.min(F.struct("source_file", "ccn")).alias("s"))
    if pattern:
        text = F.concat_ws(" ", "source_file", "hospital_name")
        rows = rows.where(F.lower(text).contains(pattern.strip().lower()) & (word_start(F.col("source_file"), pattern) | F.coalesce(word_start(F.col("hospital_name"), pattern), F.lit(False))))
    out = rows.join(siblings, ["ein", "charge_count"], "left")
    shares = F.col("ccn").isNull() & F.col("s").isNotNull()
    kind = F.when(F.col("ccn").isNotNull(), "linked").when(shares, "shared").otherwise("missing")
    return out.select("source_file", "hospital_name", "ein", "ccn", "charge_count", kind.alias("class"), F.when(shares, F.col("s.source_file")).alias("shares_with"), F.when(shares, F.col("s.ccn")).alias("shares_ccn"))


def class_totals(classes: DataFrame) -> DataFrame:
    return classes.groupBy("class").agg(F.count("*").alias("files"), F.sum("charge_count").alias("charge_rows"))


#: What each state of the coverage means, in a sentence.
SENTENCES = {
    "nothing": "No hospital and no file matches, so look for another name.",
    "no_files": "Hospitals match, but no file of theirs is loaded.",
    "none_linked": "Files match, but none of them is linked to a hospital.",
    "extra_files": "Every hospital has prices; some files beyond them are linked to none.",
    "partly": "Some of the hospitals have prices, others have none.",
    "all": "Every hospital has prices, and every file is linked or a copy of one that is.",
}


def diagnosis(classes: DataFrame, hospitals: DataFrame) -> DataFrame:
    """One row: the counts, one of six states that they mean, and its sentence, over all
    matches.

    ``nothing``, ``no_files``, ``none_linked``, ``extra_files``, ``partly`` or ``all``.
    """
    f = classes.agg(F.count("*").alias("files"), F.count_if(F.col("class") == "linked").alias("linked"), F.count_if(F.col("class") == "missing").alias("missing"))
    h = hospitals.agg(F.count("*").alias("hospitals"), F.count_if("covered").alias("covered"))
    state = (
        F.when(F.expr("files = 0 and hospitals = 0"), "nothing")
        .when(F.expr("files = 0"), "no_files")
        .when(F.expr("linked = 0"), "none_linked")
        .when(F.expr("missing > 0 and covered = hospitals"), "extra_files")
        .when(F.expr("covered < hospitals"), "partly")
        .otherwise("all")
    )
    sentence = F.create_map(*[F.lit(x) for kv in SENTENCES.items() for x in kv])
    return beside(f, h).withColumn("diagnosis", state).withColumn("sentence", F.element_at(sentence, F.col("diagnosis")))


def coverage(hospitals: DataFrame, sources: DataFrame, pattern: str, state: str | None = None, limit: int = 200) -> dict[str, DataFrame]:
    """The coverage question; the state narrows hospitals, the limit only what is listed."""
    known, classes = hospital_coverage(hospitals, sources, pattern, state), file_classes(sources, pattern)
    return {
        "hospitals": known.orderBy("covered", "name", "ccn").limit(limit),
        "files": classes.orderBy(F.desc("charge_count"), "source_file").limit(limit),
        "totals": class_totals(classes),
        "diagnosis": diagnosis(classes, known),
    }
