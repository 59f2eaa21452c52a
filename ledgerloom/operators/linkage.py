"""Links between files and hospitals: prioritised rules, suggestions, reviewed decisions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.names import file_ccn, jaccard, name_key, readable_name, significant_tokens, source_state
from ..functions.text import is_yes

MATCH_FLOOR = 0.3
MANUAL = "manual_review"


def unique_names(hospitals: DataFrame) -> DataFrame:
    """(key, state) with exactly one CCN."""
    rows = hospitals.select("ccn", F.upper("state").alias("state"), name_key("name").alias("key")).where("key <> '' and state is not null")
    return rows.groupBy("key", "state").agg(F.count_distinct("ccn").alias("n"), F.min("ccn").alias("ccn")).where("n = 1").drop("n")


def ambiguous_names(hospitals: DataFrame) -> DataFrame:
    """(key, state) that several CCNs share."""
    rows = hospitals.select("ccn", F.upper("state").alias("state"), name_key("name").alias("key")).where("key <> '' and state is not null")
    return rows.groupBy("key", "state").agg(F.count_distinct("ccn").alias("ccns")).where("ccns > 1")


def known_npis(lists: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """``(npis, ccn)`` of distinct lists of NPIs: by the first that the crosswalk knows.

    A stored crosswalk has one CCN for each NPI; of several the smallest counts."""
    each = lists.select("npis", F.posexplode("npis").alias("pos", "npi"))
    hits = each.join(crosswalk.groupBy("npi").agg(F.min("ccn").alias("npi_ccn")), "npi")
    return hits.groupBy("npis").agg(F.min_by("npi_ccn", "pos").alias("ccn"))


def by_name(sources: DataFrame, hospitals: DataFrame) -> DataFrame:
    named = sources.select("source_file", name_key("hospital_name").alias("key"), source_state(F.col("license_state"), F.col("hospital_address")).alias("state"))
    return named.join(unique_names(hospitals), ["key", "state"]).select("source_file", "ccn")


def link(sources: DataFrame, hospitals: DataFrame, crosswalk: DataFrame, name_fallback: bool = True) -> DataFrame:
    """Sources with ``ccn`` and ``link_method`` by the strongest rule that fits: a stamped
    file name, an NPI of the crosswalk (the listed ones in order, the primary last), a unique
    name in its state.  A reviewed decision stays.

    Each row is linked by what it says itself, so rows that share a file name make no pairs.
    Rows without a stamp or an NPI have a key of their own, so they don't meet in one task."""
    own = F.concat(F.lit("none of "), F.coalesce("source_file", F.lit("")))
    listed = F.array_compact(F.concat(F.coalesce("npis", F.array().cast("array<string>")), F.array("primary_npi")))
    found = sources.withColumns({
        "_stamp": F.coalesce(file_ccn("source_file"), own), "_npis": F.when(F.size(listed) > 0, listed).otherwise(F.array(own)),
        "_key": name_key("hospital_name"), "_state": source_state(F.col("license_state"), F.col("hospital_address")),
    })
    stamps = hospitals.select(F.col("ccn").alias("_a")).distinct()
    npis = known_npis(found.select(F.col("_npis").alias("npis")).distinct(), crosswalk)
    found = found.join(stamps, F.col("_stamp") == F.col("_a"), "left").join(npis.toDF("_npis", "_b"), "_npis", "left")
    if name_fallback:
        found = found.join(unique_names(hospitals).select(F.col("key").alias("_key"), F.col("state").alias("_state"), F.col("ccn").alias("_c")), ["_key", "_state"], "left")
    else:
        found = found.withColumn("_c", F.lit(None).cast("string"))
    kept = F.col("link_method") == MANUAL
    method = F.when(F.col("_a").isNotNull(), "filename_ccn").when(F.col("_b").isNotNull(), "crosswalk_npi").when(F.col("_c").isNotNull(), "name_state")
    out = found.withColumns({"ccn": F.when(kept, F.col("ccn")).otherwise(F.coalesce("_a", "_b", "_c")), "link_method": F.when(kept, F.col("link_method")).otherwise(method)})
    return out.select(sources.columns)


def method_counts(linked: DataFrame) -> DataFrame:
    return linked.groupBy(F.coalesce("link_method", F.lit("unlinked")).alias("link_method")).agg(F.count("*").alias("files"), F.coalesce(F.sum("charge_count"), F.lit(0)).alias("charge_rows"))


def probable(unlinked: DataFrame, gaps: DataFrame, floor: float = MATCH_FLOOR, per_file: int = 3) -> DataFrame:
    """The ``per_file`` likeliest hospitals of each unlinked file.

    ``unlinked(source_file, hospital_name, state, charge_count)``, ``gaps(ccn, name,
    state)``.  Both the name inside a file and the file's own name are tried.  Candidates
    share a telling word, and the state where the file has one.  Names are compared once
    for each distinct (name, state), so repeated names make no pairs.  Two sets of words
    that are alike share one of the rarest words of each, so each set is looked up by its
    rarest words only, as many as the floor needs; the frequent ones pair nothing.
    """
    state = F.coalesce(F.upper("state"), F.lit(""))
    texts = F.array(F.coalesce("hospital_name", F.lit("")), readable_name("source_file"))
    sides = unlinked.select("source_file", state.alias("src_state"), F.explode(texts).alias("text")).select("source_file", "src_state", F.array_sort(significant_tokens("text")).alias("words"))
    left = sides.select("src_state", "words").distinct()
    known = gaps.select("ccn", "name", "state", F.upper("state").alias("gap_state"), F.array_sort(significant_tokens("name")).alias("gap_words"))
    right = known.select("gap_state", "gap_words").distinct()
    each = right.select("gap_state", "gap_words", F.explode("gap_words").alias("word"))
    frequency = left.select(F.explode("words").alias("word")).unionByName(each.select("word")).groupBy("word").agg(F.count("*").alias("n"))
    left_keys = _rarest(left, ["src_state", "words"], "words", frequency, floor)
    right_keys = _rarest(right, ["gap_state", "gap_words"], "gap_words", frequency, floor)
    # the state is part of the key where the file has one
    stated = left_keys.where("src_state <> ''").join(right_keys.withColumn("src_state", F.col("gap_state")), ["word", "src_state"])
    anywhere = left_keys.where("src_state = ''").join(right_keys, "word")
    pairs = stated.unionByName(anywhere)
    scored = pairs.drop("word").distinct().withColumn("score", jaccard(F.col("words"), F.col("gap_words"))).where(F.col("score") >= floor)
    # of hospitals that score alike, the first by CCN count, so a name needs no more than these
    same = Window.partitionBy("gap_state", "gap_words").orderBy("ccn")
    members = known.withColumn("n", F.row_number().over(same)).where(F.col("n") <= per_file).drop("n")
    best = Window.partitionBy("src_state", "words").orderBy(F.desc("score"), "ccn")
    per_class = scored.join(members, ["gap_state", "gap_words"]).withColumn("n", F.row_number().over(best)).where(F.col("n") <= per_file)
    hits = sides.join(per_class.select("src_state", "words", "ccn", "name", "state", "score"), ["src_state", "words"])
    each = hits.groupBy("source_file", "ccn").agg(F.max("score").alias("score"), F.first("name").alias("hospital"), F.first("state").alias("state"), F.first("src_state").alias("src_state"))
    of_file = Window.partitionBy("source_file").orderBy(F.desc("score"), "ccn")
    top = each.withColumn("place", F.row_number().over(of_file)).where(F.col("place") <= per_file)
    out = top.join(unlinked.select("source_file", F.col("hospital_name").alias("file_hospital_name"), "charge_count"), "source_file")
    return out.select("source_file", "place", "ccn", "hospital", "state", F.round("score", 3).alias("score"), (F.col("src_state") != "").alias("same_state"), "file_hospital_name", "charge_count")


def _rarest(classes: DataFrame, key: list[str], words: str, frequency: DataFrame, floor: float) -> DataFrame:
    """Each class with the rarest of its n words, n - ceil(floor * n) + 1 of them: sets with
    a Jaccard similarity of at least ``floor`` share one of both sides' rarest words."""
    rows = classes.select(*key, F.explode(words).alias("word")).join(frequency, "word")
    order = F.array_sort(F.collect_list(F.struct("n", "word")))
    kept = F.size("o") - F.ceil(F.lit(floor) * F.size("o")) + 1
    ranked = rows.groupBy(*key).agg(order.alias("o"))
    return ranked.select(*key, F.explode(F.slice("o", F.lit(1), kept.cast("int"))).alias("e")).select(*key, F.col("e.word").alias("word"))


def suggestions(matches: DataFrame, limit: int | None = None) -> DataFrame:
    """The review sheet of probable matches, largest files first."""
    out = matches.orderBy(F.desc("charge_count"), F.desc("score"), "source_file", "ccn")
    out = out.limit(limit) if limit else out
    return out.select(F.lit("").alias("confirm"), "ccn", "hospital", "state", F.when(F.col("same_state"), "yes").otherwise("no").alias("state_known"), F.col("charge_count").alias("charge_rows"), "score", "source_file", F.coalesce("file_hospital_name", F.lit("")).alias("file_hospital_name"), F.lit("").alias("note"))


def decide(sheet: DataFrame, sources: DataFrame, hospitals: DataFrame, relink: bool = False) -> DataFrame:
    """The status of each reviewed row: skipped, unknown_file, unknown_ccn,
    already_linked or applied, the first that fits."""
    rows = sheet.select(F.trim(F.coalesce("source_file", F.lit(""))).alias("source_file"), F.upper(F.trim(F.coalesce("ccn", F.lit("")))).alias("ccn"), is_yes("confirm").alias("_yes"))
    rows = rows.join(sources.select("source_file", F.col("ccn").alias("_now"), F.lit(True).alias("_file")), "source_file", "left")
    rows = rows.join(hospitals.select("ccn", F.lit(True).alias("_known")).distinct(), "ccn", "left")
    other = F.col("_now").isNotNull() & (F.col("_now") != F.col("ccn")) & F.lit(not relink)
    status = F.when(~F.col("_yes"), "skipped").when(F.col("_file").isNull(), "unknown_file").when(F.col("_known").isNull(), "unknown_ccn").when(other, "already_linked").otherwise("applied")
    return rows.select("source_file", "ccn", status.alias("status"), F.col("_now").alias("previous_ccn"))


def apply_links(sources: DataFrame, decisions: DataFrame) -> DataFrame:
    """Sources with the applied decisions; of several for a file the largest CCN counts."""
    new = decisions.where("status = 'applied'").groupBy("source_file").agg(F.max("ccn").alias("_new"))
    out = sources.join(new, "source_file", "left")
    given = F.col("_new").isNotNull()
    return out.withColumns({"ccn": F.coalesce("_new", "ccn"), "link_method": F.when(given, MANUAL).otherwise(F.col("link_method"))}).select(sources.columns)
