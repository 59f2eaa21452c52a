"""Where hospitals publish their files: targets, index pages, the block of a hospital."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.names import absolute_url, index_urls, jaccard, significant_tokens, site_root
from ..functions.text import empty_to_null, slug

MATCH_THRESHOLD, AMBIGUOUS_ROWS = 0.34, 12
MANIFEST = ("ccn", "name", "state", "status", "mrf_url", "location_name", "score", "website", "note")
FIELD = r"^\s*([A-Za-z][A-Za-z0-9 _-]*?)\s*[:=]\s*(.*)$"


def targets(hospitals: DataFrame, covered: DataFrame, websites: DataFrame, states: list[str] | None = None, include_covered: bool = False) -> DataFrame:
    """Hospitals to look up, with their web site (null where none is known)."""
    rows = hospitals.where(F.col("state").isin(*[s.upper() for s in states])) if states else hospitals
    if not include_covered:
        rows = rows.join(covered, "ccn", "left_anti")
    return rows.select("ccn", "name", "city", "state").join(websites, "ccn", "left").orderBy("state", "name", "ccn")


def target_counts(hospitals: DataFrame, covered: DataFrame, websites: DataFrame) -> DataFrame:
    """One row: hospitals in scope, with data, and without a web site."""
    rows = hospitals.select("ccn").join(covered.select("ccn", F.lit(1).alias("c")), "ccn", "left").join(websites.select("ccn", F.lit(1).alias("w")).distinct(), "ccn", "left")
    return rows.agg(F.count("*").alias("in_scope"), F.count("c").alias("covered"), F.count_if(F.col("c").isNull() & F.col("w").isNull()).alias("no_website"))


def index_blocks(pages: DataFrame) -> DataFrame:
    """Facility blocks of index pages ``pages(url, body)``: a second location-name opens
    the next block; blocks without mrf-url go."""
    body = F.regexp_replace(F.coalesce("body", F.lit("")), r"\r\n?", "\n")
    lines = pages.select("url", F.posexplode(F.split(body, "\n")).alias("line", "raw"))
    key = F.translate(F.lower(F.trim(F.regexp_extract("raw", FIELD, 1))), "_", "-")
    fields = lines.select("url", "line", key.alias("key"), F.trim(F.regexp_extract("raw", FIELD, 2)).alias("value")).where("key <> ''")
    # the first name stays in the first block, so counting starts with the second
    seen = F.sum(F.when(F.col("key") == "location-name", 1).otherwise(0)).over(Window.partitionBy("url").orderBy("line"))
    blocks = fields.withColumn("block", F.greatest(seen - 1, F.lit(0))).groupBy("url", "block")
    last = lambda name: F.max_by(F.when(F.col("key") == name, F.col("value")), F.when(F.col("key") == name, F.col("line")))
    out = blocks.agg(last("mrf-url").alias("mrf_url"), last("location-name").alias("location_name"))
    return out.where("mrf_url <> ''").select("url", "block", "mrf_url", empty_to_null(F.col("location_name")).alias("location_name"))


def match_pages(wanted: DataFrame, pages: DataFrame) -> DataFrame:
    """The manifest: for each hospital the block of its site's index page.

    ``wanted(ccn, name, city, state, website)``, ``pages(url, body)``.  A page's only
    block is taken; else the best name (with or without the city) must score 0.34 and
    beat all others, or be the one tied block that names the city.  Otherwise up to 12
    candidates are listed as ``ambiguous``.
    """
    hospitals = wanted.withColumn("root", site_root("website"))
    asked = hospitals.select("root").distinct().where("root <> ''").select("root", F.posexplode(index_urls(F.col("root"))).alias("rank", "url"))
    blocks = asked.join(index_blocks(pages), "url")
    first = blocks.groupBy("root").agg(F.min("rank").alias("rank"))
    blocks = blocks.join(first, ["root", "rank"]).withColumn("blocks", F.count("*").over(Window.partitionBy("root")))
    rows = hospitals.join(blocks, "root", "left")
    place = significant_tokens("location_name")
    plain = jaccard(significant_tokens("name"), place)
    with_city = F.when(empty_to_null(F.trim("city")).isNotNull(), jaccard(significant_tokens(F.concat_ws(" ", "name", "city")), place))
    rows = rows.withColumn("plain", plain).withColumn("score", F.when(F.col("blocks") == 1, 1.0).otherwise(F.greatest(plain, F.coalesce(with_city, plain))))
    rows = rows.withColumn("in_city", F.coalesce(F.size(F.array_intersect(significant_tokens("city"), place)) > 0, F.lit(False)) & F.col("city").isNotNull())
    w = Window.partitionBy("ccn")
    rows = rows.withColumn("best", F.max("score").over(w))
    rows = rows.withColumn("tied", F.count_if(F.col("score") >= F.col("best") - 1e-9).over(w)).withColumn("tied_here", F.count_if((F.col("score") >= F.col("best") - 1e-9) & F.col("in_city")).over(w))
    top = (F.col("score") >= F.col("best") - 1e-9) & (F.col("best") >= MATCH_THRESHOLD)
    chosen = top & ((F.col("tied") == 1) | ((F.col("tied_here") == 1) & F.col("in_city")))
    found = F.max(chosen.cast("int")).over(w) == 1
    status = F.when(F.col("root") == "", "no_website").when(F.col("mrf_url").isNull(), "no_hpt").when(found, "found").otherwise("ambiguous")
    rows = rows.withColumn("chosen", chosen).withColumn("status", status)
    listed = Window.partitionBy("ccn").orderBy(F.desc("score"), "block")
    rows = rows.withColumn("place", F.row_number().over(listed)).where((F.col("status") != "found") & (F.col("place") <= AMBIGUOUS_ROWS) | F.col("chosen"))
    note = F.when(F.col("status") == "ambiguous", F.format_string("%d facilities share %s", F.col("blocks"), F.col("root"))).when(F.col("status") == "no_hpt", F.concat(F.lit("no readable index at "), F.col("root"))).when(F.col("status") == "no_website", "no website on record").otherwise("")
    score = F.round(F.when(F.col("status") == "ambiguous", F.col("plain")).otherwise(F.col("score")), 3)
    return rows.select("ccn", "name", "state", "status", absolute_url(F.col("mrf_url"), F.col("url")).alias("mrf_url"), "location_name", score.alias("score"), "website", note.alias("note"))


def ready(manifest: DataFrame, include_ambiguous: bool = False) -> DataFrame:
    """Rows to fetch, with the file name to store each under."""
    wanted = ["found", "ambiguous"] if include_ambiguous else ["found"]
    rows = manifest.where(F.col("status").isin(*wanted) & (F.coalesce("mrf_url", F.lit("")) != ""))
    extension = F.coalesce(empty_to_null(F.lower(F.regexp_extract("mrf_url", r"(?i)\.(csv|json|xlsx|zip)(\.gz)?(?:$|[?#])", 1))), F.lit("csv"))
    return rows.withColumn("file_name", F.concat(F.lit("ccn-"), F.col("ccn"), F.lit("_"), slug("name"), F.lit("_standardcharges."), extension))


def manifest_sheet(manifest: DataFrame) -> DataFrame:
    """All columns as strings without nulls, for a CSV."""
    return manifest.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in MANIFEST])
