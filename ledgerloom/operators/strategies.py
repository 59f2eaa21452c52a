"""Implementation strategies: needs in sequence, costed commitments, printed totals.

A document is one row, its lines an array.  Which headings count depends on the headings
before them, which is one fold over the few lines that may be headings; everything else
looks at a line by itself, so no line is shuffled and nothing leaves the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import empty_to_null
from .community import DECLINE, dekern

# Verbs that make a sum a promise, phrases that make it a fact.
COMMITTING = (
    "contribute", "fund", "funding", "provide", "subsidize", "subsidise", "invest", "allocate", "commit", "donate",
    "sponsor", "support", "purchase", "pay for", "cover the cost",
)
DESCRIPTIVE = (
    "per capita", "median", "average income", "household income", "poverty", "cost of living", "unemployment",
    "revenue", "budget deficit",
)
# Shapes of lines.
COST = r"(?:(Ongoing|\d{4}(?:\s*[-–]\s*Year\s*\d+)?)\s+)?(\d{1,4})?\s*\$\s?([\d,]+)\s*$"
TOTAL = r"(?iU)\b(?:overall\s+)?total\s+contributions?\b.*?(\d{1,5})\s+\$\s?([\d,]+)"
HEADING = r"(?U)^(\d{1,2})\s+([A-Z][A-Za-z0-9 ,&()/'’.-]{3,70}?)(?:\s+([a-z])(?:\s+[A-Z].*)?)?$"
NUMBER = r"^(\d{1,2})$"
TACTIC_BEGINS = r"(?U)^\s*[a-z]\s"
TACTIC = r"(?U)^([a-z])\s+[A-Z]"
MONEY = r"(?U)\$\s?([\d,]+(?:\.\d{2})?)"
FISCAL = r"(?iU)\bFY\s?(20\d{2})\b"
LINE_END = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"
#: Lines that a label may take up below its number; letters of a row that describes something.
LABEL_LINES, WORDY = 4, 12


def _any_of(words: tuple[str, ...]) -> str:
    return "|".join(words)


def promises(line: Column) -> Column:
    """Whether a line with money promises it."""
    low = F.lower(line)
    return low.rlike(_any_of(COMMITTING)) & ~low.rlike(_any_of(DESCRIPTIVE))


def _one_space(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)\s+", " ")


def _whole(c: Column) -> Column:
    return F.translate(c, ",", "").try_cast("decimal(38,2)").cast("long")


def marked_lines(docs: DataFrame) -> DataFrame:
    """``(source_file, x, n, stops)``: the lines of each document that are not blank, what
    each may be, and the places of those that end a label."""

    def mark(raw: Column, at: Column) -> Column:
        text = F.regexp_replace(raw, r"(?U)^\s+|\s+$", "")
        money, alone = text.rlike(MONEY), text.rlike(NUMBER)
        named = ~money & text.rlike(HEADING)
        number = F.when(alone | named, F.regexp_extract(text, r"^(\d{1,2})", 1).cast("int"))
        return F.struct(at.alias("at"), text.alias("text"), money.alias("money"), alone.alias("alone"), number.alias("number"), (money | alone | raw.rlike(TACTIC_BEGINS)).alias("stop"))

    raw = F.filter(F.split(dekern(F.coalesce("text", F.lit(""))), LINE_END), lambda c: c.rlike(r"(?U)\S"))
    lines = docs.select("source_file", F.transform(raw, mark).alias("x"))
    return lines.select("source_file", "x", F.size("x").alias("n"), F.transform(F.filter("x", lambda e: e["stop"]), lambda e: e["at"]).alias("stops"))


def with_headings(marked: DataFrame) -> DataFrame:
    """``marked`` with ``heads``: the accepted headings in order, so the need of rank k is
    the k-th of them, with its place and the last line of its label.

    A heading counts only if it has the next number.  A bare number counts only after a
    heading with a label, and takes the lines below as its label: at most four, up to the
    next number, tactic or sum."""
    place = "at int, until int"
    start = F.struct(F.lit(False).alias("labelled"), F.expr(f"cast(array() as array<struct<{place}>>)").alias("heads"))

    def step(state: Column, line: Column) -> Column:
        taken = state["heads"]
        inside = F.coalesce(F.try_element_at(taken, F.lit(-1))["until"] >= line["at"], F.lit(False))
        fits = ~inside & (line["number"] == F.size(taken) + 1) & (state["labelled"] | ~line["alone"])
        end = F.coalesce(F.array_min(F.filter("stops", lambda k: k > line["at"])), F.col("n")) - 1
        until = F.when(line["alone"], F.least(end, line["at"] + LABEL_LINES)).otherwise(line["at"])
        head = F.struct(line["at"].alias("at"), until.cast("int").alias("until"))
        return F.when(fits, F.struct((state["labelled"] | ~line["alone"]).alias("labelled"), F.array_append(taken, head).alias("heads"))).otherwise(state)

    able = F.filter("x", lambda e: e["number"].isNotNull())
    return marked.withColumn("heads", F.aggregate(able, start, step)["heads"])


def strategy_rows(docs: DataFrame) -> DataFrame:
    """Needs, commitments and printed totals of every document, in one table.

    ``docs(source_file, text)``; null and empty texts give no rows.  ``line`` counts the
    lines that are not blank.  A label that the text ends in names no need."""
    found = with_headings(marked_lines(docs))
    own = lambda h: F.get("x", h["at"])["text"]
    below = lambda h: F.array_join(F.transform(F.slice("x", h["at"] + 2, h["until"] - h["at"]), lambda e: e["text"]), " ")
    label = lambda h: F.when(F.get("x", h["at"])["alone"], F.when(h["until"] < F.col("n") - 1, below(h))).otherwise(F.regexp_extract(own(h), HEADING, 2))
    needs = F.filter(F.transform("heads", lambda h, k: F.struct(F.lit("need").alias("kind"), (k + 1).alias("need_rank"), h["at"].alias("line"), label(h).alias("text"))), lambda e: e["text"] != "")
    rank = lambda e: F.nullif(F.size(F.filter("heads", lambda h: h["at"] < e["at"])), F.lit(0))
    sums = F.transform(F.filter("x", lambda e: e["money"]), lambda e: F.struct(F.when(e["text"].rlike(TOTAL), "total").otherwise("commitment").alias("kind"), rank(e).alias("need_rank"), e["at"].alias("line"), e["text"].alias("text")))
    each = found.select("source_file", F.explode(F.concat(needs, sums)).alias("e")).select("source_file", "e.*")

    t, kind = F.col("text"), F.col("kind")
    cost = lambda k: empty_to_null(F.regexp_extract(t, "(?iU)" + COST, k))
    before = F.regexp_replace(F.regexp_extract(t, "(?isU)^(.*?)" + COST, 1), r"[^\p{L}]", "")
    listed = cost(3).isNotNull() & (cost(1).isNotNull() | cost(2).isNotNull() | ((F.length(before) >= WORDY) & promises(t)))
    rows = each.withColumn("tabulated", F.when(kind == "commitment", listed).otherwise(False))
    rows = rows.where((kind != "commitment") | F.col("tabulated") | promises(t))
    total = lambda k: F.regexp_extract(t, TOTAL, k)
    table = F.col("tabulated")
    years = F.array_sort(F.array_distinct(F.regexp_extract_all(t, F.lit(FISCAL), F.lit(1))))
    return rows.select(
        "source_file", "kind", "line", "need_rank", F.when(table, empty_to_null(F.regexp_extract(t, TACTIC, 1))).alias("letter"),
        F.when(kind == "need", F.regexp_replace(_one_space(t), "^[ ,]+|[ ,]+$", "")).otherwise(_one_space(t)).alias("text"),
        F.when(table, F.trim(cost(1))).alias("timeframe"), F.when(kind == "total", _whole(total(1))).when(table, _whole(cost(2))).cast("int").alias("hours"),
        F.when(kind == "total", _whole(total(2))).when(table, _whole(cost(3))).when(kind == "commitment", _whole(F.regexp_extract(t, MONEY, 1))).alias("dollars"),
        F.when(kind == "commitment", years).otherwise(F.array().cast("array<string>")).alias("fiscal_years"), "tabulated",
    )


def roll_up(rows: DataFrame) -> DataFrame:
    """Committed dollars and hours of each document against its printed total, the last
    where there are several.

    ``reconciles`` is null where nothing is printed."""
    mine, printed = F.col("kind") == "commitment", F.when(F.col("kind") == "total", F.col("line"))
    out = rows.groupBy("source_file").agg(
        F.count_if(F.col("kind") == "need").alias("needs"),
        F.count_if(mine).alias("commitments"),
        F.coalesce(F.sum(F.when(mine, F.col("dollars"))), F.lit(0)).alias("committed_dollars"),
        F.coalesce(F.sum(F.when(mine, F.col("hours"))), F.lit(0)).alias("committed_hours"),
        F.max_by("dollars", printed).alias("stated_dollars"),
        F.max_by("hours", printed).alias("stated_hours"),
    )
    return out.withColumn("reconciles", F.col("committed_dollars") == F.col("stated_dollars"))


def declines(docs: DataFrame) -> DataFrame:
    return docs.select("source_file", F.regexp_count(F.coalesce("text", F.lit("")), F.lit(DECLINE)).alias("declines"))
