"""Prices of one billing code: spread, payers, usual description."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import beside
from ..functions.text import empty_to_null
from . import ranks

UNNAMED = "(unnamed)"
MEASURES = ("gross", "cash", "negotiated")


def matching(charges: DataFrame, sources: DataFrame, hospitals: DataFrame, code: str | None = None, state: str | None = None, payer: str | None = None, linked_only: bool = True) -> DataFrame:
    """Charge rows of a code with their file's hospital.

    A state filter asks for the hospital's state, so files without a hospital drop out;
    without it, ``linked_only=False`` keeps them.  ``payer`` is a case-insensitive
    pattern part, in which % and _ are wild.
    """
    rows = charges if code is None else charges.where(F.col("code") == code)
    if payer:
        rows = rows.where(F.col("payer_name").ilike(f"%{payer}%"))
    rows = rows.join(sources.select("source_file", "ccn"), "source_file")
    known = hospitals.select("ccn", "state")
    if state:
        return rows.join(known.where(F.col("state") == state), "ccn")
    return rows.join(known, "ccn", "inner" if linked_only else "left")


def positive(c: Column | str) -> Column:
    """A price, or null: zero and below are placeholders."""
    x = F.col(c) if isinstance(c, str) else c
    return F.when(x > 0, x.cast("double"))


QUARTILES = {"p25": 0.25, "median": 0.5, "p75": 0.75}


def spread(rows: DataFrame, *by: str) -> DataFrame:
    """Rows, hospitals, and count, quartiles and extremes of each measure.

    Quartiles come from counts of equal prices, written once, so a code with very many
    prices is not gathered in one task."""
    measures = dict(zip(MEASURES, ("gross_charge", "discounted_cash", "negotiated_dollar"), strict=True))
    total = rows.groupBy(*by).agg(F.count("*").alias("charge_rows"), F.count_distinct(F.coalesce("ccn", "source_file")).alias("hospitals"))
    keys = list(by)
    number = {name: k for k, name in enumerate(measures)}  # a small key sorts faster than a name
    each = F.explode(F.array(*[F.struct(F.lit(number[name]).cast("byte").alias("measure"), positive(c).alias("v")) for name, c in measures.items()]))
    prices = rows.select(*keys, each.alias("e")).select(*keys, "e.measure", "e.v")
    found = ranks.quantiles(ranks.counted(prices, [*keys, "measure"], F.col("v")), [*keys, "measure"], QUARTILES)
    of = lambda name, c: F.max(F.when(F.col("measure") == number[name], F.col(c)))
    wide = found.groupBy(*keys).agg(
        *[F.coalesce(of(name, "n"), F.lit(0)).alias(f"{name}_count") for name in measures], *[F.round(of(name, q), 4).alias(f"{name}_{q}") for name in measures for q in QUARTILES],
        *[of(name, c).alias(f"{name}_{c}") for name in measures for c in ("min", "max")],
    )
    out = together(total, wide, keys)
    return out.withColumns({f"{name}_count": F.coalesce(f"{name}_count", F.lit(0)) for name in measures})


def together(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of two tables of groups side by side; without keys both have one row."""
    return ranks.joined(left, right, keys, "left") if keys else beside(left, right)


def by_payer(rows: DataFrame, *by: str) -> DataFrame:
    """Count and median of the negotiated prices of each payer."""
    payer = F.coalesce(empty_to_null(F.trim("payer_name")), F.lit(UNNAMED)).alias("payer")
    keys = [*by, "payer"]
    counts = ranks.counted(rows.select(*by, payer, positive("negotiated_dollar").alias("v")), keys, F.col("v"))
    found = ranks.quantiles(counts, keys, {"median": 0.5})
    return found.select(*keys, F.col("n").alias("prices"), F.round("median", 4).alias("median"))


def top_payers(rows: DataFrame, n: int = 10) -> DataFrame:
    return by_payer(rows).orderBy(F.desc("prices"), "payer").limit(n)


def usual_description(rows: DataFrame, *by: str) -> DataFrame:
    """The most frequent description; of equals the first by name."""
    counted = rows.where("description is not null").groupBy(*by, "description").agg(F.count("*").alias("n"))
    best = F.min(F.struct((-F.col("n")).alias("m"), "description"))
    out = counted.groupBy(*by).agg(best.alias("b"))
    return out.select(*by, F.col("b.description").alias("description"), (-F.col("b.m")).alias("rows_with_it"))


def price(charges: DataFrame, sources: DataFrame, hospitals: DataFrame, code: str, **filters) -> dict[str, DataFrame]:
    """The price question: ``spread``, ``payers`` and ``description`` of one code."""
    rows = matching(charges, sources, hospitals, code, **filters)
    return {"spread": spread(rows), "payers": by_payer(rows), "description": usual_description(rows)}
