"""Places and order statistics of a column within groups of any size.

Equal values are counted first and written once, ordered by group and value over as many
ranges as the shuffle has partitions, so the ranges of a group grow in number with its
values.  Each range is put in order by itself; the sums of the ranges before give it its
offset.  Of the groups only one can cross the border of two ranges, so the offsets are no
more rows than ranges.  So results are exact, and no group is sorted or gathered in one
task, however large it is."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written

#: The column that numbers the ranges of a table of counts.
PART = "_range"


def _columns(names: list[str]) -> list[Column]:
    return [F.col(f"`{c}`") for c in names]


def counted(rows: DataFrame, by: list[str], value: Column, weight: Column | None = None) -> DataFrame:
    """``(*by, x, same, _range)``: each distinct value as a double with its rows (or
    weights), and the range that it is in.  Nulls and NaN are left out.

    The table is written when this is called, so what reads it does not count again."""
    x = value.cast("double")
    n = F.count("*") if weight is None else F.sum(weight)
    counts = rows.withColumn("x", x).where(F.col("x").isNotNull() & ~F.isnan("x")).groupBy(*_columns(by), "x").agg(n.cast("long").alias("same"))
    return ranged(counts, by)


def ranged(counts: DataFrame, by: list[str]) -> DataFrame:
    """Rows that are counted already, ``(*by, x, same)``, written with their range.  Other
    columns stay, and a group may have rows without a value to be filtered out later."""
    dealt = counts.repartitionByRange(*_columns(by), F.col("x"))
    return written(dealt.withColumn(PART, F.spark_partition_id()), "counts")


def joined(a: DataFrame, b: DataFrame, by: list[str], how: str = "inner") -> DataFrame:
    """A join in which null keys are a group like any other."""
    other = b.select(*[F.col(f"`{c}`").alias(f"_{c}") for c in by], *[c for c in b.columns if c not in by])
    same = reduce(and_, (a[c].eqNullSafe(other[f"_{c}"]) for c in by))
    return a.join(other, same, how).drop(*[f"_{c}" for c in by])


def _ordered(counts: DataFrame, by: list[str]) -> DataFrame:
    """``counts`` with ``below``, the weight of the group's smaller values, and ``n``, the
    weight of the group."""
    sums = counts.groupBy(*_columns(by), PART).agg(F.sum("same").alias("held"))
    own = Window.partitionBy(*_columns(by))
    up_to = F.sum("held").over(own.orderBy(PART))
    crossing = sums.select(
        *_columns(by), PART, (up_to - F.col("held")).alias("before"), F.sum("held").over(own).alias("whole"), F.count("*").over(own).alias("ranges"),
    ).where("ranges > 1").drop("ranges")
    inside = Window.partitionBy(*_columns(by), PART).orderBy("x")
    all_here = inside.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = counts.withColumns({"low": F.sum("same").over(inside) - F.col("same"), "here": F.sum("same").over(all_here)})
    # two rows a border between ranges at most
    found = joined(rows, F.broadcast(crossing), [*by, PART], "left")
    return found.select(
        *_columns(by), "x", "same", (F.col("low") + F.coalesce("before", F.lit(0))).alias("below"), F.coalesce("whole", "here").alias("n"),
    )


def placed(counts: DataFrame, by: list[str]) -> DataFrame:
    """The values of ``counted`` with ``below``: the weight of the group's smaller values."""
    return _ordered(counts, by).drop("n")


def at_places(counts: DataFrame, by: list[str], places: Column) -> DataFrame:
    """``(*by, n, place, x)``: the values at the wanted places (from 0) of each group.

    ``places`` is an array over ``n``, the group's weight; places outside give nothing."""
    own = F.filter(F.array_distinct(places), lambda k: (k >= F.col("below")) & (k < F.col("below") + F.col("same")))
    return _ordered(counts, by).select(*_columns(by), "n", "x", F.explode(own).alias("place"))


def quantiles(counts: DataFrame, by: list[str], qs: dict[str, float]) -> DataFrame:
    """``(*by, n, min, max, *names)``: interpolated quantiles (linear between the two
    nearest values), the weight and the extremes of each group."""
    at = lambda q: (F.col("n") - 1) * F.lit(q)
    ends = [F.lit(0).cast("long"), F.col("n") - 1]
    places = F.array(*ends, *[F.floor(at(q)) + k for q in qs.values() for k in (0, 1)])
    marks = F.map_from_entries(F.collect_list(F.struct("place", "x")))
    rows = at_places(counts, by, places).groupBy(*_columns(by)).agg(F.max("n").alias("n"), F.min("x").alias("min"), F.max("x").alias("max"), marks.alias("marks"))

    def value(q: float) -> Column:
        low = F.try_element_at("marks", F.floor(at(q)))
        return low + (at(q) - F.floor(at(q))) * (F.coalesce(F.try_element_at("marks", F.floor(at(q)) + 1), low) - low)

    return rows.select(*_columns(by), "n", "min", "max", *[value(q).alias(name) for name, q in qs.items()])
