"""Column functions: cleaning, identifiers, names, ratios.  All run inside the JVM."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def beside(*facts: DataFrame) -> DataFrame:
    """One row with the columns of several one-row tables, by a union and an aggregate."""
    rows = facts[0]
    for more in facts[1:]:
        rows = rows.unionByName(more, allowMissingColumns=True)
    return rows.agg(*[F.max(c).alias(c) for c in rows.columns])
