"""Raw CSVs as strings, and columns found by any of their known spellings."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_strings(spark: SparkSession, path: str | list[str], **options: str) -> DataFrame:
    """A CSV with a header; every column a string, names trimmed and upper-cased."""
    raw = spark.read.option("header", True).options(**options).csv(path)
    return raw.toDF(*[c.replace("﻿", "").strip().upper() for c in raw.columns])


def spelled(name: str) -> str:
    return re.sub(r"[^A-Z0-9]+", "_", name.upper()).strip("_")


def pick(df: DataFrame, candidates: list[str], required: bool = True) -> Column:
    """The first known spelling that ``df`` has; null where none is and none is needed."""
    have = {spelled(c): c for c in reversed(df.columns)}
    for name in candidates:
        if spelled(name) in have:
            return F.col(f"`{have[spelled(name)]}`")
    if required:
        raise ValueError(f"none of {', '.join(candidates)} among the columns {', '.join(df.columns)}")
    return F.lit(None).cast("string")


def resolve(df: DataFrame, spellings: dict[str, list[str]], required: tuple[str, ...] = ()) -> DataFrame:
    return df.select(*[pick(df, names, key in required).alias(key) for key, names in spellings.items()])
