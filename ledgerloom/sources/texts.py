"""Whole text documents and index pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """``(source_file, text)`` of extracted documents, one row a file."""
    raw = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.txt").text(path, wholetext=True)
    return raw.select(F.col("_metadata.file_name").alias("source_file"), F.col("value").alias("text"))
