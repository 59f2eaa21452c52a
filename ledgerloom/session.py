"""A session with the settings that the library relies on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",  # of repeated header names the last counts
}


def session(app: str = "ledgerloom", **more: str) -> SparkSession:
    """The running session, or a new one; ``more`` are further settings."""
    return SparkSession.builder.appName(app).config(map=SETTINGS | more).getOrCreate()


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new folder for files that driver and executors share, below ``spark.checkpoint.dir``.

    Where that is unset a temporary folder serves, but only in local mode, where one
    machine runs everything."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="ledgerloom-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as Parquet in a new shared folder, read back: what is read more than once is
    worked out once, and a lost executor costs nothing that lies before it."""
    path = shared_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
