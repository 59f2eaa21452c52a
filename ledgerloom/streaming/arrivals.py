"""Incremental ingest of charge rows that land as files in a folder.

A file stream with a checkpoint takes each file once; each micro-batch replaces its
files' rows in the store.  Files that gave no rows come back from the outcome ledger, not
from the stream, so they can be tried again."""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.store import latest
from ..sources import batch as files
from ..sources import charges

#: A row for each file and try; the newest says what holds.
LEDGER = "source_file string, status string, rows long, reason string, tried_at timestamp"


def arrivals(spark: SparkSession, path: str, schema: str, kind: str = "parquet") -> DataFrame:
    """A stream of the rows of files that land below ``path``, with their file's name."""
    rows = spark.readStream.schema(schema).format(kind).option("recursiveFileLookup", True).load(path)
    return rows.withColumn("arrived_in", F.col("_metadata.file_name"))


def replace_files(target: str, bucket: int = 64) -> Callable[[DataFrame, int], None]:
    """A batch function that overwrites the partitions of the batch's files only.

    Facts are partitioned by file bucket and file; dynamic overwrite touches no other."""

    def run(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumn("bucket", F.pmod(F.xxhash64("source_file"), F.lit(bucket)))
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket", "source_file").parquet(target)

    return run


def ingest_available(stream: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Take all files that have landed since the last run, then stop."""
    query = stream.writeStream.foreachBatch(replace_files(target)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The newest outcome of every file, ``LEDGER``; empty before the first run."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not root.getFileSystem(spark._jsc.hadoopConfiguration()).exists(root):
        return spark.createDataFrame([], LEDGER)
    return latest(spark.read.schema(LEDGER).parquet(path), ["source_file"], "tried_at")


def take(listed: DataFrame, target: str, ledger: str, scratch: str, range_bytes: int = files.RANGE_BYTES) -> None:
    """Load the charge files of ``listed(path, source_file, size)``: read each once, replace its
    facts below ``target``, then add its outcome to ``ledger``.

    A run that is ended before the outcome is written is taken again, with the same facts."""
    if listed.isEmpty():
        return
    at = f"{scratch.rstrip('/')}/{uuid4().hex}"
    listed.write.parquet(f"{at}/listed")
    held = listed.sparkSession.read.parquet(f"{at}/listed")
    staged = files.stage_listed(held, f"{at}/read", range_bytes)
    lines, raw = files.lines(staged), files.nested(staged)
    heads = charges.headers(lines)
    facts = charges.charges(lines, heads).unionByName(charges.json_charges(raw))
    replace_files(target)(facts, 0)
    headed = heads.select("source_file").unionByName(raw.where(charges.is_charge_file()).select("source_file"))
    stored = facts.withColumn("bucket", F.lit(0)).schema  # given, since there may be no facts yet
    loaded = held.sparkSession.read.schema(stored).parquet(target).select("source_file").join(held.select("source_file").distinct(), "source_file", "left_semi")
    done = files.ledger(held, staged, headed, loaded)
    done.withColumn("tried_at", F.current_timestamp()).write.mode("append").parquet(ledger)


def load_arrived(spark: SparkSession, landing: str, target: str, ledger: str, checkpoint: str, scratch: str, range_bytes: int = files.RANGE_BYTES) -> DataFrame:
    """Load the charge files that have landed since the last run, and those whose last try gave
    no rows; the ledger after it.

    A stream of names brings each path once, so a file that is replaced under its name comes
    from the ledger: any file that lies there now and is not ``loaded`` is tried again, those
    of no bytes as soon as they have some.  Loaded files are not read again.  Names of files
    are those of their ends: a name that lands in two folders is one file."""
    stream = files.named(spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").option("recursiveFileLookup", True).load(landing))
    run = lambda rows, _: take(rows, target, ledger, scratch, range_bytes)
    at = f"{scratch.rstrip('/')}/{uuid4().hex}"
    read_ledger(spark, ledger).where("status <> 'loaded'").select("source_file").write.parquet(at)
    tried = spark.read.parquet(at)  # as it is before the new files
    stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    now, known = files.files(spark, landing), read_ledger(spark, ledger).select("source_file")
    again = now.join(tried, "source_file", "left_semi").unionByName(now.join(known, "source_file", "left_anti"))
    take(again, target, ledger, scratch, range_bytes)
    return read_ledger(spark, ledger)
