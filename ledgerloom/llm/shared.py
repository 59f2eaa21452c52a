"""What several training-data operators need: shared tables and components."""

from __future__ import annotations

import tempfile
import uuid
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where it is unset a temporary folder serves, but only in local mode, where one
    machine runs everything.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    root = "file://" + tempfile.mkdtemp(prefix="ledgerloom-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def cut(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    The written table ends the lineage: a lost executor costs no recomputation of
    what lies before, and no replica on one machine is needed.
    """
    path = f"{shared_dir(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_defaults(df: DataFrame, carry: bool = False, **kinds: str) -> DataFrame:
    """Only the named columns, cast; extra columns of the caller never clash.

    With ``carry`` the caller's whole row goes along as the struct ``whole``.
    """
    cols = [F.col(f"`{name}`").cast(kind).alias(name) for name, kind in kinds.items()]
    return df.select(*cols, *([F.struct("*").alias("whole")] if carry else []))


def carried(df: DataFrame, schema: str) -> str:
    """``schema`` with the struct ``whole`` if ``df`` has it."""
    return schema + (f", whole {df.schema['whole'].dataType.simpleString()}" if "whole" in df.columns else "")


def passed_on(batch: pa.RecordBatch, lo: int, n: int, arrays: list, names: list[str]) -> pa.RecordBatch:
    """A result batch for rows lo to lo + n, with their ``whole`` where there is one."""
    if "whole" in batch.schema.names:
        arrays, names = [*arrays, batch.column("whole").slice(lo, n)], [*names, "whole"]
    return pa.RecordBatch.from_arrays(arrays, names)


def components(edges: DataFrame, most_rounds: int = 64) -> DataFrame:
    """Connected components of ``edges(a long, b long)`` as ``(node, root)``.

    Random-mate contraction: in each round every node points to the neighbour (or
    itself) with the smallest hash for that round, edges move to the targets, and
    loops and repeats go.  The expected number of nodes falls by a constant factor a
    round, whatever the shape, so rounds grow with the logarithm of the nodes.  The
    grouping is a partial minimum and the joins are plain equi-joins that AQE can
    split, so a node with very many neighbours needs no task of its own.  Isolated
    nodes are not returned.  ``root`` is some member of the component.
    """
    spark = edges.sparkSession
    edges = cut(edges.where("a <> b").selectExpr("least(a, b) as a", "greatest(a, b) as b").distinct(), "edges")
    maps = []
    for turn in range(most_rounds):
        if edges.isEmpty():
            break
        both = edges.select("a", "b").unionByName(edges.selectExpr("b as a", "a as b"))
        rank = lambda c: F.xxhash64(F.col(c), F.lit(turn))
        best = both.groupBy("a").agg(F.min(F.struct(rank("b").alias("h"), F.col("b").alias("node"))).alias("m"))
        goal = F.when(F.col("m.h") < rank("a"), F.col("m.node")).otherwise(F.col("a"))
        step = cut(best.select(F.col("a").alias("node"), goal.alias("goal")), "contract")
        maps.append(step)
        moved = edges.join(step.selectExpr("node as a", "goal as ga"), "a").join(step.selectExpr("node as b", "goal as gb"), "b")
        moved = moved.where("ga <> gb").selectExpr("least(ga, gb) as a", "greatest(ga, gb) as b").distinct()
        edges = cut(moved, "edges")
    else:
        raise RuntimeError("components did not settle")
    if not maps:
        return spark.createDataFrame([], "node long, root long")

    def follow(found: DataFrame, step: DataFrame) -> DataFrame:
        later = step.selectExpr("node as root", "goal")
        return found.join(later, "root", "left").select("node", F.coalesce("goal", "root").alias("root"))

    return reduce(follow, maps[1:], maps[0].selectExpr("node", "goal as root"))
