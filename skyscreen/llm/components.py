"""Connected components of a graph of any size, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, files_for, scratch, stored


def _star(edges: DataFrame, large: bool, files: int) -> DataFrame:
    """Each node hands its larger (large star) or smaller (small star) neighbours on to the smallest node it sees.

    The smallest nodes are stored, so that the join can split a hot node.
    """
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    if large:
        both = down.unionByName(down.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = stored(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "cc-least", files)
        return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    least = stored(down.groupBy("a").agg(F.min("b").alias("m")), "cc-least", files)
    handed = down.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return handed.unionByName(least.select("a", F.col("m").alias("b")))


def _settled(edges: DataFrame) -> bool:
    """Whether every node points at one other, which points at none."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("into")).unionByName(edges.select(F.col("b").alias("node"), F.lit(0).alias("out"), F.lit(1).alias("into")))
    nodes = ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
    return nodes.where((F.col("out") > 1) | ((F.col("out") == 1) & (F.col("into") == 1))).isEmpty()


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, label`` for every node of ``edges`` (a, b), each once: the label is the smallest node of its component.

    Null ends and loops are ignored; without edges there are no nodes. Every round is written to the shared folder, where only
    the last one stays, and ends with a look whether the graph is one of stars.
    """
    spark = edges.sparkSession
    now = stored(edges.select("a", "b").where("a is not null and b is not null and a <> b"), "cc")
    files, large = files_for(now.count()), False
    while True:
        with scratch(spark) as block:
            after = _star(_star(now, True, files), False, files) if large else _star(now, False, files)
            after = block.keep(stored(after.distinct(), "cc", files))
        discard(spark, now._stored_at)
        now, large = after, True
        if _settled(now):
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
