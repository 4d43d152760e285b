"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geosieve.sources.scratch import Scratch


def components(scratch: Scratch, edges: DataFrame, rows: int | None = None) -> DataFrame:
    """(node, root): each node of the edges (a, b), roots excepted, with its component's smallest node.

    A step is a grouped minimum and a join, so a node with very many edges is
    split as any skewed key, and each step is written to the shared folder, so
    a lost executor costs one step at most. ``rows`` is about how many edges
    there are, if known.
    """
    now = scratch.keep(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct(), rows)
    state = lambda e: tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
    was = state(now)
    while was[0]:
        both = now.union(now.select("v", "u")).toDF("x", "y")
        low = both.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m"))
        large = both.where("y > x").join(low, "x").select(F.col("y").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.toDF("u", "v"))
        new = scratch.keep(small.distinct(), was[0])
        scratch.drop(now)
        is_, now = state(new), new
        if is_ == was:
            break
        was = is_
    return now.toDF("node", "root")


def labelled(scratch: Scratch, nodes: DataFrame, edges: DataFrame, key: str) -> DataFrame:
    """nodes with component, the smallest key that edges (a, b) reach from theirs."""
    roots = components(scratch, edges).toDF(key, "component")
    return nodes.join(roots, key, "left").withColumn("component", F.coalesce("component", key))
