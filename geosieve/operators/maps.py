"""Differences of two maps and grafts between them, on placemarks as rows (folder, name, parts).

A mark is known by its folder's path and its name; marks that share both are a bag, compared
by how often each geometry is in it, so names that repeat without end cost sums, not lists.
Geometries are the same when their coordinates agree to six decimals in order. A null
folder or name is empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAME, DIFFERS, ONLY_A, ONLY_B = "same", "differs", "only in a", "only in b"


def geometry_digest(parts: Column, style: Column | str | None = None) -> Column:
    """A digest of all rings' vertices, arrays of struct(lng, lat), to six decimals, and of a style."""
    number = lambda c: F.format_string("%.6f", F.round(c, 6) + F.lit(0.0))  # noqa: E731 (0.0 has one sign)
    ring = lambda r: F.array_join(F.transform(r, lambda v: F.concat_ws(",", number(v["lng"]), number(v["lat"]))), " ")
    rings = F.array_join(F.transform(F.flatten(F.coalesce(parts, F.array())), ring), "|")
    return F.md5(F.concat_ws("||", rings, F.coalesce(style, F.lit("")) if style is not None else F.lit("")))


def _both(a: DataFrame, b: DataFrame) -> DataFrame:
    """(folder, name, digest, a, b): how often each geometry has that path and name on either side."""
    def side(df: DataFrame, in_a: int) -> DataFrame:
        style = F.col("style") if "style" in df.columns else None
        return df.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("folder", "name")], geometry_digest(F.col("parts"), style).alias("digest"), F.lit(in_a).alias("a"), F.lit(1 - in_a).alias("b"))

    return side(a, 1).union(side(b, 0)).groupBy("folder", "name", "digest").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))


def map_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """(folder, name, in_a, in_b, outcome) of every path and name of either map: same, differs, only in a, only in b."""
    found = _both(a, b).groupBy("folder", "name").agg(F.sum("a").alias("in_a"), F.sum("b").alias("in_b"), F.bool_or(F.col("a") != F.col("b")).alias("_off"))
    outcome = F.when(F.col("in_b") == 0, ONLY_A).when(F.col("in_a") == 0, ONLY_B).when(F.col("_off"), DIFFERS).otherwise(SAME)
    return found.select("folder", "name", "in_a", "in_b", outcome.alias("outcome"))


def moved(a: DataFrame, b: DataFrame) -> DataFrame:
    """(name, digest, from_folder, to_folder) of marks with the same name and geometry that left one folder and came to one other; more than one on a side is no move."""
    left = _both(a, b).where("a <> b").withColumns({"_gone": F.greatest(F.col("a") - F.col("b"), F.lit(0)), "_new": F.greatest(F.col("b") - F.col("a"), F.lit(0))})
    named = left.groupBy("name", "digest").agg(F.sum("_gone").alias("_gone"), F.sum("_new").alias("_new"), F.min(F.when(F.col("_gone") > 0, F.col("folder"))).alias("from_folder"), F.min(F.when(F.col("_new") > 0, F.col("folder"))).alias("to_folder"))
    return named.where("_gone = 1 and _new = 1").select("name", "digest", "from_folder", "to_folder")


def folder_counts(a: DataFrame, b: DataFrame) -> DataFrame:
    """(folder, in_a, in_b): marks directly in each folder of either map, folders above them included; null where a map hasn't got a folder."""
    def side(df: DataFrame, name: str) -> DataFrame:
        own = df.groupBy(F.coalesce("folder", F.lit("")).alias("folder")).agg(F.count("*").alias("n"))
        steps = F.split("folder", "/")
        above = own.select(F.explode(F.transform(F.sequence(F.lit(1), F.size(steps)), lambda i: F.array_join(F.slice(steps, 1, i), "/"))).alias("folder"), F.lit(0).cast("long").alias("n"))
        return own.union(above).groupBy("folder").agg(F.sum("n").alias(name))

    return side(a, "in_a").join(side(b, "in_b"), "folder", "full")


def graft(target: DataFrame, source: DataFrame, branch: str, at: str) -> DataFrame:
    """target with the branch of source, a folder and all below, put at a path, in place of what the target has there and below."""
    below = lambda path: (F.coalesce("folder", F.lit("")) == path) | F.startswith(F.coalesce("folder", F.lit("")), F.lit(f"{path}/"))
    brought = source.where(below(branch)).withColumn("folder", F.concat(F.lit(at), F.substring("folder", len(branch) + 1, 1_000_000)))
    return target.where(~below(at)).unionByName(brought)
