"""Sinks: the wide and long tables, the run manifest, and publishing only what changed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geosieve.sources.responses import missing


def write_batch(wide: DataFrame, long: DataFrame, path: str, batch: str) -> None:
    """Parquet tables of a batch; other batches of the folder stay."""
    wide.withColumn("batch", F.lit(batch)).write.partitionBy("batch").option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(f"{path}/sites")
    long.withColumn("batch", F.lit(batch)).write.partitionBy("batch").option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(f"{path}/provenance")


def file_digests(spark: SparkSession, *paths: str) -> DataFrame:
    """(path, bytes, sha256) of input files, hashed by tasks; a file is read whole, so it must be under 2 GB."""
    files = spark.read.format("binaryFile").load(list(paths))
    return files.select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def manifest(
    long: DataFrame,
    accepted: DataFrame,
    rejected: DataFrame,
    run_at: str,
    elapsed_s: float | None = None,
    inputs: DataFrame | None = None,
    answers: DataFrame | None = None,
    requests: DataFrame | None = None,
) -> DataFrame:
    """One nested row: when and how long, the inputs' digests, how many sites, each producer's fields, vintage and tallies by status, and how many requests had a kept answer.

    inputs: file_digests of the run's inputs, a handful. answers and requests as responses.missing takes them; without
    both, hits and misses are null.
    """
    tallies = long.groupBy("source", "status").agg(F.count("*").alias("n"))
    by_producer = tallies.groupBy("source").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("status", "n")))).alias("status_counts"))
    # The fields a producer has, in their order: first places are met before names are listed, so the lists are as long as a producer is wide.
    placed = long.groupBy("source", "field").agg(F.min("ordinal").alias("ordinal"), F.max("vintage").alias("vintage"))
    fields = placed.groupBy("source").agg(F.array_sort(F.collect_list(F.struct("ordinal", "field")))["field"].alias("fields"), F.max("vintage").alias("vintage"))
    by_producer = by_producer.join(fields.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    order = lambda a, b: F.when(a["source"] < b["source"], -1).when(a["source"] > b["source"], 1).otherwise(0)
    listed = F.array_sort(F.collect_list(F.struct("source", "status_counts", "fields", "vintage")), order)  # a row a producer
    producers = by_producer.agg(listed.alias("producers"))
    counts = accepted.agg(F.count("*").alias("sites_accepted")).join(rejected.agg(F.count("*").alias("sites_rejected")))
    row = producers.join(counts)
    if inputs is not None:
        row = row.join(inputs.agg(F.array_sort(F.collect_list(F.struct("path", "bytes", "sha256"))).alias("inputs")))
    else:
        row = row.withColumn("inputs", F.lit(None).cast("array<struct<path:string,bytes:bigint,sha256:string>>"))
    if answers is not None and requests is not None:
        lost = missing(answers, requests).agg(F.count("*").alias("cache_misses"))
        row = row.join(requests.agg(F.count("*").alias("_asked"))).join(lost).withColumn("cache_hits", F.col("_asked") - F.col("cache_misses"))
    else:
        row = row.withColumns({c: F.lit(None).cast("long") for c in ("cache_hits", "cache_misses")})
    return row.select(F.lit(run_at).alias("run_at"), F.lit(elapsed_s).cast("double").alias("elapsed_s"), "inputs", "sites_accepted", "sites_rejected", "producers", "cache_hits", "cache_misses")


def fingerprint(df: DataFrame) -> str:
    """A digest of a table's rows whatever their order."""
    row = F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in df.columns])
    n, total = df.agg(F.count("*"), F.coalesce(F.sum(row.cast("decimal(38,0)")), F.lit(0))).first()
    return f"{n}:{total}"


def publish(df: DataFrame, path: str, stamp: str, spark: SparkSession) -> bool:
    """Write df to path unless its rows are there already; what was there before moves beside it. True if it wrote.

    It is written beside the path first, so a write that fails leaves what was there.
    """
    jvm, conf = spark._jvm, spark._jsparkSession.sessionState().newHadoopConf()
    at = jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(conf)
    if fs.exists(at):
        there = spark.read.parquet(path)
        if sorted(there.columns) == sorted(df.columns) and fingerprint(there.select(df.columns)) == fingerprint(df):
            return False
    new = jvm.org.apache.hadoop.fs.Path(f"{path}.{stamp}.new")
    df.write.mode("overwrite").parquet(str(new))
    old = jvm.org.apache.hadoop.fs.Path(f"{path}.{stamp}")
    moved = fs.exists(at)
    if moved and not fs.rename(at, old):
        raise OSError(f"{path} could not be moved to {old}")
    if not fs.rename(new, at):
        if moved:
            fs.rename(old, at)  # what was there stays published
        raise OSError(f"{new} could not be moved to {path}")
    return True


def csv_export(df: DataFrame, path: str) -> None:
    """A CSV folder with a header for people; one part, so only for tables meant to be read."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
