"""An extension: the fetch log as a stream, tallied by window with late rows, and the latest good answer kept."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from geosieve.operators.relational import latest_ok


def tallies(log: DataFrame, window: str = "10 minutes", late: str = "30 minutes") -> DataFrame:
    """Responses by producer, window and outcome; rows later than the watermark are dropped by Spark."""
    counted = log.withWatermark("fetched_at", late).groupBy(F.window("fetched_at", window), "producer", "ok").agg(F.count("*").alias("n"))
    return counted.select(F.col("window.start").alias("start"), "producer", "ok", "n")


def keep_latest(log: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Merge each batch's latest good answers into the table at path, version by version.

    A batch writes a new version from the one before it, so a batch that is
    run again writes the same one.
    """

    def merge(batch: DataFrame, n: int) -> None:
        spark = batch.sparkSession
        new = latest_ok(batch, ["producer", "key"], F.col("ok"), ["fetched_at"], ["url", "body"]).where("body is not null")
        new = new.select("producer", "key", "fetched_at", "url", "body")
        if n:
            old = spark.read.schema(new.schema).parquet(f"{path}/v{n - 1}")
            both = old.unionByName(new)
            best = F.max(F.struct("fetched_at", "url", "body"))
            new = both.groupBy("producer", "key").agg(best.alias("b")).select("producer", "key", "b.*")
        new.write.mode("overwrite").parquet(f"{path}/v{n}")
        # The version before stays, in case this batch runs again; older ones aren't read any more.
        old = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/v{n - 2}")
        old.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(old, True)

    return log.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
