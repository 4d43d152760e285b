"""Groups of grids are dealt to tasks."""

from pyspark.sql import functions as F

from geosieve.operators import overlay, parcels, raster
from geosieve.plans import registry


def test_groups_of_grids_are_dealt_to_as_many_tasks_as_are_set(spark):
    """Small shuffles would be merged to one task, whatever work is on them."""
    point = F.struct(F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))
    shapes = spark.range(50).select(F.col("id").alias("site"), F.lit(None).cast("int").alias("rank"), F.array(F.array(point)).alias("rings"))
    cells = spark.range(50).select(F.col("id").alias("site"), *[F.lit(0).alias(c) for c in ("row", "column", "cover")], F.lit(True).alias("site_"), F.lit(False).alias("building"), F.lit(0.0).alias("height"))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cells = cells.withColumnRenamed("site", "k").withColumnRenamed("site_", "site")
    for df in (overlay.zone_shares(shapes, "site", 8), raster.measure_usable(cells, "k", 1, 10.0)):
        assert df.rdd.getNumPartitions() == tasks


def test_zones_of_parcels_are_dealt_to_as_many_tasks_as_are_set(spark, monkeypatch):
    """A file of one row group is read by one task, which would make all rows of the join."""
    seen, pairs = [], parcels.pairs_within
    monkeypatch.setattr(parcels, "pairs_within", lambda shapes, *more: seen.append(shapes.rdd.getNumPartitions()) or pairs(shapes, *more))
    for name in ("parcel_adjacency", "parcel_groups"):
        registry.QUERIES[name](spark, "/root/testdata/sf0.001")
    assert seen == [int(spark.conf.get("spark.sql.shuffle.partitions"))] * 2
