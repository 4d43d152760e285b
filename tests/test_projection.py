"""Equal-area projections against published worked examples and areas known in closed form."""

import math

import pytest
from pyspark.sql import functions as F

from geosieve.functions import projection

CLARKE_1866 = (6_378_206.4, 0.00676866)


def test_published_examples(spark):
    """The numerical examples of the ellipsoidal forms in a well-known manual of map projections, given to 0.1 m."""
    c = lambda v: F.lit(float(v))
    one = spark.range(1).select(*projection.albers(c(35), c(-75), (29.5, 45.5, 23.0, -96.0), CLARKE_1866), *projection.azimuthal(c(30), c(-110), c(40), c(-100), CLARKE_1866)).first()
    assert list(one) == pytest.approx([1_885_472.7, 1_535_925.0, -965_932.1, -1_056_814.9], abs=0.1)


def test_areas_are_kept(spark):
    """Rings of many vertices along parallels and meridians have the zone's area, which the ellipsoid gives in closed form."""
    a, e2 = projection.GRS80
    e = math.sqrt(e2)

    def q(lat):
        s = math.sin(math.radians(lat))
        return (1 - e2) * (s / (1 - e2 * s * s) - math.log((1 - e * s) / (1 + e * s)) / (2 * e))

    south, west, n = 37.0, -101.0, 1_000
    steps = [i / n for i in range(n)]
    ring = [(west + d, south) for d in steps] + [(west + 1, south + d) for d in steps] + [(west + 1 - d, south + 1) for d in steps] + [(west, south + 1 - d) for d in steps]
    rows = spark.createDataFrame([(ring,), ([],)], "ring array<struct<lng:double,lat:double>>")
    about = lambda lat, lng: projection.azimuthal(lat, lng, F.lit(37.4), F.lit(-100.6))
    area = lambda by: projection.ring_area(F.col("ring"), by)
    got = rows.select(area(projection.albers).alias("conic"), area(about).alias("azimuthal")).collect()
    want = a * a / 2 * math.radians(1) * (q(south + 1) - q(south))
    assert [got[0].conic, got[0].azimuthal] == pytest.approx([want, want], rel=1e-8)
    assert (got[1].conic, got[1].azimuthal) == (0.0, 0.0)


def test_parcels_are_measured_by_as_many_tasks_as_are_set(spark):
    from geosieve.plans import registry

    made = registry.QUERIES["parcel_acres"](spark, "/root/testdata/sf0.001")
    assert made.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
