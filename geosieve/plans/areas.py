"""Areas on the ellipsoid."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geosieve.functions import geo, projection
from geosieve.plans.registry import Tables, query
from geosieve.plans.spatial import HOLE, OUTLINE, PARTS, parts

_A, _E2 = projection.GRS80
_E = math.sqrt(_E2)
_Q = lambda s: f"({1 - _E2!r} * ({s} / (1 - {_E2!r} * {s} * {s}) - ln((1 - {_E!r} * {s}) / (1 + {_E!r} * {s})) / {2 * _E!r}))"
_QP = projection._pole(_E2)
_R = _A * math.sqrt(_QP / 2)
_FIRST, _SECOND, _, _LNG0 = projection.CONUS
_VERTICES = " UNION ALL ".join(f"SELECT feature, size, {int(ring is HOLE)} AS ring, {i} AS i, f_lat, f_lng, f_lng + r * {x}e0 AS lng, f_lat + r * {y}e0 AS lat FROM k" for ring in (OUTLINE, HOLE) for i, (x, y) in enumerate(ring))


@query(f"""WITH {PARTS}, k AS (SELECT *, 2e-3 + size * 4e-4 AS r FROM parts), v AS ({_VERTICES}),
    p AS (SELECT *, sin(radians(lat)) AS s, sin(radians(f_lat)) AS s0, radians(lng - f_lng) AS t FROM v),
    b AS (SELECT *, {_Q("s")} / {_QP!r} AS sb, {_Q("s0")} / {_QP!r} AS sb0, {_A!r} * cos(radians(f_lat)) / sqrt(1 - {_E2!r} * s0 * s0) / {_R!r} AS m0 FROM p),
    c AS (SELECT *, sqrt(1 - sb * sb) AS cb, sqrt(1 - sb0 * sb0) AS cb0 FROM b),
    z AS (SELECT *, {_R!r} * sqrt(2 / (1 + sb0 * sb + cb0 * cb * cos(t))) AS w, m0 / cb0 AS d FROM c),
    parallels AS (SELECT pow(cos(radians({_FIRST})), 2) / (1 - {_E2!r} * pow(sin(radians({_FIRST})), 2)) AS m1, pow(cos(radians({_SECOND})), 2) / (1 - {_E2!r} * pow(sin(radians({_SECOND})), 2)) AS m2, {_Q(f"sin(radians({_FIRST}))")} AS q1, {_Q(f"sin(radians({_SECOND}))")} AS q2),
    cone AS (SELECT (m1 - m2) / (q2 - q1) AS n, m1 + (m1 - m2) / (q2 - q1) * q1 AS c FROM parallels),
    xy AS (SELECT feature, size, ring, i, w * d * cb * sin(t) AS x, w / d * (cb0 * sb - sb0 * cb * cos(t)) AS y, {_A!r} / n * sqrt(cone.c - n * sb * {_QP!r}) AS rho, n * radians(lng - {_LNG0}e0) AS turn FROM z, cone),
    xyz AS (SELECT *, rho * sin(turn) AS u, -rho * cos(turn) AS v FROM xy),
    e AS (SELECT *, coalesce(lead(x) OVER o, first_value(x) OVER o) AS x1, coalesce(lead(y) OVER o, first_value(y) OVER o) AS y1, coalesce(lead(u) OVER o, first_value(u) OVER o) AS u1, coalesce(lead(v) OVER o, first_value(v) OVER o) AS v1 FROM xyz WINDOW o AS (PARTITION BY feature, ring ORDER BY i)),
    g AS (SELECT feature, ring, abs(sum(x * y1 - x1 * y)) / 2 AS a, abs(sum((u + u1) * (v1 - v))) / 2 AS b FROM e GROUP BY ALL)
    SELECT feature, round(sum(CASE ring WHEN 0 THEN a ELSE -a END) / 4046.8564224e0, 3) AS acres, round(sum(CASE ring WHEN 0 THEN b ELSE -b END) / 4046.8564224e0, 3) AS acres_conic FROM g GROUP BY feature""")
def parcel_acres(t: Tables) -> DataFrame:
    """Acres of each parcel without its hole on the ellipsoid, projected about its own point, and by the country's conic projection."""
    r = F.lit(2e-3) + F.col("size") * F.lit(4e-4)
    ring = lambda corners: F.array(*[F.struct((F.col("f_lng") + r * F.lit(x)).alias("lng"), (F.col("f_lat") + r * F.lit(y)).alias("lat")) for x, y in corners])
    about = lambda lat, lng: projection.azimuthal(lat, lng, F.col("f_lat"), F.col("f_lng"))
    acres = lambda by: F.round((projection.ring_area(F.col("outer"), by) - projection.ring_area(F.col("hole"), by)) / geo.ACRE_M2, 3)
    # A row is small and its projections are not: as many tasks as are set, however few files and bytes there are.
    own = parts(t).repartition(int(t.spark.conf.get("spark.sql.shuffle.partitions")), "feature")
    rows = own.select("feature", "f_lat", "f_lng", ring(OUTLINE).alias("outer"), ring(HOLE).alias("hole"))
    return rows.select("feature", acres(about).alias("acres"), acres(projection.albers).alias("acres_conic"))
