"""Nearest features without a radius and ground within circles, against brute force."""

import math
import random

from pyspark.sql import functions as F

from geosieve.functions import geo
from geosieve.operators.circles import shares_within
from geosieve.operators.lines import near_segments
from geosieve.operators.pyramid import nearest_complete

LNG, LAT = 111320.0, 110540.0


def metres(lat, lng, f_lat, f_lng):
    return math.hypot((f_lng - lng) * LNG * math.cos(math.radians(lat)), (f_lat - lat) * LAT)


def test_nearest_of_all_points(spark):
    rng = random.Random(5)
    town = [(i, 40 + rng.gauss(0, 0.02), -90 + rng.gauss(0, 0.02)) for i in range(600)]
    lone = [(1000 + i, rng.uniform(-80, 80), rng.uniform(-179, 179)) for i in range(25)]
    same = [(2000 - i, 10.0, 10.0) for i in range(300)]
    odd = [(3000, None, 1.0), (3001, 95.0, 0.0), (3002, 1.0, None)]
    points = [(*p, f"n{p[0]}") for p in town + lone + same + odd]
    features = spark.createDataFrame(points, "feature long, f_lat double, f_lng double, name string")
    at = [(i, rng.uniform(-85, 85), rng.uniform(-180, 180)) for i in range(120)] + [(500 + i, 40 + rng.gauss(0, 0.05), -90 + rng.gauss(0, 0.05)) for i in range(60)] + [(900, 10.0, 10.0), (901, 12.0, 9.0)]
    sites = spark.createDataFrame([*at, (990, None, 0.0), (991, 0.0, 181.0)], "site long, lat double, lng double")
    good = [p for p in points if p[0] < 3000]
    most = []
    for levels in (2, 6, 8):
        rows = {r.site: r for r in nearest_complete(sites, features, "site", "feature", ["name"], levels=levels).collect()}
        assert len(rows) == len(at) + 2 and rows[990].best is None and rows[991].best is None
        for k, lat, lng in at:
            d, f = min((math.floor(metres(lat, lng, p[1], p[2]) * 1000 + 0.5), p[0]) for p in good)
            assert (rows[k].best.d_mm, rows[k].best.feature, rows[k].best.name) == (d, f, f"n{f}")
        assert rows[900].best.feature == 1701 and rows[900].measured <= 2
        most.append(max(rows[k].measured for k, _, _ in at))
    # Cells of 220 m part the town, of 3.5 km hardly.
    assert most[0] >= most[1] > most[2] and most[2] < 200
    assert all(r.best is None for r in nearest_complete(sites, features.limit(0), "site", "feature", ["name"]).collect())


def test_nearest_of_all_segments(spark):
    rng = random.Random(6)
    lines = [(i, *(rng.uniform(30, 45), rng.uniform(-100, -80))) for i in range(80)]
    lines = [(i, a, b, a + rng.uniform(-3, 3) * (i % 3), b + rng.uniform(-3, 3) * (i % 3)) for i, a, b in lines]
    rows = spark.createDataFrame(lines, "line long, a_lat double, a_lng double, b_lat double, b_lng double")
    sites = spark.createDataFrame([(i, rng.uniform(30, 45), rng.uniform(-100, -80)) for i in range(80)], "site long, lat double, lng double")
    box = tuple(f(F.col(f"a_{c}"), F.col(f"b_{c}")) for f in (F.least, F.greatest) for c in ("lat", "lng"))
    far = geo.segment_distance(*geo.offset(F.col("lat"), F.col("lng"), F.col("a_lat"), F.col("a_lng")), *geo.offset(F.col("lat"), F.col("lng"), F.col("b_lat"), F.col("b_lng")))
    got = {r.site: (r.best.d_mm, r.best.line) for r in nearest_complete(sites, rows, "site", "line", [], box, far).collect()}
    all_pairs = near_segments(sites, rows, 4_000_000.0).groupBy("site").agg(F.min(F.struct("d_mm", "line")).alias("b")).collect()
    assert got == {r.site: (r.b.d_mm, r.b.line) for r in all_pairs} and len(got) == 80


def inside(rings, x, y):
    odd = False
    for ring in rings:
        for (ax, ay), (bx, by) in zip(ring, ring[1:] + ring[:1]):
            if (ay > y) != (by > y) and x < (bx - ax) * (y - ay) / (by - ay) + ax:
                odd = not odd
    return odd


def test_ground_within_circles(spark):
    rng = random.Random(7)
    lat0, lng0 = 40.0, -90.0
    fx = LNG * math.cos(math.radians(lat0))
    shapes = []
    for i in range(14):
        cx, cy, n = rng.uniform(-900, 900), rng.uniform(-900, 900), rng.randrange(3, 9)
        star = [(cx + rng.uniform(200, 900) * math.cos(t), cy + rng.uniform(200, 900) * math.sin(t)) for t in (2 * math.pi * k / n for k in range(n))]
        hole = [(cx + 60 * math.cos(t), cy + 60 * math.sin(t)) for t in (0.1, 1.7, 3.3, 4.9)] if i % 2 and n > 4 else []
        star = star[::-1] if i % 3 else star
        shapes.append((i, star, [hole] if hole else []))
    shapes.append((50, [(-5000.0, -5000.0), (5000.0, -5000.0), (5000.0, 5000.0), (-5000.0, 5000.0)], []))
    ring = lambda r: [(x / fx + lng0, y / LAT + lat0) for x, y in r]
    rows = [(i, ring(o), [ring(h) for h in hs]) for i, o, hs in shapes] + [(60, [], []), (61, None, None), (62, ring([(0, 0), (100, 0)]), None)]
    table = spark.createDataFrame(rows, "shape long, outer array<struct<lng:double,lat:double>>, holes array<array<struct<lng:double,lat:double>>>")
    sites = spark.createDataFrame([(1, lat0, lng0, 700.0), (2, None, lng0, 700.0), (3, lat0, lng0, -1.0)], "site long, lat double, lng double, r double")
    radii = {"near": F.col("r"), "pass_": F.col("r") + 600}
    got = {(r.site, r.shape): (r.near, r.pass_) for r in shares_within(sites, table, "site", "shape", radii, F.lit(1300.0), 500.0).collect()}
    assert all(v[0] == 0 for k, v in got.items() if k[0] == 3) and not any(k[0] == 2 or k[1] in (60, 61, 62) for k in got)
    step = 12.0
    for i, outer, holes in shapes:
        rings = [outer, *holes]
        shoelace = lambda r: abs(sum(a[0] * b[1] - a[1] * b[0] for a, b in zip(r, r[1:] + r[:1]))) / 2
        whole = shoelace(outer) - sum(map(shoelace, holes))
        for r, share in zip((700.0, 1300.0), got.get((1, i), (0.0, 0.0))):
            n = int(r / step) + 1
            cells = [((a + 0.5) * step, (b + 0.5) * step) for a in range(-n, n) for b in range(-n, n)]
            ground = sum(step * step for x, y in cells if x * x + y * y <= r * r and inside(rings, x, y))
            assert abs(share * whole - ground) < 0.02 * whole + 2 * step * step
    assert abs(got[(1, 50)][0] * 1e8 - math.pi * 700**2) < 1e-3 and abs(got[(1, 50)][1] * 1e8 - math.pi * 1300**2) < 1e-3


def test_points_near_footprints(spark):
    from geosieve.operators.footprints import points_near_footprints

    rng = random.Random(9)
    grounds = []
    for i, (lat, lng) in enumerate([(29.0, -95.0), (29.02, -95.01), (64.0, 20.0), (-64.0, 20.0), (0.0, 0.0)]):
        star = [(lng + rng.uniform(0.005, 0.02) * math.cos(t), lat + rng.uniform(0.005, 0.02) * math.sin(t)) for t in (2 * math.pi * k / 7 for k in range(7))]
        grounds.append((i, lat, lng, star, [[(lng + 0.002, lat), (lng, lat + 0.002), (lng - 0.002, lat)]]))
    rows = [*grounds, (90, 29.0, -95.0, [], []), (91, None, None, None, None)]
    ring = "array<struct<lng:double,lat:double>>"
    table = spark.createDataFrame(rows, f"site long, lat double, lng double, outer {ring}, holes array<{ring}>").withColumn("edges", geo.polygon_edges(F.col("outer"), F.col("holes")))
    points = [(i, g[1] + rng.uniform(-0.06, 0.06), g[2] + rng.uniform(-0.1, 0.1)) for i, g in enumerate(grounds * 60)] + [(1000 + i, g[1] + 0.0005, g[2]) for i, g in enumerate(grounds)] + [(2000, None, 1.0)]
    got = {(r.site, r.point): r.d_mm for r in points_near_footprints(table, spark.createDataFrame(points, "point long, f_lat double, f_lng double"), "site", "point", 3_000.0).collect()}
    want = {}
    for i, lat, lng, outer, holes in grounds:
        fx = LNG * math.cos(math.radians(lat))
        for n, y, x in points[:-1]:
            d = math.inf
            for r in [outer, *holes]:
                for a, b in zip(r, r[1:] + r[:1]):
                    ax, ay, bx, by = (a[0] - x) * fx, (a[1] - y) * LAT, (b[0] - x) * fx, (b[1] - y) * LAT
                    u = min(1.0, max(0.0, -(ax * (bx - ax) + ay * (by - ay)) / ((bx - ax) ** 2 + (by - ay) ** 2)))
                    d = min(d, math.hypot(ax + u * (bx - ax), ay + u * (by - ay)))
            mm = 0 if inside([outer, *holes], x, y) else math.floor(d * 1000 + 0.5)
            if mm <= 3_000_000:
                want[i, n] = mm
    assert got.keys() == want.keys() and len(want) > 50 and 0 in want.values()
    assert all(abs(got[k] - want[k]) <= 1 for k in want) and all(want[i, 1000 + i] > 0 for i in range(5))
