"""Geometry expressions and overlays against plain Python."""

import math

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from geosieve.functions import geo
from geosieve.operators import overlay, spatial


def frame(lat, lng, a):
    return (a[0] - lng) * 111320 * math.cos(math.radians(lat)), (a[1] - lat) * 110540


def to_segment(p, q):
    dx, dy = q[0] - p[0], q[1] - p[1]
    n = dx * dx + dy * dy
    t = 0.0 if n == 0 else min(1, max(0, -(p[0] * dx + p[1] * dy) / n))
    return math.hypot(p[0] + t * dx, p[1] + t * dy)


def inside(ring, x, y):
    odd = False
    for a, b in zip(ring, ring[1:] + ring[:1]):
        if (a[1] > y) != (b[1] > y) and x < (b[0] - a[0]) * (y - a[1]) / (b[1] - a[1]) + a[0]:
            odd = not odd
    return odd


def test_rings(spark):
    rng = np.random.default_rng(4)
    rows = []
    for i in range(200):
        n = int(rng.integers(3, 9))
        angle = np.sort(rng.uniform(0, 2 * math.pi, n))
        r = rng.uniform(0.05, 0.3, n)
        ring = [(-90 + float(a), 40 + float(b)) for a, b in zip(r * np.cos(angle), r * np.sin(angle))]
        rows.append((i, 40 + float(rng.uniform(-0.3, 0.3)), -90 + float(rng.uniform(-0.3, 0.3)), ring))
    df = spark.createDataFrame(rows, "i int, lat double, lng double, ring array<struct<lng:double,lat:double>>")
    lat, lng, ring = F.col("lat"), F.col("lng"), F.col("ring")
    got = df.select("i", geo.ring_contains(ring, lat, lng).alias("inside"), geo.ring_distance(ring, lat, lng).alias("d"), geo.ring_area_m2(ring).alias("area")).collect()
    for r in got:
        _, y, x, ring = rows[r.i]
        assert r.inside == inside(ring, x, y)
        edges = [to_segment(frame(y, x, a), frame(y, x, b)) for a, b in zip(ring, ring[1:] + ring[:1])]
        assert abs(r.d - min(edges)) < 1e-6
        area = abs(sum(math.radians(b[0] - a[0]) * (2 + math.sin(math.radians(a[1])) + math.sin(math.radians(b[1]))) for a, b in zip(ring, ring[1:] + ring[:1]))) * 6378137**2 / 2
        assert abs(r.area - area) <= 1e-6 * area


def test_range_join_is_complete_and_gives_pairs_once(spark):
    rng = np.random.default_rng(5)
    a = [(i, float(rng.uniform(20, 68)), float(rng.uniform(-120, -118))) for i in range(300)]
    b = [(i, float(rng.uniform(20, 68)), float(rng.uniform(-120, -118))) for i in range(300)]
    sites, features = spark.createDataFrame(a, "site int, lat double, lng double"), spark.createDataFrame(b, "f int, f_lat double, f_lng double")
    got = [(r.site, r.f) for r in spatial.points_within(sites, features, 40_000).select("site", "f").collect()]
    want = {(i, j) for i, y, x in a for j, v, u in b if round(math.hypot(*frame(y, x, (u, v))) * 1000) <= 40_000_000}
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 50


def test_no_feature_and_no_site(spark):
    sites = spark.createDataFrame([(1, 40.0, -90.0)], "site int, lat double, lng double")
    none = spark.createDataFrame([], "f int, f_lat double, f_lng double")
    pairs = spatial.points_within(sites, none, 1000)
    assert spatial.per_site(sites, "site", pairs, spatial.nearest("f").alias("b")).first().b is None
    assert spatial.within_gap(sites, "site", 1000).first().component == 1


SQUARE = np.array([[0, 0], [4, 0], [4, 4], [0, 4]], float)


@settings(max_examples=100, deadline=None)
@given(st.floats(-5, 5), st.floats(-5, 5), st.floats(0.5, 6), st.floats(0.5, 6))
def test_clip_boxes(x, y, w, h):
    box = np.array([[x, y], [x + w, y], [x + w, y + h], [x, y + h]])
    want = max(0, min(4, x + w) - max(0, x)) * max(0, min(4, y + h) - max(0, y))
    assert abs(abs(overlay._area(overlay.clip_convex(box, SQUARE))) - want) < 1e-9
    assert abs(abs(overlay._area(overlay.clip_convex(box[::-1], SQUARE[::-1]))) - want) < 1e-9


def test_clip_shapes(spark):
    star = [[0.0, -2.0], [1.0, 1.0], [6.0, 2.0], [1.0, 3.0], [0.0, 6.0], [-1.0, 3.0], [-6.0, 2.0], [-1.0, 1.0]]
    points = np.random.default_rng(6).uniform(-6, 6, (200_000, 2))
    hits = sum(inside([tuple(p) for p in star], *p) and 0 <= p[0] <= 4 and 0 <= p[1] <= 4 for p in points[:40_000])
    df = spark.createDataFrame([(star, SQUARE.tolist()), (None, SQUARE.tolist())], "s array<array<double>>, c array<array<double>>")
    got = [r[0] for r in df.select(overlay.clipped_area("s", "c")).collect()]
    assert abs(got[0] - hits / 40_000 * 144) < 0.3 and got[1] is None


def test_small_expressions(spark):
    one = spark.createDataFrame([(40.0, -90.0)], "lat double, lng double")
    lat, lng = F.col("lat"), F.col("lng")
    ring = geo.circle(lat, lng, F.lit(1000.0))
    r = one.select(geo.ring_area_m2(ring).alias("a"), geo.ring_distance(ring, lat, lng).alias("d"), F.struct(*geo.centroid(ring)).alias("c"), geo.equal_area_radius(F.lit(math.pi * 9)).alias("r")).first()
    assert abs(r.d - 1000) < 2 and abs(r.a / 1e6 / math.pi - 1) < 0.02 and abs(r.c[0] - 40) < 1e-9 and abs(r.r - 3) < 1e-12
    p = lambda x, y: (F.lit(float(x)), F.lit(float(y)))
    got = one.select(geo.segments_cross(p(0, 0), p(2, 2), p(0, 2), p(2, 0)), geo.segments_cross(p(0, 0), p(1, 1), p(2, 0), p(2, 2))).first()
    assert tuple(got) == (True, False)


def test_drift(spark):
    from geosieve.plans.relations import drift

    rows = [("same", 10, 1, 11, 1), ("gone", 10, 1, None, None), ("new", None, None, 3, 2), ("grown", 1000, 1, 1200, 2), ("from zero", 0, 1, 900, 1)]
    got = drift(spark.createDataFrame(rows, "event_type string, bn int, bv int, cn int, cv int")).collect()
    assert {r.layer: r.flags for r in got} == {"same": "", "gone": "unreachable", "new": "new", "grown": "records,vintage", "from zero": ""}


def test_zone_shares(spark):
    ring = lambda *p: [[{"x": float(x), "y": float(y)} for x, y in p]]
    square, circle = ring((0, 0), (100, 0), (100, 100), (0, 100)), ring(*[(50 + 30 * math.cos(a / 50 * math.pi), 50 + 30 * math.sin(a / 50 * math.pi)) for a in range(100)])
    holed = square + ring((20, 20), (80, 20), (80, 80), (20, 80))
    rows = [("a", None, square), ("a", 1, circle), ("a", 0, ring((50, 0), (150, 0), (150, 100), (50, 100))), ("b", None, holed), ("b", 3, circle), ("c", 2, square), ("d", None, None)]
    df = spark.createDataFrame(rows, "k string, rank int, rings array<array<struct<x:double,y:double>>>")
    got = {(r.k, r.rank): r.pct for r in overlay.zone_shares(df, "k", 256).collect()}
    disc = math.pi * 900 / 10_000 * 100
    assert abs(got["a", 0] - 50) < 0.5 and abs(got["a", 1] - disc / 2) < 0.3 and abs(got["a", None] - (50 - disc / 2)) < 0.5
    assert got["b", None] == 100 and set(k for k, _ in got) == {"a", "b"}
    assert abs(sum(v for (k, _), v in got.items() if k == "a") - 100) < 1e-9
