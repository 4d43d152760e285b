"""Range joins at size: no copies through the driver, places measured once, and what is on an edge."""

import math

import numpy as np
from pyspark.sql import functions as F

from geosieve.operators import spatial
from geosieve.operators.grid import box_join
from geosieve.operators.producers import Near, Ring, Spec, records, screen_features
from geosieve.plans import registry, spatial as plans  # noqa: F401  (the registry loads the plans)


def frame(lat, lng, lat2, lng2):
    return math.hypot((lng2 - lng) * 111320 * math.cos(math.radians(lat)), (lat2 - lat) * 110540)


def layers(spark):
    """Sites and features of which many share a place, and a site and a feature without one."""
    rng = np.random.default_rng(8)
    spot = lambda: (40 + int(rng.integers(12)) / 50, -90 + int(rng.integers(12)) / 50)
    s = [(i, *spot()) for i in range(80)] + [(80, None, None), (81, 60.0, -90.0)]
    f = [(i, *spot(), int(rng.integers(9))) for i in range(90)] + [(90, None, None, 3)]
    return s, f, spark.createDataFrame(s, "site int, lat double, lng double"), spark.createDataFrame(f, "f int, f_lat double, f_lng double, size int")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_copies_of_features_are_not_broadcast(spark):
    _, _, sites, features = layers(spark)
    assert "SortMergeJoin" in plan(spatial.range_join(sites, features, 1_000.0))
    point = tuple(F.col(c) for c in ("lat", "lng", "lat", "lng"))
    other = tuple(F.col(c) for c in ("f_lat", "f_lng", "f_lat", "f_lng"))
    assert "SortMergeJoin" in plan(box_join(sites, features, point, other, (0.01, 0.01)))


def test_measured_places_agree_with_all_pairs(spark):
    s, f, sites, features = layers(spark)
    wanted = {"near": spatial.Nearest(5_000, ("size",)), "big": spatial.Nearest(4_000, (), "size >= 6"), "n": spatial.Total(3_000), "even": spatial.Total(5_000, "size % 2 = 0"), "total": spatial.Total(4_000, None, "sum", "size"), "top": spatial.Total(5_000, None, "max", "size")}
    got = {r.site: r for r in spatial.measured(sites, features, "site", "f", wanted).collect()}
    assert len(got) == len(s)
    for i, lat, lng in s:
        pairs = sorted((round(frame(lat, lng, y, x) * 1000), j, z) for j, y, x, z in f if y is not None) if lat is not None else []
        pairs = [p for p in pairs if p[0] <= 5_000_000]
        r, within = got[i], lambda m, k=pairs: [p for p in k if p[0] <= m * 1000]
        if not pairs:
            assert r.near is r.big is r.n is r.total is None
            continue
        big = [p for p in within(4_000) if p[2] >= 6]
        assert tuple(r.near) == pairs[0] and (tuple(r.big) if r.big else None) == (big[0][:2] if big else None)
        assert (r.n, r.even, r.total or 0, r.top) == (len(within(3_000)), sum(p[2] % 2 == 0 for p in pairs), sum(p[2] for p in within(4_000)), max(p[2] for p in pairs))


def test_screened_features_give_the_records_of_pairs(spark):
    _, _, sites, features = layers(spark)
    specs = [Spec("a", 5_000, (Near({"m": "distance", "id": "f"}, "size > 4"),), (Ring("n", 2_000), Ring("top", 4_000, what="max", column="size")), all_absent=True), Spec("b", 1_500, (Near({"m2": "distance"}),), (Ring("sum2", 1_000, what="sum", column="size"),))]
    columns = ["site", "field", "status", "value", "note", "method", "source"]
    got = screen_features(sites, "site", features, "f", specs).select(columns).collect()
    pairs = spatial.points_within(sites, features, 5_000)
    want = [r for s in specs for r in records(sites, "site", pairs, "f", s).select(columns).collect()]
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_a_place_just_outside_an_edge_is_in_no_polygon(spark, monkeypatch):
    # The outline has a corner one radius east of its point; 1e-9 degrees beyond it are 0.1 mm.
    feature = spark.createDataFrame([(1, 10, 40.0, -90.0)], "feature int, size int, f_lat double, f_lng double")
    r = 0.06
    at = [(1, 40.0, -90.0 + r + 1e-9), (2, 40.0, -90.0 + 0.5 * r)]
    monkeypatch.setattr(plans, "parts", lambda t: feature)
    monkeypatch.setattr(plans, "sites", lambda t: spark.createDataFrame(at, "site int, lat double, lng double"))
    got = {x.site: x.polygon for x in plans.point_in_polygon(None).collect()}
    assert got == {1: None, 2: 1}
