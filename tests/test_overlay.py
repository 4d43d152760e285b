"""Grid joins, exact overlays and lines against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from geosieve.operators import lines, places, planar
from geosieve.operators.grid import box_join, degrees
from geosieve.plans import registry


def test_box_join_finds_each_pair_once(spark):
    rng = random.Random(1)

    def boxes(n, at):
        out = []
        for i in range(n):
            size = 10 ** rng.uniform(-4, 1.3) if i % 3 else 0.0
            y, x = (rng.uniform(-20, 20) if i % 7 else 0.0 for _ in "yx")
            out.append((at + i, i % 2, y, x, y + size * rng.random(), x + size))
        return out

    a, b = boxes(150, 0), boxes(150, 1000)
    left = spark.createDataFrame([*a, (999, 0, None, 0.0, 1.0, 1.0)], "a long, k int, y0 double, x0 double, y1 double, x1 double")
    right = spark.createDataFrame(b, "b long, k int, s double, w double, n double, e double")
    own, other = tuple(F.col(c) for c in ("y0", "x0", "y1", "x1")), tuple(F.col(c) for c in "swne")
    touch = lambda p, q: p[2] <= q[4] and q[2] <= p[4] and p[3] <= q[5] and q[3] <= p[5]
    for cell in ((0.01, 0.02), (3.0, 3.0)):
        got = sorted((r.a, r.b) for r in box_join(left, right.drop("k"), own, other, cell).select("a", "b").collect())
        assert got == sorted((p[0], q[0]) for p in a for q in b if touch(p, q))
        keyed = sorted((r.a, r.b) for r in box_join(left, right, own, other, cell, on=("k",)).select("a", "b").collect())
        assert keyed == sorted((p[0], q[0]) for p in a for q in b if touch(p, q) and p[1] == q[1])
    assert box_join(left, right.limit(0), own, other, (1.0, 1.0)).count() == 0


def test_a_large_box_is_copied_to_few_cells(spark):
    from geosieve.operators import grid

    one = spark.createDataFrame([(0, -30.0, -60.0, 30.0, 60.0)], "a int, s double, w double, n double, e double")
    side = grid._levelled(one, "l", tuple(F.col(c) for c in "swne"), degrees(100.0))
    assert grid._placed(side, "l", grid._levelled(one, "r", tuple(F.col(c) for c in "swne"), degrees(100.0)), "r", degrees(100.0)).count() <= 4


def inside(rings, x, y):
    odd = False
    for ring in rings:
        for (ax, ay), (bx, by) in zip(ring, ring[1:] + ring[:1]):
            if (ay > y) != (by > y) and x < (bx - ax) * (y - ay) / (by - ay) + ax:
                odd = not odd
    return odd


def swept(shapes, ranks):
    """Areas by winner of (rank, rings) by plain trapezoids."""
    edges = [(i, r, *a, *b) for i, (r, rings) in enumerate(shapes) for ring in rings for a, b in zip(ring, ring[1:] + ring[:1])]
    ys = {e[3] for e in edges} | {e[5] for e in edges}
    for p in edges:
        for q in edges:
            d = (p[4] - p[2]) * (q[5] - q[3]) - (p[5] - p[3]) * (q[4] - q[2])
            if d:
                t = ((q[2] - p[2]) * (q[5] - q[3]) - (q[3] - p[3]) * (q[4] - q[2])) / d
                if 0 <= t <= 1:
                    ys.add(p[3] + t * (p[5] - p[3]))
    ys, out = sorted(ys), {}
    for lo, hi in zip(ys, ys[1:]):
        if hi - lo < 1e-12:
            continue
        m = (lo + hi) / 2
        xs = sorted({(e[4] - e[2]) * (m - e[3]) / (e[5] - e[3]) + e[2] for e in edges if min(e[3], e[5]) < m < max(e[3], e[5])})
        for a, b in zip(xs, xs[1:]):
            held = [r for r, rings in shapes if inside(rings, (a + b) / 2, m)]
            if None in held:
                k = min((r for r in held if r is not None), default=None)
                out[k] = out.get(k, 0.0) + (b - a) * (hi - lo)  # the middle line of a trapezoid
    return out


def test_overlays_equal_brute_force(spark):
    rng = random.Random(3)
    star = lambda n, x, y, r: [(x + r * rng.uniform(0.3, 1) * math.cos(2 * math.pi * i / n), y + r * rng.uniform(0.3, 1) * math.sin(2 * math.pi * i / n)) for i in range(n)]
    square = lambda x, y, r: [(float(x + a * r), float(y + b * r)) for a, b in ((-1, -1), (1, -1), (1, 1), (-1, 1))]
    cases = {
        1: [(None, [star(9, 0, 0, 300), star(5, 0, 0, 60)])] + [(rng.randrange(3), [star(7, rng.uniform(-200, 200), rng.uniform(-200, 200), 120), star(4, 0, 0, 20)]) for _ in range(7)],
        2: [(None, [square(0, 0, 100)]), (1, [square(0, 0, 50)]), (1, [square(0, 0, 50)]), (0, [square(50, 0, 50)]), (2, [square(500, 500, 10)])],  # repeated, edge to edge, outside
        3: [(None, [square(0, 0, 10)]), (None, [square(5, 0, 10)])],
        4: [(0, [square(0, 0, 10)])],  # no footprint
        5: [(None, [[(0.0, 0.0), (10.0, 0.0), (5.0, 0.0)]]), (0, [square(0, 0, 5)])],  # of no area
        6: [(None, [star(40, 1e6, 4e6, 900)]), (0, [star(60, 1e6, 4e6, 800)]), (1, [square(1e6, 4e6, 700)])],
    }
    rows = [(k, i, r, rings) for k, shapes in cases.items() for i, (r, rings) in enumerate(shapes)]
    edges = planar.ring_edges(spark.createDataFrame(rows, "site int, shape long, rank int, rings array<array<struct<x double, y double>>>"))
    want = {(k, r): a for k, shapes in cases.items() for r, a in swept(shapes, 3).items() if a > 1e-6}
    for band in (17.0, 64.0, 1e5):
        got = {(r.site, r.rank): r.area for r in planar.overlay_areas(edges, ["site"], 3, band).collect() if r.area > 1e-6}
        assert got.keys() == want.keys()
        assert all(got[k] == pytest.approx(want[k], rel=1e-6) for k in want)
    assert got[2, None] + got[2, 0] + got[2, 1] == pytest.approx(40_000) and got[3, None] == pytest.approx(20 * 25)
    named = edges.withColumn("zone", F.concat(F.lit("z"), "rank")).drop("rank")
    by = {(r.site, r.zone): r.area for r in planar.group_areas(named, ["site"], "zone").collect()}
    alone = {(k, f"z{z}"): swept([s for s in shapes if s[0] in (None, z)], 3).get(z, 0.0) for k, shapes in cases.items() for z in range(3)}
    assert all(by.get(k, 0.0) == pytest.approx(a, rel=1e-6, abs=1e-6) for k, a in alone.items())
    assert planar.overlay_areas(edges.limit(0), ["site"], 3).count() == 0


def test_breakdown_text(spark):
    areas = spark.createDataFrame([(1, "AE", 728.434), (1, "X", 39294.98), (1, "V", 1.0)], "site int, zone string, area double")
    r = planar.breakdown(areas, ["site"], "zone", F.lit(40_024.4)).first()
    assert r.breakdown == "X 9.710 ac (98.2%); AE 0.180 ac (1.8%)"


def test_nearest_lines_with_parts_and_feet(spark):
    rng = random.Random(6)
    made = []
    for i in range(60):
        lat, lng = 40 + rng.uniform(-0.3, 0.3), -100 + rng.uniform(-0.3, 0.3)
        parts = [[(lng + rng.uniform(-0.1, 0.1), lat + rng.uniform(-0.1, 0.1)) for _ in range(rng.choice([1, 2, 5]))] for _ in range(rng.choice([0, 1, 3]))]
        made.append((i, i % 3 == 0, parts))
    made.append((60, True, made[5][2]))  # as near as another one
    places_ = [(i, 40 + rng.uniform(-0.4, 0.4), -100 + rng.uniform(-0.4, 0.4)) for i in range(40)] + [(40, 0.0, 0.0)]
    df = spark.createDataFrame(made, "line int, big boolean, parts array<array<struct<lng double, lat double>>>")
    sites = spark.createDataFrame(places_, "site int, lat double, lng double")
    got = {r.site: r for r in lines.nearest_lines(sites, lines.segments(df), "site", "line", 8000.0, {"any": None, "large": F.col("big")}, []).collect()}
    assert len(got) == 41 and got[40]["any"] is None
    for s, lat, lng in places_:
        k = math.cos(math.radians(lat)) * 111320
        best = {}
        for line, big, parts in made:
            for p, part in enumerate(parts):
                for q, (a, b) in enumerate(zip(part, part[1:])):
                    (ax, ay), (bx, by) = (((x - lng) * k, (y - lat) * 110540) for x, y in (a, b))
                    n = (bx - ax) ** 2 + (by - ay) ** 2
                    u = max(0.0, min(1.0, -(ax * (bx - ax) + ay * (by - ay)) / n)) if n else 0.0
                    x, y = ax + u * (bx - ax), ay + u * (by - ay)
                    mm = round(math.hypot(x, y) * 1000)
                    for name in ("any", "large") if big else ("any",):
                        if mm <= 8_000_000:
                            best[name] = min(best.get(name, (mm, line, p, q, lat + y / 110540, lng + x / k)), (mm, line, p, q, lat + y / 110540, lng + x / k))
        for name in ("any", "large"):
            r = got[s][name]
            assert (r is None) == (name not in best)
            if r is not None:
                assert (r.d_mm, r.line, r.part, r.segment) == best[name][:4] and (r.foot_lat, r.foot_lng) == pytest.approx(best[name][4:], abs=1e-9)


def test_candidates_of_wide_circles(spark):
    """A parcel far from a wide circle's middle comes out wherever cells lie, one out of reach doesn't."""
    area = "site int, lat double, lng double, radius_m double, acres int, first boolean, sub_lat double, sub_lng double, own_tokens array<string>"
    areas = spark.createDataFrame([(1, 40.0, -100.0, 40_000.0, 20, True, 0.0, 0.0, ["a"]), (2, 40.0, -100.0, 500.0, 20, True, 0.0, 0.0, ["a"])], area)
    north, east = 38_000 / 110_540, 45_500 / (111_320 * math.cos(math.radians(40)))
    rows = [(1, 40.0 + north, -100.0, 10.0), (2, 40.0, -100.0 + east, 6000.0), (3, 40.0 - 1.01 * north * 40 / 38, -100.0, 10.0), (4, 40.001, -100.0, 0.0), (5, 40.0, -100.0 - 2 * east, 60_000.0)]
    parcels = spark.createDataFrame([(p, la, ln, m, 20.0, "Owner", ["b"], f"P{p}") for p, la, ln, m in rows], "parcel int, f_lat double, f_lng double, reach_m double, parcel_acres double, owner string, tokens array<string>, apn string")
    got = sorted((r.site, r.parcel) for r in places.candidates(areas, parcels, "site").collect())
    assert got == [(1, 1), (1, 2), (1, 4), (1, 5), (2, 4)]


def test_overlays_shuffle_edges_only(spark):
    """Crossings and strips are made where the edges of a band are: nothing is joined or windowed, so what is shuffled grows with edges alone."""
    rows = [(1, 0, None, 0.0, 0.0, 5.0, 9.0), (1, 0, None, 5.0, 9.0, 9.0, 0.0), (1, 0, None, 9.0, 0.0, 0.0, 0.0)]
    edges = spark.createDataFrame(rows, "site int, shape long, rank int, x0 double, y0 double, x1 double, y1 double")
    plan = planar.overlay_areas(edges, ["site"], 2)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Window" not in plan


def test_overlay_blocks_add_up(monkeypatch):
    """Areas don't depend on how many strips and pairs are held at once."""
    rng = np.random.default_rng(4)
    n = 60
    ay = rng.uniform(0, 50, n)
    by = ay + rng.uniform(1, 14, n)
    group, shape = np.sort(rng.integers(0, 3, n)), rng.integers(0, 7, n)
    rank = np.where(shape < 2, -1, shape % 3)
    of = (group, shape, rank, rng.uniform(0, 60, n), ay, rng.uniform(-2, 2, n), ay, by)
    want = planar._group_areas(*of, 3, 64.0)
    assert (want > 0).any()
    for held in (1, 7, 50):
        monkeypatch.setattr(planar, "AT_ONCE", held)
        assert planar._group_areas(*of, 3, 64.0) == pytest.approx(want)


EDGES = "site int, shape long, rank int, x0 double, y0 double, x1 double, y1 double"


def ring(*corners):
    return [(*a, *b) for a, b in zip(corners, corners[1:] + corners[:1])]


def box(x, y, r):
    return ring((x - r, y - r), (x + r, y - r), (x + r, y + r), (x - r, y + r))


def grounds(spark):
    """Sites with zones of several ranks: a footprint of many edges under many ranks, none, no zones, one that comes twice, no key."""
    rng = random.Random(7)
    round_ = ring(*[(300 * math.cos(i / 150 * math.pi), 300 * math.sin(i / 150 * math.pi)) for i in range(300)])
    shapes = [(1, 0, None, round_), *[(1, i + 1, i % 250, box(rng.uniform(-250, 250), rng.uniform(-250, 250), 30.0)) for i in range(500)]]
    shapes += [(2, 0, None, box(0.0, 0.0, 100.0)), (2, 1, -2, box(50.0, 0.0, 80.0)), (2, 2, 7, box(0.0, 50.0, 80.0)), (2, 3, 7, box(0.0, 0.0, 20.0)), (2, 4, 8, box(900.0, 0.0, 20.0))]
    shapes += [(3, 0, None, box(0.0, 0.0, 10.0)), (4, 1, 0, box(0.0, 0.0, 10.0)), (5, 0, None, box(0.0, 0.0, 50.0)), (5, 1, 3, box(0.0, 0.0, 20.0)), (None, 0, None, box(0.0, 0.0, 10.0)), (None, 1, 0, box(0.0, 0.0, 5.0))]
    rows = [(site, shape, rank, *e) for site, shape, rank, edges in shapes for e in edges]
    rows += [r for r in rows if r[:2] == (5, 1)] + [(2, 9, 7, 1.0, None, 2.0, 3.0)]
    return spark.createDataFrame(rows, EDGES)


def test_groups_equal_overlays_of_each_group(spark):
    """A band's footprint meets all of its groups, in blocks where there are many."""
    edges = grounds(spark)
    for band in (64.0, 1e4):
        got = {(r.site, r.rank): r.area for r in planar.group_areas(edges, ["site"], "rank", band).collect()}
        alone = edges.where("rank is null").join(edges.where("rank is not null").select("site", F.col("rank").alias("group")).distinct(), "site")
        alone = alone.unionByName(edges.where("rank is not null").withColumns({"group": F.col("rank"), "rank": F.lit(0)}))
        want = {(r.site, r.group): r.area for r in planar.overlay_areas(alone, ["site", "group"], 1, band).where("rank = 0").collect()}
        assert got.keys() == want.keys() and {k for k, _ in got} == {1, 2} and len(got) == 252
        assert all(got[k] == pytest.approx(want[k]) for k in want)


def test_ranks_may_count_as_one(spark):
    edges = grounds(spark)
    got = {(r.site, r.rank): r.area for r in planar.overlay_areas(edges, ["site"], None).collect()}
    want = {(r.site, r.rank): r.area for r in planar.overlay_areas(edges.withColumn("rank", F.when(F.col("rank").isNotNull(), 0)), ["site"], 1).collect()}
    assert got == pytest.approx(want) and got[2, 0] == pytest.approx(29_500) and got[3, None] == pytest.approx(400)


def test_overlays_and_groups_share_one_shuffle_of_edges(spark):
    """Footprints aren't joined to groups, and both measure the same dealt rows."""
    edges = grounds(spark)
    groups = planar.group_areas(edges, ["site"], "rank")
    plan = groups._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Window" not in plan
    both = planar.overlay_areas(edges, ["site"], None).withColumn("of", F.lit("all")).unionByName(groups.withColumn("of", F.lit("rank")))
    both.collect()
    ran = both._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert ran.count("ReusedExchange") == 1


def test_breakdown_measures_a_footprint_twice(spark):
    """Once whole and once by group: totals and words are of the same rows."""
    plan = registry.QUERIES["footprint_breakdown"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 2


def test_breakdown_of_every_key(spark):
    areas = spark.createDataFrame([(1, "X", 39294.98), (1, "V", 1.0), (2, "V", 1.0), (3, None, None)], "site int, zone string, area double")
    said = lambda **more: {r.site: r.breakdown for r in planar.breakdown(areas, ["site"], "zone", F.lit(40_024.4), **more).collect()}
    assert said() == {1: "X 9.710 ac (98.2%)"} and said(every=True) == {1: "X 9.710 ac (98.2%)", 2: None, 3: None}
