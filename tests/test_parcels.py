"""Distances between polygons against brute force."""

import math
import random

import pytest
from pyspark.sql import functions as F

from geosieve.operators import parcels

from .test_overlay import inside

RINGS = "site int, k int, rings array<array<struct<x double, y double>>>"


def edges(rings):
    return [(*a, *b) for ring in rings for a, b in zip(ring, ring[1:] + ring[:1])]


def point_far(px, py, ax, ay, bx, by):
    n = (bx - ax) ** 2 + (by - ay) ** 2
    t = max(0.0, min(1.0, ((px - ax) * (bx - ax) + (py - ay) * (by - ay)) / n)) if n else 0.0
    return math.hypot(ax + t * (bx - ax) - px, ay + t * (by - ay) - py)


def far(p, q):
    if inside(p, *q[0][0]) or inside(q, *p[0][0]):
        return 0.0
    least = math.inf
    for a in edges(p):
        for b in edges(q):
            side = lambda s, x, y: (s[2] - s[0]) * (y - s[1]) - (s[3] - s[1]) * (x - s[0])
            if side(a, *b[:2]) * side(a, *b[2:]) < 0 and side(b, *a[:2]) * side(b, *a[2:]) < 0:
                return 0.0
            least = min(least, *(point_far(*e, *o) for s, o in ((a, b), (b, a)) for e in (s[:2], s[2:])))
    return least


def star(rng, n, x, y, r):
    return [(x + s * math.cos(2 * math.pi * i / n), y + s * math.sin(2 * math.pi * i / n)) for i in range(n) for s in (r * rng.uniform(0.3, 1),)]


def test_concave_parcels_equal_brute_force(spark):
    rng = random.Random(5)
    rows = []
    for i in range(70):
        x, y, r = rng.uniform(0, 900), rng.uniform(0, 900), 10 ** rng.uniform(0.5, 2)
        rows.append((i % 2, i, [star(rng, rng.choice([3, 6, 11]), x, y, r)] + ([star(rng, 4, x, y, r / 5)] if i % 3 == 0 else [])))
    square = lambda x, y, r: [(float(x + a * r), float(y + b * r)) for a, b in ((-1, -1), (1, -1), (1, 1), (-1, 1))]
    rows += [(0, 100, [square(5000, 0, 100), square(5000, 0, 60)]), (0, 101, [square(5000, 0, 10)]), (0, 102, [square(5000, 0, 1)]), (0, 103, [square(5200, 0, 100)])]  # in a hole, inside, edge to edge
    df = spark.createDataFrame(rows, RINGS)
    every = {(a[0], a[1], b[1]): far(a[2], b[2]) for a in rows for b in rows if a[0] == b[0] and a[1] < b[1]}
    for gap in (3.0, 40.5):
        got = {(r.site, r.a, r.b): r.apart_m for r in parcels.pairs_within(df, "k", gap, ("site",)).collect()}
        want = {k: d for k, d in every.items() if d <= gap}
        assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], abs=1e-6) for k in want)
    root = {r[1]: r[1] for r in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for (_, a, b), d in every.items():
        if d <= 40.5:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    assert {r.k: r.component for r in parcels.grouped(df, "k", 40.0, ("site",)).collect()} == {k: find(k) for k in root}
    pairs = parcels.pairs_within(df, "k", 3.0, ("site",))
    shared = {(r.a, r.b): r.overlap_m2 for r in parcels.overlaps(df, "k", pairs, ("site",)).collect()}
    assert shared[101, 102] == pytest.approx(4) and shared[100, 103] == 0 and (100, 101) not in shared
    # Against points of a fine grid.
    for (a, b), area in list(shared.items())[:12]:
        p, q = (next(r[2] for r in rows if r[1] == k) for k in (a, b))
        xs, ys = ([v[i] for ring in p for v in ring] for i in (0, 1))
        n, (x0, x1, y0, y1) = 120, (min(xs), max(xs), min(ys), max(ys))
        hits = sum(inside(p, x, y) and inside(q, x, y) for i in range(n) for j in range(n) for x, y in [(x0 + (x1 - x0) * (i + 0.5) / n, y0 + (y1 - y0) * (j + 0.5) / n)])
        assert area == pytest.approx(hits * (x1 - x0) * (y1 - y0) / n**2, abs=0.02 * (x1 - x0) * (y1 - y0) + 1e-6)
    assert parcels.pairs_within(df.where(F.lit(False)), "k", 3.0).count() == 0


def ragged(rng, n, x, y, r):
    return [(x + s * math.cos(2 * math.pi * i / n), y + s * math.sin(2 * math.pi * i / n)) for i in range(n) for s in (r * rng.uniform(0.8, 1),)]


def apart(p, q):
    return min(far(a, b) for a in p for b in q)


def test_polygons_of_many_edges_and_parts_equal_brute_force(spark):
    rng = random.Random(9)
    polygons = {}
    for i in range(36):
        x, y, n = rng.uniform(0, 700), rng.uniform(0, 700), rng.choice([4, 15, 16, 17, 33, 90])
        r = 8 if n == 4 else rng.uniform(15, 120)
        polygons[i] = [[ragged(rng, n, x, y, r)] + ([ragged(rng, 20, x, y, r / 2)] if i % 3 == 0 else [])]
        if i % 4 == 0:
            polygons[i].append([ragged(rng, 5, x + 300, y, 6)])
    # In another one by the second part alone, about another one by the second part alone, and the same row twice.
    polygons |= {100: [[ragged(rng, 40, 5000, 0, 200)]], 101: [[ragged(rng, 4, 3000, 0, 5)], [ragged(rng, 4, 5000, 0, 5)]], 102: [[ragged(rng, 4, 2000, 0, 5)], [ragged(rng, 40, 3000, 0, 300)]]}
    polygons[103] = [[ragged(rng, 4, 5020, 0, 5)]] * 2
    polygons[104] = [[ragged(rng, 40, 5020, 0, 90)]] * 2
    df = spark.createDataFrame([(0, k, rings) for k, parts in polygons.items() for rings in parts], RINGS)
    for gap, cell in ((2.0, 50.0), (30.0, 300.0)):
        got = {(r.a, r.b): r.apart_m for r in parcels.pairs_within(df, "k", gap, ("site",), cell).collect()}
        want = {(a, b): d for a in polygons for b in polygons if a < b for d in (apart(polygons[a], polygons[b]),) if d <= gap}
        assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], abs=1e-6) for k in want)
        assert {(100, 101), (101, 102), (100, 103), (100, 104), (103, 104)} <= got.keys()


def test_odd_rings_and_missing_coordinates(spark):
    square = lambda x, y, r: [(x - r, y - r), (x + r, y - r), (x + r, y + r), (x - r, y + r)]
    rows = [(0, 1, [square(0.0, 0.0, 10.0), None, []]), (0, 2, [square(0.0, 0.0, 2.0) + [(None, 3.0), (float("nan"), 0.0)]]), (0, 3, None), (0, 4, []), (0, 5, [[(11.0, 0.0)]]), (0, None, [square(0.0, 0.0, 5.0)]), (1, 6, [square(0.0, 0.0, 5.0)])]
    got = {(r.a, r.b): r.apart_m for r in parcels.pairs_within(spark.createDataFrame(rows, RINGS), "k", 3.0, ("site",)).collect()}
    assert got == {(1, 2): 0.0, (1, 5): pytest.approx(1.0)}


def test_polygons_are_joined_as_runs_and_not_as_edges(spark, monkeypatch):
    """The join's rows, of which each is copied to its cells, are as few as polygons of few edges are."""
    sizes, join = [], parcels.box_join
    monkeypatch.setattr(parcels, "box_join", lambda left, right, *more: sizes.append((left.count(), right.count())) or join(left, right, *more))
    rng = random.Random(3)
    df = spark.createDataFrame([(0, k, [ragged(rng, 10, 40.0 * k, 0.0, 15)]) for k in range(20)] + [(0, 50, [ragged(rng, 160, 0.0, 0.0, 90)])], RINGS)
    parcels.pairs_within(df, "k", 3.0, ("site",))
    assert sizes[0] == (30, 30)
