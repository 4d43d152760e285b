"""What a pair of a range join costs: nothing with a cosine or a root is a condition of the join, where its terms are computed many times."""

import re

from pyspark.sql import functions as F

from geosieve.operators import circles, lines, spatial
from geosieve.plans import complete, registry

SF = "/root/testdata/sf0.001"


def join_conditions(df):
    """The lines of merge joins in the plan."""
    return re.findall(r"SortMergeJoin.*", df._jdf.queryExecution().executedPlan().toString())


def test_a_range_join_only_adds_and_compares(spark):
    sites = spark.createDataFrame([(1, 40.0, -90.0)], "site int, lat double, lng double")
    features = spark.createDataFrame([(1, 40.0, -90.01), (2, 40.0, -90.2)], "f int, f_lat double, f_lng double")
    for own in (None, F.lit(2_000.0)):
        found = join_conditions(spatial.range_join(sites, features, 30_000.0, own_m=own))
        assert found and not any("COS" in x for x in found)


def test_a_sites_own_reach_holds_east_and_west_too(spark):
    sites = spark.createDataFrame([(1, 40.0, -90.0, 2_000.0), (2, 40.0, -90.0, None), (3, 60.0, -90.0, 2_000.0)], "site int, lat double, lng double, own double")
    features = spark.createDataFrame([(1, 40.0, -90.02), (2, 40.0, -90.03), (3, 40.01, -89.98), (4, 60.0, -90.03), (5, 60.0, -90.04)], "f int, f_lat double, f_lng double")
    got = {(r.site, r.f) for r in spatial.range_join(sites, features, 30_000.0, own_m=F.col("own")).collect()}
    assert got == {(1, 1), (1, 3), (2, 1), (2, 2), (2, 3), (3, 4)}


def test_distances_of_lines_are_no_condition_of_their_join(spark):
    found = join_conditions(registry.QUERIES["nearest_segment"](spark, SF))
    assert found and not any("SQRT" in x or "COS" in x for x in found)


def test_segments_that_lie_alike_and_sites_at_one_place_are_measured_once(spark, monkeypatch):
    seen, join = [], lines.box_join
    monkeypatch.setattr(lines, "box_join", lambda left, right, *more: seen.append((left.count(), right.count())) or join(left, right, *more))
    part = [(-90.0, 40.01), (-89.9, 40.01), (-89.8, 40.05)]
    made = [(9 - i, i >= 3, f"n{i}", [part]) for i in range(9)] + [(20, True, "late", [part[:2]])]
    df = spark.createDataFrame(made, "line int, big boolean, name string, parts array<array<struct<lng double, lat double>>>")
    at = [(i, 40.0, -89.95) for i in range(8)] + [(8, None, None), (9, 50.0, -89.95)]
    sites = spark.createDataFrame(at, "site int, lat double, lng double")
    out = lines.nearest_lines(sites, lines.segments(df), "site", "line", 8000.0, {"any": None, "big": F.col("big"), "none": F.col("line") > 99}, ["name"])
    found = join_conditions(out)
    assert found and not any("SQRT" in x or "COS" in x for x in found)
    got = {r.site: r for r in out.collect()}
    assert len(got) == 10 and all(r["none"] is None for r in got.values()) and all(got[i]["any"] is got[i]["big"] is None for i in (8, 9))
    for i in range(8):
        r = got[i]["any"]
        assert (r.d_mm, r.line, r.part, r.segment, r.name) == (1_105_400, 1, 0, 0, "n8") and r == got[i]["big"]
        assert abs(r.foot_lat - 40.01) < 1e-9 and abs(r.foot_lng + 89.95) < 1e-9
    # The first pass meets all places, the second one those with a line.
    assert seen == [(3, 2), (1, 2)]


def test_each_circle_takes_one_root_of_an_edge(spark):
    """As one expression the root was taken wherever a point of the circle is named, in code too long to be compiled."""
    ring = "array<struct<lng:double,lat:double>>"
    table = spark.createDataFrame([(1, [(-90.0, 40.0), (-89.99, 40.0), (-90.0, 40.01)], None)], f"shape long, outer {ring}, holes array<{ring}>")
    sites = spark.createDataFrame([(1, 40.0, -90.0, 700.0)], "site long, lat double, lng double, r double")
    name = "spark.sql.debug.maxToStringFields"
    before = spark.conf.get(name)
    spark.conf.set(name, "1000")
    try:
        plan = circles.shares_within(sites, table, "site", "shape", {"near": F.col("r"), "far": F.col("r") * 2}, F.lit(1400.0), 500.0)._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set(name, before)
    assert plan.count("SQRT(") == 2 and 0 < plan.count("ATAN2(") <= 5


def test_polygons_that_hold_a_site_come_with_their_shares(spark):
    ring = "array<struct<lng:double,lat:double>>"
    square = lambda x, y, r: [(x - r, y - r), (x + r, y - r), (x + r, y + r), (x - r, y + r)]
    outer = square(-90.0, 40.0, 0.01)
    rows = [(1, 7, outer, None), (2, 8, outer[::-1], [square(-90.0, 40.0, 0.001)]), (3, 9, outer, [square(-90.0, 40.0, 0.001)[::-1], square(-90.005, 40.005, 0.001)])]
    table = spark.createDataFrame(rows, f"shape long, hu long, outer {ring}, holes array<{ring}>")
    sites = spark.createDataFrame([(1, 40.0, -90.0), (2, 40.005, -90.005), (3, 40.02, -90.0)], "site long, lat double, lng double")
    got = {(r.site, r["shape"]): r for r in circles.shares_within(sites, table, "site", "shape", {"all": F.lit(9_000.0), "none": F.lit(0.0)}, F.lit(9_000.0), 500.0, ("hu",), "held").collect()}
    assert len(got) == 9 and {k for k, r in got.items() if r.held} == {(1, 1), (2, 1), (2, 2)}
    assert all(r.hu == k[1] + 6 and abs(r["all"] - 1) < 1e-9 and r.none == 0 for k, r in got.items())


def test_blocks_that_lie_alike_count_as_one_and_are_dealt(spark, monkeypatch):
    seen, shares, measured = [], complete.shares_within, complete.spatial.measured
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    monkeypatch.setattr(complete, "shares_within", lambda own, shapes, *more: seen.append((own.rdd.getNumPartitions(), shapes.count())) or shares(own, shapes, *more))
    monkeypatch.setattr(complete.spatial, "measured", lambda own, blocks, *more: seen.append(blocks.rdd.getNumPartitions()) or measured(own, blocks, *more))
    # Nine of a size and one of another at the place of customer 13's site, whose own is shifted by (-6, +5) thousandths.
    rows = [(20 - i, 7 if i < 9 else 8, 25.0 + 13 * 6007 % 24000 / 1000, -124.0 + 13 * 50021 % 57000 / 1000) for i in range(10)]
    monkeypatch.setattr(complete, "parts", lambda t: spark.createDataFrame(rows, "feature long, size long, f_lat double, f_lng double").coalesce(1))
    got = {r.site: r for r in complete.housing_blocks(registry.Tables(spark, SF)).collect()}
    assert seen == [(tasks, 2), tasks]
    with_any = {k for k, r in got.items() if r.hu_near_pass > 0}
    assert with_any == {13} and got[13].blocks_within_1mi == 10 and got[13].hu_within_1mi == 71 and got[13].pop_within_1mi == 213
    assert 0 < got[13].hu_near_review <= got[13].hu_near_pass <= 71


def test_sites_in_no_block_are_no_rows_of_the_join_with_blocks(spark):
    """As nulls of an outer join's key they would all be in one task."""
    joins = re.findall(r"Join LeftOuter.*", registry.QUERIES["housing_blocks"](spark, SF)._jdf.queryExecution().optimizedPlan().toString())
    assert joins and not any("(at#" in x for x in joins)
