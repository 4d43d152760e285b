"""Sites cut into tiles against the same grids measured whole."""

import numpy as np
import pytest

from geosieve.operators import raster, tiles

SCHEMA = "k string, row int, column int, site boolean, building boolean, cover int, height double, road boolean, industrial boolean"


def plain_patches(mask):
    out, n = np.zeros(mask.shape, int), 0
    for i, j in zip(*np.nonzero(mask)):
        if not out[i, j]:
            n += 1
            todo = [(i, j)]
            while todo:
                y, x = todo.pop()
                if 0 <= y < mask.shape[0] and 0 <= x < mask.shape[1] and mask[y, x] and not out[y, x]:
                    out[y, x] = n
                    todo += [(y + 1, x), (y - 1, x), (y, x + 1), (y, x - 1)]
    return out


def test_patches_and_distances_at_random():
    rng = np.random.default_rng(5)
    for share in (0.0, 0.02, 0.3, 0.55, 0.7, 1.0):
        mask = rng.random((23, 31)) < share
        assert np.array_equal(raster.patches(mask), plain_patches(mask))
        y, x = np.mgrid[0:23, 0:31]
        for d in (0.0, 0.9, 1.0, 2**0.5, 5.0, 7.3, 60.0):
            want = np.zeros_like(mask)
            for i, j in zip(*np.nonzero(mask)):
                want |= (y - i) ** 2 + (x - j) ** 2 <= d * d
            assert np.array_equal(raster.grown(mask, d), want)
    spiral = np.zeros((9, 9), bool)
    spiral[0, :] = spiral[:, 8] = spiral[8, :] = spiral[2:, 0] = spiral[2, :7] = True
    assert raster.patches(spiral).max() == plain_patches(spiral).max()


def grids(n):
    """Rows of three sites: rough ground with long patches, one without heights, one with cover missing."""
    rng = np.random.default_rng(6)
    rows = []
    for k in "abc":
        height = np.cumsum(rng.normal(0, 1.0, (n, n)), axis=0) * 0.8
        height[rng.random((n, n)) < 0.002] = np.nan
        site = np.ones((n, n), bool)
        site[:3] = site[:, -4:] = False
        site[n // 2] = rng.random(n) < 0.3
        building, road, industry = rng.random((n, n)) < 0.001, np.zeros((n, n), bool), rng.random((n, n)) < 0.004
        road[1] = True
        for i in range(n):
            for j in range(n):
                cover = None if k == "c" and (i, j) == (9, 9) else 90 if rng.random() < 0.001 else 52
                rows.append((k, i, j, bool(site[i, j]), bool(building[i, j]), cover, None if k == "b" or np.isnan(height[i, j]) else float(height[i, j]), bool(road[i, j]), bool(industry[i, j])))
    return rows


@pytest.mark.parametrize("setbacks", [None, (10.0, 20.0, 0.0)])
def test_any_tile_gives_the_same(spark, setbacks):
    n = 61
    cells = spark.createDataFrame(grids(n), SCHEMA).repartition(3)
    options = dict(gap_m=20.0, pad_width_m=20.0, building_m=15.0, near_m=(30.0, 40.0), setbacks_m=setbacks)
    want = sorted(raster.measure_usable(cells, "k", n, 10.0, **options).collect())
    assert want[0].lost_slope_m2 > 0 and want[0].pads > 0 and want[2].status == "failed"
    for tile in (16, 25, 64):
        got = tiles.measure_tiles(cells, "k", n, 10.0, tile=tile, **options)
        assert got.columns == list(want[0].asDict()) and sorted(got.collect()) == want


def test_odd_tables(spark):
    cells = spark.createDataFrame(grids(20)[:400], SCHEMA)
    assert tiles.measure_tiles(cells.limit(0), "k", 20, 10.0).count() == 0
    want = raster.measure_usable(cells, "k", 20, 10.0).collect()
    lost = spark.createDataFrame([(None, 1, 1, True, True, 5, 1.0, True, True), ("a", None, 1, True, True, 5, 1.0, True, True), ("a", 20, 1, True, True, 5, 1.0, True, True)], SCHEMA)
    got = tiles.measure_tiles(cells.union(cells).union(lost).withColumn("ty", cells["row"]).withColumn("total", cells["row"]), "k", 20, 10.0)
    assert got.collect() == want


def test_patch_through_many_tiles(spark):
    """One winding strip of cells through all tiles is one block, however small the tiles."""
    n = 64
    strip = lambda i, j: i % 8 < 4 or (j >= n - 4 if i // 8 % 2 == 0 else j < 4)
    cells = spark.createDataFrame([("a", i, j, strip(i, j), False, 52, None, False, False) for i in range(n) for j in range(n)], SCHEMA)
    got = tiles.measure_tiles(cells, "k", n, 10.0, gap_m=0.0, setback_m=0.0, building_m=0.0, pad_width_m=0.0, tile=8).first()
    area = sum(strip(i, j) for i in range(n) for j in range(n)) * 100.0
    assert (got.usable_m2, got.largest_m2, got.pads) == (area, area, int(area // 2000))
