"""Usable land of sites of any size: grids cut into tiles, with rims for what reaches across.

A tile is one row that holds its cells as bytes. A step whose reach is known
sends each tile's rim to the tiles beside it and works on one tile with its
surroundings at a time, so memory follows the tile's size, not the site's.
Patches may cross any number of tiles: each tile numbers its own, those at an
edge are linked with what lies on the other side, and components over these
links tell the whole ones. No measure depends on the size of the tiles.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from geosieve.operators import raster
from geosieve.operators.components import components
from geosieve.sources.scratch import Scratch

TILE = 512
SITE, BUILDING, ROAD, INDUSTRY = 1, 2, 4, 8
SETBACK, NEAR_BUILDING, COVER, STEEP, UNKNOWN = 2, 4, 8, 16, 32
LOST = {"setback": SETBACK, "building": NEAR_BUILDING, "cover": COVER, "slope": STEEP}
LAYERS = {"bits": np.uint8, "cover": np.int16, "height": np.float64}
NO_COVER = -1
EDGES = "array<struct<across boolean, row int, column int, patch long>>"
PATCHES = "array<struct<patch long, cells long>>"


def packed(cells: DataFrame, key: str, size: int, tile: int) -> DataFrame:
    """One row a tile (key, ty, tx, bits, cover, height) of cells as measure_tiles takes them."""
    flags = {"site": SITE, "building": BUILDING, "road": ROAD, "industrial": INDUSTRY}
    kept = cells.where(F.col(key).isNotNull() & F.col("row").between(0, size - 1) & F.col("column").between(0, size - 1))
    bits = sum((F.when(F.col(n), v).otherwise(0) for n, v in flags.items() if n in cells.columns), F.lit(0))
    rows = kept.select(
        key, F.floor(F.col("row") / tile).cast("int").alias("ty"), F.floor(F.col("column") / tile).cast("int").alias("tx"), F.col("row").cast("int"), F.col("column").cast("int"),
        bits.cast("int").alias("bits"), F.coalesce(F.col("cover").cast("int"), F.lit(NO_COVER)).alias("cover"), F.coalesce(F.col("height").cast("double"), F.lit(float("nan"))).alias("height"),
    )

    def pack(table: pa.Table) -> pa.Table:
        at = (table.column("row").to_numpy() % tile) * tile + table.column("column").to_numpy() % tile
        out = {"bits": np.zeros(tile * tile, np.uint8), "cover": np.full(tile * tile, np.iinfo(np.int16).max, np.int16), "height": np.full(tile * tile, np.nan)}
        np.bitwise_or.at(out["bits"], at, table.column("bits").to_numpy().astype(np.uint8))
        np.minimum.at(out["cover"], at, table.column("cover").to_numpy().astype(np.int16))
        np.fmax.at(out["height"], at, table.column("height").to_numpy())
        out["cover"][out["cover"] == np.iinfo(np.int16).max] = NO_COVER
        first = table.slice(0, 1)
        return pa.table({**{c: first.column(c) for c in (key, "ty", "tx")}, **{n: pa.array([v.tobytes()], pa.binary()) for n, v in out.items()}})

    return rows.groupBy(key, "ty", "tx").applyInArrow(pack, f"{key} {dict(cells.dtypes)[key]}, ty int, tx int, bits binary, cover binary, height binary")


def over_rims(tiles: DataFrame, key: str, layers: dict[str, type], size: int, tile: int, halo: int, f: Callable[[dict[str, np.ndarray], int, int, tuple[slice, slice]], dict], schema: str) -> DataFrame:
    """f of each tile's layers with a rim of ``halo`` cells, cut at the grid's edges: one row a tile.

    f takes the layers, the row and column of the tile's first cell in the
    grid, and where in the layers the tile lies. A rim is at most a tile wide.
    """
    if halo > tile:
        raise ValueError(f"a rim of {halo} cells is wider than a tile of {tile}")
    kind = dict(tiles.dtypes)[key]
    spans = (slice(tile - halo, tile), slice(0, tile), slice(0, halo))

    def send(batches):
        for b in batches:
            for k in range(b.num_rows):
                ty, tx = b.column("ty")[k].as_py(), b.column("tx")[k].as_py()
                held = {n: np.frombuffer(b.column(n)[k].as_buffer(), t).reshape(tile, tile) for n, t in layers.items()}
                # The part that the tile dy, dx away needs: the side that faces it.
                to = [(dy, dx) for dy in (-1, 0, 1) for dx in (-1, 0, 1) if 0 <= (ty + dy) * tile < size and 0 <= (tx + dx) * tile < size and (halo or not (dy or dx))]
                cut = lambda n, dy, dx: held[n][spans[1 - dy if dy else 1], spans[1 - dx if dx else 1]].tobytes()
                yield pa.RecordBatch.from_arrays(
                    [pa.concat_arrays([b.column(key).slice(k, 1)] * len(to)), pa.array([ty + dy for dy, _ in to], pa.int32()), pa.array([tx + dx for _, dx in to], pa.int32()), pa.array([-dy for dy, _ in to], pa.int32()), pa.array([-dx for _, dx in to], pa.int32()),
                     *[pa.array([cut(n, dy, dx) for dy, dx in to], pa.binary()) for n in layers]],
                    names=[key, "ty", "tx", "dy", "dx", *layers],
                )

    fill = {np.uint8: 0, np.int16: NO_COVER, np.float64: np.nan}
    # Where in a window the tile to the north or west, the tile itself, and the one to the south or east lie.
    place = {-1: slice(0, halo), 0: slice(halo, halo + tile), 1: slice(halo + tile, tile + 2 * halo)}

    def work(table: pa.Table) -> pa.Table:
        dy, dx = table.column("dy").to_pylist(), table.column("dx").to_pylist()
        if (0, 0) not in zip(dy, dx):
            return pa.schema(out_schema).empty_table()
        ty, tx = table.column("ty")[0].as_py(), table.column("tx")[0].as_py()
        wide = {n: np.full((tile + 2 * halo,) * 2, fill[t], t) for n, t in layers.items()}
        for k, (y, x) in enumerate(zip(dy, dx)):
            for n, t in layers.items():
                part = wide[n][place[y], place[x]]
                part[:] = np.frombuffer(table.column(n)[k].as_buffer(), t).reshape(part.shape)
        top, left = ty * tile, tx * tile
        up, west = min(halo, top), min(halo, left)
        down, east = min(top + tile + halo, size), min(left + tile + halo, size)
        rows, columns = slice(halo - up, halo + down - top), slice(halo - west, halo + east - left)
        own = slice(up, up + min(tile, size - top)), slice(west, west + min(tile, size - left))
        got = f({n: v[rows, columns] for n, v in wide.items()}, top, left, own)
        first = table.slice(0, 1)
        return pa.table({**{c: first.column(c) for c in (key, "ty", "tx")}, **{n: pa.array([v], out_schema.field(n).type) for n, v in got.items()}})

    out = tiles.sparkSession.createDataFrame([], f"{key} {kind}, ty int, tx int, {schema}").schema
    out_schema = to_arrow_schema(out)
    sent = tiles.mapInArrow(send, f"{key} {kind}, ty int, tx int, dy int, dx int, {', '.join(f'{n} binary' for n in layers)}")
    return sent.groupBy(key, "ty", "tx").applyInArrow(work, out)


def at_edges(found: np.ndarray, top: int, left: int, size: int) -> tuple[np.ndarray, list[dict], list[dict]]:
    """(first cells by patch number, patches at an edge with their sizes, their edge cells) of a tile's numbered patches.

    A patch's name is its first cell's place in the grid. An edge cell is told
    as the border it lies at: rows or columns across, and the cell before it.
    """
    h, w = found.shape
    _, first = np.unique(found, return_index=True)
    if not (found == 0).any():
        first = np.append(0, first)
    names = (first // w + top) * size + first % w + left
    cells = np.bincount(found.ravel(), minlength=len(names))
    sides = ((True, top - 1, left, found[0]), (True, top + h - 1, left, found[-1]), (False, top, left - 1, found[:, 0]), (False, top, left + w - 1, found[:, -1]))
    edge = [
        {"across": across, "row": row if across else row + k, "column": column + k if across else column, "patch": int(names[line[k]])}
        for across, row, column, line in sides
        if 0 <= (row if across else column) < size - 1
        for k in np.flatnonzero(line).tolist()
    ]
    touching = {e["patch"] for e in edge}
    return names, [{"patch": int(names[k]), "cells": int(cells[k])} for k in range(1, len(names)) if int(names[k]) in touching], edge


def joined_patches(scratch: Scratch, tiles: DataFrame, key: str) -> DataFrame:
    """(key, ty, tx, patch, whole, total) of the patches at an edge: the name and the cells of the whole patch, over all tiles."""
    node = F.struct(F.col(key), F.col("patch"))
    edges = tiles.select(key, F.explode("edges").alias("e")).select(key, "e.*")
    # A border cell has one patch on either side, so a group holds two rows at most.
    links = edges.groupBy(key, "across", "row", "column").agg(F.min(node).alias("a"), F.max(node).alias("b")).where("a <> b").select("a", "b")
    roots = components(scratch, links)
    own = tiles.select(key, "ty", "tx", F.explode("patches").alias("p")).select(key, "ty", "tx", "p.*")
    own = own.withColumn("node", node).join(roots, "node", "left").withColumn("whole", F.coalesce("root.patch", "patch"))
    totals = own.groupBy(key, "whole").agg(F.sum("cells").alias("total"))
    return own.select(key, "ty", "tx", "patch", "whole").join(totals, [key, "whole"])


def measure_tiles(cells: DataFrame, key: str, size: int, cell_m: float, gap_m: float = 50.0, setback_m: float = 20.0, most_slope: float = 15.0, excluded: tuple[int, ...] = (11, 90, 95), building_m: float = 10.0, pad_m2: float = 2000.0, pad_width_m: float = 30.0, least_patch_m2: float = 1011.7, near_m: tuple[float, float] = (30.0, 150.0), setbacks_m: tuple[float, float, float] | None = None, tile: int = TILE) -> DataFrame:
    """The columns of raster.measure_usable, for grids of any size.

    cells as there; size is the grid's rows and columns, the same for all
    sites. Tiles are made wider where a step's reach is wider. Cells without a
    key, or without a place in the grid, are left out. Of repeated cells the
    flags of all count, the least cover (none before any) and the greatest
    height. No cells, no rows. Other columns are not read.
    """
    scratch = Scratch(cells.sparkSession)
    near = (max(near_m) + max(setbacks_m)) / cell_m if setbacks_m else setback_m / cell_m
    first_rim = int(np.ceil(max(gap_m / cell_m + near, building_m / cell_m))) + 4
    radius = pad_width_m / 2 / cell_m
    second_rim = 2 * int(np.ceil(radius)) + 2
    tile = max(tile, first_rim, second_rim)

    def losses(of: dict[str, np.ndarray], top: int, left: int, own: tuple[slice, slice]) -> dict:
        has = lambda bit: (of["bits"] & bit) > 0
        site = has(SITE)
        if setbacks_m:
            inside = raster.inside_setback_by_neighbour(site, gap_m / cell_m, has(ROAD), has(INDUSTRY), tuple(m / cell_m for m in near_m), tuple(m / cell_m for m in setbacks_m))
        else:
            inside = raster.inside_setback(site, gap_m / cell_m, setback_m / cell_m)
        slope = raster.slope_percent(of["height"], cell_m)[own]
        found = raster.patches(np.nan_to_num(slope, nan=-1.0) > most_slope)
        names, patches, edges = at_edges(found, top, left, size)
        # Patches that touch no other tile are told here; the others once their parts are known.
        open_ = np.isin(names, [p["patch"] for p in patches])
        large = np.bincount(found.ravel(), minlength=len(names)) * cell_m**2 >= least_patch_m2
        steep = (found > 0) & (open_ | large)[found]
        planes = {SITE: site[own], SETBACK: (site & ~inside)[own], NEAR_BUILDING: (site & raster.grown(has(BUILDING), building_m / cell_m))[own], COVER: (site & np.isin(of["cover"], (0, *excluded)))[own], STEEP: steep, UNKNOWN: np.isnan(slope)}
        bits = np.zeros((tile, tile), np.uint8)
        for bit, plane in planes.items():
            bits[: plane.shape[0], : plane.shape[1]][plane] |= bit
        return {"bits": bits.tobytes(), "missing": bool((of["cover"][own][site[own]] < 0).any()), "heights": bool((~np.isnan(of["height"][own])).any()), "patches": patches, "edges": edges}

    first = scratch.keep(over_rims(packed(cells, key, size, tile), key, LAYERS, size, tile, first_rim, losses, f"bits binary, missing boolean, heights boolean, patches {PATCHES}, edges {EDGES}"))
    small = joined_patches(scratch, first, key).where(F.col("total") * cell_m**2 < least_patch_m2)
    # A tile's patches at an edge are at most as many as its edge cells.
    small = small.groupBy(key, "ty", "tx").agg(F.collect_list("patch").alias("small"))
    known = first.groupBy(key).agg(F.bool_or("heights").alias("known"))
    tiles = first.select(key, "ty", "tx", "bits").join(small, [key, "ty", "tx"], "left").join(known, key)
    names = [f"n_{n}" for n in ("site", *LOST)]

    def settle(batches):
        for b in batches:
            free, counts = [], []
            for k in range(b.num_rows):
                ty, tx = b.column("ty")[k].as_py(), b.column("tx")[k].as_py()
                bits = np.frombuffer(b.column("bits")[k].as_buffer(), np.uint8).reshape(tile, tile)
                has = {n: (bits & bit) > 0 for n, bit in {"site": SITE, **LOST}.items()}
                gone = b.column("small")[k].as_py()
                if gone:
                    found = raster.patches(has["slope"])
                    values, at = np.unique(found, return_index=True)
                    names_ = (at // tile + ty * tile) * size + at % tile + tx * tile
                    has["slope"] &= ~np.isin(found, values[np.isin(names_, gone) & (values > 0)])
                if b.column("known")[k].as_py():
                    has["slope"] |= (bits & UNKNOWN) > 0
                has["slope"] &= has["site"]
                free.append((has["site"] & ~np.logical_or.reduce([has[n] for n in LOST])).astype(np.uint8).tobytes())
                counts.append([int(v.sum()) for v in has.values()])
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in (key, "ty", "tx")], pa.array(free, pa.binary()), *[pa.array([c[i] for c in counts], pa.int64()) for i in range(len(names))]], names=[key, "ty", "tx", "free", *names])

    kind = dict(cells.dtypes)[key]
    second = scratch.keep(tiles.mapInArrow(settle, f"{key} {kind}, ty int, tx int, free binary, {', '.join(f'{n} long' for n in names)}"))

    def blocks(of: dict[str, np.ndarray], top: int, left: int, own: tuple[slice, slice]) -> dict:
        found = raster.patches(raster.opened(of["free"] > 0, radius)[own])
        names_, patches, edges = at_edges(found, top, left, size)
        cells_ = np.bincount(found.ravel(), minlength=len(names_))
        cells_[0] = 0
        whole = cells_[~np.isin(names_, [p["patch"] for p in patches])]
        return {"usable": int(cells_.sum()), "largest": int(whole.max(initial=0)), "pads": int(np.floor(whole * cell_m**2 / pad_m2).sum()), "patches": patches, "edges": edges}

    third = scratch.keep(over_rims(second, key, {"free": np.uint8}, size, tile, second_rim, blocks, f"usable long, largest long, pads long, patches {PATCHES}, edges {EDGES}"))
    wholes = joined_patches(scratch, third, key).select(key, "whole", "total").distinct()
    wholes = wholes.groupBy(key).agg(F.max("total").alias("across_largest"), F.sum(F.floor(F.col("total") * cell_m**2 / pad_m2)).alias("across_pads"))
    lost = second.groupBy(key).agg(*[F.sum(n).alias(n) for n in names])
    inside = third.groupBy(key).agg(*[f(n).alias(n) for n, f in (("usable", F.sum), ("largest", F.max), ("pads", F.sum))])
    failed = first.groupBy(key).agg(F.bool_or("missing").alias("failed"))
    out = lost.join(inside, key).join(failed, key).join(wholes, key, "left").fillna(0, ["across_largest", "across_pads"])
    told = lambda c, kind="double": F.when(~F.col("failed"), c.cast(kind))
    m2 = lambda c: told(c * F.lit(cell_m**2))
    return out.select(
        key, m2(F.col("n_site")).alias("site_m2"), m2(F.col("usable")).alias("usable_m2"), m2(F.greatest("largest", "across_largest")).alias("largest_m2"), *[m2(F.col(f"n_{n}")).alias(f"lost_{n}_m2") for n in LOST],
        told(F.col("pads") + F.col("across_pads"), "long").alias("pads"), F.when(F.col("failed"), "failed").otherwise("ok").alias("status"),
    )
