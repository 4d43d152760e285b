"""Overlays: boxes in closed form, polygons clipped to convex ones, unions on a line or a grid."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def box_overlap(ax0: Column, ay0: Column, ax1: Column, ay1: Column, bx0: Column, by0: Column, bx1: Column, by1: Column) -> Column:
    """The area two boxes share."""
    side = lambda a0, a1, b0, b1: F.greatest(F.lit(0.0), F.least(a1, b1) - F.greatest(a0, b0))
    return side(ax0, ax1, bx0, bx1) * side(ay0, ay1, by0, by1)


def clip_convex(subject: np.ndarray, convex: np.ndarray) -> np.ndarray:
    """The part of a polygon (n, 2) inside a convex one, edge by edge of the latter."""
    if _area(convex) < 0:
        convex = convex[::-1]
    out = subject
    for a, b in zip(convex, np.roll(convex, -1, axis=0)):
        if not len(out):
            break
        side = (b[0] - a[0]) * (out[:, 1] - a[1]) - (b[1] - a[1]) * (out[:, 0] - a[0])
        kept = []
        for i in range(len(out)):
            j = (i + 1) % len(out)
            if side[i] >= 0:
                kept.append(out[i])
            if (side[i] > 0) != (side[j] > 0) and side[i] != side[j]:
                kept.append(out[i] + (out[j] - out[i]) * (side[i] / (side[i] - side[j])))
        out = np.array(kept).reshape(-1, 2)
    return out


def _area(p: np.ndarray) -> float:
    if len(p) < 3:
        return 0.0
    x, y = p[:, 0], p[:, 1]
    return float((x * np.roll(y, -1) - np.roll(x, -1) * y).sum() / 2)


@F.arrow_udf(T.DoubleType())
def clipped_area(subject: pa.Array, convex: pa.Array) -> pa.Array:
    """The area of a polygon inside a convex one; both are arrays of [x, y] in a plane, null gives null."""
    out = []
    for s, c in zip(subject.to_pylist(), convex.to_pylist()):
        out.append(None if s is None or c is None else abs(_area(clip_convex(np.array(s, float).reshape(-1, 2), np.array(c, float).reshape(-1, 2)))))
    return pa.array(out, pa.float64())


def ring_ends(rings: pa.Array) -> tuple[np.ndarray, ...]:
    """Which row each edge of its rings (lists of struct(x, y)) is of, and its ends ax, ay, bx, by; the closing edges are included."""
    inner = rings.flatten()
    count, size = (a.value_lengths().fill_null(0).to_numpy(zero_copy_only=False) for a in (rings, inner))
    x, y = (inner.flatten().field(c).to_numpy(zero_copy_only=False) for c in "xy")
    row = np.repeat(np.repeat(np.arange(len(rings)), count), size)
    after = np.arange(1, len(x) + 1)
    last = np.cumsum(size)[size > 0]
    after[last - 1] = last - size[size > 0]
    return row, x, y, x[after], y[after]


def united(shape: np.ndarray, layer: np.ndarray, layers: int, ends: list[np.ndarray], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Whether grid points (layers by y by x) are inside any shape of a layer, each by the even-odd rule over all its rings.

    shape is that of each edge, layer that of each shape. A shape's edges cut a
    row into intervals, taken from the right, and the intervals of a layer are summed.
    """
    ax, ay, bx, by = ends
    low, high = (np.searchsorted(y, f(ay, by)) for f in (np.minimum, np.maximum))
    n = np.where(np.isnan(ay) | np.isnan(by), 0, high - low)
    e = np.repeat(np.arange(len(ax)), n)
    row = np.repeat(low, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    at = (bx[e] - ax[e]) * (y[row] - ay[e]) / (by[e] - ay[e]) + ax[e]
    k = np.where(np.isnan(at), 0, np.searchsorted(x, at))
    line = shape[e] * len(y) + row
    order = np.lexsort((-k, line))
    k, line, e, row = k[order], line[order], e[order], row[order]
    first = np.maximum.accumulate(np.where(np.append(True, line[1:] != line[:-1])[: len(line)], np.arange(len(line)), 0))
    even = (np.arange(len(line)) - first) % 2 == 0
    begin = np.where(np.append(line[1:] == line[:-1], False)[: len(line)], np.append(k[1:], 0)[: len(line)], 0)
    wide = len(x) + 1
    base = (layer[shape[e]] * len(y) + row) * wide
    size = layers * len(y) * wide
    steps = np.bincount((base + begin)[even], minlength=size) - np.bincount((base + k)[even], minlength=size)
    return np.cumsum(steps.reshape(layers, len(y), wide), axis=2)[:, :, :-1] > 0


def zone_shares(shapes: DataFrame, key: str, cells: int = 128) -> DataFrame:
    """Areas of a footprint by zone, each without what more severe zones cover: key, rank, area, pct.

    shapes: key, rank (null for the footprint, else the zone's severity, 0 the
    worst) and rings of struct(x, y) in metres. Rank null in the result is the
    unmapped rest, so shares add up to 100. The footprint's box is cut into
    cells by cells, whose centres decide: an area is off by at most about its
    perimeter times half a cell. A footprint and the zones over it are one
    group; a missing or empty footprint gives no row.
    """

    def one(table: pa.Table) -> pa.Table:
        rank, (shape, *ends) = table.column("rank").fill_null(-1).to_numpy(), ring_ends(table.column("rings").combine_chunks())
        own = rank[shape] < 0
        out: list[tuple[int | None, float, float]] = []
        if own.any():
            (x0, y0), (x1, y1) = ((min(ends[i][own].min(), ends[i + 2][own].min()) for i in (0, 1)), (max(ends[i][own].max(), ends[i + 2][own].max()) for i in (0, 1)))
            middle = (np.arange(cells) + 0.5) / cells
            x, y = x0 + (x1 - x0) * middle, y0 + (y1 - y0) * middle
            ranks = np.unique(rank)
            layers = dict(zip(ranks.tolist(), united(shape, np.searchsorted(ranks, rank), len(ranks), ends, x, y)))
            rest = layers.pop(-1)
            cell, total = (x1 - x0) * (y1 - y0) / cells**2, rest.sum()
            for r, layer in layers.items():
                held = layer & rest
                if held.any():
                    out.append((r, float(held.sum() * cell), float(100 * held.sum() / total)))
                rest = rest & ~layer
            if rest.any():
                out.append((None, float(rest.sum() * cell), float(100 * rest.sum() / total)))
        who = pa.array([table.column(key)[0].as_py()] * len(out), table.schema.field(key).type)
        return pa.table({key: who, "rank": pa.array([r for r, _, _ in out], pa.int32()), "area": pa.array([a for _, a, _ in out], pa.float64()), "pct": pa.array([p for _, _, p in out], pa.float64())})

    # A number of tasks: the shuffled rings are small for the work on them, and would be merged to few tasks.
    dealt = shapes.repartition(int(shapes.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)
    return dealt.groupBy(key).applyInArrow(one, f"{key} {dict(shapes.dtypes)[key]}, rank int, area double, pct double")


def answered_within(x0: Column, y0: Column, x1: Column, y1: Column, reach: Column) -> Column:
    """Whether a box, in metres about its site, lies wholly inside the radius of an answer about the site."""
    return F.sqrt(F.greatest(x0 * x0, x1 * x1) + F.greatest(y0 * y0, y1 * y1)) <= reach
