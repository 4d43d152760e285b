"""Exact areas of overlaid polygons, by trapezoids between edges.

Polygons are rows of edges. The plane is cut into horizontal bands, and in each
band at every y where an edge begins, ends or crosses another one. Between two such
y's no edges cross, so put in order from left to right they bound trapezoids, and
running counts along that order tell which polygons each trapezoid lies in. So
unions, intersections and differences are sums over the same trapezoids: no polygon
is built, no grid rounds the result, and concave shapes, holes and polygons of many
rings are nothing special.

Only edges are shuffled, a row for each band they reach; a task makes crossings, strips
and trapezoids of one band after the other, in bounded blocks. The work of a band is
what lies in it, so a polygon of very many vertices is spread over tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geosieve.functions.geo import ACRE_M2


def ring_edges(shapes: DataFrame, rings: str = "rings") -> DataFrame:
    """A row for each edge of the rings, arrays of struct(x, y), the closing ones included: x0, y0, x1, y1."""
    ring = shapes.withColumn("_ring", F.explode(rings)).drop(rings)
    edges = ring.select("*", F.posexplode("_ring").alias("_i", "_a")).withColumn("_b", F.get("_ring", (F.col("_i") + 1) % F.size("_ring")))
    return edges.select(*[c for c in shapes.columns if c != rings], F.col("_a.x").alias("x0"), F.col("_a.y").alias("y0"), F.col("_b.x").alias("x1"), F.col("_b.y").alias("y1"))


#: Rows of edges, pairs of them or edges of strips that a task holds at once, unless one band has more edges.
AT_ONCE = 500_000


def banded(edges: DataFrame, keys: list[str], kind: str, band: float) -> DataFrame:
    """The edges in each band: keys, band, shape, kind (the rank or group), the lower end ax, ay, the height by of the upper one, and slope.

    Horizontal edges bound no trapezoid from the side and go; null coordinates
    and keys go too.
    """
    up = F.col("y0") < F.col("y1")
    end = lambda a, b: F.when(up, F.col(a)).otherwise(F.col(b))
    held = edges.where("y0 <> y1").where(reduce(and_, [F.col(k).isNotNull() for k in keys]))
    lines = held.select(*keys, F.col("shape"), F.col(kind), end("x0", "x1").alias("ax"), end("y0", "y1").alias("ay"), end("y1", "y0").alias("by"), ((F.col("x1") - F.col("x0")) / (F.col("y1") - F.col("y0"))).alias("slope"))
    cell = lambda y: F.floor(F.col(y) / band).cast("long")
    return lines.withColumn("band", F.explode(F.sequence(cell("ay"), cell("by")))).where(F.greatest("ay", F.col("band") * F.lit(band)) < F.least("by", (F.col("band") + 1) * F.lit(band)))


def _blocks(sizes: np.ndarray, most: int | None = None) -> Iterator[tuple[int, int]]:
    """Runs of items whose sizes add up to about AT_ONCE or the most given, at least one item each."""
    ends, a = np.cumsum(sizes), 0
    while a < len(sizes):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + (most or AT_ONCE), "right")))
        yield a, b
        a = b


def _counted(counts: np.ndarray) -> np.ndarray:
    """0 to n - 1 for each count n, one after the other."""
    return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)


def _runs(*columns: np.ndarray) -> np.ndarray:
    """Where a run of equal values begins, for each row the row that begins its run."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))


def _crossings(group: np.ndarray, ax: np.ndarray, ay: np.ndarray, slope: np.ndarray, low: np.ndarray, high: np.ndarray, band: float) -> tuple[np.ndarray, np.ndarray]:
    """Group and y of each crossing of pieces of a group, found among those that share a cell of the band."""
    xs = ax + slope * (low - ay), ax + slope * (high - ay)
    first, last = (np.floor(f(*xs) / band).astype(np.int64) for f in (np.minimum, np.maximum))
    n = last - first + 1
    piece, column = np.repeat(np.arange(len(ax)), n), np.repeat(first, n) + _counted(n)
    order = np.lexsort((column, group[piece]))
    piece = piece[order]
    start = _runs(group[piece], column[order])
    # Each piece meets those after it in its cell.
    after = np.searchsorted(start, start, "right") - 1 - np.arange(len(start))
    found = []
    for a, b in _blocks(after):
        i = np.repeat(np.arange(a, b), after[a:b])
        p, q = piece[i], piece[i + 1 + _counted(after[a:b])]
        p, q = np.where(slope[p] < slope[q], p, q), np.where(slope[p] < slope[q], q, p)
        with np.errstate(divide="ignore", invalid="ignore"):
            y = (ax[q] - ax[p] + slope[p] * ay[p] - slope[q] * ay[q]) / (slope[p] - slope[q])
        kept = (slope[p] < slope[q]) & (y > np.maximum(low[p], low[q])) & (y < np.minimum(high[p], high[q]))
        found.append((group[p[kept]], y[kept]))
    return tuple(np.concatenate(x) for x in zip((group[:0], ay[:0]), *found))


def _group_areas(group: np.ndarray, shape: np.ndarray, rank: np.ndarray, ax: np.ndarray, ay: np.ndarray, slope: np.ndarray, low: np.ndarray, high: np.ndarray, ranks: int, band: float) -> np.ndarray:
    """Areas by group, 0 to n - 1, and first rank, the last column for none; rank -1 is the footprint's."""
    out = np.zeros((group.max(initial=-1) + 1) * (ranks + 1))
    # Strips lie between neighbouring y's at which edges of a group begin, end or cross.
    at, y = _crossings(group, ax, ay, slope, low, high, band)
    every = np.concatenate([low, high, y])
    of = np.concatenate([group, group, at])
    order = np.lexsort((every, of))
    start = _runs(of[order], every[order])
    firsts = np.unique(start)
    number = np.empty(len(every), np.int64)
    number[order] = np.searchsorted(firsts, start)
    ys, owner = every[order][firsts], of[order][firsts]
    begin, end = number[: len(low)], number[len(low) : 2 * len(low)]
    pieces = np.cumsum(np.bincount(begin, minlength=len(ys)) - np.bincount(end, minlength=len(ys)))
    by_begin, longest = np.argsort(begin, kind="stable"), int((end - begin).max(initial=0))
    begins = begin[by_begin]
    for a, b in _blocks(pieces):
        near = by_begin[np.searchsorted(begins, a - longest) : np.searchsorted(begins, b)]
        near = near[end[near] > a]
        n = np.minimum(end[near], b) - np.maximum(begin[near], a)
        i, strip = np.repeat(near, n), np.repeat(np.maximum(begin[near], a), n) + _counted(n)
        x_low, x_high = (ax[i] + slope[i] * (v - ay[i]) for v in (ys[strip], ys[np.minimum(strip + 1, len(ys) - 1)]))
        middle = x_low + x_high
        own = np.lexsort((slope[i], middle, shape[i], strip))
        step = np.empty(len(i), np.int64)
        step[own] = 1 - 2 * ((np.arange(len(i)) - _runs(strip[own], shape[i][own])) % 2)
        order = np.lexsort((slope[i], shape[i], middle, strip))
        i, strip, x_low, x_high, step = i[order], strip[order], x_low[order], x_high[order], step[order]
        start = _runs(strip)

        def deep(where: np.ndarray) -> np.ndarray:
            run = np.cumsum(np.where(where, step, 0))
            return run - np.where(start > 0, run[start - 1], 0) > 0

        first = np.full(len(i), ranks)
        for r in reversed(range(ranks)):
            first[deep(rank[i] == r)] = r
        area = (x_low[1:] - x_low[:-1] + x_high[1:] - x_high[:-1]) / 2 * (ys[np.minimum(strip + 1, len(ys) - 1)] - ys[strip])[:-1]
        kept = deep(rank[i] < 0)[:-1] & (strip[1:] == strip[:-1]) & (area > 0)
        out += np.bincount(owner[strip[:-1][kept]] * (ranks + 1) + first[:-1][kept], area[kept], len(out))
    return out.reshape(-1, ranks + 1)


def _measured(edges: DataFrame, keys: list[str], kind: str, band: float, measured: Callable[[pa.Table, np.ndarray], pa.Table], schema: str) -> DataFrame:
    """What measured makes of edges by key and band, given rows of whole groups and their groups, numbered in the order of rows.

    Calls with the same edges, keys, kind and band deal the same rows, so one shuffle serves them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def measure(last: bool) -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(held)
            start = _runs(*[_codes(table.column(k)) for k in (*keys, "band")])
            whole = len(start) if last else int(start[-1])
            held[:] = table.slice(whole).to_batches()
            if whole:
                yield from measured(table.slice(0, whole), np.unique(start[:whole], return_inverse=True)[1]).to_batches()

        rows_held, least = 0, AT_ONCE // 10
        for b in batches:
            held.append(b)
            rows_held += b.num_rows
            if rows_held >= least:
                yield from measure(False)
                rows_held = sum(x.num_rows for x in held)
                least = max(AT_ONCE // 10, 2 * rows_held)
        if rows_held:
            yield from measure(True)

    tasks = int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return banded(edges, keys, kind, band).repartition(tasks, *keys, "band").sortWithinPartitions(*keys, "band").mapInArrow(run, schema)


def _codes(column: pa.ChunkedArray) -> np.ndarray:
    """A number for each value, -1 for null."""
    return pc.fill_null(pc.dictionary_encode(column).combine_chunks().indices, -1).to_numpy(zero_copy_only=False)


def _pieces(table: pa.Table, band: float) -> tuple[np.ndarray, ...]:
    """Shape, ax, ay, slope and the heights within the band of each edge."""
    c = {n: table.column(n).to_numpy() for n in ("ax", "ay", "by", "slope", "band")}
    # Shapes matter by which are the same and by their order.
    shape = np.unique(table.column("shape").to_numpy(), return_inverse=True)[1]
    return shape, c["ax"], c["ay"], c["slope"], np.maximum(c["ay"], c["band"] * band), np.minimum(c["by"], (c["band"] + 1) * band)


def overlay_areas(edges: DataFrame, keys: list[str], ranks: int | None, band: float = 64.0) -> DataFrame:
    """keys, rank, area: the ground of each footprint by the first rank that covers it, null where none does.

    edges: keys, shape (which polygon; inside is by the even-odd rule over all
    rings of one), rank (null for the footprint, else 0 to ranks - 1, the most
    severe first; if ranks is None, all ranks count as one, 0), x0, y0, x1, y1
    in a plane. Polygons of one rank, and footprints of one key, are united.
    Areas add up to the footprint's. Keys without a footprint, or with one of
    no area, give no row; ground outside the footprint isn't counted; a rank of
    no area has no row.
    """
    edges = edges.withColumn("rank", F.col("rank").cast("int"))
    kinds, layers = dict(edges.dtypes), 1 if ranks is None else ranks
    schema = ", ".join([*[f"`{k}` {kinds[k]}" for k in keys], "rank int", "area double"])

    def measured(table: pa.Table, group: np.ndarray) -> pa.Table:
        rank = table.column("rank").fill_null(-1).to_numpy()
        if ranks is None:
            rank = np.where(table.column("rank").is_null().to_numpy(), -1, 0)
        # A band without a footprint has nothing to give.
        kept = np.bincount(group, rank < 0)[group] > 0
        shape, *lines = (x[kept] for x in _pieces(table, band))
        areas = _group_areas(group[kept], shape, rank[kept], *lines, layers, band)
        at, found = np.nonzero(areas > 0)
        who = table.select(keys).take(np.searchsorted(group, at))
        return pa.table([*[who.column(k) for k in keys], pa.array(found, pa.int32(), mask=found == layers), pa.array(areas[at, found])], [*keys, "rank", "area"])

    found = _measured(edges, keys, "rank", band, measured, schema)
    return found.groupBy(*keys, "rank").agg(F.sum("area").alias("area"))


def group_areas(edges: DataFrame, keys: list[str], group: str, band: float = 64.0) -> DataFrame:
    """keys, group, area: the union of each group's polygons on the footprint, whatever other groups cover.

    edges as in overlay_areas, with a group in place of a rank, null for the footprint.
    A band's footprint meets each of its groups where they lie; no copies of it are shuffled.
    """
    kinds = dict(edges.dtypes)
    schema = ", ".join([*[f"`{c}` {kinds[c]}" for c in (*keys, group)], "area double"])

    def measured(table: pa.Table, bands: np.ndarray) -> pa.Table:
        codes, pieces = _codes(table.column(group)), _pieces(table, band)
        own = np.flatnonzero(codes < 0)
        owned = np.bincount(bands[own], minlength=bands[-1] + 1)
        zones = np.flatnonzero((codes >= 0) & (owned[bands] > 0))
        # A part is what a band has of one group; its rows follow one another.
        zones = zones[np.lexsort((codes[zones], bands[zones]))]
        firsts = np.unique(_runs(bands[zones], codes[zones]))
        counts, at = np.diff(firsts, append=len(zones)), bands[zones[firsts]]
        held, begin = owned[at], np.searchsorted(bands[own], at)
        areas = [np.empty(0)]
        for a, b in _blocks(counts + held, AT_ONCE // 10):
            i = np.concatenate([zones[firsts[a] : firsts[a] + counts[a:b].sum()], own[np.repeat(begin[a:b], held[a:b]) + _counted(held[a:b])]])
            part = np.concatenate([np.repeat(np.arange(b - a), n[a:b]) for n in (counts, held)])
            shape, *lines = (x[i] for x in pieces)
            areas.append(_group_areas(part, shape, np.where(codes[i] < 0, -1, 0), *lines, 1, band)[:, 0])
        area = np.concatenate(areas)
        who = table.select([*keys, group]).take(zones[firsts[area > 0]])
        return who.append_column("area", pa.array(area[area > 0]))

    found = _measured(edges, keys, group, band, measured, schema)
    return found.groupBy(*keys, group).agg(F.sum("area").alias("area"))


def breakdown(areas: DataFrame, keys: list[str], group: str, total: Column, least_acres: float = 0.0005, every: bool = False) -> DataFrame:
    """keys, breakdown: 'group acres ac (share%)' of all groups of a key, largest first, those under the least acres left out; with every, keys that have no others get null, else no row."""
    acres = F.col("area") / ACRE_M2
    text = F.concat(F.col(group), F.lit(" "), F.format_number(acres, 3), F.lit(" ac ("), F.format_number(100 * F.col("area") / total, 1), F.lit("%)"))
    large = F.when(acres >= least_acres, F.struct((-F.col("area")).alias("minus"), F.col(group).alias("group"), text.alias("text")))
    listed = F.sort_array(F.collect_list(large))  # a key's groups are few
    said = F.when(F.size(listed) > 0, F.array_join(listed["text"], "; "))
    return (areas if every else areas.where(acres >= least_acres)).groupBy(*keys).agg(said.alias("breakdown"))
