"""Distances between polygons, and what follows from them: neighbours, groups by gap.

Polygons are joined as runs of a few edges, by the boxes of the runs, so neither all
pairs of polygons nor all pairs of edges are made, and a row stays small however many
edges a polygon has. Only runs that meet are taken apart into edges. A polygon inside
another one is found by a vertex of each of its rings.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geosieve.operators.components import labelled
from geosieve.operators.grid import box_join
from geosieve.operators.planar import overlay_areas, ring_edges
from geosieve.sources.scratch import Scratch

#: Parcels this much farther apart than the gap still count as one ground, since outlines are drawn to about half a metre.
DRAWN_M = 0.5


def _from_segment(px: Column, py: Column, ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    """The squared distance from a point to a segment."""
    dx, dy = bx - ax, by - ay
    n = dx * dx + dy * dy
    t = F.when(n == 0, 0.0).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), ((px - ax) * dx + (py - ay) * dy) / n)))
    x, y = ax + t * dx - px, ay + t * dy - py
    return x * x + y * y


def segments_apart(p: tuple[Column, ...], q: tuple[Column, ...]) -> Column:
    """The distance between two segments (x0, y0, x1, y1), 0 where they cross."""
    side = lambda s, x, y: (s[2] - s[0]) * (y - s[1]) - (s[3] - s[1]) * (x - s[0])
    cross = (side(p, q[0], q[1]) * side(p, q[2], q[3]) < 0) & (side(q, p[0], p[1]) * side(q, p[2], p[3]) < 0)
    ends = [_from_segment(s[i], s[i + 1], *o) for s, o in ((p, q), (q, p)) for i in (0, 2)]
    return F.when(cross, 0.0).otherwise(F.sqrt(F.least(*ends)))


#: Edges of a polygon that are one row of the join.
RUN = 16
_ENDS = ("x0", "y0", "x1", "y1")


def _rings() -> Column:
    return F.filter("rings", lambda r: r.isNotNull())


def _runs(shapes: DataFrame) -> DataFrame:
    """A row for each run of at most RUN edges, closing ones included: _n, its number, and _run, an array of struct(x0, y0, x1, y1, head).

    The first edge of each ring is its head. Edges that lack a coordinate go.
    """
    ends = lambda v, w: [c.alias(n) for n, c in zip(_ENDS, (v["x"], v["y"], w["x"], w["y"]))]
    edges = lambda r: F.transform(r, lambda v, i: F.struct(*ends(v, F.get(r, (i + 1) % F.size(r)))))
    known = lambda e: reduce(and_, [e[c].isNotNull() & ~F.isnan(e[c]) for c in _ENDS])
    headed = lambda e, i: F.struct(*[e[c].alias(c) for c in _ENDS], (i == 0).alias("head"))
    held = shapes.withColumn("_edges", F.flatten(F.transform(_rings(), lambda r: F.transform(F.filter(edges(r), known), headed)))).drop("rings")
    # Cut within the generator: a filter on the edges, or a slice beside it, would be made anew wherever it is used.
    last = F.floor((F.size("_edges") - 1) / RUN).cast("int")
    cut = F.transform(F.sequence(F.lit(0), last), lambda n: F.struct(n.alias("_n"), F.slice("_edges", n * RUN + 1, RUN).alias("_run")))
    return held.select(*[c for c in held.columns if c != "_edges"], F.inline(F.when(F.size("_edges") > 0, cut)))


def _sides(run: str) -> tuple[Column, ...]:
    """South, west, north and east of a run."""
    of = lambda most, least, c: least(*[most(F.col(run)[f"{c}{i}"]) for i in (0, 1)])
    return of(F.array_min, F.least, "y"), of(F.array_min, F.least, "x"), of(F.array_max, F.greatest, "y"), of(F.array_max, F.greatest, "x")


def _crosses(e: Column, x: Column, y: Column) -> Column:
    """Whether an edge crosses the line from a point eastward; a point inside has an odd number of such edges."""
    return ((e["y0"] > y) != (e["y1"] > y)) & (x < (e["x1"] - e["x0"]) * (y - e["y0"]) / (e["y1"] - e["y0"]) + e["x0"])


def pairs_within(shapes: DataFrame, key: str, gap_m: float, on: tuple[str, ...] = (), cell_m: float = 50.0) -> DataFrame:
    """(on, a, b, apart_m): pairs of polygons, a under b by key, whose ground is at most the gap apart, each once; 0 where they touch or overlap.

    shapes: key, the columns ``on``, and rings of struct(x, y) in metres, inside by the
    even-odd rule over all rings of one row. Rows that share a key are one polygon of several parts.
    """
    shapes = shapes.select(key, *on, "rings", F.coalesce(F.size(F.flatten("rings")) <= RUN, F.lit(False)).alias("_whole"))
    runs = _runs(shapes)
    left, right = (runs.select(*on, F.col(key).alias(c), F.col("_whole").alias(f"{s}_whole"), F.col("_run").alias(f"{s}_run")) for c, s in (("a", "p"), ("b", "q")))
    # Both sides are widened by half the gap and a little for rounding, which makes them one and the same shuffle.
    half = gap_m / 2 + 1e-6
    box = lambda s: (s[0] - half, s[1] - half, s[2] + half, s[3] + half)
    met = box_join(left, right, box(_sides("p_run")), box(_sides("q_run")), (cell_m, cell_m), on).where("a < b")
    # Of a row that is one run, all edges about a point are here.
    within = lambda inner, outer: F.exists(inner, lambda v: v["head"] & (F.size(F.filter(outer, lambda e: _crosses(e, v["x0"], v["y0"]))) % 2 == 1))
    of_q = ("_s", "_w", "_n", "_e")
    met = met.withColumns({"_in": (F.col("q_whole") & within("p_run", "q_run")) | (F.col("p_whole") & within("q_run", "p_run")), **dict(zip(of_q, _sides("q_run")))})
    p, q = ([f"{s}_{c}" for c in (*_ENDS, "head")] for s in "pq")
    ends = lambda names: tuple(map(F.col, names[:4]))
    span = lambda e: (F.least(e[1], e[3]), F.least(e[0], e[2]), F.greatest(e[1], e[3]), F.greatest(e[0], e[2]))
    close = lambda s, o: F.col("_in") | reduce(and_, [low <= high + (gap_m + 1e-6) for low, high in zip((*s[:2], *o[:2]), (*o[2:], *s[2:]))])
    edges = met.select(*on, "a", "b", "_in", *of_q, "q_run", F.inline("p_run").alias(*p)).where(close(span(ends(p)), tuple(map(F.col, of_q))))
    edges = edges.select(*on, "a", "b", "_in", *p, F.inline("q_run").alias(*q)).where(close(span(ends(p)), span(ends(q))))
    near = edges.withColumn("apart_m", F.when(F.col("_in"), 0.0).otherwise(segments_apart(ends(p), ends(q)))).where(F.col("apart_m") <= gap_m).select(*on, "a", "b", "apart_m")
    return near.unionByName(_inside_long(shapes, key, on, cell_m)).groupBy(*on, "a", "b").agg(F.min("apart_m").alias("apart_m"))


def _inside_long(shapes: DataFrame, key: str, on: tuple[str, ...], cell_m: float) -> DataFrame:
    """(on, a, b, apart_m), 0: pairs of which one has a ring that begins inside a row of several runs of the other, by the runs east of that point."""
    rows = shapes.where("not _whole").withColumns({"_part": F.xxhash64("rings"), "_west": F.array_min(F.flatten(_rings())["x"])})
    long = _runs(rows).select(*on, F.col(key).alias("b"), "_part", "_west", "_n", "_run")
    # Where no row has several runs, this is empty and so are the points, before they are shuffled.
    some = rows.select(F.lit(True).alias("_some")).limit(1)
    heads = _runs(shapes).crossJoin(F.broadcast(some)).select(*on, F.col(key).alias("a"), F.explode(F.filter("_run", lambda e: e["head"])).alias("_v"))
    heads = heads.select(*on, "a", F.col("_v.x0").alias("vx"), F.col("_v.y0").alias("vy"))
    south, _, north, east = _sides("_run")
    point = tuple(F.col(c) for c in ("vy", "vx", "vy", "vx"))
    held = box_join(heads, long, point, (south, F.col("_west"), north, east), (cell_m, cell_m), on).where("a <> b")
    crossed = held.select(*on, "a", "b", "vx", "vy", "_part", "_n", F.posexplode("_run").alias("_i", "_e")).where(_crosses(F.col("_e"), F.col("vx"), F.col("vy")))
    # Points and rows that are there twice count once.
    inside = crossed.groupBy(*on, "a", "b", "vx", "vy", "_part").agg(F.count_distinct("_n", "_i").alias("crossed")).where("crossed % 2 = 1")
    return inside.select(*on, F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), F.lit(0.0).alias("apart_m"))


def grouped(shapes: DataFrame, key: str, gap_m: float, on: tuple[str, ...] = (), cell_m: float = 50.0) -> DataFrame:
    """(key, on, component): polygons joined by steps of at most the gap and what outlines are off, under the smallest key. Keys must be unique over all of ``on``."""
    pairs = pairs_within(shapes, key, gap_m + DRAWN_M, on, cell_m)
    return labelled(Scratch(shapes.sparkSession), shapes.select(key, *on).distinct(), pairs.select("a", "b"), key)


def overlaps(shapes: DataFrame, key: str, pairs: DataFrame, on: tuple[str, ...] = ()) -> DataFrame:
    """pairs (on, a, b) with overlap_m2, the ground both polygons cover, exactly; 0 where they don't overlap."""
    edges = ring_edges(shapes.select(key, *on, "rings"))
    sides = [pairs.select(*on, "a", "b").join(edges.withColumnRenamed(key, c), [*on, c]).withColumns({"shape": F.lit(i), "rank": F.lit(rank).cast("int")}) for i, (c, rank) in enumerate((("a", None), ("b", 0)))]
    found = overlay_areas(sides[0].unionByName(sides[1]), [*on, "a", "b"], 1).where("rank = 0").select(*on, "a", "b", F.col("area").alias("overlap_m2"))
    return pairs.join(found, [*on, "a", "b"], "left").fillna(0.0, ["overlap_m2"])
