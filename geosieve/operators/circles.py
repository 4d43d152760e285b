"""Ground of polygons within circles, by closed form: areal interpolation without clipping.

The part of a circle between its centre and a directed edge is a sector, a
triangle and a sector, each perhaps empty; signed and summed over a ring's edges they are
the ring's ground within the circle. Edges are rows, so the sums have map-side parts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geosieve.functions import geo
from geosieve.operators.grid import box_join, circle_box, degrees
from geosieve.sources.scratch import Scratch


def swept(edges: DataFrame, radii: dict[str, str]) -> DataFrame:
    """edges with the signed area between the origin and the edge _ax, _ay, _bx, _by within each circle about the origin: columns by name, of those that hold the radii.

    Each step has columns of its own: as one expression its terms are computed again and again, in code too long for the JVM to compile.
    """
    kept, c = edges.columns, F.col
    cross, dot = (lambda p, q: p[0] * q[1] - p[1] * q[0]), (lambda p, q: p[0] * q[0] + p[1] * q[1])
    a, b, d = ((c(f"_{p}x"), c(f"_{p}y")) for p in "abd")
    rows = edges.withColumns({"_dx": b[0] - a[0], "_dy": b[1] - a[1], "_turn": F.atan2(cross(a, b), dot(a, b))})
    rows = rows.withColumns({"_dd": dot(d, d), "_ad": dot(a, d), "_aa": dot(a, a)})
    rows = rows.withColumns({f"_in_{n}": c("_ad") * c("_ad") - c("_dd") * (c("_aa") - c(r) * c(r)) for n, r in radii.items()})
    rows = rows.withColumns({f"_root_{n}": F.sqrt(F.greatest(c(f"_in_{n}"), F.lit(0.0))) for n in radii})
    # Where the edge enters and leaves the circle, as parts of its length, and the points there.
    length = F.nullif(c("_dd"), F.lit(0.0))
    rows = rows.withColumns({f"_from_{n}": F.greatest(F.lit(0.0), (-c("_ad") - c(f"_root_{n}")) / length) for n in radii} | {f"_to_{n}": F.least(F.lit(1.0), (-c("_ad") + c(f"_root_{n}")) / length) for n in radii})
    rows = rows.withColumns({f"_{at}{x}_{n}": a[i] + c(f"_{at}_{n}") * d[i] for n in radii for at in ("from", "to") for i, x in enumerate("xy")})
    sector = lambda r, p, q: r * r * F.atan2(cross(p, q), dot(p, q)) / 2

    def area(n: str, r: Column) -> Column:
        p, q = ((c(f"_{at}x_{n}"), c(f"_{at}y_{n}")) for at in ("from", "to"))
        outside = (c(f"_in_{n}") <= 0) | (c(f"_from_{n}") >= c(f"_to_{n}"))
        return F.when(~(r > 0) | (c("_dd") == 0), 0.0).when(outside, r * r * c("_turn") / 2).otherwise(sector(r, a, p) + cross(p, q) / 2 + sector(r, q, b))

    return rows.select(*kept, *[area(n, c(r)).alias(n) for n, r in radii.items()])


def _turned(ring: Column, sign: int) -> Column:
    """struct of a ring and the sign that makes what its edges sweep positive, times another sign."""
    x, y = (F.get(ring, 0)[k] for k in ("lng", "lat"))
    cross = lambda a, b: (a["lng"] - x) * (b["lat"] - y) - (b["lng"] - x) * (a["lat"] - y)
    whole = F.aggregate(geo.ring_edges(ring), F.lit(0.0), lambda s, e: s + cross(e["a"], e["b"]))
    return F.struct((F.signum(whole) * sign).alias("sign"), ring.alias("v"))


def shares_within(sites: DataFrame, shapes: DataFrame, key: str, shape: str, radii: dict[str, Column], widest_m: Column, cell_m: float, carried: tuple[str, ...] = (), held: str | None = None) -> DataFrame:
    """(key, shape, carried, and a column for each radius): what part of a polygon's ground lies within each radius of a site, in its frame; held names a column for whether the polygon holds the site.

    sites: key, lat, lng and what the radii, in metres, are made of. shapes: shape, carried, outer, a ring
    of struct(lng, lat), and holes, an array of rings, inside outer and apart from each other; rings may turn either way and don't cross themselves.
    Pairs come from one grid join of boxes as far as ``widest_m`` of the site; those without ground or whose boxes
    don't meet have no row. A null or not positive radius holds nothing. cell_m is about the size of small polygons.
    """
    ends = lambda k: F.transform("outer", lambda v: v[k])
    rings = F.concat(F.array(_turned(F.col("outer"), 1)), F.transform(F.coalesce("holes", F.array()), lambda h: _turned(h, -1)))
    boxed = shapes.select(shape, *carried, rings.alias("_rings"), *[f(ends(k)).alias(f"_{n}") for n, f, k in (("s", F.array_min, "lat"), ("w", F.array_min, "lng"), ("n", F.array_max, "lat"), ("e", F.array_max, "lng"))])
    # Written once: its rings are made row by row, and what a plan expects of them would be tested by making them again before each join.
    boxed = Scratch(sites.sparkSession).keep(boxed)
    names = {n: f"_r_{n}" for n in radii}
    own = sites.select(key, "lat", "lng", geo.cosine(F.col("lat")).alias("_cos"), *[F.greatest(F.coalesce(r, F.lit(0.0)), F.lit(0.0)).alias(names[n]) for n, r in radii.items()], widest_m.alias("_widest"))
    pairs = box_join(own, boxed, circle_box(F.col("lat"), F.col("lng"), F.col("_widest")), tuple(F.col(f"_{c}") for c in "swne"), degrees(cell_m))
    kept = [key, shape, *carried, "lat", "lng", "_cos", *names.values()]
    edges = pairs.select(*kept, F.inline("_rings")).select(*kept, "sign", "v", F.posexplode("v").alias("_i", "_a")).withColumn("_b", F.get("v", (F.col("_i") + 1) % F.size("v")))
    at = lambda p: geo.offset(F.col("lat"), F.col("lng"), F.col(f"{p}.lat"), F.col(f"{p}.lng"), F.col("_cos"))
    crossed = geo.edge_crosses(F.struct(F.col("_a").alias("a"), F.col("_b").alias("b")), F.col("lat"), F.col("lng"))
    offsets = {f"_{p}{x}": m for p in "ab" for x, m in zip("xy", at(f"_{p}"))}
    edges = edges.select(key, shape, *carried, "sign", *names.values(), *[m.alias(n) for n, m in offsets.items()], *([crossed.alias("_crossed")] if held else []))
    # What a ring of a known turn sweeps adds up to the ground, whichever its ring: pairs are grouped once.
    sums = [F.sum(F.col("sign") * F.col(n)).alias(n) for n in radii] + [F.sum(F.col("sign") * (F.col("_ax") * F.col("_by") - F.col("_ay") * F.col("_bx")) / 2).alias("_whole")]
    by_shape = swept(edges, names).groupBy(key, shape, *carried).agg(*sums, *([F.sum("_crossed").alias("_crossed")] if held else [])).where("_whole > 0")
    part = lambda n: F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col(n) / F.col("_whole")))
    return by_shape.select(key, shape, *carried, *[part(n).alias(n) for n in radii], *([(F.col("_crossed") % 2 == 1).alias(held)] if held else []))
