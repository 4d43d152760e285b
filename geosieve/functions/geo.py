"""Geometry as column expressions: distances in a local frame, rings, areas.

Distances use the frame of the point that asks: metres east and north of it,
with the cosine of its own latitude. Rings are arrays of struct(lng, lat), the
first vertex not repeated; a repeated one does no harm.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values of the local frame: metres in a degree.
M_PER_DEG_LNG, M_PER_DEG_LAT = 111320.0, 110540.0
EARTH_RADIUS_M = 6378137.0
ACRE_M2 = 4046.8564224
MILE_M, FOOT_M = 1609.344, 0.3048


def cosine(lat: Column) -> Column:
    return F.cos(F.radians(lat))


def offset(lat: Column, lng: Column, to_lat: Column, to_lng: Column, cos: Column | None = None) -> tuple[Column, Column]:
    """Metres east and north from a point to another; cos is the cosine of its latitude where it is at hand, so that pairs don't each take it."""
    return (to_lng - lng) * M_PER_DEG_LNG * (cosine(lat) if cos is None else cos), (to_lat - lat) * M_PER_DEG_LAT


def distance(lat: Column, lng: Column, to_lat: Column, to_lng: Column) -> Column:
    """Metres from a point to another, in the frame of the first."""
    x, y = offset(lat, lng, to_lat, to_lng)
    return F.sqrt(x * x + y * y)


def millimetres(d: Column) -> Column:
    """A distance as a whole number, so that ties and order don't hang on the last bit."""
    return F.round(d * 1000).cast("long")


def _along(ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    """How far along a segment the point nearest the origin lies, 0 to 1."""
    dx, dy = bx - ax, by - ay
    length = dx * dx + dy * dy
    return F.when(length == 0, F.lit(0.0)).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), -(ax * dx + ay * dy) / length)))


def foot(ax: Column, ay: Column, bx: Column, by: Column) -> tuple[Column, Column]:
    """The point of a segment nearest the origin."""
    t = _along(ax, ay, bx, by)
    return ax + t * (bx - ax), ay + t * (by - ay)


def segment_distance(ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    """Distance from the origin to a segment."""
    x, y = foot(ax, ay, bx, by)
    return F.sqrt(x * x + y * y)


def _edges(ring: Column, f) -> Column:
    """f(a, b) for each edge of a ring, the closing one included."""
    n = F.size(ring)
    return F.transform(ring, lambda a, i: f(a, F.get(ring, (i + 1) % n)))


def ring_edges(ring: Column) -> Column:
    """array of struct(a, b) of the edges of a ring."""
    return _edges(ring, lambda a, b: F.struct(a.alias("a"), b.alias("b")))


def polygon_edges(outer: Column, holes: Column) -> Column:
    """array of struct(a, b) of the edges of all rings of a polygon."""
    return F.flatten(F.transform(F.concat(F.array(outer), holes), ring_edges))


def edge_crosses(edge: Column, lat: Column, lng: Column) -> Column:
    """1 if the ray east of a point crosses an edge, else 0."""
    a, b = edge["a"], edge["b"]
    at = (b["lng"] - a["lng"]) * (lat - a["lat"]) / F.nullif(b["lat"] - a["lat"], F.lit(0.0)) + a["lng"]
    return F.when(((a["lat"] > lat) != (b["lat"] > lat)) & (lng < at), 1).otherwise(0)


def edge_distance(edge: Column, lat: Column, lng: Column) -> Column:
    """Metres from a point to an edge."""
    a, b = edge["a"], edge["b"]
    return segment_distance(*offset(lat, lng, a["lat"], a["lng"]), *offset(lat, lng, b["lat"], b["lng"]))


def ring_contains(ring: Column, lat: Column, lng: Column) -> Column:
    """Whether a point is inside a ring by the even-odd rule."""
    crossed = _edges(ring, lambda a, b: edge_crosses(F.struct(a.alias("a"), b.alias("b")), lat, lng))
    return F.aggregate(crossed, F.lit(0), lambda n, x: n + x) % 2 == 1


def ring_distance(ring: Column, lat: Column, lng: Column) -> Column:
    """Metres from a point to the nearest edge of a ring."""
    return F.array_min(_edges(ring, lambda a, b: edge_distance(F.struct(a.alias("a"), b.alias("b")), lat, lng)))


def polygon_distance(outer: Column, holes: Column, lat: Column, lng: Column) -> Column:
    """0 inside the outer ring and outside all holes, else metres to the nearest edge; for single rows, see spatial.polygon_distances."""
    inside = ring_contains(outer, lat, lng) & ~F.exists(holes, lambda h: ring_contains(h, lat, lng))
    edges = F.array_min(F.concat(F.array(ring_distance(outer, lat, lng)), F.transform(holes, lambda h: ring_distance(h, lat, lng))))
    return F.when(inside, F.lit(0.0)).otherwise(edges)


def ring_area_m2(ring: Column) -> Column:
    """The area of a ring on a sphere."""

    def part(a: Column, b: Column) -> Column:
        return F.radians(b["lng"] - a["lng"]) * (2 + F.sin(F.radians(a["lat"])) + F.sin(F.radians(b["lat"])))

    return F.abs(F.aggregate(_edges(ring, part), F.lit(0.0), lambda s, x: s + x)) * (EARTH_RADIUS_M**2 / 2)


def centroid(ring: Column) -> tuple[Column, Column]:
    """The mean of a ring's vertices, (lat, lng)."""
    mean = lambda k: F.aggregate(ring, F.lit(0.0), lambda s, v: s + v[k]) / F.size(ring)
    return mean("lat"), mean("lng")


def equal_area_radius(area: Column) -> Column:
    """The radius of the circle with an area."""
    return F.sqrt(area / F.pi())


def circle(lat: Column, lng: Column, radius_m: Column, n: int = 64) -> Column:
    """A ring of n vertices around a point."""
    angle = lambda i: i * F.lit(2.0) * F.pi() / n
    return F.transform(
        F.sequence(F.lit(0), F.lit(n - 1)),
        lambda i: F.struct(
            (lng + radius_m * F.cos(angle(i)) / (M_PER_DEG_LNG * F.cos(F.radians(lat)))).alias("lng"),
            (lat + radius_m * F.sin(angle(i)) / M_PER_DEG_LAT).alias("lat"),
        ),
    )


def orientation(ax: Column, ay: Column, bx: Column, by: Column, cx: Column, cy: Column) -> Column:
    """The sign of the turn from a by b to c."""
    return F.signum((bx - ax) * (cy - ay) - (by - ay) * (cx - ax))


def segments_cross(a: tuple, b: tuple, c: tuple, d: tuple) -> Column:
    """Whether segments ab and cd cross inside both."""
    return (orientation(*a, *b, *c) * orientation(*a, *b, *d) < 0) & (orientation(*c, *d, *a) * orientation(*c, *d, *b) < 0)
