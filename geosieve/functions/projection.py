"""Equal-area projections of the ellipsoid as column expressions, by closed form.

Both keep areas exactly, so the area of a small ring is its shoelace sum in the plane: an
azimuthal one about a point, whose shapes are true near it, and Albers' conic one for a whole
country. Latitudes and longitudes are in degrees, x and y in metres.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Half axis in metres and squared eccentricity of GRS 80.
GRS80 = (6_378_137.0, 0.00669438002290)
#: Standard parallels, latitude and longitude of origin used for the contiguous states.
CONUS = (29.5, 45.5, 23.0, -96.0)


def _authalic(sine: Column, e2: float) -> Column:
    """q of a sine of latitude; half the ellipsoid's area over it is a squared axis times pi times q."""
    e = math.sqrt(e2)
    return (1 - e2) * (sine / (1 - e2 * sine * sine) - F.log((1 - e * sine) / (1 + e * sine)) / (2 * e))


def _pole(e2: float) -> float:
    e = math.sqrt(e2)
    return 1 - (1 - e2) / (2 * e) * math.log((1 - e) / (1 + e))


def azimuthal(lat: Column, lng: Column, about_lat: Column, about_lng: Column, ellipsoid: tuple[float, float] = GRS80) -> tuple[Column, Column]:
    """(x, y) by the azimuthal equal-area projection about a point that isn't a pole."""
    a, e2 = ellipsoid
    qp = _pole(e2)
    s0 = F.sin(F.radians(about_lat))
    # The sine of the authalic latitude is q over that of the pole; its cosine is positive.
    sb, sb0 = _authalic(F.sin(F.radians(lat)), e2) / qp, _authalic(s0, e2) / qp
    cb, cb0 = (F.sqrt(F.greatest(F.lit(0.0), 1 - s * s)) for s in (sb, sb0))
    r = a * math.sqrt(qp / 2)
    d = a * F.cos(F.radians(about_lat)) / F.sqrt(1 - e2 * s0 * s0) / (r * cb0)
    turn = F.radians(lng - about_lng)
    b = r * F.sqrt(2 / (1 + sb0 * sb + cb0 * cb * F.cos(turn)))
    return b * d * cb * F.sin(turn), b / d * (cb0 * sb - sb0 * cb * F.cos(turn))


def albers(lat: Column, lng: Column, frame: tuple[float, float, float, float] = CONUS, ellipsoid: tuple[float, float] = GRS80) -> tuple[Column, Column]:
    """(x, y) by Albers' conic equal-area projection with two standard parallels and an origin."""
    (a, e2), (first, second, lat0, lng0) = ellipsoid, frame
    e = math.sqrt(e2)

    def constants(phi: float) -> tuple[float, float]:
        s = math.sin(math.radians(phi))
        q = (1 - e2) * (s / (1 - e2 * s * s) - math.log((1 - e * s) / (1 + e * s)) / (2 * e))
        return math.cos(math.radians(phi)) ** 2 / (1 - e2 * s * s), q

    (m1, q1), (m2, q2), (_, q0) = map(constants, (first, second, lat0))
    n = (m1 - m2) / (q2 - q1)
    c = m1 + n * q1
    rho = a / n * F.sqrt(c - n * _authalic(F.sin(F.radians(lat)), e2))
    turn = n * F.radians(lng - lng0)
    return rho * F.sin(turn), a / n * math.sqrt(c - n * q0) - rho * F.cos(turn)


def ring_area(ring: Column, project) -> Column:
    """The area in the plane of a ring of struct(lng, lat), projected by project(lat, lng); 0 for an empty one."""
    closed = F.transform(F.concat(ring, F.slice(ring, 1, 1)), lambda v: F.struct(*[c.alias(n) for n, c in zip("xy", project(v["lat"], v["lng"]))]))
    # One walk along the vertices, each projected once, whatever their number.
    start = F.struct(F.lit(0.0).alias("s"), F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))
    walked = F.aggregate(closed, start, lambda at, p: F.struct((at["s"] + at["x"] * p["y"] - p["x"] * at["y"]).alias("s"), p["x"].alias("x"), p["y"].alias("y")))
    return F.abs(walked["s"]) / 2
