"""Nearest lines of many parts, with the point of the line that is nearest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geosieve.functions import geo
from geosieve.operators.grid import box_join, degrees
from geosieve.sources.scratch import Scratch


def segments(lines: DataFrame, parts: str = "parts") -> DataFrame:
    """A row for each segment of the parts, arrays of struct(lng, lat): part, segment, a_lat, a_lng, b_lat, b_lng. A part of one vertex has none."""
    rest = [c for c in lines.columns if c != parts]
    rows = lines.select(*rest, F.posexplode(parts).alias("part", "_vertices"))
    rows = rows.select(*rest, "part", "_vertices", F.posexplode(F.slice("_vertices", 1, F.greatest(F.size("_vertices") - 1, F.lit(0)))).alias("segment", "_a"))
    rows = rows.withColumn("_b", F.get("_vertices", F.col("segment") + 1))
    return rows.select(*rest, "part", "segment", *[F.col(f"_{e}.{c}").alias(f"{e}_{c}") for e in "ab" for c in ("lat", "lng")])


ENDS = tuple(f"{e}_{c}" for e in "ab" for c in ("lat", "lng"))


def _about(sites: DataFrame, rows: DataFrame, radius_m: float) -> DataFrame:
    """Pairs of sites (lat, lng) and segments in whose box, widened by the radius, they lie."""
    south, west, north, east = (f(F.col(f"a_{c}"), F.col(f"b_{c}")) for f in (F.least, F.greatest) for c in ("lat", "lng"))
    high = radius_m / geo.M_PER_DEG_LAT
    # The frame's cosine is the site's, so the widest degree span is at the highest latitude that can be in reach.
    side = F.lit(radius_m) / (geo.M_PER_DEG_LNG * geo.cosine(F.least(F.lit(89.0), F.greatest(F.abs(south), F.abs(north)) + high)))
    point = tuple(F.col(c) for c in ("lat", "lng", "lat", "lng"))
    return box_join(sites, rows, point, (south - high, west - side, north + high, east + side), degrees(3 * radius_m))


def _measured(pairs: DataFrame) -> DataFrame:
    """Pairs (lat, lng, its cosine, a segment) with d_mm and the nearest point foot_lat, foot_lng."""
    x, y = geo.foot(*[m for e in "ab" for m in geo.offset(F.col("lat"), F.col("lng"), F.col(f"{e}_lat"), F.col(f"{e}_lng"), F.col("_cos"))])
    far = geo.millimetres(F.sqrt(F.col("_x") * F.col("_x") + F.col("_y") * F.col("_y")))
    foot = {"foot_lat": F.col("lat") + F.col("_y") / geo.M_PER_DEG_LAT, "foot_lng": F.col("lng") + F.col("_x") / (geo.M_PER_DEG_LNG * F.col("_cos"))}
    return pairs.withColumns({"_x": x, "_y": y}).withColumns({"d_mm": far, **foot}).drop("_x", "_y")


def near_segments(sites: DataFrame, rows: DataFrame, radius_m: float) -> DataFrame:
    """Pairs of sites (lat, lng) and segments within the radius, with d_mm and the nearest point foot_lat, foot_lng."""
    near = _measured(_about(sites.withColumn("_cos", geo.cosine(F.col("lat"))), rows, radius_m))
    return near.where(F.col("d_mm") <= int(radius_m * 1000)).drop("_cos")


def nearest_lines(sites: DataFrame, rows: DataFrame, key: str, ordinal: str, radius_m: float, wanted: dict[str, Column | None], carried: list[str]) -> DataFrame:
    """All sites with a struct for each name wanted: the nearest line for which its condition holds, null without one.

    A line is as near as its nearest segment; of equally near lines the first in source order
    is taken, of its equally near segments the first. All conditions are met in the same passes. The structs
    hold d_mm, the ordinal, part and segment, the nearest point and the carried columns.

    Pairs are those of places: sites at one place are measured once, and segments that lie
    alike count as one. A first pass takes least distances, a second one looks for the first segment at those, which
    is joined to its line at last. Distances are tested in aggregates: as filters they would be conditions of the
    joins, which take them apart and compute their terms many times a pair.
    """
    scratch, spot, which = Scratch(sites.sparkSession), ["lat", "lng"], [ordinal, "part", "segment"]
    holds = {n: F.lit(True) if where is None else where for n, where in wanted.items()}
    alike = scratch.keep(rows.groupBy(*ENDS).agg(*[F.min(F.when(where, F.struct(*which))).alias(f"_first_{n}") for n, where in holds.items()]))
    own = sites.select(*spot).distinct().withColumn("_cos", geo.cosine(F.col("lat")))
    of = lambda n: F.col("d_mm") == F.col(f"_least_{n}")
    least = [f"_least_{n}" for n in wanted]

    some = alike.select(*ENDS, *[F.col(f"_first_{n}").isNotNull().alias(f"_some_{n}") for n in wanted])
    within = F.col("d_mm") <= int(radius_m * 1000)
    found = _measured(_about(own, some, radius_m)).groupBy(*spot, "_cos").agg(*[F.min(F.when(within & F.col(f"_some_{n}"), F.col("d_mm"))).alias(f"_least_{n}") for n in wanted])
    found = scratch.keep(found.where(F.coalesce(*least).isNotNull()))

    reach = F.greatest(*map(F.col, least), F.lit(0)) / 1000 + 0.01  # whatever the rounding
    found = found.withColumns({"_own_lat": reach / geo.M_PER_DEG_LAT, "_own_lng": reach / (geo.M_PER_DEG_LNG * F.abs(F.col("_cos")))})
    held = [F.col(c).between(F.least(f"a_{c}", f"b_{c}") - F.col(f"_own_{c}"), F.greatest(f"a_{c}", f"b_{c}") + F.col(f"_own_{c}")) for c in spot]
    near = _measured(_about(found, alike, radius_m).where(held[0] & held[1]))
    first = near.groupBy(*spot, "_cos", *least).agg(*[F.min(F.when(of(n), F.col(f"_first_{n}"))).alias(f"_first_{n}") for n in wanted])

    names = first.select(*spot, "_cos", *least, F.inline(F.array(*[F.struct(F.lit(n).alias("_name"), *[F.col(f"_first_{n}.{c}").alias(c) for c in which]) for n in wanted])))
    whole = F.struct("d_mm", *which, "foot_lat", "foot_lng", *carried)
    best = _measured(names.join(rows.hint("merge"), which)).groupBy(*spot).agg(*[F.min(F.when((F.col("_name") == n) & where & of(n), whole)).alias(n) for n, where in holds.items()])
    return sites.join(best, spot, "left").select(key, *[c for c in sites.columns if c != key], *wanted)
