"""Distances from points to the ground of a site, not to its pin."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geosieve.functions import geo
from geosieve.operators.grid import box_join, degrees


def points_near_footprints(footprints: DataFrame, points: DataFrame, key: str, point: str, radius_m: float, cell_m: float = 1_000.0) -> DataFrame:
    """(key, point, d_mm) of points f_lat, f_lng at most the radius from a footprint's edge, 0 on its ground; in the frame of the site.

    footprints: key, lat, lng of the pin and edges (geo.polygon_edges), inside by the even-odd rule over all of
    them, so a hole is outside. Footprints meet points in one grid join of their boxes; then
    edges are rows, and their minimum and parity are taken before anything is shuffled. Footprints without edges, and points without a place, are near nothing.
    """
    def extent(f, c: str) -> Column:
        return f(F.transform("edges", lambda e: e["a"][c]))  # rings are closed: each vertex begins an edge

    high = radius_m / geo.M_PER_DEG_LAT
    # The frame is the pin's, wherever the edge lies, so its cosine alone sets the width.
    wide = F.lit(radius_m) / (geo.M_PER_DEG_LNG * F.cos(F.radians(F.least(F.lit(89.0), F.abs(F.col("_lat"))))))
    boxes = footprints.select(key, F.col("lat").alias("_lat"), "edges", extent(F.array_min, "lat").alias("_s"), extent(F.array_min, "lng").alias("_w"), extent(F.array_max, "lat").alias("_n"), extent(F.array_max, "lng").alias("_x"))
    reach = (F.col("_s") - high, F.col("_w") - wide, F.col("_n") + high, F.col("_x") + wide)
    here = tuple(F.col(c) for c in ("f_lat", "f_lng", "f_lat", "f_lng"))
    met = box_join(boxes, points.select(point, "f_lat", "f_lng"), reach, here, degrees(cell_m))
    rows = met.select(key, point, "_lat", "f_lat", "f_lng", F.explode("edges").alias("_e"))
    at = lambda p: ((F.col(f"_e.{p}.lng") - F.col("f_lng")) * geo.M_PER_DEG_LNG * F.cos(F.radians("_lat")), (F.col(f"_e.{p}.lat") - F.col("f_lat")) * geo.M_PER_DEG_LAT)
    rows = rows.select(key, point, geo.segment_distance(*at("a"), *at("b")).alias("_d"), geo.edge_crosses(F.col("_e"), F.col("f_lat"), F.col("f_lng")).alias("_c"))
    # On the ground of a footprint if an odd number of its edges lie east.
    out = rows.groupBy(key, point).agg(F.min("_d").alias("_d"), F.sum("_c").alias("_c"))
    out = out.select(key, point, F.when(F.col("_c") % 2 == 1, 0).otherwise(geo.millimetres(F.col("_d"))).alias("d_mm"))
    return out.where(F.col("d_mm") <= int(radius_m * 1000))
