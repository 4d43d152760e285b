"""Nearest features without a radius, each answer proved complete by a pyramid of cells.

A fixed radius leaves sites without an answer, a wide one reads everything. Here
the occupied cells of a grid form a pyramid, each level's cells a quarter as wide as
those above, and each cell holds the box of the features in it. A site descends: of the
cells it still has, none of whose features can be nearer than the cell's box and all of
whose features are as near as the box's farthest corner, those stay whose nearest point
is within the least farthest corner of all. What is dropped can't hold the nearest feature,
so what is measured at the end suffices, and it is few: the cells about the answer.

Upper levels have few cells by arithmetic (6 by 12, 24 by 46, 92 by 182 at most) and are broadcast;
lower ones are joined by the cell above, so a site's cells aren't multiplied before the join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from geosieve.functions import geo
from geosieve.operators.grid import Box
from geosieve.sources.scratch import Scratch

#: Degrees of the top level's cells, and how many of them a cell has along each side at the next level.
TOP, SPLIT = 32.0, 4
#: Levels whose cells are broadcast: 16,744 cells at most.
BROADCAST_LEVELS = 3
#: Distances count as whole millimetres, so a feature this much farther can still tie.
TIE_M = 0.002


def _cells(placed: DataFrame) -> DataFrame:
    return placed.groupBy("_row", "_column").agg(F.min("_s").alias("_s"), F.min("_w").alias("_w"), F.max("_n").alias("_n"), F.max("_e").alias("_e"))


def _above(cells: DataFrame) -> DataFrame:
    up = lambda c: F.floor(F.col(c) / SPLIT).cast("long").alias(c)
    return _cells(cells.select(up("_row"), up("_column"), "_s", "_w", "_n", "_e"))


def _reach() -> tuple[Column, Column]:
    """The least and greatest distance from a site to a point of a cell's box, in the site's frame."""
    y0, y1 = (F.col(c) - F.col("lat") for c in ("_s", "_n"))
    x0, x1 = (F.col(c) - F.col("lng") for c in ("_w", "_e"))
    far = lambda a, b: F.greatest(F.abs(a), F.abs(b))
    near = lambda a, b: F.greatest(a, -b, F.lit(0.0))
    length = lambda x, y: geo.distance(F.col("lat"), F.lit(0.0), F.col("lat") + y, x)
    return length(near(x0, x1), near(y0, y1)), length(far(x0, x1), far(y0, y1))


def nearest_complete(
    sites: DataFrame,
    features: DataFrame,
    key: str,
    ordinal: str,
    carried: list[str],
    box: Box | None = None,
    distance: Column | None = None,
    levels: int = 6,
) -> DataFrame:
    """(key, best, cells, measured) of all sites (key, lat, lng): the nearest feature however far, its d_mm, the ordinal and carried columns.

    Features are points f_lat, f_lng, or have a box (south, west, north, east) and a
    ``distance`` in metres from lat, lng that lies between those to the box's nearest and farthest
    point. Of equally near features the first in source order is taken. ``cells`` and
    ``measured`` tell how many last cells and features a site was measured against.
    Sites and features without a place on the map, null or off it, are near nothing;
    best is null then, and where there are no features. Names of the two sides must differ.
    """
    scratch = Scratch(sites.sparkSession)
    if box is None:
        # A point many features share (a geocoder's default) is one feature, the first.
        features = features.groupBy("f_lat", "f_lng").agg(F.min(F.struct(ordinal, *carried)).alias("_f")).select("f_lat", "f_lng", "_f.*")
        box = (F.col("f_lat"), F.col("f_lng"), F.col("f_lat"), F.col("f_lng"))
        distance = geo.distance(F.col("lat"), F.col("lng"), F.col("f_lat"), F.col("f_lng"))
    s, w, n, e = box
    size = TOP / SPLIT ** (levels - 1)
    placed = features.withColumns({"_s": s, "_w": w, "_n": n, "_e": e}).where("_s >= -90 and _n <= 90 and _w >= -180 and _e <= 180")
    middle = lambda a, b: F.floor((F.col(a) + F.col(b)) / (2 * size)).cast("long")
    placed = placed.withColumns({"_row": middle("_s", "_n"), "_column": middle("_w", "_e")})
    pyramid = [scratch.keep(_cells(placed))]
    while len(pyramid) < levels:
        pyramid.insert(0, _above(pyramid[0]))

    # Sites at one place descend once.
    spot = ["lat", "lng"]
    own = W.partitionBy(*spot)
    low, high = _reach()
    held = sites.select(*spot).where("lat between -90 and 90 and lng between -180 and 180").distinct().repartition(*spot)
    top = pyramid[0].agg(F.collect_list(F.struct("_row", "_column", "_s", "_w", "_n", "_e")).alias("_top"))  # 72 cells at most
    held = held.crossJoin(F.broadcast(top)).select(*spot, F.inline("_top"))  # a join with one row
    for level in range(levels):
        if level:
            below = pyramid[level].withColumns({f"_up{c}": F.floor(F.col(c) / SPLIT).cast("long") for c in ("_row", "_column")})
            above = held.select(*spot, F.col("_row").alias("_up_row"), F.col("_column").alias("_up_column"))
            held = above.join(F.broadcast(below) if level < BROADCAST_LEVELS else below.hint("merge"), ["_up_row", "_up_column"])  # the lower ones are merged, as hinted: estimates miss what is multiplied
        held = held.withColumns({"_low": low, "_high": high}).withColumn("_bound", F.min("_high").over(own) + TIE_M).where("_low <= _bound")
    cells = held.select(*spot, "_row", "_column")
    measured = cells.join(placed.drop("_s", "_w", "_n", "_e").hint("merge"), ["_row", "_column"]).withColumn("d_mm", geo.millimetres(distance))
    best = F.min(F.struct("d_mm", ordinal, *carried)).alias("best")
    found = measured.groupBy(*spot, "_row", "_column").agg(best, F.count("*").alias("n")).groupBy(*spot).agg(F.min("best").alias("best"), F.count("*").alias("cells"), F.sum("n").alias("measured"))
    return sites.select(key, *spot).join(found, spot, "left").drop(*spot).fillna(0, ["cells", "measured"])
