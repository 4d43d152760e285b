"""Joins of boxes on a grid of many levels.

One cell size fits neither points nor counties: with small cells a large box is
copied thousands of times, with large ones every cell holds too many small
boxes. Here a box lives at the level whose cells are the first at least as
large as it, each level having cells twice the size of the one before, so it
touches at most four cells there. Two boxes meet at the level of the larger one: each
row also goes to the coarser levels that the other side has boxes at, to at most
four cells of each. Which levels a side has is one number, a bit a level.

A pair that shares several cells comes out of the one that holds the lower left
corner of what the boxes have in common, so each pair comes out once. The equality on
level and cell is an ordinary join, whose skewed cells AQE splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geosieve.functions import geo

#: From the least cell to one this many doublings larger.
LEVELS = 40
Box = tuple[Column, Column, Column, Column]


def circle_box(lat: Column, lng: Column, radius_m: Column, spread_m: Column | float = 0.0) -> Box:
    """(south, west, north, east) that hold a circle as seen from any point within spread_m of its latitude."""
    high = radius_m / geo.M_PER_DEG_LAT
    reach = F.least(F.lit(89.0), F.abs(lat) + high + spread_m / geo.M_PER_DEG_LAT)
    side = radius_m / (geo.M_PER_DEG_LNG * F.cos(F.radians(reach)))
    return lat - high, lng - side, lat + high, lng + side


def _levelled(df: DataFrame, side: str, box: Box, cell: tuple[float, float]) -> DataFrame:
    south, west, north, east = (f"_{side}_{c}" for c in ("s", "w", "n", "e"))
    df = df.withColumns({south: box[0], west: box[1], north: box[2], east: box[3]})
    size = F.greatest((F.col(north) - F.col(south)) / cell[0], (F.col(east) - F.col(west)) / cell[1], F.lit(1.0))
    return df.withColumn(f"_{side}_level", F.least(F.ceil(F.log2(size)).cast("int"), F.lit(LEVELS - 1)))


def _placed(df: DataFrame, side: str, other: DataFrame, other_side: str, cell: tuple[float, float]) -> DataFrame:
    used = other.agg(F.coalesce(F.bit_or(F.pow(F.lit(2.0), F.col(f"_{other_side}_level")).cast("long")), F.lit(0).cast("long")).alias("_used"))
    own = F.col(f"_{side}_level")
    levels = F.filter(F.sequence(F.lit(0), F.lit(LEVELS - 1)), lambda v: (v == own) | ((v > own) & (F.getbit("_used", v) == 1)))
    rows = df.crossJoin(F.broadcast(used)).withColumn("_level", F.explode(levels)).drop("_used")  # a join with one row
    for name, low, high, size in (("_row", "s", "n", cell[0]), ("_column", "w", "e", cell[1])):
        rows = rows.withColumn(name, F.explode(F.sequence(_cell(f"_{side}_{low}", size), _cell(f"_{side}_{high}", size))))
    return rows


def _cell(at: str, size: float) -> Column:
    return F.floor(F.col(at) / (F.lit(size) * F.pow(F.lit(2.0), F.col("_level")))).cast("long")


def box_join(left: DataFrame, right: DataFrame, left_box: Box, right_box: Box, cell: tuple[float, float], on: tuple[str, ...] = ()) -> DataFrame:
    """Pairs of rows whose boxes (south, west, north, east) touch, each once.

    cell is the height and width of the least cells, about the size of the
    small boxes; any gives the same pairs. Rows can be asked to agree in columns
    ``on``; other names of the two sides must differ. Boxes with a null side
    meet nothing.
    """
    left, right = _levelled(left, "l", left_box, cell), _levelled(right, "r", right_box, cell)
    # Sizes are estimated as before the explode, so without the hint the copies could be broadcast, through the driver.
    tall, wide = (F.lit(size) * F.pow(F.lit(2.0), F.col("_level")) for size in cell)
    copies = _placed(right, "r", left, "l", cell).withColumns({"_tall": tall, "_wide": wide})  # powers are of rows, not of pairs
    both = _placed(left, "l", right, "r", cell).join(copies.hint("merge"), [*on, "_level", "_row", "_column"])
    touch = (F.col("_l_s") <= F.col("_r_n")) & (F.col("_r_s") <= F.col("_l_n")) & (F.col("_l_w") <= F.col("_r_e")) & (F.col("_r_w") <= F.col("_l_e"))
    corner = (F.floor(F.greatest("_l_s", "_r_s") / F.col("_tall")) == F.col("_row")) & (F.floor(F.greatest("_l_w", "_r_w") / F.col("_wide")) == F.col("_column"))
    both = both.where((F.greatest("_l_level", "_r_level") == F.col("_level")) & touch & corner)
    return both.drop("_level", "_row", "_column", "_tall", "_wide", *[f"_{s}_{c}" for s in "lr" for c in ("s", "w", "n", "e", "level")])


def degrees(metres: float) -> tuple[float, float]:
    """The height and width in degrees of a cell of about so many metres."""
    return metres / geo.M_PER_DEG_LAT, metres / geo.M_PER_DEG_LAT
