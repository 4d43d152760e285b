"""Where a site is: located clues, neighbours of a parcel, candidate parcels, crossings of roads, power demand."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from geosieve.functions import geo
from geosieve.functions.text import COMMON_AREA, same_owner
from geosieve.operators.grid import box_join, circle_box, degrees

#: Location tiers, the surest first.
TIERS = ("L1", "L2", "L3", "L4", "L5")
#: Parcels smaller than this are slivers; more overlap than this is the parcel itself; parcels this near touch.
SLIVER_M2, SAME_OVERLAP, TOUCH_M = 20.0, 0.9, 3.0
#: A candidate's area may be off by this part; more candidates than this are no answer.
TOLERANCE, MOST_ASKED, ADJACENT_M = 0.15, 5, 150
#: About the size of the small circles of a candidate search; any gives the same pairs.
CELL_M = 2_000.0
#: Crossings farther apart than this are ambiguous; kilowatts of a rack and of a square foot.
SPREAD_M, RACK_KW, SQUARE_FOOT_KW = 500.0, 1.74, 0.1875


def checked(clues: DataFrame) -> DataFrame:
    """clues with ok and check: whether a located clue lies in the stated county, or is a rough one near enough to it.

    clues: tier, county (where it fell), stated_county, county_m (metres to
    the stated county), radius_m, zip, stated_zip. Area centroids are always ok.
    """
    area = F.col("tier").isin("L4", "L5")
    same = F.col("stated_county").isNull() | F.coalesce(F.lower("county") == F.lower("stated_county"), F.lit(False))
    near = F.coalesce((F.col("tier") == "L3") & (F.col("county_m") <= F.col("radius_m")), F.lit(False))
    where = F.when(same, "in the county").when(near, "near the stated county").otherwise("not in the stated county")
    by_zip = F.when(F.col("stated_zip").isNotNull(), F.when(F.coalesce(F.col("zip") == F.col("stated_zip"), F.lit(False)), "in stated ZIP").otherwise("another ZIP"))
    return clues.withColumn("ok", area | same | near).withColumn("check", F.when(area, "area centroid").otherwise(F.concat_ws("; ", where, by_zip)))


def best_location(clues: DataFrame, key: str, ordinal: str, columns: list[str]) -> DataFrame:
    """The best ok clue of each key by tier, the earliest of equals, with how many clues were rejected; keys without one stay."""
    rank = F.array_position(F.array(*map(F.lit, TIERS)), F.col("tier"))
    best = F.min(F.when(F.col("ok"), F.struct(rank.alias("_rank"), ordinal, "tier", *columns)))
    out = clues.groupBy(key).agg(best.alias("b"), F.count_if(~F.col("ok")).alias("rejected"))
    return out.select(key, *[F.col(f"b.{c}").alias(c) for c in ("tier", *columns)], "rejected")


def neighbours(pairs: DataFrame, key: str) -> DataFrame:
    """A parcel's neighbours among pairs with what lies within reach of its box.

    pairs: key, ordinal, apn, area_m2, overlap_m2, distance_m, tokens, and
    own_apn and own_tokens of the parcel. Slivers, the parcel itself (by
    overlap or number) and repeats of a number and whole area are left out.
    """
    itself = (F.col("overlap_m2") > SAME_OVERLAP * F.greatest(F.col("area_m2"), F.lit(1.0))) | F.coalesce(F.col("apn") == F.col("own_apn"), F.lit(False))
    kept = pairs.where((F.col("area_m2") >= SLIVER_M2) & ~itself).withColumn("_whole", F.bround("area_m2", 0))
    first = kept.groupBy(key, "apn", "_whole").agg(F.min(F.struct("ordinal", "area_m2", "distance_m", "tokens", "own_tokens")).alias("f"))
    acres = F.bround(F.col("f.area_m2") / geo.ACRE_M2, 2)
    return first.select(key, "apn", F.col("_whole").alias("m2"), acres.alias("acres"), (F.col("f.distance_m") <= TOUCH_M).alias("touches"), same_owner(F.col("f.tokens"), F.col("f.own_tokens")).alias("same_owner"))


def neighbour_labels(found: DataFrame, key: str, most: int = 30) -> DataFrame:
    """The neighbours of each key that are labelled: the same owner's first, then the largest."""
    place = F.row_number().over(W.partitionBy(key).orderBy(~F.col("same_owner"), F.desc("acres"), "apn", "m2"))
    return found.withColumn("place", place).where(F.col("place") <= most)


def candidates(areas: DataFrame, parcels: DataFrame, key: str) -> DataFrame:
    """Parcels within 15 % of the stated acres that reach into any circle of a key, ranked: by the substation, the owner, the area, the distance.

    areas: key, lat, lng, radius_m, acres, first (the circle the rest is
    measured from), sub_lat, sub_lng, own_tokens; parcels: parcel, f_lat,
    f_lng, reach_m (the radius of its own circle), parcel_acres, owner,
    tokens, apn. More than MOST_ASKED are told by too_many and stay.
    """
    fits = F.abs(F.col("parcel_acres") - F.col("acres")) <= TOLERANCE * F.col("acres")
    kept = parcels.where(~F.coalesce(F.col("owner").rlike(COMMON_AREA), F.lit(False)))
    # Circles are seen from the areas, whose latitudes are within both radii of a parcel's.
    kept = kept.crossJoin(F.broadcast(areas.agg(F.coalesce(F.max("radius_m"), F.lit(0.0)).alias("_widest"))))  # one row
    own = circle_box(F.col("lat"), F.col("lng"), F.col("radius_m"))
    box = circle_box(F.col("f_lat"), F.col("f_lng"), F.col("reach_m"), F.col("_widest"))
    pairs = box_join(areas, kept, own, box, degrees(CELL_M)).drop("_widest").where(fits)
    far = geo.distance(F.col("lat"), F.col("lng"), F.col("f_lat"), F.col("f_lng"))
    pairs = pairs.withColumn("_d", far).where(F.col("_d") <= F.col("radius_m") + F.col("reach_m"))
    sub = geo.distance(F.col("sub_lat"), F.col("sub_lng"), F.col("f_lat"), F.col("f_lng"))
    diff = F.bround(100 * (F.col("parcel_acres") - F.col("acres")) / F.col("acres"), 0).cast("int")
    rows = pairs.select(
        key, "apn", F.bround("parcel_acres", 1).alias("_acres"), "parcel", F.coalesce(sub <= ADJACENT_M, F.lit(False)).alias("adjacent"), F.coalesce(same_owner(F.col("tokens"), F.col("own_tokens")), F.lit(False)).alias("same_owner"),
        diff.alias("diff_pct"), F.when(F.col("first"), geo.millimetres(F.col("_d"))).alias("d_mm"),
    )
    once = rows.groupBy(key, "apn", "_acres").agg(F.min("parcel").alias("parcel"), F.bool_or("adjacent").alias("adjacent"), F.bool_or("same_owner").alias("same_owner"), F.min("diff_pct").alias("diff_pct"), F.min("d_mm").alias("d_mm"))
    order = W.partitionBy(key).orderBy(~F.col("adjacent"), ~F.col("same_owner"), F.abs("diff_pct"), F.asc_nulls_last("d_mm"), "parcel")
    counted = once.groupBy(key).agg(F.count("*").alias("n"))
    return once.withColumn("place", F.row_number().over(order)).join(counted, key).withColumn("too_many", F.col("n") > MOST_ASKED).drop("_acres")


def owner_search(tracts: DataFrame, parcels: DataFrame, key: str) -> DataFrame:
    """Parcels under the name given for a tract: matches within 15 % of its acres, or of any size where none is stated, and context.

    tracts: key, name, tract_acres; parcels: key, parcel, owner, parcel_acres,
    outside_m. Names of fewer than three letters are not looked for.
    """
    name = F.trim(F.regexp_replace(F.upper("name"), "[^A-Z ]", ""))
    pairs = parcels.join(tracts.withColumn("_name", name).where(F.length("_name") >= 3), key).where(F.contains(F.upper("owner"), F.col("_name")))
    off = (F.col("parcel_acres") - F.col("tract_acres")) / F.col("tract_acres")
    match = F.col("tract_acres").isNull() | (F.abs(off) <= TOLERANCE)
    return pairs.select(key, "name", "parcel", match.alias("match"), F.bround(100 * off, 0).cast("int").alias("diff_pct"), "outside_m")


def crossings(segments: DataFrame, key: str) -> DataFrame:
    """Where two named roads of a key cross: the middle of the crossings, or ambiguous if they lie too far apart.

    segments: key, road (1 or 2), ax, ay, bx, by in metres. Pairs are of one
    key's two roads only; a key is an intersection that someone names.
    """
    one = segments.where("road = 1").select(key, *[F.col(c).alias(f"p{c}") for c in ("ax", "ay", "bx", "by")])
    two = segments.where("road = 2").select(key, *[F.col(c).alias(f"q{c}") for c in ("ax", "ay", "bx", "by")])
    c = F.col
    dx, dy, ex, ey = c("pbx") - c("pax"), c("pby") - c("pay"), c("qbx") - c("qax"), c("qby") - c("qay")
    cross = dx * ey - dy * ex
    u = ((c("qax") - c("pax")) * ey - (c("qay") - c("pay")) * ex) / F.nullif(cross, F.lit(0.0))
    v = ((c("qax") - c("pax")) * dy - (c("qay") - c("pay")) * dx) / F.nullif(cross, F.lit(0.0))
    met = one.join(two, key).select(key, (c("pax") + u * dx).alias("x"), (c("pay") + u * dy).alias("y"), u.alias("u"), v.alias("v")).where("u between 0 and 1 and v between 0 and 1")
    middle = met.groupBy(key).agg(F.avg("x").alias("mx"), F.avg("y").alias("my"), F.count("*").alias("n"))
    spread = met.join(middle, key).groupBy(key).agg(F.max(F.sqrt((c("x") - c("mx")) ** 2 + (c("y") - c("my")) ** 2)).alias("spread"))
    return middle.join(spread, key).select(key, "mx", "my", "n", "spread", (c("spread") > SPREAD_M).alias("ambiguous"))


def power_demand(sites: DataFrame, units: DataFrame, key: str) -> DataFrame:
    """Generator kilowatts, rack load, average load from spend, and load from area of each site.

    sites: key, racks, spend, price, square_feet; units: key, kw. A site whose
    generators publish nothing has no kilowatts rather than 0.
    """
    made = units.groupBy(key).agg(F.sum("kw").alias("kw"))
    out = sites.join(made, key, "left")
    average = F.when((F.col("spend") > 0) & (F.col("price") > 0), F.col("spend") / F.col("price") / 8760)
    return out.select(
        key, F.when(F.col("kw") > 0, F.bround("kw", 0).cast("long")).alias("generator_kw"), F.when(F.col("racks") > 0, F.bround(F.col("racks") * RACK_KW, 1)).alias("rack_kw"),
        F.bround(average, 3).alias("average_kw"), F.bround(F.col("square_feet") * SQUARE_FOOT_KW / 1000, 4).alias("area_mw"),
    )


def kept_or_all(rows: DataFrame, keys: list[str], kept: Column) -> DataFrame:
    """The rows of a key that meet a condition, or all of a key none of whose rows does."""
    some = rows.groupBy(*keys).agg(F.bool_or(F.coalesce(kept, F.lit(False))).alias("_some"))
    return rows.join(some, keys).where(~F.col("_some") | kept).drop("_some")
