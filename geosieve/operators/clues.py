"""Where a site is, from the words said about it: candidates out of local tables, checked against the stated county and ZIP.

Clues are looked up once a distinct value, through inverted indexes: names by their rarest run of
letters, addresses by house number and street word, roads by name within a ZIP's box. Nothing
unclear becomes a point: what is ambiguous, unknown or no place stays as an unresolved clue with
its reason. Layers hold the features of the states that the sites lie in.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geosieve.functions import geo
from geosieve.functions.text import address_parts
from geosieve.operators.grid import box_join
from geosieve.operators.places import TIERS, checked, crossings
from geosieve.operators.spatial import polygon_distances, range_join
from geosieve.sources.scratch import Scratch

#: Types that can give a place, in the order they are tried, with tier and radius in metres (areas have their own).
PLACED = {
    "apn": ("L1", 50), "coordinate": ("L2", 100), "coordinate_approx": ("L2", 500), "street_address": ("L2", 100), "substation_name": ("L3", 2000), "intersection": ("L3", 2000), "landmark": ("L3", 2000),
    "zip": ("L4", None), "county": ("L5", None),
}
#: Types that never give a place, and why.
UNPLACED = {"substation_planned": "location unknown", "owner_name": "search the parcel records by hand", "corridor": "context only", "area_name": "context only"}
GRAM = 3
AREA_CELL_M = 50_000.0
#: Degrees of the least cells that ZIP areas and roads meet in; any gives the same pairs.
ROAD_CELL = (0.25, 0.25)
_COORDINATE = r"^\s*([+-]?\d+\.?\d*)\s*,\s*([+-]?\d+\.?\d*)\s*$"
_CROSSING = r"^\s*(.+?)\s*(?:&|\band\b|/|@)\s*(.+?)\s*(?:,|$)"


@dataclass(frozen=True)
class Gazetteer:
    """Local layers that clues are looked up in.

    parcels: apn, county, lat, lng. addresses: place, address, lat, lng.
    substations: place, name, county, lat, lng. landmarks: place, name, lat,
    lng. roads: name, a_lat, a_lng, b_lat, b_lng, a row a segment. counties and
    zips: area, lat, lng, radius_m, edges (geo.polygon_edges), south, west,
    north, east. place orders a layer's rows; the first is taken of equals.
    """

    parcels: DataFrame
    addresses: DataFrame
    substations: DataFrame
    landmarks: DataFrame
    roads: DataFrame
    counties: DataFrame
    zips: DataFrame


def _looked_for(name: Column) -> Column:
    return F.replace(F.upper(name), F.lit("'"), F.lit(""))


def _grams(text: Column, least: Column | int) -> Column:
    """The distinct runs of ``least`` to GRAM letters of a text."""
    none = F.array().cast("array<string>")

    def runs(n: int) -> Column:
        found = F.transform(F.sequence(F.lit(1), F.length(text) - (n - 1)), lambda i: F.substring(text, i, F.lit(n)))
        return F.when((F.length(text) >= n) & (F.lit(n) >= least), found).otherwise(none)

    return F.array_distinct(F.concat(*map(runs, range(1, GRAM + 1))))


def names_holding(values: DataFrame, layer: DataFrame) -> DataFrame:
    """Rows of a layer (name, ...) with each value that its name holds, in upper case and without the value's apostrophes.

    A value meets only the names that share its rarest run of three letters
    (of all its letters, if it has fewer). An empty value is held by none.
    """
    upper = F.upper("name")
    index = layer.where("name is not null").withColumn("gram", F.explode(_grams(upper, 1)))
    counts = index.groupBy("gram").agg(F.count("*").alias("n"))
    asked = values.select("value").where("value is not null").distinct().withColumn("_asked", _looked_for(F.col("value")))
    runs = asked.withColumn("gram", F.explode(_grams(F.col("_asked"), F.least(F.length("_asked"), F.lit(GRAM)))))
    rarest = runs.join(counts, "gram", "left").groupBy("value", "_asked").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram"))["gram"].alias("gram"))
    # An index has many rows a name, which its estimated size misses: merged, it isn't broadcast.
    return rarest.join(index.hint("merge"), "gram").where(F.contains(upper, F.col("_asked"))).drop("gram", "_asked")


def inside(points: DataFrame, key: str, areas: DataFrame, name: str) -> DataFrame:
    """(key, name): the first area by name that holds each point (lat, lng); points in none have no row. On an edge, to half a millimetre, is inside."""
    box = F.col("south"), F.col("west"), F.col("north"), F.col("east")
    pairs = range_join(points.select(key, "lat", "lng"), areas.select("area", "edges", "south", "west", "north", "east"), 1.0, box, AREA_CELL_M)
    return polygon_distances(pairs, [key, "area"]).where("d_mm = 0").groupBy(key).agg(F.min("area").alias(name))


def _parcels(clues: DataFrame, g: Gazetteer) -> DataFrame:
    known = g.parcels.groupBy(F.col("apn").alias("value"), F.lower("county").alias("_county")).agg(F.count("*").alias("n"), F.min(F.struct("lat", "lng")).alias("at"))
    rows = clues.withColumn("_county", F.lower("stated_county")).join(known, ["value", "_county"], "left")
    n = F.coalesce("n", F.lit(0))
    why = F.when(F.col("stated_county").isNull(), "no county to look the number up in").when(n != 1, F.concat(n.cast("string"), F.lit(" matches")))
    return rows.select("clue", F.col("at.lat").alias("lat"), F.col("at.lng").alias("lng"), F.lit("parcel number").alias("basis"), why.alias("why"))


def _coordinates(clues: DataFrame) -> DataFrame:
    part = lambda k: F.regexp_extract("value", _COORDINATE, k).try_cast("double")
    why = F.when(part(1).isNull() | part(2).isNull(), "no coordinate")
    return clues.select("clue", part(1).alias("lat"), part(2).alias("lng"), F.lit("stated coordinate").alias("basis"), why.alias("why"))


def _addresses(clues: DataFrame, g: Gazetteer) -> DataFrame:
    cut = lambda df, c: df.withColumn("_p", address_parts(F.col(c))).select("*", F.col("_p.number").alias("_number"), F.explode("_p.words").alias("_word")).drop("_p")
    asked = cut(clues.select("value").distinct(), "value")
    pairs = asked.join(cut(g.addresses, "address").hint("merge"), ["_number", "_word"]).groupBy("value", "place", "address", "lat", "lng").agg(F.count("*").alias("n"))
    best = pairs.groupBy("value").agg(F.min(F.struct((-F.col("n")).alias("minus"), "place", "address", "lat", "lng")).alias("at"))
    rows = clues.join(best, "value", "left")
    why = F.when(F.col("at").isNull(), "no match")
    return rows.select("clue", F.col("at.lat").alias("lat"), F.col("at.lng").alias("lng"), F.concat(F.lit("address "), F.col("at.address")).alias("basis"), why.alias("why"))


def _substations(clues: DataFrame, g: Gazetteer) -> DataFrame:
    found = names_holding(clues, g.substations)
    first = F.min(F.struct("place", "name", "lat", "lng"))
    near = F.struct(F.round("lat", 3), F.round("lng", 3))
    anywhere = found.groupBy("value").agg(F.count("*").alias("n"), first.alias("any"))
    within = found.groupBy("value", F.lower("county").alias("_county")).agg(F.count("*").alias("n_in"), first.alias("own"), (F.min(near) == F.max(near)).alias("same"))
    rows = clues.withColumn("_county", F.lower("stated_county")).join(anywhere, "value", "left").join(within, ["value", "_county"], "left")
    use, n = F.coalesce("own", "any"), F.coalesce("n_in", "n", F.lit(0))
    why = F.when(n == 0, "no match").when((n > 1) & ~F.coalesce("same", F.lit(False)), F.concat(n.cast("string"), F.lit(" matches, ambiguous")))
    return rows.select("clue", use["lat"].alias("lat"), use["lng"].alias("lng"), F.concat(F.lit("substation "), use["name"]).alias("basis"), why.alias("why"))


def _landmarks(clues: DataFrame, g: Gazetteer) -> DataFrame:
    first = names_holding(clues, g.landmarks).groupBy("value").agg(F.min(F.struct("place", "name", "lat", "lng")).alias("at"))
    rows = clues.join(first, "value", "left")
    why = F.when(F.col("at").isNull(), "no match")
    return rows.select("clue", F.col("at.lat").alias("lat"), F.col("at.lng").alias("lng"), F.concat(F.lit("landmark "), F.col("at.name")).alias("basis"), why.alias("why"))


def _crossings(clues: DataFrame, g: Gazetteer) -> DataFrame:
    box = g.zips.select(F.col("area").alias("stated_zip"), F.col("lat").alias("z_lat"), F.col("lng").alias("z_lng"), "south", "west", "north", "east")
    named = clues.join(box, "stated_zip", "left").withColumns({"one": F.regexp_extract("value", _CROSSING, 1), "two": F.regexp_extract("value", _CROSSING, 2)})
    roads = named.where("one <> '' and z_lat is not null").select("clue", "z_lat", "z_lng", "south", "west", "north", "east", F.posexplode(F.array("one", "two")).alias("road", "_name"))
    roads = roads.withColumns({"road": F.col("road") + 1, "_name": _looked_for(F.col("_name"))})
    # A name is that of many roads all over the map, so they meet by place too.
    box, reach = tuple(F.col(c) for c in ("south", "west", "north", "east")), tuple(f(f"a_{c}", f"b_{c}") for f in (F.least, F.greatest) for c in ("lat", "lng"))
    roads = box_join(roads, g.roads.withColumn("_name", F.upper("name")), box, reach, ROAD_CELL, ("_name",))
    ends = {f"{e}{c}": v for e in "ab" for c, v in zip("xy", geo.offset(F.col("z_lat"), F.col("z_lng"), F.col(f"{e}_lat"), F.col(f"{e}_lng")))}
    lines = roads.select("clue", "road", *[v.alias(k) for k, v in ends.items()]).distinct()
    there = lines.groupBy("clue").agg(F.bool_or(F.col("road") == 1).alias("has_one"), F.bool_or(F.col("road") == 2).alias("has_two"))
    rows = named.join(there, "clue", "left").join(crossings(lines, "clue"), "clue", "left")
    unknown = lambda name: F.concat(F.lit("no road named "), name, F.lit(" in the ZIP area"))
    why = (
        F.when((F.col("one") == "") | F.col("z_lat").isNull(), "not two roads, or no ZIP area to search in")
        .when(~F.coalesce("has_one", F.lit(False)), unknown(F.col("one"))).when(~F.coalesce("has_two", F.lit(False)), unknown(F.col("two")))
        .when(F.col("n").isNull(), "the roads do not cross in the ZIP area").when(F.col("ambiguous"), F.concat(F.lit("the roads cross at "), F.col("n").cast("string"), F.lit(" places, ambiguous")))
    )
    lat, lng = F.col("z_lat") + F.col("my") / geo.M_PER_DEG_LAT, F.col("z_lng") + F.col("mx") / (geo.M_PER_DEG_LNG * F.cos(F.radians("z_lat")))
    return rows.select("clue", lat.alias("lat"), lng.alias("lng"), F.concat(F.lit("roads "), F.col("one"), F.lit(" x "), F.col("two")).alias("basis"), why.alias("why"))


def resolve(clues: DataFrame, g: Gazetteer, site: str = "site") -> DataFrame:
    """The place of each site with clues: its best candidate, how that was checked, the other candidates, and what stays unresolved.

    clues: clue (unique), site, clue_type, value. Returns site, tier, clue,
    clue_type, lat, lng, radius_m, basis, check, rejected, others and
    farthest_mm (other points that passed, and the farthest of them from the
    best), and unresolved, the reasons in order. A site none of whose clues
    gives a place has nulls. Of several counties or ZIPs the first counts; one
    that isn't known gives no place. Clues without a value, type or id, and of
    types that say nothing of a place, are passed over; extra columns are not read.
    """
    types = [*PLACED, *UNPLACED]
    kept = clues.where("clue is not null and value is not null").select("clue", site, "clue_type", "value")
    first = lambda kind: F.min(F.when(F.col("clue_type") == kind, F.struct("clue", "value")))
    stated = kept.groupBy(site).agg(first("county").alias("_c"), first("zip").alias("_z"))
    rows = kept.where(F.col("clue_type").isin(types)).join(stated, site)
    rows = rows.withColumns({"stated_county": F.col("_c.value"), "stated_zip": F.col("_z.value"), "_kept": F.coalesce(F.col("clue") == F.when(F.col("clue_type") == "county", F.col("_c.clue")).when(F.col("clue_type") == "zip", F.col("_z.clue")), F.lit(True))}).where("_kept")
    # Each of the three tables is read several times; written, none of its plan is repeated.
    scratch = Scratch(clues.sparkSession)
    rows = scratch.keep(rows.drop("_c", "_z", "_kept"))
    of = lambda *kinds: rows.where(F.col("clue_type").isin(*kinds))
    area = lambda kind, layer: of(kind).join(layer.select(F.lower("area").alias("_v"), "lat", "lng", "radius_m"), F.lower("value") == F.col("_v")).select("clue", "lat", "lng", F.lit(f"{kind} centroid").alias("basis"), F.lit(None).cast("string").alias("why"), F.col("radius_m").alias("_radius"))
    found = [_parcels(of("apn"), g), _coordinates(of("coordinate", "coordinate_approx")), _addresses(of("street_address"), g), _substations(of("substation_name"), g), _crossings(of("intersection"), g), _landmarks(of("landmark"), g)]
    placed = area("zip", g.zips).unionByName(area("county", g.counties))
    for x in found:
        placed = placed.unionByName(x, allowMissingColumns=True)
    table = lambda pairs: F.create_map(*[F.lit(x) for kv in pairs.items() for x in kv])
    tier, radius, order = table({k: v[0] for k, v in PLACED.items()}), table({k: float(v[1] or 0) for k, v in PLACED.items()}), table({k: i for i, k in enumerate(types)})
    kind = F.col("clue_type")
    tried = rows.join(placed, "clue").withColumns({"tier": F.element_at(tier, kind), "radius_m": F.coalesce("_radius", F.element_at(radius, kind)), "_order": F.element_at(order, kind)})
    tried = scratch.keep(tried)
    points = tried.where("why is null")
    exact = points.where(F.col("tier").isin("L1", "L2", "L3"))
    counties = g.counties.select(F.lower("area").alias("_v"), "edges")
    anchors = exact.where("tier = 'L3'").select("clue", "lat", "lng", F.lower("stated_county").alias("_v")).join(counties, "_v")
    away = polygon_distances(anchors, ["clue"]).select("clue", (F.col("d_mm") / 1000).alias("county_m"))
    seen = points.join(inside(exact, "clue", g.counties, "county"), "clue", "left").join(inside(exact, "clue", g.zips, "zip"), "clue", "left").join(away, "clue", "left")
    told = scratch.keep(checked(seen))
    rank = F.array_position(F.array(*map(F.lit, TIERS)), F.col("tier"))
    fields = ("tier", "clue_type", "lat", "lng", "radius_m", "basis", "check")
    best = told.where("ok").groupBy(site).agg(F.min(F.struct(rank.alias("_rank"), "_order", "clue", *fields)).alias("b"))
    others = told.where(F.col("ok") & F.col("tier").isin("L1", "L2", "L3")).join(best, site).where(F.col("clue") != F.col("b.clue"))
    far = geo.millimetres(geo.distance(F.col("b.lat"), F.col("b.lng"), F.col("lat"), F.col("lng")))
    others = others.groupBy(site).agg(F.count("*").alias("others"), F.max(far).alias("farthest_mm"))
    say = lambda why: F.struct("_order", "clue", F.concat("clue_type", F.lit(" '"), "value", F.lit("': "), why).alias("text"))
    hand = of(*UNPLACED).withColumn("_order", F.element_at(order, kind)).select(site, say(F.element_at(table(UNPLACED), kind)).alias("u"), F.lit(0).alias("out"))
    failed = tried.where("why is not null").select(site, say(F.col("why")).alias("u"), F.lit(0).alias("out"))
    out = told.where(~F.col("ok")).select(site, say(F.concat(F.lit("rejected, "), F.col("check"))).alias("u"), F.lit(1).alias("out"))
    # The reasons of one site, as many as its clues at most.
    open_ = hand.union(failed).union(out).groupBy(site).agg(F.sum("out").alias("rejected"), F.array_join(F.transform(F.array_sort(F.collect_list("u")), lambda u: u["text"]), "; ").alias("unresolved"))
    all_ = stated.select(site).where(F.col(site).isNotNull()).join(best, site, "left").join(others, site, "left").join(open_, site, "left")
    return all_.select(site, "b.tier", "b.clue", *[F.col(f"b.{c}") for c in fields[1:]], F.coalesce("rejected", F.lit(0)).alias("rejected"), F.coalesce("others", F.lit(0)).alias("others"), "farthest_mm", F.coalesce("unresolved", F.lit("")).alias("unresolved"))
