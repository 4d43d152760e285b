"""Spatial queries over the star schema, placed on the map by a fixed synthetic geocode.

Customers are sites, parts and suppliers features. The geocode is integer
arithmetic on keys, the same in Spark and in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geosieve.functions import geo
from geosieve.operators import spatial
from geosieve.plans.registry import Tables, query
from geosieve.sources.scratch import Scratch

R = 50_000


def place(key: str, by_lat: int = 7919, by_lng: int = 104729) -> tuple[Column, Column]:
    """Latitude and longitude of a key."""
    k = F.col(key).cast("long")
    return F.lit(25.0) + (k * by_lat % 24000) / F.lit(1000.0), F.lit(-124.0) + (k * by_lng % 57000) / F.lit(1000.0)


def sites(t: Tables) -> DataFrame:
    lat, lng = place("c_custkey")
    return t.customer.select(F.col("c_custkey").alias("site"), lat.alias("lat"), lng.alias("lng"))


def spots(t: Tables) -> DataFrame:
    """The places of sites, each once."""
    return sites(t).select("lat", "lng").distinct()


def parts(t: Tables) -> DataFrame:
    lat, lng = place("p_partkey", 6007, 50021)
    return t.part.select(F.col("p_partkey").alias("feature"), F.col("p_size").cast("long").alias("size"), lat.alias("f_lat"), lng.alias("f_lng"))


def suppliers(t: Tables) -> DataFrame:
    lat, lng = place("s_suppkey", 3571, 81001)
    return t.supplier.select(F.col("s_suppkey").alias("point"), F.col("s_nationkey").cast("long").alias("nation"), lat.alias("lat"), lng.alias("lng"))


SITES = "sites AS (SELECT c_custkey AS site, 25e0 + (c_custkey * 7919 % 24000) / 1e3 AS lat, -124e0 + (c_custkey * 104729 % 57000) / 1e3 AS lng FROM customer)"
PARTS = "parts AS (SELECT p_partkey AS feature, CAST(p_size AS BIGINT) AS size, 25e0 + (p_partkey * 6007 % 24000) / 1e3 AS f_lat, -124e0 + (p_partkey * 50021 % 57000) / 1e3 AS f_lng FROM part)"
SUPPLIERS = "suppliers AS (SELECT s_suppkey AS point, CAST(s_nationkey AS BIGINT) AS nation, 25e0 + (s_suppkey * 3571 % 24000) / 1e3 AS lat, -124e0 + (s_suppkey * 81001 % 57000) / 1e3 AS lng FROM supplier)"


def far(a: str, b: str, lat: str = "f_lat", lng: str = "f_lng") -> str:
    """SQL for the millimetres from a point of a to one of b."""
    x, y = f"(({b}.{lng} - {a}.lng) * 111320e0 * cos(radians({a}.lat)))", f"(({b}.{lat} - {a}.lat) * 110540e0)"
    return f"CAST(round(sqrt({x} * {x} + {y} * {y}) * 1000) AS BIGINT)"


NEAR = f"{far('s', 'f')} AS d_mm FROM sites s JOIN parts f ON f.f_lat BETWEEN s.lat - 0.5 AND s.lat + 0.5 AND f.f_lng BETWEEN s.lng - 1 AND s.lng + 1"
PAIRS = f"pairs AS (SELECT * FROM (SELECT s.site, f.feature, f.size, {NEAR}) WHERE d_mm <= {R * 1000})"


@query(f"""WITH {SITES}, {PARTS}, {PAIRS},
    best AS (SELECT site, min(row(d_mm, feature)) AS b FROM pairs GROUP BY site)
    SELECT sites.site, b[2] AS nearest_feature, b[1] // 1000 AS nearest_m, CASE WHEN b IS NULL THEN 'absent' ELSE 'ok' END AS status
    FROM sites LEFT JOIN best USING (site)""")
def nearest_point_within_radius(t: Tables) -> DataFrame:
    """Each site's nearest feature within the radius, or absent."""
    out = spatial.measured(sites(t), parts(t), "site", "feature", {"b": spatial.Nearest(R)})
    return out.select(
        "site",
        F.col("b.feature").alias("nearest_feature"),
        F.floor(F.col("b.d_mm") / 1000).alias("nearest_m"),
        F.when(F.col("b").isNull(), "absent").otherwise("ok").alias("status"),
    )


@query(f"""WITH {SITES}, {PARTS}, {PAIRS},
    best AS (SELECT site, min(row(d_mm, feature)) FILTER (size >= 20) AS a, min(row(d_mm, feature)) FILTER (size >= 40) AS b FROM pairs GROUP BY site)
    SELECT sites.site, a[2] AS hub20, a[1] // 1000 AS hub20_m, b[2] AS hub40, b[1] // 1000 AS hub40_m FROM sites LEFT JOIN best USING (site)""")
def nearest_conditional(t: Tables) -> DataFrame:
    """The nearest features of at least two sizes, from one range join."""
    out = spatial.measured(sites(t), parts(t), "site", "feature", {f"b{n}": spatial.Nearest(R, where=f"size >= {n}") for n in (20, 40)})
    return out.select("site", *[c for n in (20, 40) for c in (F.col(f"b{n}.feature").alias(f"hub{n}"), F.floor(F.col(f"b{n}.d_mm") / 1000).alias(f"hub{n}_m"))])


@query(f"""WITH {SITES}, {PARTS}, {PAIRS}
    SELECT sites.site, count(*) FILTER (d_mm <= 10000000) AS within_10km, count(*) FILTER (d_mm <= 25000000) AS within_25km, count(feature) AS within_50km,
        CAST(coalesce(sum(size) FILTER (d_mm <= 25000000), 0) AS BIGINT) AS size_25km, max(size) AS max_size_50km,
        count(*) FILTER (size % 2 = 0 AND d_mm <= 25000000) AS even_25km, count(*) FILTER (size % 2 = 1 AND d_mm <= 25000000) AS odd_25km
    FROM sites LEFT JOIN pairs USING (site) GROUP BY sites.site""")
def ring_counts_and_sums(t: Tables) -> DataFrame:
    """Counts and sums in rings, by category too; zero where nothing is near, no maximum."""
    ring = lambda km, *more: spatial.Total(km * 1_000, *more)
    out = spatial.measured(
        sites(t), parts(t), "site", "feature",
        {"within_10km": ring(10), "within_25km": ring(25), "within_50km": ring(50), "size_25km": ring(25, None, "sum", "size"), "max_size_50km": ring(50, None, "max", "size"),
         "even_25km": ring(25, "size % 2 = 0"), "odd_25km": ring(25, "size % 2 = 1")},
    )
    return out.fillna(0, ["within_10km", "within_25km", "within_50km", "size_25km", "even_25km", "odd_25km"])


LINES = "lines AS (SELECT *, f_lat + (feature % 7 - 3) * 5e-2 AS g_lat, f_lng + (feature % 11 - 5) * 5e-2 AS g_lng FROM parts)"
LINE_R = 15_000


def lines(t: Tables) -> DataFrame:
    return parts(t).withColumns(
        {"g_lat": F.col("f_lat") + (F.col("feature") % 7 - 3) * F.lit(0.05), "g_lng": F.col("f_lng") + (F.col("feature") % 11 - 5) * F.lit(0.05)}
    )


@query(f"""WITH {SITES}, {PARTS}, {LINES},
    ends AS (SELECT site, feature, size, (f_lng - lng) * 111320e0 * cos(radians(lat)) AS ax, (f_lat - lat) * 110540e0 AS ay,
        (g_lng - lng) * 111320e0 * cos(radians(lat)) AS bx, (g_lat - lat) * 110540e0 AS b_y
        FROM sites JOIN lines ON f_lat BETWEEN lat - 0.4 AND lat + 0.4 AND f_lng BETWEEN lng - 0.6 AND lng + 0.6),
    feet AS (SELECT *, CASE WHEN bx = ax AND b_y = ay THEN 0e0 ELSE least(1e0, greatest(0e0, -(ax * (bx - ax) + ay * (b_y - ay)) / ((bx - ax) * (bx - ax) + (b_y - ay) * (b_y - ay)))) END AS u FROM ends),
    far AS (SELECT site, feature, size, CAST(round(sqrt((ax + u * (bx - ax)) * (ax + u * (bx - ax)) + (ay + u * (b_y - ay)) * (ay + u * (b_y - ay))) * 1000) AS BIGINT) AS d_mm FROM feet),
    best AS (SELECT site, min(row(d_mm, feature)) AS a, min(row(d_mm, feature)) FILTER (size >= 25) AS b, count(*) AS n FROM far WHERE d_mm <= {LINE_R * 1000} GROUP BY site)
    SELECT sites.site, a[2] AS line, a[1] // 100 / 10e0 AS line_m, b[2] AS big_line, b[1] // 100 / 10e0 AS big_line_m, n AS lines_near FROM sites LEFT JOIN best USING (site)""")
def nearest_segment(t: Tables) -> DataFrame:
    """The nearest line and the nearest big line by point-to-segment distance."""
    box = (F.least("f_lat", "g_lat"), F.least("f_lng", "g_lng"), F.greatest("f_lat", "g_lat"), F.greatest("f_lng", "g_lng"))
    a, b = (geo.offset(F.col("lat"), F.col("lng"), F.col(f"{e}_lat"), F.col(f"{e}_lng"), F.col("cos")) for e in "fg")
    # Lines are dealt to as many tasks as are set: a file of few row groups is read by few, which would make all copies.
    dealt = lines(t).repartition(int(t.spark.conf.get("spark.sql.shuffle.partitions")), "feature")
    found = lambda own, *own_m: spatial.range_join(own, dealt, LINE_R, box, 30_000, *own_m).withColumn("d_mm", geo.millimetres(geo.segment_distance(*a, *b)))
    big, near = F.col("size") >= 25, F.col("d_mm") <= LINE_R * 1000
    # Sites at one place are measured once: first the least distances, which group without a sort, then the lines at those.
    # The distance is tested in the aggregates: as a filter it would be a condition of the join, which takes it apart and computes its terms many times a pair.
    own = spots(t).withColumn("cos", geo.cosine(F.col("lat")))
    least = found(own).groupBy("lat", "lng", "cos").agg(F.min(F.when(near, F.col("d_mm"))).alias("least"), F.min(F.when(near & big, F.col("d_mm"))).alias("least_big"), F.count_if(near).alias("lines_near"))
    least = Scratch(t.spark).keep(least.where("lines_near > 0"))
    first = lambda c, where: F.min(F.when(where & (F.col("d_mm") == F.col(c)), F.col("feature")))
    best = found(least, spatial.reach("least", "least_big")).groupBy("lat", "lng", "least", "least_big", "lines_near").agg(first("least", F.lit(True)).alias("line"), first("least_big", big).alias("big_line"))
    out = sites(t).join(best, ["lat", "lng"], "left")
    tenth = lambda c: F.floor(F.col(c) / 100) / F.lit(10.0)
    return out.select("site", "line", tenth("least").alias("line_m"), "big_line", tenth("least_big").alias("big_line_m"), "lines_near")


#: The corners of a synthetic outline, in radii from its point, and those of its hole.
OUTLINE = ((1.0, 0.0), (0.2, 0.9), (-0.8, 0.5), (-0.3, -0.1), (-0.7, -0.8), (0.4, -0.9))
HOLE = ((0.3, 0.0), (0.0, 0.3), (-0.1, 0.0), (0.0, -0.3))
RING_R, POLYGON_CELL = 20_000, 40_000
EDGE_SQL = " UNION ALL ".join(
    f"SELECT feature, size, f_lat, f_lng, {int(ring is HOLE)} AS hole, f_lng + r * {a[0]}e0 AS alng, f_lat + r * {a[1]}e0 AS alat, f_lng + r * {b[0]}e0 AS blng, f_lat + r * {b[1]}e0 AS blat FROM radii"
    for ring in (OUTLINE, HOLE)
    for a, b in zip(ring, (*ring[1:], ring[0]))
)
POLYGON_SQL = f"""WITH {SITES}, {PARTS}, radii AS (SELECT *, 2e-2 + size * 4e-3 AS r FROM parts),
    edges AS ({EDGE_SQL}),
    ends AS (SELECT site, feature, size, hole, (alat > lat) <> (blat > lat) AND lng < (blng - alng) * (lat - alat) / nullif(blat - alat, 0e0) + alng AS crosses,
        (alng - lng) * 111320e0 * cos(radians(lat)) AS ax, (alat - lat) * 110540e0 AS ay, (blng - lng) * 111320e0 * cos(radians(lat)) AS bx, (blat - lat) * 110540e0 AS b_y
        FROM sites JOIN edges ON f_lat BETWEEN lat - 0.5 AND lat + 0.5 AND f_lng BETWEEN lng - 0.7 AND lng + 0.7),
    feet AS (SELECT *, least(1e0, greatest(0e0, -(ax * (bx - ax) + ay * (b_y - ay)) / ((bx - ax) * (bx - ax) + (b_y - ay) * (b_y - ay)))) AS u FROM ends),
    rings AS (SELECT site, feature, any_value(size) AS size, count(*) FILTER (hole = 0 AND crosses) % 2 = 1 AND count(*) FILTER (hole = 1 AND crosses) % 2 = 0 AS inside,
        CAST(round(min(sqrt((ax + u * (bx - ax)) * (ax + u * (bx - ax)) + (ay + u * (b_y - ay)) * (ay + u * (b_y - ay)))) * 1000) AS BIGINT) AS edge_mm FROM feet GROUP BY ALL),
    far AS (SELECT *, CASE WHEN inside THEN 0 ELSE edge_mm END AS d_mm FROM rings)"""


def polygons(t: Tables) -> DataFrame:
    r = F.lit(0.02) + F.col("size") * F.lit(0.004)
    ring = lambda corners: F.array(*[F.struct((F.col("f_lng") + r * x).alias("lng"), (F.col("f_lat") + r * y).alias("lat")) for x, y in corners])
    return parts(t).select("feature", "size", geo.polygon_edges(ring(OUTLINE), F.array(ring(HOLE))).alias("edges"), (F.col("f_lat") - r).alias("south"), (F.col("f_lng") - r).alias("west"), (F.col("f_lat") + r).alias("north"), (F.col("f_lng") + r).alias("east"))


def polygon_pairs(own: DataFrame, t: Tables, radius: float) -> DataFrame:
    """Places (lat, lng) and the polygons in whose widened box they lie, with edges."""
    box = tuple(F.col(c) for c in ("south", "west", "north", "east"))
    return spatial.range_join(own, polygons(t), radius, box, cell_m=POLYGON_CELL)


@query(f"""{POLYGON_SQL}, best AS (SELECT site, min(row(d_mm, feature)) AS a, count(*) FILTER (d_mm = 0) AS holding FROM far WHERE d_mm <= {RING_R * 1000} GROUP BY site)
    SELECT sites.site, a[2] AS polygon, a[1] // 1000 AS polygon_m, coalesce(holding, 0) AS holding FROM sites LEFT JOIN best USING (site)""")
def polygon_distance(t: Tables) -> DataFrame:
    """The nearest polygon, 0 inside it and outside its holes."""
    far_ = lambda own, radius: spatial.polygon_distances(polygon_pairs(own, t, radius), ["lat", "lng", "feature"])
    best = spatial.nearest("feature").alias("a")
    # What is in a polygon needs no search: only places in none are measured against all polygons in reach.
    held = Scratch(t.spark).keep(far_(spots(t), 1.0).where("d_mm = 0").groupBy("lat", "lng").agg(best, F.count("*").alias("holding")))
    rest = far_(spots(t).join(held, ["lat", "lng"], "left_anti"), RING_R).where(F.col("d_mm") <= RING_R * 1000).groupBy("lat", "lng").agg(best, F.lit(0).cast("long").alias("holding"))
    out = sites(t).join(held.unionByName(rest), ["lat", "lng"], "left")
    return out.select("site", F.col("a.feature").alias("polygon"), F.floor(F.col("a.d_mm") / 1000).alias("polygon_m"), F.coalesce("holding", F.lit(0)).alias("holding"))


@query(f"""{POLYGON_SQL}, hits AS (SELECT site, min(feature) AS polygon, max(size) AS largest, string_agg(CAST(feature AS VARCHAR), ';' ORDER BY feature) AS polygons FROM far WHERE inside GROUP BY site)
    SELECT sites.site, polygon, largest, polygons, CASE WHEN polygon IS NULL THEN 'absent' ELSE 'ok' END AS status FROM sites LEFT JOIN hits USING (site)""")
def point_in_polygon(t: Tables) -> DataFrame:
    """The first polygon that holds each site, and all of them."""
    # Inside is the parity of the edges east of a place; one within half a millimetre outside is not inside.
    crossed = polygon_pairs(spots(t), t, 1.0).select("lat", "lng", "feature", "size", F.explode("edges").alias("e"))
    inside = crossed.groupBy("lat", "lng", "feature", "size").agg(F.sum(geo.edge_crosses(F.col("e"), F.col("lat"), F.col("lng"))).alias("c")).where("c % 2 = 1")
    listed = F.array_join(F.transform(F.array_sort(F.collect_set("feature")), lambda x: x.cast("string")), ";")
    hits = inside.groupBy("lat", "lng").agg(F.min("feature").alias("polygon"), F.max("size").alias("largest"), listed.alias("polygons"))
    out = sites(t).join(hits, ["lat", "lng"], "left")
    return out.select("site", "polygon", "largest", "polygons", F.when(F.col("polygon").isNull(), "absent").otherwise("ok").alias("status"))


@query(f"""WITH {SITES}, {PARTS}, {PAIRS}, near AS (SELECT *, min(d_mm) OVER (PARTITION BY site) AS least FROM pairs),
    best AS (SELECT site, min(row(-size, feature, d_mm)) AS b, count(*) AS n FROM near WHERE d_mm <= least + 5000000 GROUP BY site)
    SELECT site, b[2] AS feature, -b[1] AS size, b[3] // 1000 AS feature_m, n AS in_band FROM best""")
def tie_band_argmax(t: Tables) -> DataFrame:
    """Of the features within 5 km of the nearest one's distance, the largest."""
    out = spatial.best_in_band(sites(t), parts(t), "site", "feature", "size", R, 5_000_000)
    return out.select("site", F.col("best.feature"), (-F.col("best.minus")).alias("size"), F.floor(F.col("best.d_mm") / 1000).alias("feature_m"), "in_band")


@query(f"""WITH {SITES}, {PARTS}, {PAIRS}, best AS (SELECT site, min(row(d_mm, feature)) AS b FROM pairs GROUP BY site)
    SELECT sites.site, b[2] AS feature, b[1] // 1000 AS feature_m, CASE WHEN b[1] <= 10000000 THEN 10000 WHEN b[1] <= 25000000 THEN 25000 WHEN b IS NOT NULL THEN 50000 END AS searched_m
    FROM sites LEFT JOIN best USING (site)""")
def expanding_search(t: Tables) -> DataFrame:
    """The nearest feature by radii of 10, 25 and 50 km, each only for sites still without one."""
    out = spatial.expanding_nearest(sites(t), parts(t), "site", "feature", [10_000, 25_000, R])
    return out.select("site", F.col("best.feature"), F.floor(F.col("best.d_mm") / 1000).alias("feature_m"), "searched_m")


GAP = 60_000
LINKS_SQL = f"""{SUPPLIERS}, links AS (SELECT a.point AS a, b.point AS b FROM suppliers a JOIN suppliers b ON a.point <> b.point AND {far("a", "b", "lat", "lng")} <= {GAP * 1000}),
    both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
    reach AS (SELECT point, point AS other FROM suppliers UNION SELECT reach.point, both_ways.b FROM reach JOIN both_ways ON reach.other = both_ways.a),
    grouped AS (SELECT suppliers.*, (SELECT min(other) FROM reach WHERE reach.point = suppliers.point) AS component FROM suppliers)"""


@query(f"WITH RECURSIVE {LINKS_SQL} SELECT point, component FROM grouped")
def components_within_gap(t: Tables) -> DataFrame:
    """Supplier points grouped by steps of at most 60 km."""
    return spatial.within_gap(suppliers(t), "point", GAP).select("point", "component")


@query(f"""WITH RECURSIVE {LINKS_SQL}, sized AS (SELECT *, CAST(round(s_acctbal * 100) AS BIGINT) AS area FROM grouped JOIN supplier ON point = s_suppkey),
    rolled AS (SELECT component, count(*) AS pieces, CAST(sum(area) AS BIGINT) AS area, max(area) AS largest, CASE WHEN count(DISTINCT nation) = 1 THEN CAST(min(nation) AS VARCHAR) ELSE 'Mixed' END AS kind FROM sized GROUP BY component),
    ranked AS (SELECT component, nation, row_number() OVER (PARTITION BY component ORDER BY sum(area) DESC, nation) AS n FROM sized GROUP BY component, nation),
    named AS (SELECT component, CASE WHEN count(*) > 3 THEN string_agg(CAST(point AS VARCHAR), '; ' ORDER BY point) FILTER (k <= 3) || ' +' || (count(*) - 3) || ' more' ELSE string_agg(CAST(point AS VARCHAR), '; ' ORDER BY point) END AS members
        FROM (SELECT *, row_number() OVER (PARTITION BY component ORDER BY point) AS k FROM sized) GROUP BY component)
    SELECT nation || '-' || lpad(CAST(row_number() OVER (PARTITION BY nation ORDER BY area DESC, component) AS VARCHAR), 3, '0') AS id, component, pieces, area, largest, kind, nation, members
    FROM rolled JOIN ranked USING (component) JOIN named USING (component) WHERE n = 1""")
def site_grouping_rollup(t: Tables) -> DataFrame:
    """Grouped points with totals, their main nation, members with "+N more" and a running id in each nation."""
    from geosieve.operators.relational import joined_some, numbered_id

    sized = spatial.within_gap(suppliers(t), "point", GAP).join(
        t.supplier.select(F.col("s_suppkey").alias("point"), F.round(F.col("s_acctbal") * 100).cast("long").alias("area")), "point"
    )
    by_nation = sized.groupBy("component", "nation").agg(F.sum("area").alias("part"), F.count("*").alias("n"), F.max("area").alias("most"))
    rolled = by_nation.groupBy("component").agg(
        F.sum("n").alias("pieces"),
        F.sum("part").alias("area"),
        F.max("most").alias("largest"),
        F.when(F.count("*") == 1, F.min("nation").cast("string")).otherwise("Mixed").alias("kind"),
        F.min(F.struct((-F.col("part")).alias("minus"), "nation"))["nation"].alias("nation"),
    )
    named = joined_some(sized, "component", "point", 3, "members")
    return numbered_id(rolled.join(named, "component"), "nation", [F.desc("area"), F.asc("component")], "id")


@query(f"""WITH {SITES}, {PARTS}, cells AS (SELECT site, i, j, (j - 7) * 1000e0 AS x, (i - 7) * 1000e0 AS y FROM sites, range(15) a(i), range(15) b(j)),
    near AS (SELECT s.site, (f.f_lng - s.lng) * 111320e0 * cos(radians(s.lat)) AS fx, (f.f_lat - s.lat) * 110540e0 AS fy FROM sites s JOIN parts f ON f.f_lat BETWEEN s.lat - 0.3 AND s.lat + 0.3 AND f.f_lng BETWEEN s.lng - 0.4 AND s.lng + 0.4),
    held AS (SELECT c.site, c.i, c.j, CAST(round(min(sqrt((x - fx) * (x - fx) + (y - fy) * (y - fy))) * 1000) AS BIGINT) AS d FROM cells c LEFT JOIN near n USING (site) GROUP BY ALL)
    SELECT site, count(*) FILTER (d IS NULL OR d >= 3707200) AS usable, count(*) FILTER (d < 3707200) AS blocked,
        count(*) FILTER (d IS NULL OR d >= 8707200) AS far FROM held GROUP BY site""")
def usable_cells(t: Tables) -> DataFrame:
    """Cells of a 15 by 15 km grid about each site that lie clear of all features, half a diagonal on the safe side."""
    cell, clear, farther = 1000.0, 3000.0, 8000.0
    half = 0.7072 * cell
    reach = 12_000 + farther
    x, y = geo.offset(F.col("lat"), F.col("lng"), F.col("f_lat"), F.col("f_lng"))
    # Places of sites and of features, each once; what is too far from every cell is left out before there are cells.
    near = spatial.range_join(spots(t), parts(t).select("f_lat", "f_lng").distinct(), reach).select("lat", "lng", x.alias("x"), y.alias("y"))
    near = near.where((F.abs("x") < 7 * cell + farther + cell) & (F.abs("y") < 7 * cell + farther + cell))
    # Cells are rows, so that the arithmetic is compiled and their minimum is taken before anything is shuffled.
    cells = near.select("lat", "lng", "x", "y", F.explode(F.sequence(F.lit(0), F.lit(224))).alias("c"))
    dx, dy = (F.col("c") % 15 - 7) * F.lit(cell) - F.col("x"), (F.floor(F.col("c") / 15) - 7) * F.lit(cell) - F.col("y")
    away = cells.select("lat", "lng", "c", F.sqrt(dx * dx + dy * dy).alias("d")).where(F.col("d") < farther + cell)
    least = away.groupBy("lat", "lng", "c").agg(geo.millimetres(F.min("d")).alias("d"))
    blocked = lambda m: F.count_if(F.col("d") < int((m + half) * 1000))
    held = sites(t).join(least.groupBy("lat", "lng").agg(blocked(clear).alias("blocked"), blocked(farther).alias("close")), ["lat", "lng"], "left").fillna(0, ["blocked", "close"])
    return held.select("site", (225 - F.col("blocked")).alias("usable"), "blocked", (225 - F.col("close")).alias("far"))
