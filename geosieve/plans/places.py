"""Queries of operators/places.py and small relational ones: subsets, probes, profiles, zone tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from geosieve.functions import rules as r
from geosieve.functions import text as x
from geosieve.operators import places as p
from geosieve.plans.registry import Tables, query
from geosieve.operators import spatial
from geosieve.operators.overlay import box_overlap
from geosieve.plans.spatial import GAP, LINKS_SQL, PARTS, SITES, far, parts, sites, suppliers
from geosieve.plans.surroundings import one

CLUES = """clues AS (SELECT l_orderkey AS site, CAST(l_linenumber AS BIGINT) * 1000000000 + l_partkey * 10000 + l_suppkey AS ordinal, 'L' || (l_partkey % 5 + 1) AS tier, 'C' || l_suppkey % 3 AS county, CASE WHEN l_orderkey % 4 <> 0 THEN 'c' || l_orderkey % 3 END AS stated_county, (l_partkey * 37 % 5000) * 1e0 AS county_m, 2000e0 AS radius_m,
    'Z' || l_suppkey % 4 AS zip, CASE WHEN l_orderkey % 3 <> 0 THEN 'Z' || l_orderkey % 4 END AS stated_zip, l_partkey AS place FROM lineitem),
    checked AS (SELECT *, stated_county IS NULL OR lower(county) = stated_county AS same, tier = 'L3' AND county_m <= radius_m AS close, tier IN ('L4', 'L5') AS area FROM clues)"""


def clues(t: Tables) -> DataFrame:
    l, o, s = F.col("l_partkey"), F.col("l_orderkey"), F.col("l_suppkey")  # noqa: E741
    text = lambda a, c: F.concat(F.lit(a), c.cast("string"))
    return t.lineitem.select(
        o.alias("site"), (F.col("l_linenumber").cast("long") * 1000000000 + l * 10000 + s).alias("ordinal"), text("L", l % 5 + 1).alias("tier"), text("C", s % 3).alias("county"), F.when(o % 4 != 0, text("c", o % 3)).alias("stated_county"),
        (l * 37 % 5000 * 1.0).alias("county_m"), F.lit(2000.0).alias("radius_m"), text("Z", s % 4).alias("zip"), F.when(o % 3 != 0, text("Z", o % 4)).alias("stated_zip"), l.alias("place"),
    )


@query(f"""WITH {CLUES}, c AS (SELECT *, area OR same OR close AS ok, CASE WHEN area THEN 'area centroid' ELSE concat_ws('; ', CASE WHEN same THEN 'in the county' WHEN close THEN 'near the stated county' ELSE 'not in the stated county' END, CASE WHEN stated_zip IS NOT NULL THEN CASE WHEN zip = stated_zip THEN 'in stated ZIP' ELSE 'another ZIP' END END) END AS said FROM checked),
    b AS (SELECT *, row_number() OVER (PARTITION BY site ORDER BY tier, ordinal) AS n FROM c WHERE ok), g AS (SELECT site, count(*) FILTER (NOT ok) AS rejected FROM c GROUP BY site)
    SELECT g.site, tier, place, said AS "check", rejected FROM g LEFT JOIN b ON b.site = g.site AND n = 1""")
def locate_sites(t: Tables) -> DataFrame:
    """The best located clue of each site after the check of county and ZIP, and how many clues were rejected."""
    return p.best_location(p.checked(clues(t)), "site", "ordinal", ["place", "check"])


@query("""WITH r AS (SELECT l_orderkey AS site, CAST(l_linenumber AS BIGINT) * 1000000000 + l_partkey * 10000 + l_suppkey AS ordinal, 'A' || l_suppkey % 12 AS apn, (l_partkey * 31 % 9000) / 4e0 AS area, (l_partkey * 17 % 9000) / 4e0 AS overlap, (l_suppkey % 80) / 10e0 AS distance, 'A' || l_orderkey % 12 AS own_apn, l_suppkey % 6 AS o, l_orderkey % 6 AS mine FROM lineitem),
    k AS (SELECT *, round_even(area, 0) AS whole FROM r WHERE area >= 20 AND NOT overlap > 0.9e0 * greatest(area, 1e0) AND apn <> own_apn),
    f AS (SELECT *, row_number() OVER (PARTITION BY site, apn, whole ORDER BY ordinal) AS n FROM k),
    g AS (SELECT site, apn, whole AS m2, round_even(area / 4046.8564224e0, 2) AS acres, distance <= 3 AS touches, o = mine AS same_owner FROM f WHERE n = 1)
    SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY site ORDER BY CASE WHEN same_owner THEN 0 ELSE 1 END, acres DESC, apn, m2) AS INTEGER) AS place FROM g) WHERE place <= 30""")
def parcel_neighbours(t: Tables) -> DataFrame:
    """The neighbours of each parcel without slivers, itself and repeats, which of them touch it, in the order they are labelled."""
    a, o, s = F.col("l_partkey"), F.col("l_orderkey"), F.col("l_suppkey")
    text = lambda c: F.concat(F.lit("A"), c.cast("string"))
    tokens = lambda c: x.owner_tokens(F.concat(F.lit("Owner"), c.cast("string"), F.lit(" Land LLC")))
    rows = t.lineitem.select(
        o.alias("site"), (F.col("l_linenumber").cast("long") * 1000000000 + a * 10000 + s).alias("ordinal"), text(s % 12).alias("apn"), (a * 31 % 9000 / 4.0).alias("area_m2"), (a * 17 % 9000 / 4.0).alias("overlap_m2"), (s % 80 / 10.0).alias("distance_m"),
        text(o % 12).alias("own_apn"), tokens(s % 6).alias("tokens"), tokens(o % 6).alias("own_tokens"),
    )
    return p.neighbour_labels(p.neighbours(rows, "site"), "site")


@query(f"""WITH {SITES}, {PARTS}, a AS (SELECT site, lat, lng, 20000e0 AS radius, 20 + site % 30 AS acres, true AS first FROM sites UNION ALL SELECT site, lat + 1e-1, lng, 10000e0, 20 + site % 30, false FROM sites),
    f AS (SELECT *, size + 0e0 AS pa, 'P' || feature % 700 AS apn, feature % 9 = 0 AS common, feature % 4 AS o FROM parts),
    m AS (SELECT a.site, f.apn, round_even(pa, 1) AS r, feature, {far("a", "f")} AS d_mm, first, CAST(round_even(100 * (pa - acres) / acres, 0) AS INTEGER) AS diff, o = a.site % 4 AS same, {far("a", "f")} <= (radius + 500) * 1000 AS near,
        sqrt(pow((f.f_lng - a.lng - 2e-2) * 111320e0 * cos(radians(CASE WHEN first THEN a.lat ELSE a.lat - 1e-1 END)), 2) + pow((f.f_lat - CASE WHEN first THEN a.lat ELSE a.lat - 1e-1 END) * 110540e0, 2)) <= 150 AS adj
        FROM a JOIN f ON f.f_lat BETWEEN a.lat - 0.3 AND a.lat + 0.3 AND f.f_lng BETWEEN a.lng - 0.5 AND a.lng + 0.5 WHERE abs(pa - acres) <= 0.15e0 * acres AND NOT common),
    g AS (SELECT site, apn, r, min(feature) AS parcel, bool_or(adj) AS adjacent, bool_or(same) AS same_owner, min(diff) AS diff_pct, min(d_mm) FILTER (first) AS d_mm FROM m WHERE near GROUP BY site, apn, r)
    SELECT site, apn, parcel, adjacent, same_owner, diff_pct, d_mm, CAST(row_number() OVER (PARTITION BY site ORDER BY CASE WHEN adjacent THEN 0 ELSE 1 END, CASE WHEN same_owner THEN 0 ELSE 1 END, abs(diff_pct), d_mm NULLS LAST, parcel) AS INTEGER) AS place, count(*) OVER (PARTITION BY site) AS n, count(*) OVER (PARTITION BY site) > 5 AS too_many FROM g""")
def candidate_parcels(t: Tables) -> DataFrame:
    """Parcels of the stated size in either of two circles about each site, without common areas and repeats, ranked."""
    tokens = lambda c: x.owner_tokens(F.concat(F.lit("Owner"), c.cast("string")))
    site = F.col("site")
    own = sites(t).withColumns({"acres": 20 + site % 30, "sub_lat": F.col("lat"), "sub_lng": F.col("lng") + F.lit(0.02), "own_tokens": tokens(site % 4)})
    areas = own.withColumns({"radius_m": F.lit(20000.0), "first": F.lit(True)}).unionByName(own.withColumns({"lat": F.col("lat") + F.lit(0.1), "radius_m": F.lit(10000.0), "first": F.lit(False)}))
    f = F.col("feature")
    owner = F.when(f % 9 == 0, "Oak Home Owners Assn").otherwise(F.concat(F.lit("Owner"), (f % 4).cast("string")))
    parcels = parts(t).select(f.alias("parcel"), "f_lat", "f_lng", F.lit(500.0).alias("reach_m"), (F.col("size") + F.lit(0.0)).alias("parcel_acres"), owner.alias("owner"), tokens(f % 4).alias("tokens"), F.concat(F.lit("P"), (f % 700).cast("string")).alias("apn"))
    return p.candidates(areas, parcels, "site")


@query("""WITH t AS (SELECT s_suppkey AS site, ['Smith', 'O''Neill', 'Xy', 'JONES'][s_suppkey % 4 + 1] AS name, CASE WHEN s_suppkey % 3 <> 0 THEN 10e0 + s_suppkey % 20 END AS acres FROM supplier), c AS (SELECT l_suppkey AS site, l_orderkey * 100000 + l_partkey AS parcel, ['Smith John', 'ONEILL FAMILY LP', 'xyz', 'Jonesville'][l_partkey % 4 + 1] AS owner, l_quantity * 1e0 AS a, l_partkey % 3000 AS m FROM lineitem)
    SELECT t.site, name, parcel, acres IS NULL OR abs((a - acres) / acres) <= 0.15e0 AS match, CAST(round_even(100 * (a - acres) / acres, 0) AS INTEGER) AS diff_pct, m AS outside_m FROM t JOIN c USING (site) WHERE s_suppkey_ok(name) AND contains(upper(owner), regexp_replace(upper(name), '[^A-Z ]', '', 'g'))""".replace("s_suppkey_ok(name)", "name <> 'Xy'"))
def owner_search(t: Tables) -> DataFrame:
    """Parcels under the name a tract is known by, those of its size as matches, the others as context."""
    k, a = F.col("s_suppkey"), F.col("l_partkey")
    tracts = t.supplier.select(k.alias("site"), one(("Smith", "O'Neill", "Xy", "JONES"), k % 4).alias("name"), F.when(k % 3 != 0, 10.0 + k % 20).alias("tract_acres"))
    parcels = t.lineitem.select(F.col("l_suppkey").alias("site"), (F.col("l_orderkey") * 100000 + a).alias("parcel"), one(("Smith John", "ONEILL FAMILY LP", "xyz", "Jonesville"), a % 4).alias("owner"), (F.col("l_quantity") * 1.0).alias("parcel_acres"), (a % 3000).alias("outside_m"))
    return p.owner_search(tracts, parcels, "site")


@query("""WITH s AS (SELECT l_suppkey AS k, CASE WHEN l_linenumber % 2 = 0 THEN 1 ELSE 2 END AS road, (l_partkey % 64) * 16e0 AS ax, (l_orderkey % 64) * 16e0 AS ay, (l_partkey % 37) * 16e0 AS bx, (l_orderkey % 41) * 16e0 AS by_ FROM lineitem WHERE l_quantity <= 5),
    j AS (SELECT a.k, a.ax, a.ay, a.bx - a.ax AS dx, a.by_ - a.ay AS dy, b.ax - a.ax AS wx, b.ay - a.ay AS wy, b.bx - b.ax AS ex, b.by_ - b.ay AS ey FROM s a JOIN s b USING (k) WHERE a.road = 1 AND b.road = 2),
    u AS (SELECT *, (wx * ey - wy * ex) / nullif(dx * ey - dy * ex, 0) AS u, (wx * dy - wy * dx) / nullif(dx * ey - dy * ex, 0) AS v FROM j), m AS (SELECT k, ax + u * dx AS x, ay + u * dy AS y FROM u WHERE u BETWEEN 0 AND 1 AND v BETWEEN 0 AND 1),
    c AS (SELECT k, avg(x) AS mx, avg(y) AS my, count(*) AS n FROM m GROUP BY k) SELECT c.k, round(any_value(mx), 3) AS mx, round(any_value(my), 3) AS my, any_value(n) AS n, max(sqrt(pow(x - mx, 2) + pow(y - my, 2))) > 500 AS ambiguous FROM c JOIN m USING (k) GROUP BY c.k""")
def road_crossings(t: Tables) -> DataFrame:
    """Where the two roads of each named intersection cross, and whether the places are too far apart."""
    a, o = F.col("l_partkey"), F.col("l_orderkey")
    rows = t.lineitem.where("l_quantity <= 5").select(F.col("l_suppkey").alias("k"), F.when(F.col("l_linenumber") % 2 == 0, 1).otherwise(2).alias("road"), (a % 64 * 16.0).alias("ax"), (o % 64 * 16.0).alias("ay"), (a % 37 * 16.0).alias("bx"), (o % 41 * 16.0).alias("by"))
    return p.crossings(rows, "k").select("k", F.round("mx", 3).alias("mx"), F.round("my", 3).alias("my"), "n", "ambiguous")


@query("""WITH s AS (SELECT s_suppkey AS k, CASE WHEN s_suppkey % 7 <> 0 THEN s_suppkey % 40 END AS racks, CASE WHEN s_suppkey % 5 <> 0 THEN s_acctbal END AS spend, [0.08e0, 0.12e0, NULL][s_suppkey % 3 + 1] AS price, CASE WHEN s_suppkey % 6 <> 0 THEN s_suppkey * 8e0 END AS sqft FROM supplier), u AS (SELECT l_suppkey AS k, sum(CASE WHEN l_partkey % 3 = 0 THEN l_quantity * 1e0 END) AS kw FROM lineitem WHERE l_suppkey % 4 <> 0 GROUP BY 1)
    SELECT s.k, CASE WHEN kw > 0 THEN CAST(round_even(kw, 0) AS BIGINT) END AS generator_kw, CASE WHEN racks > 0 THEN round_even(racks * 1.74e0, 1) END AS rack_kw, CASE WHEN spend > 0 AND price > 0 THEN round_even(spend / price / 8760, 3) END AS average_kw, round_even(sqft * 0.1875e0 / 1000, 4) AS area_mw FROM s LEFT JOIN u USING (k)""")
def power_demand(t: Tables) -> DataFrame:
    """Generator kilowatts, rack load, average load from spend, and load from area."""
    k = F.col("s_suppkey")
    rows = t.supplier.select(k.alias("k"), F.when(k % 7 != 0, k % 40).alias("racks"), F.when(k % 5 != 0, F.col("s_acctbal")).alias("spend"), one((0.08, 0.12, None), k % 3).alias("price"), F.when(k % 6 != 0, k * 8.0).alias("square_feet"))
    units = t.lineitem.where("l_suppkey % 4 <> 0").select(F.col("l_suppkey").alias("k"), F.when(F.col("l_partkey") % 3 == 0, F.col("l_quantity") * 1.0).alias("kw"))
    return p.power_demand(rows, units, "k")


@query("""WITH w AS (SELECT DISTINCT l_suppkey * 3 AS id FROM lineitem) SELECT w.id, s_suppkey IS NOT NULL AS known FROM w LEFT JOIN supplier ON s_suppkey = w.id""")
def site_subset(t: Tables) -> DataFrame:
    """The sites that a run asks for, with those it does not know."""
    wanted = t.lineitem.select((F.col("l_suppkey") * 3).alias("id")).distinct()
    return wanted.join(t.supplier.select(F.col("s_suppkey").alias("id"), F.lit(True).alias("known")), "id", "left").fillna(False, ["known"])


@query("""WITH r AS (SELECT l_orderkey AS k, 'S' || l_suppkey % 6 || '-' || l_partkey AS panel, CAST(l_linenumber AS BIGINT) * 1000000000 + l_partkey AS ordinal, 'S' || l_orderkey % 6 AS county FROM lineitem), m AS (SELECT *, starts_with(panel, county) AS hit, bool_or(starts_with(panel, county)) OVER (PARTITION BY k) AS some_hit FROM r)
    SELECT k, count(*) AS kept, min(panel) AS first_panel FROM m WHERE hit OR NOT some_hit GROUP BY k""")
def county_panels(t: Tables) -> DataFrame:
    """Map panels of the county a site lies in, or all where none is its county's."""
    text = lambda c: F.concat(F.lit("S"), c.cast("string"))
    rows = t.lineitem.select(F.col("l_orderkey").alias("k"), F.concat(text(F.col("l_suppkey") % 6), F.lit("-"), F.col("l_partkey").cast("string")).alias("panel"), text(F.col("l_orderkey") % 6).alias("county"))
    return p.kept_or_all(rows, ["k"], F.col("panel").startswith(F.col("county"))).groupBy("k").agg(F.count("*").alias("kept"), F.min("panel").alias("first_panel"))


@query("""WITH l AS (SELECT o_custkey AS k, o_orderkey AS id, CASE WHEN o_orderkey % 6 <> 0 THEN (o_orderkey % 40) * 10e0 - 20 END AS kv, (o_orderkey * 7919 % 20000) * 1e0 AS d FROM orders), g AS (SELECT k, min(row(d, id)) AS a, min(row(d, id)) FILTER (kv >= 100) AS b, count(*) FILTER (kv > 0 AND kv < 100) AS under100, count(*) FILTER (kv >= 100) AS over100, count(*) FILTER (kv <= 0) AS unpublished, count(*) FILTER (kv IS NULL) AS blank,
        count(*) FILTER (kv >= 69 AND d <= 1000) AS kv69_1km, count(*) FILTER (kv >= 115 AND d <= 3000) AS kv115_3km, count(*) FILTER (kv >= 230 AND d <= 8000) AS kv230_8km, count(DISTINCT kv) AS voltages FROM l GROUP BY k)
    SELECT k, under100, over100, unpublished, blank, kv69_1km, kv115_3km, kv230_8km, voltages, coalesce(b[1] - a[1] > 50, false) AS high_is_farther, CASE WHEN kv IS NULL OR kv <= 0 THEN 'unpublished' WHEN kv < 100 THEN 'under 100' WHEN kv < 130 THEN '100-115' WHEN kv < 200 THEN '138-161' ELSE '230+' END AS tier FROM g JOIN (SELECT k AS k2, id, kv FROM l) x ON k2 = k AND x.id = a[2]""")
def voltage_profile(t: Tables) -> DataFrame:
    """Lines of each site by voltage and distance, whether its nearest high one is farther off, and the nearest's tier."""
    o = F.col("o_orderkey")
    rows = t.orders.select(F.col("o_custkey").alias("k"), o.alias("id"), F.when(o % 6 != 0, o % 40 * 10.0 - 20).alias("kv"), (o * 7919 % 20000 * 1.0).alias("d"))
    kv, d = F.col("kv"), F.col("d")
    near = lambda least, m: F.count_if((kv >= least) & (d <= m))
    best = rows.groupBy("k").agg(
        F.min(F.struct("d", "id", "kv")).alias("a"), F.min(F.when(kv >= 100, d)).alias("b"), F.count_if((kv > 0) & (kv < 100)).alias("under100"), F.count_if(kv >= 100).alias("over100"), F.count_if(kv <= 0).alias("unpublished"), F.count_if(kv.isNull()).alias("blank"),
        near(69, 1000).alias("kv69_1km"), near(115, 3000).alias("kv115_3km"), near(230, 8000).alias("kv230_8km"), F.count_distinct("kv").alias("voltages"),
    )
    v = F.col("a.kv")
    tier = F.when(v.isNull() | (v <= 0), "unpublished").when(v < 100, "under 100").when(v < 130, "100-115").when(v < 200, "138-161").otherwise("230+")
    return best.withColumns({"high_is_farther": F.coalesce(F.col("b") - F.col("a.d") > 50, F.lit(False)), "tier": tier}).drop("a", "b")


@query("""WITH z AS (SELECT l_suppkey AS k, CASE WHEN l_partkey % 4 = 0 THEN NULL ELSE 'Z' || l_partkey % 4 END AS zone, CASE WHEN l_partkey % 3 = 0 THEN 'FLOODWAY' END AS subtype, l_partkey % 2 = 0 AS sfha, l_quantity / 4e0 AS acres FROM lineitem)
    SELECT k, zone, subtype, sfha, round(sum(acres), 4) AS acres, round(100 * sum(acres) / sum(sum(acres)) OVER (PARTITION BY k), 4) AS pct FROM z GROUP BY k, zone, subtype, sfha""")
def zone_table(t: Tables) -> DataFrame:
    """Acres and shares of a site by zone, subtype and hazard flag; nulls are groups of their own."""
    a = F.col("l_partkey")
    rows = t.lineitem.select(F.col("l_suppkey").alias("k"), F.when(a % 4 != 0, F.concat(F.lit("Z"), (a % 4).cast("string"))).alias("zone"), F.when(a % 3 == 0, "FLOODWAY").alias("subtype"), (a % 2 == 0).alias("sfha"), (F.col("l_quantity") / 4.0).alias("acres"))
    grouped = rows.groupBy("k", "zone", "subtype", "sfha").agg(F.sum("acres").alias("acres"))
    whole = F.sum("acres").over(W.partitionBy("k"))  # a handful of zones a site
    return grouped.withColumns({"pct": F.round(100 * F.col("acres") / whole, 4), "acres": F.round("acres", 4)})


@query("""WITH s AS (SELECT event_id, user_id AS service, event_type AS layer, CASE WHEN event_id % 5 <> 0 THEN epoch_us(ts) END AS taken, (event_id * 13) % 70 - 40 AS points, event_type = 'error' AS archive FROM events),
    b AS (SELECT service, max(points) AS points, bool_or(archive) AS archive, arg_max(event_id, row(coalesce(taken, 0), -event_id)) AS latest, count(*) AS n FROM s GROUP BY service)
    SELECT service, 50 + points - CASE WHEN archive THEN 40 ELSE 0 END AS score, latest, CAST(n AS BIGINT) AS n, CASE service % 3 WHEN 0 THEN 'not public' WHEN 1 THEN 'no response' ELSE 'no public parcel service found' END AS reason FROM b""")
def service_probe(t: Tables) -> DataFrame:
    """A service scored by its best layer and not by their sum, its latest scene with none read as 0, and why it is unresolved."""
    e = F.col("event_id")
    taken = F.when(e % 5 != 0, F.unix_micros(F.col("ts").cast("timestamp")))
    best = t.events.groupBy(F.col("user_id").alias("service")).agg(F.max(e * 13 % 70 - 40).alias("points"), F.bool_or(F.col("event_type") == "error").alias("archive"), F.max(F.struct(F.coalesce(taken, F.lit(0)).alias("t"), (-e).alias("minus"))).alias("last"), F.count("*").alias("n"))
    why = t.spark.createDataFrame([(0, "not public"), (1, "no response")], "kind long, reason string")
    out = best.withColumn("kind", F.col("service") % 3).join(F.broadcast(why), "kind", "left")  # two rows
    return out.select("service", (50 + F.col("points") - F.when(F.col("archive"), 40).otherwise(0)).alias("score"), (-F.col("last.minus")).alias("latest"), "n", F.coalesce("reason", F.lit("no public parcel service found")).alias("reason"))


@query("""WITH u AS (SELECT s_nationkey AS k, 'public' AS kind, s_suppkey AS id, round(s_acctbal) AS size FROM supplier WHERE s_suppkey % 2 = 0 UNION ALL SELECT s_nationkey, 'private', s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE round(s_acctbal) END FROM supplier WHERE s_suppkey % 2 = 1 UNION ALL SELECT s_nationkey, 'public', s_suppkey, round(s_acctbal) FROM supplier WHERE s_suppkey % 4 = 0),
    d AS (SELECT DISTINCT k, kind, id, size FROM u) SELECT kind, id, size, place FROM (SELECT *, CAST(row_number() OVER (ORDER BY coalesce(size, 0) DESC, id, kind) AS INTEGER) AS place FROM d) WHERE place <= 28""")
def tagged_union_top(t: Tables) -> DataFrame:
    """Two layers as one with their kind, repeated features dropped, and the 28 largest, no size read as 0."""
    size = F.round("s_acctbal")
    side = lambda where, kind, value: t.supplier.where(where).select(F.lit(kind).alias("kind"), F.col("s_suppkey").alias("id"), value.alias("size"))
    both = side("s_suppkey % 2 = 0", "public", size).unionByName(side("s_suppkey % 2 = 1", "private", F.when(F.col("s_suppkey") % 3 != 0, size))).unionByName(side("s_suppkey % 4 = 0", "public", size)).dropDuplicates()
    top = both.orderBy(F.coalesce("size", F.lit(0)).desc(), "id", "kind").limit(28)  # the report is of 28
    return top.withColumn("place", F.row_number().over(W.orderBy(F.coalesce("size", F.lit(0)).desc(), "id", "kind")))


@query("""WITH c AS (SELECT o_custkey % 200 AS market, CASE o_orderkey % 5 WHEN 0 THEN NULL ELSE 'Carrier ' || o_orderkey % 5 END AS carrier, o_orderkey AS seen, o_orderstatus AS state FROM orders), f AS (SELECT market, carrier, min(seen) AS first FROM c WHERE carrier IS NOT NULL GROUP BY ALL)
    SELECT c.market, (SELECT string_agg(carrier, ', ' ORDER BY first) FROM f WHERE f.market = c.market) AS carriers, count(*) FILTER (state = 'F') AS quoted, count(*) FILTER (state = 'O') AS nearby, count(*) FILTER (state = 'P') AS unknown FROM c GROUP BY c.market""")
def carriers_by_market(t: Tables) -> DataFrame:
    """The carriers of each market in the order they are first seen, and counts by status."""
    o = F.col("o_orderkey")
    rows = t.orders.select((F.col("o_custkey") % 200).alias("market"), F.when(o % 5 != 0, F.concat(F.lit("Carrier "), (o % 5).cast("string"))).alias("carrier"), o.alias("at"), F.col("o_orderstatus").alias("state"))
    first = rows.where("carrier is not null").groupBy("market", "carrier").agg(F.min("at").alias("first"))
    listed = first.groupBy("market").agg(F.array_join(F.array_sort(F.collect_list(F.struct("first", "carrier")))["carrier"], ", ").alias("carriers"))  # a row a carrier
    counted = rows.groupBy("market").agg(*[F.count_if(F.col("state") == v).alias(n) for v, n in (("F", "quoted"), ("O", "nearby"), ("P", "unknown"))])
    return counted.join(listed, "market", "left").select("market", "carriers", "quoted", "nearby", "unknown")


@query("""WITH n AS (SELECT l_orderkey AS k, CAST(l_linenumber AS BIGINT) * 1000000000 + l_partkey * 10000 + l_suppkey AS ordinal, ['East Texas Sub', 'Westfield', 'NEW EAST', 'Road 7'][l_partkey % 4 + 1] AS name, l_suppkey * 7 % 1000 AS d, ['East Road Substation', 'new sub', 'Field'][l_orderkey % 3 + 1] AS asked FROM lineitem),
    h AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY d, ordinal) AS i FROM n WHERE asked = 'East Road Substation' AND name IN ('East Texas Sub', 'NEW EAST') OR asked = 'Field' AND name = 'Westfield')
    SELECT o.k, h.name, h.d AS metres FROM (SELECT DISTINCT k FROM n) o LEFT JOIN h ON h.k = o.k AND i = 1""")
def named_substation(t: Tables) -> DataFrame:
    """The nearest substation a word of whose name is a telling word of the one asked for."""
    a, o, s = F.col("l_partkey"), F.col("l_orderkey"), F.col("l_suppkey")
    rows = t.lineitem.select(o.alias("k"), (F.col("l_linenumber").cast("long") * 1000000000 + a * 10000 + s).alias("ordinal"), one(("East Texas Sub", "Westfield", "NEW EAST", "Road 7"), a % 4).alias("name"), (s * 7 % 1000).alias("d"), x.name_tokens(one(("East Road Substation", "new sub", "Field"), o % 3)).alias("tokens"))
    hit = F.exists("tokens", lambda w: F.contains(F.lower("name"), w))
    best = rows.groupBy("k").agg(F.min(F.when(hit, F.struct("d", "ordinal", "name"))).alias("b"))
    return best.select("k", F.col("b.name").alias("name"), F.col("b.d").alias("metres"))


@query("""WITH b AS (SELECT p_partkey AS k, ['Residential', 'Unclassified', 'Commercial', NULL][p_partkey % 4 + 1] AS occ, CASE p_partkey % 5 WHEN 0 THEN 0e0 WHEN 1 THEN NULL ELSE p_size * 80e0 END AS sqft, p_size * 60e0 AS area, p_partkey % 3 = 0 AS on_site, 'Owner ' || p_partkey % 9 AS owner, p_partkey * 50e0 AS span FROM part), c AS (SELECT *, CASE WHEN sqft > 0 THEN sqft ELSE area END AS size FROM b)
    SELECT k, coalesce(occ = 'Residential' AND size >= 600 OR occ = 'Unclassified' AND NOT on_site AND size BETWEEN 800 AND 2500, false) AS home, contains(lower(owner), 'owner 7') OR k % 100 = 12 AS probe_hit,
        (SELECT v FROM (SELECT unnest([25, 50, 100, 200, 250, 500, 1000, 1500, 2000, 2500, 3000, 4000]) AS v) ORDER BY abs(v - span * 0.2e0 / 0.3048e0), v LIMIT 1) AS scale_feet,
        span / 2 - greatest(span / 4 + 200, (span + 200) / 2e0) AS frame_west FROM c""")
def building_and_map_rules(t: Tables) -> DataFrame:
    """Which buildings are homes, whether a probe's owner pattern hits, and a map's scale bar and frame."""
    k, size = F.col("p_partkey"), F.col("p_size")
    home = r.counts_as_home(one(("Residential", "Unclassified", "Commercial", None), k % 4), F.when(k % 5 == 0, 0.0).when(k % 5 != 1, size * 80.0), size * 60.0, k % 3 == 0, 600, 800, 2500)
    hit = F.concat_ws(" ", F.concat(F.lit("Owner "), (k % 9).cast("string")), F.when(k % 100 == 12, "id-12")).rlike("(?i)owner 7|id-12")
    span = k * 50.0
    box = r.frame(F.lit(0.0), F.lit(0.0), span, span / 4, 100.0, 2.0)
    return t.part.select(k.alias("k"), home.alias("home"), hit.alias("probe_hit"), r.scale_feet(span).alias("scale_feet"), box["west"].alias("frame_west"))


@query("""WITH e AS (SELECT l_orderkey AS k, CAST(l_linenumber AS BIGINT) * 1000000000 + l_partkey * 10000 + l_suppkey AS ordinal, CASE WHEN l_partkey % 3 = 0 THEN 'mw_full' ELSE 'mw' END AS field, ['actual', 'target', 'range_high', 'estimate'][l_suppkey % 4 + 1] AS kind, l_quantity * 1e0 AS mw FROM lineitem),
    w AS (SELECT *, CASE WHEN field = 'mw' AND kind = 'actual' THEN 1 WHEN kind = 'actual' THEN 2 WHEN field = 'mw' AND kind = 'target' THEN 3 WHEN field = 'mw' AND kind = 'range_high' THEN 4 END AS rank FROM e), f AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY rank NULLS LAST, ordinal) AS n FROM w)
    SELECT k, CASE WHEN rank IS NOT NULL THEN mw END AS mw, CASE rank WHEN 1 THEN 'actual' WHEN 2 THEN 'actual' WHEN 3 THEN 'request' WHEN 4 THEN 'up_to' END AS kind FROM f WHERE n = 1""")
def headline_power(t: Tables) -> DataFrame:
    """The headline megawatts of each site's evidence and what kind of figure it is."""
    a, s = F.col("l_partkey"), F.col("l_suppkey")
    rows = t.lineitem.select(F.col("l_orderkey").alias("k"), (F.col("l_linenumber").cast("long") * 1000000000 + a * 10000 + s).alias("ordinal"), F.when(a % 3 == 0, "mw_full").otherwise("mw").alias("field"), one(("actual", "target", "range_high", "estimate"), s % 4).alias("kind"), (F.col("l_quantity") * 1.0).cast("string").alias("value"))
    return r.headline_mw(rows, "k", "ordinal")


@query("""WITH b AS (SELECT n_nationkey AS county, (n_nationkey % 5) * 10e0 AS x, (n_nationkey // 5) * 10e0 AS y FROM nation), s AS (SELECT s_suppkey AS site, (s_suppkey * 7 % 40) * 1e0 AS sx, (s_suppkey * 13 % 40) * 1e0 AS sy FROM supplier),
    o AS (SELECT site, county, greatest(0e0, least(x + 10, sx + 8) - greatest(x, sx)) * greatest(0e0, least(y + 10, sy + 8) - greatest(y, sy)) AS a FROM s, b) SELECT site, county, round(100 * a / 64, 4) AS pct FROM o WHERE a > 0""")
def county_shares(t: Tables) -> DataFrame:
    """The part of each site's box that lies in each county."""
    n, k = F.col("n_nationkey"), F.col("s_suppkey")
    counties = t.nation.select(n.alias("county"), (n % 5).cast("long").alias("i"), F.floor(n / 5).alias("j"))
    own = t.supplier.select(k.alias("site"), (k * 7 % 40 * 1.0).alias("sx"), (k * 13 % 40 * 1.0).alias("sy"))
    cells = own.withColumn("i", F.explode(F.sequence(F.floor(F.col("sx") / 10), F.floor((F.col("sx") + 8) / 10)))).withColumn("j", F.explode(F.sequence(F.floor(F.col("sy") / 10), F.floor((F.col("sy") + 8) / 10))))
    x0, y0, sx, sy = F.col("i") * 10.0, F.col("j") * 10.0, F.col("sx"), F.col("sy")
    area = box_overlap(x0, y0, x0 + 10, y0 + 10, sx, sy, sx + 8, sy + 8)
    return cells.join(counties, ["i", "j"]).withColumn("a", area).where("a > 0").select("site", "county", F.round(100 * F.col("a") / 64, 4).alias("pct"))


@query(f"WITH RECURSIVE {LINKS_SQL} SELECT component, count(*) AS homes, CASE WHEN count(*) >= 5 THEN 'neighbourhood' ELSE 'homes' END AS kind FROM grouped GROUP BY component")
def home_clusters(t: Tables) -> DataFrame:
    """Points joined by steps of at most the gap; five or more are a neighbourhood."""
    grouped = spatial.within_gap(suppliers(t), "point", GAP).groupBy("component").agg(F.count("*").alias("homes"))
    return grouped.withColumn("kind", F.when(F.col("homes") >= 5, "neighbourhood").otherwise("homes"))


@query("""WITH h AS (SELECT l_suppkey AS k, (l_partkey * 37 % 4000) * 1.0 + 0.3 AS x, (l_orderkey * 53 % 4000) * 1.0 + 0.3 AS y FROM lineitem) SELECT k, count(DISTINCT row(round(x / 25), round(y / 25))) AS cells, count(*) AS homes FROM h GROUP BY k""")
def receptor_cells(t: Tables) -> DataFrame:
    """Receptors snapped to a 25 m grid: how many circles their union needs."""
    rows = t.lineitem.select(F.col("l_suppkey").alias("k"), (F.col("l_partkey") * 37 % 4000 + 0.3).alias("x"), (F.col("l_orderkey") * 53 % 4000 + 0.3).alias("y"))
    snapped = rows.groupBy("k", F.bround(F.col("x") / 25).alias("i"), F.bround(F.col("y") / 25).alias("j")).agg(F.count("*").alias("n"))
    return snapped.groupBy("k").agg(F.count("*").alias("cells"), F.sum("n").alias("homes"))


@query("""WITH s AS (SELECT DISTINCT l_orderkey AS site, l_partkey % 13 AS dimension FROM lineitem WHERE l_quantity > 20), e AS (SELECT DISTINCT l_orderkey AS site, l_partkey % 13 AS dimension FROM lineitem WHERE l_discount > 0.05) SELECT site, dimension FROM s EXCEPT SELECT site, dimension FROM e""")
def evidence_coverage(t: Tables) -> DataFrame:
    """Dimensions that a site's text speaks of and no evidence row covers."""
    pairs = lambda where: t.lineitem.where(where).select(F.col("l_orderkey").alias("site"), (F.col("l_partkey") % 13).alias("dimension")).distinct()
    return pairs("l_quantity > 20").join(pairs("l_discount > 0.05"), ["site", "dimension"], "left_anti")


@query("""WITH b AS (SELECT s_suppkey AS k, s_suppkey % 11 <> 0 AS answered, CASE WHEN s_suppkey % 6 = 0 THEN 'OWNER' ELSE '' END AS gone, CASE WHEN s_suppkey % 4 = 0 THEN 0 WHEN s_suppkey % 7 = 0 THEN NULL ELSE s_suppkey * 100 END AS was, s_suppkey * 100 + (s_suppkey * 37 % 900) AS now, '20' || (10 + s_suppkey % 3) AS v0, '20' || (10 + s_suppkey % 5 % 3) AS v, CASE WHEN s_suppkey % 8 = 0 THEN 'Lines v2' ELSE 'Lines' END AS name, CASE WHEN s_suppkey % 9 = 0 THEN '2099' END AS up FROM supplier)
    SELECT k, CASE WHEN NOT answered THEN 'unreachable' ELSE concat_ws('; ', CASE WHEN gone <> '' THEN 'fields gone: ' || gone END, CASE WHEN was > 0 AND abs(now - was) > greatest(50e0, 0.05e0 * was) THEN 'records' END, CASE WHEN v0 <> v THEN 'vintage' END, CASE WHEN name <> 'Lines' THEN 'renamed' END, CASE WHEN up > v THEN 'newer release upstream' END) END AS flags FROM b""")
def drift_report(t: Tables) -> DataFrame:
    """What changed at each source against its baseline."""
    k = F.col("s_suppkey")
    year = lambda c: F.concat(F.lit("20"), (10 + c).cast("string"))
    flags = r.drift_flags(k % 11 != 0, F.when(k % 6 == 0, "OWNER").otherwise(""), F.when(k % 4 == 0, 0).when(k % 7 != 0, k * 100), k * 100 + k * 37 % 900, year(k % 3), year(k % 5 % 3), F.lit("Lines"), F.when(k % 8 == 0, "Lines v2").otherwise("Lines"), F.when(k % 9 == 0, "2099"))
    return t.supplier.select(k.alias("k"), flags.alias("flags"))

