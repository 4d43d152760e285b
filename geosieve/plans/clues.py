"""Sites located from raw words: clues and local layers are made from the customers' keys and places."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geosieve.functions import geo
from geosieve.operators.clues import Gazetteer, resolve
from geosieve.plans.registry import Tables, query
from geosieve.plans.spatial import SITES, sites

#: High and wide in degrees of the boxes that stand for counties and ZIP areas.
COUNTY, ZIP = (2.0, 3.0), (0.5, 0.5)


def boxes(at: DataFrame, name: str, size: tuple[float, float]) -> DataFrame:
    """The boxes of a lattice that hold any of the sites, as areas of a gazetteer."""
    i, j = F.floor((F.col("lat") - 25) / size[0]), F.floor((F.col("lng") + 124) / size[1])
    area = at.select(i.alias("i"), j.alias("j")).distinct()
    side = {"south": 25 + F.col("i") * F.lit(size[0]), "west": -124 + F.col("j") * F.lit(size[1])}
    area = area.withColumns({**side, "area": F.concat(F.lit(name), F.col("i").cast("string"), F.lit("_"), F.col("j").cast("string"))})
    area = area.withColumns({"north": F.col("south") + size[0], "east": F.col("west") + size[1], "lat": F.col("south") + size[0] / 2, "lng": F.col("west") + size[1] / 2, "radius_m": F.lit(size[0] * 50_000.0)})
    corner = lambda a, b: F.struct(F.col(a).alias("lat"), F.col(b).alias("lng"))
    ring = F.array(corner("south", "west"), corner("north", "west"), corner("north", "east"), corner("south", "east"))
    return area.withColumn("edges", geo.polygon_edges(ring, F.slice(F.array(ring), 1, 0))).drop("i", "j")


def layers(t: Tables) -> Gazetteer:
    """Local layers: a parcel, an address, a substation, a landmark and two roads at every customer's place."""
    k = F.col("site")
    text = lambda a, c, b="": F.concat(F.lit(a), c.cast("string"), F.lit(b))
    # Off the lattice of a thousandth of a degree, so that none lies on a border.
    at = sites(t).withColumns({"lat": F.col("lat") + F.lit(0.0004), "lng": F.col("lng") + F.lit(0.0004)})
    own = at.withColumn("county", F.concat(F.lit("County "), F.floor((F.col("lat") - 25) / COUNTY[0]).cast("string"), F.lit("_"), F.floor((F.col("lng") + 124) / COUNTY[1]).cast("string")))
    line = lambda name, dy, dx: own.select(name.alias("name"), *[(F.col(c) + F.lit(s * d)).alias(f"{e}_{c}") for e, s in (("a", -1), ("b", 1)) for c, d in (("lat", dy), ("lng", dx))])
    return Gazetteer(
        parcels=own.select(text("A", k % 400).alias("apn"), "county", "lat", "lng"),
        addresses=own.select(k.alias("place"), F.concat(text("", k % 90 + 1), text(" Ash", k % 30, " Road, Town")).alias("address"), "lat", "lng"),
        substations=own.select(k.alias("place"), text("Mill ", k % 700, " East").alias("name"), "county", "lat", "lng"),
        landmarks=own.select(k.alias("place"), text("Old Hall ", k % 500, ".").alias("name"), "lat", "lng"),
        roads=line(text("Row ", k % 20), 0.0, 0.1).union(line(text("Lane ", k % 20), 0.1, 0.0)),
        counties=boxes(at, "County ", COUNTY),
        zips=boxes(at, "Z", ZIP),
    )


def clues(t: Tables) -> DataFrame:
    """A county and a ZIP of most customers, and a clue an order about its customer's place or another's."""
    s, k = F.col("site"), F.col("k")
    cell = lambda a, size: F.concat(F.lit(a), F.floor((F.col("lat") - 25) / size[0]).cast("string"), F.lit("_"), F.floor((F.col("lng") + 124) / size[1]).cast("string"))
    own = sites(t)
    areas = own.where(s % 5 != 0).select((s * 10).alias("clue"), "site", F.lit("county").alias("clue_type"), F.lower(cell("County ", COUNTY)).alias("value"))
    areas = areas.union(own.where(s % 4 != 0).select((s * 10 + 1).alias("clue"), "site", F.lit("zip"), cell("Z", ZIP)))
    rows = t.orders.select(F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("site")).join(own, "site")
    who = F.when(k % 3 == 0, k % 1000 + 1).otherwise(s)
    put = lambda f, *xs: F.format_string(f, *xs)
    kinds = [
        ("apn", put("A%d", who % 400)), ("coordinate", F.concat((F.col("lat") + F.lit(0.0013)).cast("decimal(9,4)").cast("string"), F.lit(", "), (F.col("lng") + F.lit(0.0004)).cast("decimal(9,4)").cast("string"))),
        ("street_address", put("%d ash%d Rd, Elsewhere", who % 90 + 1, who % 30)), ("substation_name", put("mill %d e", who % 700)), ("intersection", put("Row %d & Lane %d, Town", who % 20, who % 20)),
        ("landmark", put("hall %d.", who % 500)), ("owner_name", F.lit("Smith")), ("coordinate_approx", F.lit("near the river")),
    ]
    kind, value = F.lit(None).cast("string"), F.lit(None).cast("string")
    for n, (name, v) in enumerate(kinds):
        kind, value = F.when(k % 11 == n, name).otherwise(kind), F.when(k % 11 == n, v).otherwise(value)
    return areas.union(rows.select((k + 1_000_000_000_000).alias("clue"), "site", kind.alias("clue_type"), value.alias("value")))


_CELL = lambda a, lat, lng, size: f"'{a}' || CAST(floor(({lat} - 25) / {size[0]}e0) AS BIGINT) || '_' || CAST(floor(({lng} + 124) / {size[1]}e0) AS BIGINT)"
_KIND = "CASE k % 11 WHEN 0 THEN 'apn' WHEN 1 THEN 'coordinate' WHEN 2 THEN 'street_address' WHEN 3 THEN 'substation_name' WHEN 4 THEN 'intersection' WHEN 5 THEN 'landmark' WHEN 6 THEN 'owner_name' WHEN 7 THEN 'coordinate_approx' END"


@query(f"""WITH {SITES}, own AS (SELECT site AS place, lat + 4e-4 AS lat, lng + 4e-4 AS lng, {_CELL("county ", "lat + 4e-4", "lng + 4e-4", COUNTY)} AS county, {_CELL("Z", "lat + 4e-4", "lng + 4e-4", ZIP)} AS zip FROM sites),
    said AS (SELECT *, CASE WHEN site % 5 <> 0 THEN {_CELL("county ", "lat", "lng", COUNTY)} END AS county, CASE WHEN site % 4 <> 0 THEN {_CELL("Z", "lat", "lng", ZIP)} END AS zip FROM sites),
    q AS (SELECT o_orderkey AS k, s.*, {_KIND.replace("k %", "o_orderkey %")} AS kind, CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey % 1000 + 1 ELSE site END AS who FROM orders JOIN said s ON s.site = o_custkey),
    apn AS (SELECT k, count(p.place) AS n, min(row(p.lat, p.lng)) AS spot FROM q LEFT JOIN own p ON p.place % 400 = who % 400 AND p.county = q.county WHERE kind = 'apn' GROUP BY k, q.county),
    addr AS (SELECT k, count(*) AS n, min(row(p.place, p.lat, p.lng)) AS spot FROM q JOIN own p ON p.place % 90 = who % 90 WHERE kind = 'street_address' GROUP BY k),
    subs AS (SELECT k, count(*) AS n, count(*) FILTER (p.county = q.county) AS n_in, min(row(p.place, p.lat, p.lng)) AS any_, min(row(p.place, p.lat, p.lng)) FILTER (p.county = q.county) AS own_,
        count(DISTINCT row(round(p.lat, 3), round(p.lng, 3))) FILTER (p.county = q.county) AS spots FROM q JOIN own p ON contains(upper('Mill ' || p.place % 700 || ' East'), upper('mill ' || who % 700 || ' e')) WHERE kind = 'substation_name' GROUP BY k),
    mark AS (SELECT k, count(*) AS n, min(row(p.place, p.lat, p.lng)) AS spot FROM q JOIN own p ON contains(upper('Old Hall ' || p.place % 500 || '.'), upper('hall ' || who % 500 || '.')) WHERE kind = 'landmark' GROUP BY k),
    z AS (SELECT DISTINCT zip, 25 + floor((lat - 25) / 0.5e0) * 0.5e0 AS south, -124 + floor((lng + 124) / 0.5e0) * 0.5e0 AS west FROM own),
    met AS (SELECT k, r.lat AS y, c.lng AS x, z.south + 0.25e0 AS zy FROM q JOIN z ON z.zip = q.zip JOIN own r ON r.place % 20 = who % 20 AND r.lat BETWEEN south AND south + 0.5e0 AND r.lng BETWEEN west - 0.1e0 AND west + 0.6e0
        JOIN own c ON c.place % 20 = who % 20 AND c.lng BETWEEN west AND west + 0.5e0 AND c.lat BETWEEN south - 0.1e0 AND south + 0.6e0 WHERE kind = 'intersection' AND abs(r.lat - c.lat) <= 0.1e0 AND abs(r.lng - c.lng) <= 0.1e0),
    mid AS (SELECT k, avg(y) AS y, avg(x) AS x FROM met GROUP BY k),
    cross_ AS (SELECT k, any_value(mid.y) AS y, any_value(mid.x) AS x, max(sqrt(pow((met.y - mid.y) * 110540e0, 2) + pow((met.x - mid.x) * 111320e0 * cos(radians(zy)), 2))) AS spread FROM met JOIN mid USING (k) GROUP BY k),
    pts AS (SELECT k, 1 AS tier, 0 AS ord, CASE WHEN n = 1 THEN spot[1] END AS y, spot[2] AS x FROM apn UNION ALL SELECT k, 2, 1, CAST(CAST(lat + 0.0013e0 AS DECIMAL(9,4)) AS DOUBLE), CAST(CAST(lng + 4e-4 AS DECIMAL(9,4)) AS DOUBLE) FROM q WHERE kind = 'coordinate'
        UNION ALL SELECT k, 2, 3, spot[2], spot[3] FROM addr UNION ALL SELECT k, 3, 4, CASE WHEN n_in = 0 AND n = 1 THEN any_[2] WHEN n_in = 1 OR spots = 1 THEN own_[2] END, CASE WHEN n_in > 0 THEN own_[3] ELSE any_[3] END FROM subs
        UNION ALL SELECT k, 3, 5, CASE WHEN spread <= 500 THEN y END, x FROM cross_ UNION ALL SELECT k, 3, 6, spot[2], spot[3] FROM mark),
    held AS (SELECT q.site, q.k, q.county, tier, ord, y, x, {_CELL("county ", "y", "x", COUNTY)} AS got, 25 + CAST(split_part(substr(q.county, 8), '_', 1) AS INT) * 2e0 AS cs, -124 + CAST(split_part(substr(q.county, 8), '_', 2) AS INT) * 3e0 AS cw FROM q JOIN pts USING (k) WHERE y IS NOT NULL),
    ok AS (SELECT *, county IS NULL OR (got = county AND EXISTS (SELECT 1 FROM own WHERE own.county = got)) OR (tier = 3 AND sqrt(pow(greatest(cs - y, y - cs - 2, 0) * 110540e0, 2) + pow(greatest(cw - x, x - cw - 3, 0) * 111320e0 * cos(radians(y)), 2)) <= 2000) AS ok FROM held),
    areas AS (SELECT s.site, 4 AS tier, 7 AS ord, s.site * 10 + 1 AS clue, south + 0.25e0 AS y, west + 0.25e0 AS x FROM said s JOIN z ON z.zip = s.zip UNION ALL
        SELECT s.site, 5, 8, s.site * 10, 26 + floor((s.lat - 25) / 2) * 2e0, -122.5e0 + floor((s.lng + 124) / 3) * 3e0 FROM said s WHERE s.county IN (SELECT county FROM own)),
    alls AS (SELECT site, tier, ord, k + 1000000000000 AS clue, y, x FROM ok WHERE ok UNION ALL SELECT * FROM areas),
    best AS (SELECT * FROM alls QUALIFY row_number() OVER (PARTITION BY site ORDER BY tier, ord, clue) = 1), rej AS (SELECT site, count(*) AS n FROM ok WHERE NOT ok GROUP BY site),
    oth AS (SELECT a.site, count(*) AS n FROM alls a JOIN best b ON a.site = b.site AND a.clue <> b.clue WHERE a.tier < 4 GROUP BY a.site),
    everyone AS (SELECT site FROM said WHERE county IS NOT NULL OR zip IS NOT NULL UNION SELECT site FROM q WHERE kind IS NOT NULL)
    SELECT e.site, 'L' || b.tier AS tier, b.clue, round(b.y, 5) AS lat, round(b.x, 5) AS lng, coalesce(rej.n, 0) AS rejected, coalesce(oth.n, 0) AS others FROM everyone e LEFT JOIN best b ON b.site = e.site LEFT JOIN rej ON rej.site = e.site LEFT JOIN oth ON oth.site = e.site""")
def sites_from_clues(t: Tables) -> DataFrame:
    """Each site's best place from raw words of parcels, coordinates, addresses, substations, crossings, landmarks, ZIPs and counties."""
    out = resolve(clues(t), layers(t))
    return out.select("site", "tier", "clue", F.round("lat", 5).alias("lat"), F.round("lng", 5).alias("lng"), "rejected", "others")
