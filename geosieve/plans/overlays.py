"""Exact overlays of footprints and zones, and lines of many parts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geosieve.functions import rules, text as x
from geosieve.operators import lines, parcels, planar
from geosieve.plans.registry import Tables, query
from geosieve.plans.spatial import HOLE, OUTLINE, PARTS, SITES, parts, sites

RANKS, FOOTPRINT_M = 5, 500.0
LABELS = ("AE floodway", "AE", "X 0.2%", "X levee", "X")


def _zone_rows(t: Tables, part: DataFrame) -> DataFrame:
    """A zone of each part, at the supplier it is dealt to."""
    count = t.supplier.agg(F.count("*").alias("n"))
    p = F.col("p_partkey").cast("long")
    return part.crossJoin(F.broadcast(count)).select((p % F.col("n") + 1).alias("site"), p.alias("shape"), (p % RANKS).cast("int").alias("rank"), (p * 7919 % 1201 - 600.0).alias("cx"), (p * 104729 % 1103 - 550.0).alias("cy"), (40.0 + 2.0 * F.col("p_size")).alias("r"))


def _ringed(rows: DataFrame) -> DataFrame:
    ring = lambda corners: F.array(*[F.struct((F.col("cx") + F.col("r") * a).alias("x"), (F.col("cy") + F.col("r") * b).alias("y")) for a, b in corners])
    return rows.withColumn("rings", F.array(ring(OUTLINE), ring(HOLE))).drop("cx", "cy", "r")


def outlines(t: Tables) -> DataFrame:
    """A footprint about each supplier and the zones of the parts dealt to it, with a hole each, in metres."""
    own = t.supplier.select(F.col("s_suppkey").cast("long").alias("site"), F.lit(0).cast("long").alias("shape"), F.lit(None).cast("int").alias("rank"), F.lit(0.0).alias("cx"), F.lit(0.0).alias("cy"), F.lit(FOOTPRINT_M).alias("r"))
    return _ringed(own.unionByName(_zone_rows(t, t.part)))


def zones(t: Tables) -> DataFrame:
    """The zones alone, dealt to as many tasks as are set: a file of few row groups is read by few, whatever work is on the rings."""
    part = t.part.select("p_partkey", "p_size").repartition(int(t.spark.conf.get("spark.sql.shuffle.partitions")), "p_partkey")
    return _ringed(_zone_rows(t, part))


def shapes(t: Tables) -> DataFrame:
    """Footprints and zones as edges."""
    return planar.ring_edges(outlines(t))


_EDGES = " UNION ALL ".join(
    f"SELECT site, shape, rank, cx + r * {a[0]}e0 AS x0, cy + r * {a[1]}e0 AS y0, cx + r * {b[0]}e0 AS x1, cy + r * {b[1]}e0 AS y1 FROM shapes"
    for ring in (OUTLINE, HOLE)
    for a, b in zip(ring, (*ring[1:], ring[0]))
)


def _trapezoids(zones: str) -> str:
    """SQL for trapezoids (site, depth of the footprint, depth of each rank, area) of edges e(site, shape, rank, x0, y0, x1, y1) of whole sites, without bands."""
    depth = lambda where: f"sum(CASE WHEN {where} THEN step ELSE 0 END) OVER o > 0"
    return f"""{zones}, e AS ({_EDGES}),
    l AS (SELECT site, shape, rank, CASE WHEN y0 < y1 THEN x0 ELSE x1 END AS ax, least(y0, y1) AS ay, greatest(y0, y1) AS b_y, (x1 - x0) / (y1 - y0) AS s FROM e WHERE y0 <> y1),
    crossed AS (SELECT p.site, (q.ax - p.ax + p.s * p.ay - q.s * q.ay) / (p.s - q.s) AS y, greatest(p.ay, q.ay) AS f, least(p.b_y, q.b_y) AS g FROM l p JOIN l q ON p.site = q.site AND p.s < q.s),
    ys AS (SELECT site, ay AS y FROM l UNION SELECT site, b_y FROM l UNION SELECT site, y FROM crossed WHERE y > f AND y < g),
    cuts AS (SELECT site, y AS lo, lead(y) OVER (PARTITION BY site ORDER BY y) AS hi FROM ys),
    a AS (SELECT l.site, shape, rank, s, lo, hi, ax + s * (lo - ay) AS xl, ax + s * (hi - ay) AS xh FROM l JOIN cuts ON l.site = cuts.site AND ay <= lo AND b_y >= hi),
    st AS (SELECT *, xl + xh AS m, CASE WHEN row_number() OVER (PARTITION BY site, lo, shape ORDER BY xl + xh, s) % 2 = 1 THEN 1 ELSE -1 END AS step FROM a),
    z AS (SELECT site, {depth("rank IS NULL")} AS held, {", ".join(f"{depth(f'rank = {r}')} AS d{r}" for r in range(RANKS))},
        (hi - lo) * (lead(xl) OVER o - xl + lead(xh) OVER o - xh) / 2 AS area FROM st WINDOW o AS (PARTITION BY site, lo ORDER BY m, shape, s))"""


_SHAPES = f"""shapes AS (SELECT s_suppkey AS site, 0 AS shape, NULL::INTEGER AS rank, 0e0 AS cx, 0e0 AS cy, {FOOTPRINT_M}e0 AS r FROM supplier
    UNION ALL SELECT p_partkey % (SELECT count(*) FROM supplier) + 1, p_partkey, p_partkey % {RANKS}, p_partkey * 7919 % 1201 - 600e0, p_partkey * 104729 % 1103 - 550e0, 40e0 + 2e0 * p_size FROM part)"""


@query(f"""WITH {_trapezoids(_SHAPES)},
    w AS (SELECT site, CAST(CASE {" ".join(f"WHEN d{r} THEN {r}" for r in range(RANKS))} END AS INTEGER) AS rank, area FROM z WHERE held AND area > 0),
    g AS (SELECT site, rank, sum(area) AS area FROM w GROUP BY ALL)
    SELECT site, rank, round(area, 2) AS area_m2, round(100 * area / sum(area) OVER (PARTITION BY site), 2) AS pct FROM g""")
def footprint_overlay(t: Tables) -> DataFrame:
    """Each footprint's ground by the most severe zone on it and the unmapped rest, exactly; shares add up to 100."""
    found = planar.overlay_areas(shapes(t), ["site"], RANKS)
    total = found.groupBy("site").agg(F.sum("area").alias("total"))
    return found.join(total, "site").select("site", "rank", F.round("area", 2).alias("area_m2"), F.round(100 * F.col("area") / F.col("total"), 2).alias("pct"))


@query(f"""WITH {_trapezoids(_SHAPES)},
    g AS (SELECT site, rank, sum(area) AS area FROM ({" UNION ALL ".join(f"SELECT site, {r} AS rank, area FROM z WHERE held AND d{r}" for r in range(RANKS))}) WHERE area > 0 GROUP BY ALL),
    f AS (SELECT site, sum(area) AS total, sum(CASE WHEN {" OR ".join(f"d{r}" for r in range(RANKS))} THEN area ELSE 0 END) AS mapped FROM z WHERE held GROUP BY site),
    b AS (SELECT site, string_agg({list(LABELS)}[rank + 1] || ' ' || format('{{:,.3f}}', area / 4046.8564224e0) || ' ac (' || format('{{:.1f}}', 100 * area / total) || '%)', '; ' ORDER BY area DESC) AS breakdown FROM g JOIN f USING (site) WHERE area / 4046.8564224e0 >= 0.0005e0 GROUP BY site)
    SELECT site, round(total / 4046.8564224e0, 3) AS acres, round(greatest(0, total - mapped) / 4046.8564224e0, 3) AS unmapped_acres, breakdown FROM f LEFT JOIN b USING (site)""")
def footprint_breakdown(t: Tables) -> DataFrame:
    """Each footprint's acres, its unmapped acres, and in words what each kind of zone covers of it, overlaps counted for both."""
    edges = shapes(t)
    label = F.element_at(F.array(*map(F.lit, LABELS)), F.col("rank") + 1)
    whole = planar.overlay_areas(edges, ["site"], None)
    acres = lambda where: F.round(F.coalesce(F.sum(F.when(where, F.col("area"))), F.lit(0.0)) / planar.ACRE_M2, 3)
    total = whole.groupBy("site").agg(acres(F.lit(True)).alias("acres"), acres(F.col("rank").isNull()).alias("unmapped_acres"), F.sum("area").alias("total"))
    groups = planar.group_areas(edges, ["site"], "rank").withColumn("zone", label)
    each = total.join(groups, "site", "left")
    return planar.breakdown(each, ["site", "acres", "unmapped_acres"], "zone", F.col("total"), every=True).select("site", "acres", "unmapped_acres", "breakdown")


TOUCH_M, GAP_M = 3.0, 20.0
#: Zones are up to 280 m wide: with cells of twice that size all are at one level and few are in several cells.
ZONE_CELL_M = 600.0


def _apart(px: str, py: str, ax: str, ay: str, bx: str, b_y: str) -> str:
    """SQL for the squared distance from a point to a segment of some length."""
    u = f"least(1e0, greatest(0e0, (({px} - {ax}) * ({bx} - {ax}) + ({py} - {ay}) * ({b_y} - {ay})) / (({bx} - {ax}) * ({bx} - {ax}) + ({b_y} - {ay}) * ({b_y} - {ay}))))"
    return f"(pow({ax} + {u} * ({bx} - {ax}) - {px}, 2) + pow({ay} + {u} * ({b_y} - {ay}) - {py}, 2))"


_P, _Q = (("p.x0", "p.y0", "p.x1", "p.y1"), ("q.x0", "q.y0", "q.x1", "q.y1"))
_SIDE = lambda s, x, y: f"(({s[2]} - {s[0]}) * ({y} - {s[1]}) - ({s[3]} - {s[1]}) * ({x} - {s[0]}))"
_APART_SQL = f"""{_SHAPES}, e AS ({_EDGES}), z AS (SELECT * FROM e WHERE rank IS NOT NULL),
    d AS (SELECT p.site, p.shape AS a, q.shape AS b, CASE WHEN {_SIDE(_P, "q.x0", "q.y0")} * {_SIDE(_P, "q.x1", "q.y1")} < 0 AND {_SIDE(_Q, "p.x0", "p.y0")} * {_SIDE(_Q, "p.x1", "p.y1")} < 0 THEN 0e0
        ELSE sqrt(least({", ".join(_apart(s[i], s[i + 1], *o) for s, o in ((_P, _Q), (_Q, _P)) for i in (0, 2))})) END AS d FROM z p JOIN z q ON p.site = q.site AND p.shape < q.shape),
    v AS (SELECT site, shape, min(row(x0, y0)) AS v FROM z GROUP BY ALL),
    i AS (SELECT v.site, least(v.shape, q.shape) AS a, greatest(v.shape, q.shape) AS b FROM v JOIN z q ON v.site = q.site AND v.shape <> q.shape
        WHERE (q.y0 > v[2]) <> (q.y1 > v[2]) AND v[1] < (q.x1 - q.x0) * (v[2] - q.y0) / (q.y1 - q.y0) + q.x0 GROUP BY v.site, v.shape, q.shape HAVING count(*) % 2 = 1),
    apart AS (SELECT site, a, b, min(d) AS apart_m FROM (SELECT * FROM d UNION ALL SELECT site, a, b, 0e0 FROM i) GROUP BY ALL)"""


@query(f"WITH {_APART_SQL} SELECT site, a, b, round(apart_m, 3) AS apart_m FROM apart WHERE apart_m <= {TOUCH_M}")
def parcel_adjacency(t: Tables) -> DataFrame:
    """The zones of a site that lie within 3 m of each other, edge to edge, each pair once."""
    return parcels.pairs_within(zones(t), "shape", TOUCH_M, ("site",), ZONE_CELL_M).withColumn("apart_m", F.round("apart_m", 3))


@query(f"""WITH RECURSIVE {_APART_SQL}, links AS (SELECT site, a, b FROM apart WHERE apart_m <= {GAP_M + parcels.DRAWN_M}),
    both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
    nodes AS (SELECT DISTINCT site, shape FROM z),
    reach AS (SELECT shape, shape AS other FROM nodes UNION SELECT reach.shape, both_ways.b FROM reach JOIN both_ways ON reach.other = both_ways.a)
    SELECT site, shape, min(other) AS component FROM nodes JOIN reach USING (shape) GROUP BY ALL""")
def parcel_groups(t: Tables) -> DataFrame:
    """The zones of a site grouped by steps of at most 20 m between their edges."""
    return parcels.grouped(zones(t), "shape", GAP_M, ("site",), ZONE_CELL_M).select("site", "shape", "component")


LINE_M = 15_000
#: The vertices of a line's parts, as steps in degrees from its point.
PARTS_OF = (((0.0, 0.0), (0.06, 0.05), (0.13, 0.02)), ((0.2, 0.0), (0.2, 0.0), (0.27, -0.06)))
#: Attributes of lines; Spark SQL and DuckDB read these alike.
ATTRIBUTES = {
    "voltage": "CASE WHEN size % 6 = 0 THEN NULL WHEN size % 6 = 1 THEN '-999999' ELSE CAST(size * 10 AS STRING) END",
    "volt_class": "CASE WHEN size % 6 = 0 THEN '100-161' WHEN size % 6 = 1 THEN 'NOT AVAILABLE' ELSE '220-287' END",
    "owner": "concat('O', feature % 40)", "kind": "CASE WHEN feature % 5 = 0 THEN 'DC; OVERHEAD' ELSE 'AC; OVERHEAD' END", "state": "CASE WHEN feature % 4 = 0 THEN 'NOT AVAILABLE' ELSE 'IN SERVICE' END",
    "sub_1": "CASE WHEN feature % 3 = 0 THEN 'UNKNOWN123' ELSE concat(' S', feature % 50) END", "sub_2": "CASE WHEN feature % 7 = 0 THEN '' ELSE concat('T', feature % 60, ' ') END", "inferred": "CASE WHEN feature % 2 = 0 THEN 'Y' ELSE 'N' END",
}
_SEGMENTS = " UNION ALL ".join(
    f"SELECT *, f_lng + {a[0]}e0 AS alng, f_lat + {a[1]}e0 AS alat, f_lng + {b[0]}e0 AS blng, f_lat + {b[1]}e0 AS blat FROM lines" for part in PARTS_OF for a, b in zip(part, part[1:])
)
_KNOWN = lambda c: f"CASE WHEN trim({c}) = '' OR upper(trim({c})) LIKE 'UNKNOWN%' OR upper(trim({c})) LIKE 'NOT AVAIL%' THEN NULL ELSE trim({c}) END"


@query(f"""WITH {SITES}, {PARTS}, attributed AS (SELECT *, {", ".join(f"{e} AS {n}" for n, e in ATTRIBUTES.items())} FROM parts),
    lines AS (SELECT *, CASE WHEN TRY_CAST(voltage AS DOUBLE) > 0 THEN TRY_CAST(voltage AS DOUBLE) END AS kv, concat_ws(' - ', {_KNOWN("sub_1")}, {_KNOWN("sub_2")}) AS named FROM attributed),
    segments AS ({_SEGMENTS}),
    ends AS (SELECT site, g.*, (alng - lng) * 111320e0 * cos(radians(lat)) AS ax, (alat - lat) * 110540e0 AS ay, (blng - lng) * 111320e0 * cos(radians(lat)) AS bx, (blat - lat) * 110540e0 AS b_y
        FROM sites JOIN segments g ON f_lat BETWEEN lat - 0.3 AND lat + 0.3 AND f_lng BETWEEN lng - 0.7 AND lng + 0.4),
    feet AS (SELECT *, CASE WHEN bx = ax AND b_y = ay THEN 0e0 ELSE least(1e0, greatest(0e0, -(ax * (bx - ax) + ay * (b_y - ay)) / ((bx - ax) * (bx - ax) + (b_y - ay) * (b_y - ay)))) END AS u FROM ends),
    far AS (SELECT *, CAST(round(sqrt((ax + u * (bx - ax)) * (ax + u * (bx - ax)) + (ay + u * (b_y - ay)) * (ay + u * (b_y - ay))) * 1000) AS BIGINT) AS d_mm FROM feet),
    near AS (SELECT * FROM far WHERE d_mm <= {LINE_M * 1000}),
    best AS (SELECT site, min(row(d_mm, feature)) AS b, min(row(d_mm, feature)) FILTER (kv >= 100) AS h FROM near GROUP BY site)
    SELECT sites.site, (b[1] + 50) // 100 / 10e0 AS tx_nearest_m, CAST(round(b[1] * 3.28084e0 / 1000) AS BIGINT) AS tx_nearest_ft, x.kv AS tx_voltage_kv, x.volt_class AS tx_volt_class,
        CASE WHEN b IS NULL THEN NULL WHEN x.kv IS NOT NULL THEN 'numeric' WHEN x.volt_class <> '' AND x.volt_class NOT LIKE 'NOT AVAIL%' THEN 'class_band' ELSE 'not_published' END AS tx_voltage_basis,
        x.named AS tx_line_name, x.feature AS tx_line_id, x.owner AS tx_owner, x.kind AS tx_type, x.state AS tx_status, x.inferred AS tx_attrs_inferred,
        (h[1] + 50) // 100 / 10e0 AS tx_100kv_nearest_m, y.kv AS tx_100kv_voltage_kv, y.named AS tx_100kv_line_name, y.feature AS tx_100kv_line_id, y.owner AS tx_100kv_owner,
        CASE WHEN b IS NULL THEN 'absent' ELSE 'ok' END AS status, CASE WHEN h IS NULL THEN 'absent' ELSE 'ok' END AS status_100kv
    FROM sites LEFT JOIN best USING (site) LEFT JOIN lines x ON x.feature = b[2] LEFT JOIN lines y ON y.feature = h[2]""")
def transmission_lines(t: Tables) -> DataFrame:
    """The nearest line of many parts, and the nearest one of at least 100 kV, with what is known of each: all sixteen fields."""
    vertex = lambda v: F.struct((F.col("f_lng") + F.lit(v[0])).alias("lng"), (F.col("f_lat") + F.lit(v[1])).alias("lat"))
    # Lines are dealt to as many tasks as are set: a file of few row groups is read by few.
    made = parts(t).repartition(int(t.spark.conf.get("spark.sql.shuffle.partitions")), "feature").withColumns({n: F.expr(e) for n, e in ATTRIBUTES.items()})
    volts = rules.kilovolts(F.col("voltage"), F.col("volt_class"))
    made = made.select("feature", "volt_class", "owner", "kind", "state", "inferred", volts["kv"].alias("kv"), volts["basis"].alias("basis"), x.circuit_name(F.col("sub_1"), F.col("sub_2")).alias("named"), F.array(*[F.array(*map(vertex, p)) for p in PARTS_OF]).alias("parts"))
    carried = ["kv", "basis", "named", "volt_class", "owner", "kind", "state", "inferred"]
    found = lines.nearest_lines(sites(t), lines.segments(made), "site", "feature", LINE_M, {"b": None, "h": F.col("kv") >= 100}, carried)
    tenth = lambda c: F.floor((F.col(f"{c}.d_mm") + 50) / 100) / F.lit(10.0)
    status = lambda c: F.when(F.col(c).isNull(), "absent").otherwise("ok")
    own = {"voltage_kv": "kv", "volt_class": "volt_class", "voltage_basis": "basis", "line_name": "named", "line_id": "feature", "owner": "owner", "type": "kind", "status": "state", "attrs_inferred": "inferred"}
    return found.select(
        "site", tenth("b").alias("tx_nearest_m"), F.round(F.col("b.d_mm") * 3.28084 / 1000).cast("long").alias("tx_nearest_ft"), *[F.col(f"b.{c}").alias(f"tx_{f}") for f, c in own.items()],
        tenth("h").alias("tx_100kv_nearest_m"), *[F.col(f"h.{own[f]}").alias(f"tx_100kv_{f}") for f in ("voltage_kv", "line_name", "line_id", "owner")], status("b").alias("status"), status("h").alias("status_100kv"),
    )
