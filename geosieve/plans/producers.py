"""Producer queries: each Spec over customers as sites and parts as features, with SQL made from the same Spec."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geosieve.functions.status import to_wide
from geosieve.operators.overlay import zone_shares
from geosieve.operators.producers import Near, Ring, Spec, footprint_basis, parcel_stages, screen_features, serving
from geosieve.operators.raster import measure_usable
from geosieve.operators.tiles import measure_tiles
from geosieve.plans.registry import Tables, query
from geosieve.plans.spatial import PARTS, SITES, far, parts, sites

HALF_MILE, MILE = 804.672, 1609.344
#: Attributes that parts get as features: Spark SQL and DuckDB read these alike.
ATTRIBUTES = {
    "name": "concat('F', feature)", "city": "concat('C', feature % 100)", "kind": "CASE WHEN feature % 2 = 0 THEN 'public' ELSE 'private' END",
    "kv": "CASE WHEN size % 6 <> 0 THEN size * 10 END", "networks": "size", "pop": "size * 40000", "line_count": "size % 7", "active": "feature % 3 <> 0",
}


def _line(prefix: str, where: str | None = None) -> Near:
    named = {"voltage_kv": "kv", "line_name": "name", "line_id": "feature", "owner": "city"}
    return Near({f"{prefix}nearest_m": "distance"} | {prefix + f: c for f, c in named.items()}, where)


#: Field names and radii of the producers.
SPECS = (
    Spec("transmission", 15_000, (_line("tx_"), _line("tx_100kv_", "kv >= 100")), decimals=1, all_absent=True),
    Spec(
        "substations",
        15_000,
        (
            Near({"sub_nearest_m": "distance", "sub_nearest_name": "name", "sub_max_kv": "kv", "sub_lines": "line_count", "sub_id": "feature"}),
            Near({"sub_100kv_nearest_m": "distance", "sub_100kv_nearest_name": "name", "sub_100kv_max_kv": "kv", "sub_100kv_lines": "line_count"}, "kv >= 100"),
            Near({"sub_230kv_nearest_m": "distance", "sub_230kv_nearest_name": "name", "sub_230kv_max_kv": "kv"}, "kv >= 230"),
        ),
        (Ring("sub_count_within_10km", 10_000), Ring("sub_max_kv_within_10km", 10_000, what="max", column="kv")),
        decimals=1,
        all_absent=True,
    ),
    Spec(
        "datacenter",
        50_000,
        (Near({"dc_nearest_m": "distance", "dc_name": "name", "dc_city": "city", "dc_networks": "networks"}), Near({"dc_hub_nearest_m": "distance", "dc_hub_name": "name", "dc_hub_networks": "networks"}, "networks >= 20")),
        (Ring("dc_count_within_25km", 25_000), Ring("dc_count_within_50km", 50_000), Ring("dc_max_networks_within_50km", 50_000, what="max", column="networks")),
    ),
    Spec("metro", 50_000, (Near({"metro_250k_nearest_name": "name", "metro_250k_nearest_m": "distance", "metro_250k_pop": "pop"}, "pop >= 250000"), Near({"metro_1m_nearest_name": "name", "metro_1m_nearest_m": "distance", "metro_1m_pop": "pop"}, "pop >= 1000000"))),
    Spec(
        "schools",
        5_000,
        (Near({"school_nearest_m": "distance", "school_nearest_name": "name", "school_nearest_type": "kind", "school_nearest_city": "city"}),),
        (Ring("schools_within_0_5mi", HALF_MILE), Ring("schools_within_1mi", MILE), Ring("public_schools_within_1mi", MILE, "kind = 'public'"), Ring("private_schools_within_1mi", MILE, "kind = 'private'")),
    ),
    Spec("worship", 5_000, (Near({"worship_nearest_m": "distance", "worship_nearest_name": "name", "worship_nearest_city": "city"}),), (Ring("worship_within_0_5mi", HALF_MILE), Ring("worship_within_1mi", MILE))),
    Spec("healthcare", 5_000, (Near({"nursing_home_nearest_m": "distance", "nursing_home_nearest_name": "name", "nursing_home_beds": "size"}),), (Ring("nursing_homes_within_0_5mi", HALF_MILE), Ring("nursing_homes_within_1mi", MILE))),
    Spec("hospitals", 5_000, (Near({"hospital_nearest_m": "distance", "hospital_nearest_name": "name", "hospital_type": "kind"}),), (Ring("hospitals_within_1mi", MILE),)),
    Spec("superfund", 5_000, (Near({"npl_nearest_m": "distance", "npl_nearest_name": "name"}),), (Ring("npl_active_within_1mi", MILE, "active"), Ring("npl_deleted_within_half_mi", HALF_MILE, "NOT active")), decimals=1),
    Spec("housing", MILE, (), (Ring("hu_within_0_5mi", HALF_MILE, what="sum", column="size"), Ring("hu_within_1mi", MILE, what="sum", column="size"), Ring("pop_within_1mi", MILE, what="sum", column="pop"), Ring("blocks_within_1mi", MILE))),
    Spec("homes", 2_000, (Near({"home_nearest_m": "distance", "home_nearest_class": "kind"}, "size >= 5"),), (Ring("homes_within_review", 300, "size >= 5"), Ring("homes_within_pass", 1_000, "size >= 5")), decimals=1),
    Spec("sensitive", 5_000, (Near({"sensitive_nearest_m": "distance", "sensitive_nearest_name": "name", "sensitive_nearest_kind": "kind"}),), (Ring("sensitive_within_review", 500), Ring("sensitive_within_pass", 2_000))),
)


def features(t: Tables) -> DataFrame:
    return parts(t).withColumns({n: F.expr(e) for n, e in ATTRIBUTES.items()})


def sql_of(spec: Spec) -> str:
    """DuckDB SQL for the long records of a Spec."""
    metre = f"round_even(best.d_mm / 1000e0, {spec.decimals})" if spec.decimals else "CAST(round_even(best.d_mm / 1000e0, 0) AS BIGINT)"
    ctes, selects = [], []
    for i, n in enumerate(spec.near):
        ctes.append(f"near{i} AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY site ORDER BY d_mm, feature) AS k FROM pairs WHERE {n.where or 'true'}) WHERE k = 1)")
        for f, c in n.fields.items():
            value = metre if c == "distance" else f"best.{c}"
            selects.append(f"SELECT sites.site, '{f}' AS field, CASE WHEN best.site IS NULL THEN 'absent' ELSE 'ok' END AS status, CAST({value} AS VARCHAR) AS value FROM sites LEFT JOIN near{i} best USING (site)")
    made = {"count": "count(*) FILTER ({w})", "sum": "coalesce(CAST(sum({c}) FILTER ({w}) AS BIGINT), 0)", "max": "max({c}) FILTER ({w})"}
    for r in spec.rings:
        x = made[r.what].format(w=f"pairs.site IS NOT NULL AND d_mm <= {int(r.within_m * 1000)} AND {r.where or 'true'}", c=r.column)
        gone = " OR ".join([*["count(pairs.site) = 0"] * spec.all_absent, *[f"{x} IS NULL"] * (r.what == "max"), "false"])
        selects.append(f"SELECT sites.site, '{r.field}' AS field, CASE WHEN {gone} THEN 'absent' ELSE 'ok' END AS status, CASE WHEN {gone} THEN NULL ELSE CAST({x} AS VARCHAR) END AS value FROM sites LEFT JOIN pairs ON pairs.site = sites.site GROUP BY sites.site")
    added = ", ".join(f"{e} AS {n}" for n, e in ATTRIBUTES.items())
    near = f"{far('s', 'f')} AS d_mm FROM sites s JOIN features f ON f.f_lat BETWEEN s.lat - 0.5 AND s.lat + 0.5 AND f.f_lng BETWEEN s.lng - 1 AND s.lng + 1"
    head = f"WITH {SITES}, {PARTS}, features AS (SELECT *, {added} FROM parts), pairs AS (SELECT * FROM (SELECT s.site, f.*, {near}) WHERE d_mm <= {int(spec.radius_m * 1000)})"
    return f"{', '.join([head, *ctes])} {' UNION ALL '.join(selects)}"


def _register(spec: Spec) -> None:
    def run(t: Tables) -> DataFrame:
        return screen_features(sites(t), "site", features(t), "feature", [spec]).select("site", "field", "status", "value")

    run.__name__ = f"producer_{spec.name}"
    query(sql_of(spec))(run)


for _spec in SPECS:
    _register(_spec)


def screened(t: Tables) -> DataFrame:
    """The records of all Specs, those of about one radius from one range join."""
    return screen_features(sites(t), "site", features(t), "feature", list(SPECS))


ALL_SQL = " UNION ALL ".join(f"SELECT site, field, status, value FROM ({sql_of(s)})" for s in SPECS)


@query(f"SELECT field, status, count(*) AS n FROM ({ALL_SQL}) GROUP BY ALL")
def screening_tally(t: Tables) -> DataFrame:
    """How many sites have each field ok or absent, over all producers."""
    return screened(t).groupBy("field", "status").agg(F.count("*").alias("n"))


WIDE = ("tx_nearest_m", "sub_100kv_nearest_m", "dc_hub_nearest_m", "metro_1m_nearest_name", "schools_within_1mi", "hu_within_1mi", "npl_nearest_m", "home_nearest_m")


@query(f"SELECT site, {', '.join(f"max(value) FILTER (field = '{f}') AS {f}" for f in WIDE)} FROM ({ALL_SQL}) GROUP BY site")
def screening_wide(t: Tables) -> DataFrame:
    """The wide site table of some fields of all producers."""
    return to_wide(screened(t).where(F.col("field").isin(*WIDE)), "site", list(WIDE))


@query("""WITH h AS (SELECT l_orderkey AS site, CAST(l_linenumber AS BIGINT) * 1000000 + l_suppkey AS ordinal, 'U' || l_suppkey AS name, l_suppkey % 7 = 0 AS federal, l_partkey % 3 <> 0 AS sales, l_partkey % 2 = 0 AS residential, CAST(l_quantity AS BIGINT) AS area FROM lineitem),
    b AS (SELECT *, row_number() OVER (PARTITION BY site ORDER BY CASE WHEN federal OR NOT sales THEN 1 ELSE 0 END, CASE WHEN residential THEN 0 ELSE 1 END, area, ordinal) AS k FROM h)
    SELECT site, name AS utility_name, coalesce((SELECT string_agg(DISTINCT o.name, '; ' ORDER BY o.name) FROM h o WHERE o.site = b.site AND o.name <> b.name), '') AS utility_others_at_pin, federal OR NOT sales AS only_set_aside FROM b WHERE k = 1""")
def serving_utility(t: Tables) -> DataFrame:
    """The serving utility of overlapping territories, by our own rule."""
    hits = t.lineitem.select(
        F.col("l_orderkey").alias("site"), (F.col("l_linenumber").cast("long") * 1000000 + F.col("l_suppkey")).alias("ordinal"), F.concat(F.lit("U"), "l_suppkey").alias("name"), (F.col("l_suppkey") % 7 == 0).alias("federal"),
        (F.col("l_partkey") % 3 != 0).alias("industrial_sales"), (F.col("l_partkey") % 2 == 0).alias("residential"), F.col("l_quantity").cast("long").alias("area"),
    )
    return serving(hits, "site", "ordinal")


@query("""WITH b AS (SELECT c_custkey AS site, CASE WHEN c_custkey % 19 = 0 THEN 'county_failed' WHEN c_custkey % 17 = 0 THEN 'no_county' WHEN c_custkey % 5 = 0 THEN 'unresolved: no registered service' WHEN c_custkey % 13 = 0 THEN 'parcel_failed' WHEN c_custkey % 4 = 0 THEN 'unresolved: no polygon at the point' ELSE 'ok' END AS parcel_status FROM customer)
    SELECT site, parcel_status, CASE WHEN site % 23 = 0 THEN 'intake outline' WHEN parcel_status IN ('county_failed', 'parcel_failed') THEN 'failed' WHEN parcel_status = 'ok' AND site % 6 <> 1 THEN 'parcel boundary' ELSE 'square' END AS fp_basis,
        CASE WHEN NOT (site % 23 = 0 OR parcel_status IN ('county_failed', 'parcel_failed') OR parcel_status = 'ok' AND site % 6 <> 1) THEN greatest(200e0, round(sqrt((site % 50) * 4046.8564224e0))) END AS square_side_m FROM b""")
def parcel_and_footprint(t: Tables) -> DataFrame:
    """How far each parcel lookup came, and what the footprint rests on."""
    k = F.col("site")
    rows = t.customer.select(F.col("c_custkey").alias("site")).withColumns(
        {"county_failed": k % 19 == 0, "county": F.when(k % 17 != 0, "c"), "service": F.when(k % 5 != 0, "s"), "service_failed": k % 13 == 0, "polygon": F.when(k % 4 != 0, "p"), "outline_vertices": F.when(k % 23 == 0, 4), "parcel_acres": (k % 6 != 1).cast("int") * 2.5, "acres_stated": k % 50 * 1.0}
    )
    return footprint_basis(parcel_stages(rows)).select("site", "parcel_status", "fp_basis", "square_side_m")


SIDE = 40


def ground(t: Tables) -> DataFrame:
    """Cells of every supplier's synthetic grid."""
    k, i, j = F.col("s_suppkey"), F.col("row"), F.col("column")
    span = lambda: F.explode(F.sequence(F.lit(0), F.lit(SIDE - 1)))
    cells = t.supplier.select("s_suppkey").withColumn("row", span()).withColumn("column", span())
    return cells.withColumns(
        {"site": (i >= 2) & (i < 38) & (j >= 2 + k % 5) & (j < 36) & ~((i == 20) & (k % 3 == 0)), "building": (i - 10) * (i - 10) + (j - 12) * (j - 12) < k % 9, "cover": F.when(k % 31 != 0, F.when((i * 7 + j * 3 + k) % 97 == 0, 90).otherwise(52)), "height": F.when(j > 30, (j - 30) * (k % 4) * 1.5).otherwise(0.0)}
    )


@query()
def usable_land(t: Tables) -> DataFrame:
    """Usable land of every supplier's synthetic grid; the raster steps have no SQL, tests hold them to plain loops."""
    return measure_usable(ground(t), "s_suppkey", SIDE, 10.0)


@query()
def usable_land_tiles(t: Tables) -> DataFrame:
    """Usable land of one site made of all suppliers' grids side by side, cut into tiles; tests hold it to the same grid measured whole."""
    top = t.supplier.agg(F.coalesce(F.max("s_suppkey"), F.lit(0)).alias("n")).first().n
    wide = int(top**0.5) + 1
    k = F.col("s_suppkey")
    cells = ground(t).withColumns({"row": F.floor(k / wide) * SIDE + F.col("row"), "column": k % wide * SIDE + F.col("column"), "cover": F.coalesce("cover", F.lit(81))})
    return measure_tiles(cells.withColumn("country", F.lit(1)), "country", wide * SIDE, 10.0)


@query("""WITH z AS (SELECT l_suppkey AS site, CAST(l_linenumber AS INTEGER) AS rank, l_partkey % 48 AS x, l_orderkey % 48 AS y, 1 + floor(l_quantity / 4) AS w FROM lineitem),
    cells AS (SELECT s_suppkey AS site, i, j FROM supplier, range(64) a(i), range(64) b(j)),
    held AS (SELECT site, i, j, min(rank) AS rank FROM (SELECT site, rank, j, unnest(range(CAST(y AS BIGINT), CAST(y + w AS BIGINT))) AS i FROM (SELECT site, rank, y, w, unnest(range(CAST(x AS BIGINT), CAST(x + w AS BIGINT))) AS j FROM z)) GROUP BY ALL),
    owned AS (SELECT c.site, c.i, c.j, rank FROM cells c LEFT JOIN held h ON h.site = c.site AND h.i = c.i AND h.j = c.j)
    SELECT site, rank, count(*) * 1e0 AS area, round(count(*) * 100e0 / 4096, 6) AS pct FROM owned GROUP BY site, rank""")
def footprint_zones(t: Tables) -> DataFrame:
    """Zone shares of square footprints with the unmapped rest, cut into cells that the synthetic zones follow."""
    box = lambda x, y, w: F.array(F.array(*[F.struct((x + w * a).cast("double").alias("x"), (y + w * b).cast("double").alias("y")) for a, b in ((0, 0), (1, 0), (1, 1), (0, 1))]))
    own = t.supplier.select(F.col("s_suppkey").alias("site"), F.lit(None).cast("int").alias("rank"), box(F.lit(0), F.lit(0), F.lit(64)).alias("rings"))
    zones = t.lineitem.select(
        F.col("l_suppkey").alias("site"), F.col("l_linenumber").cast("int").alias("rank"), box(F.col("l_partkey") % 48, F.col("l_orderkey") % 48, 1 + F.floor(F.col("l_quantity") / 4)).alias("rings")
    )
    return zone_shares(own.unionByName(zones), "site", 64).withColumn("pct", F.round("pct", 6))
