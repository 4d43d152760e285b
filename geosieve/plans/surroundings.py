"""Queries of the producers in operators/surroundings.py: customers as sites, order lines as what lies about them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geosieve.functions.rules import kilovolts
from geosieve.operators import surroundings as s
from geosieve.operators.producers import parcel_stages
from geosieve.plans.registry import Tables, query

AROUND = """near AS (SELECT o_custkey AS site, CAST(l_orderkey AS BIGINT) * 10000000 + l_partkey * 100 + l_linenumber AS ordinal, greatest(0, l_partkey * 7919 % 1200000 - 150000) AS d_mm, l_partkey AS p, l_suppkey AS s, l_linenumber AS n, l_quantity AS q FROM lineitem JOIN orders ON l_orderkey = o_orderkey), sites AS (SELECT c_custkey AS site FROM customer)"""


def around(t: Tables) -> DataFrame:
    """Order lines about their customer, at synthetic distances."""
    rows = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    ordinal = F.col("l_orderkey").cast("long") * 10000000 + F.col("l_partkey") * 100 + F.col("l_linenumber")
    d = F.greatest(F.lit(0), F.col("l_partkey").cast("long") * 7919 % 1200000 - 150000)
    return rows.select(F.col("o_custkey").alias("site"), ordinal.alias("ordinal"), d.alias("d_mm"), F.col("l_partkey").alias("p"), F.col("l_suppkey").alias("s"), F.col("l_linenumber").alias("n"), F.col("l_quantity").alias("q"))


def sites(t: Tables) -> DataFrame:
    return t.customer.select(F.col("c_custkey").alias("site"))


def one(values: tuple, i):
    return F.get(F.array(*map(F.lit, values)), i.cast("int"))


def long_sql(values: dict[str, tuple[str, str]], source: str, key: str = "site") -> str:
    """SQL for long records: field -> (value, its status)."""
    each = [f"SELECT {key}, '{f}' AS field, {st} AS status, CASE WHEN {st} IN ('ok', 'manual') THEN CAST({v} AS VARCHAR) END AS value FROM {source}" for f, (v, st) in values.items()]
    return " UNION ALL ".join(each)


OUT = ("site", "field", "status", "value")
_BAD = "WHEN site % 29 = 0 THEN 'failed'"
_is = lambda present: f"CASE {_BAD} WHEN {present} THEN 'ok' ELSE 'absent' END"
ZONES = ("X", "AE", "A", "D", "VE", "X", "AO")
_SFHA = "zone IN ('A', 'AE', 'AH', 'AO', 'AR', 'A99', 'V', 'VE') OR flag = 'T'"


@query(f"""WITH {AROUND}, z AS (SELECT *, {list(ZONES)}[s % 7 + 1] AS zone, CASE WHEN p % 11 = 0 THEN 'T' WHEN p % 2 = 0 THEN 'F' END AS flag, CASE WHEN p % 3 = 0 THEN -9999e0 ELSE p / 8e0 END AS bfe, 'S' || (p % 5) AS study FROM near),
    a AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY site ORDER BY ordinal) AS k FROM z WHERE d_mm = 0) WHERE k = 1),
    h AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY site ORDER BY d_mm, ordinal) AS k FROM z WHERE {_SFHA}) WHERE k = 1),
    f AS (SELECT * FROM (SELECT l.*, 'S' || (l.s % 5) || '-' || l.n AS panel, '20' || (10 + l.s % 10) || '-01-01' AS effective, row_number() OVER (PARTITION BY l.site ORDER BY CASE WHEN 'S' || (l.s % 5) = a.study THEN 0 ELSE 1 END, l.ordinal) AS k FROM near l LEFT JOIN a USING (site) WHERE l.q < 25) WHERE k = 1),
    w AS (SELECT sites.site, a.zone, a.flag, a.bfe, a.study, a.site IS NOT NULL AS here, h.d_mm AS hd, h.zone AS hz, f.panel, f.effective, CASE WHEN a.site IS NOT NULL THEN 'mapped' WHEN sites.site % 5 = 0 THEN 'area_not_included' WHEN sites.site % 3 = 0 THEN 'no_nfhl_data' ELSE 'no_zone_returned' END AS why FROM sites LEFT JOIN a USING (site) LEFT JOIN h USING (site) LEFT JOIN f USING (site))
    """ + long_sql({"fema_determination": ("why", f"CASE {_BAD} ELSE 'ok' END"), "fema_flood_zone": ("zone", _is("here")), "fema_zone_subtype": ("CASE WHEN zone = 'AE' THEN 'FLOODWAY' END", _is("here")), "fema_sfha": (f"CASE WHEN coalesce({_SFHA}, false) THEN 'true' ELSE 'false' END", _is("here")),
        "fema_static_bfe_ft": ("CASE WHEN bfe > -9999 THEN bfe END", _is("here")), "fema_dfirm_id": ("study", _is("here")), "fema_firm_panel": ("panel", _is("panel IS NOT NULL")), "fema_panel_effective": ("effective", _is("panel IS NOT NULL")), "fema_nearest_sfha_m": ("round_even(hd / 1000e0, 1)", _is("hz IS NOT NULL")), "fema_nearest_sfha_zone": ("hz", _is("hz IS NOT NULL"))}, "w"))
def producer_flood(t: Tables) -> DataFrame:
    """Flood zones at the pin and near it, the determination, and the panel of the zone's study."""
    p, sup = F.col("p"), F.col("s")
    zone = one(ZONES, sup % 7)
    zones = around(t).select("site", "ordinal", "d_mm", zone.alias("zone"), F.when(zone == "AE", "FLOODWAY").alias("subtype"), F.when(p % 11 == 0, "T").when(p % 2 == 0, "F").alias("flag"), F.when(p % 3 == 0, -9999.0).otherwise(p / 8.0).alias("bfe"), F.concat(F.lit("S"), (p % 5).cast("string")).alias("study"))
    text = lambda c: c.cast("string")
    panels = around(t).where("q < 25").select("site", "ordinal", F.concat(F.lit("S"), text(sup % 5), F.lit("-"), text(F.col("n"))).alias("panel"), F.concat(F.lit("20"), text(10 + sup % 10), F.lit("-01-01")).alias("effective"))
    site = F.col("site")
    coverage = sites(t).select("site", (site % 5 == 0).alias("excluded"), (site % 3 != 0).alias("studied"))
    return s.flood(sites(t), "site", zones, panels, coverage, site % 29 == 0).select(*OUT)


@query(f"""WITH {AROUND}, z AS (SELECT *, ['Riverine', 'Lake', 'Pond'][s % 3 + 1] AS kind, 'P' || (p % 9) AS code, CASE WHEN p % 4 <> 0 THEN (p % 64) / 16e0 END AS acres FROM near WHERE d_mm <= 500000),
    a AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY site ORDER BY ordinal) AS k FROM z WHERE d_mm = 0) WHERE k = 1), h AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY site ORDER BY d_mm, ordinal) AS k FROM z) WHERE k = 1),
    g AS (SELECT site, count(*) AS n, sum(acres) AS total FROM z GROUP BY site),
    w AS (SELECT sites.site, CASE WHEN sites.site % 7 <> 0 THEN 'Digital' END AS state, CASE WHEN sites.site % 4 <> 0 THEN 1980 + sites.site % 40 END AS year, a.site IS NOT NULL AS here, a.kind AS ak, a.code AS ac, h.site IS NOT NULL AS seen, h.d_mm AS hd, h.kind AS hk, h.code AS hc, h.acres AS ha, coalesce(g.n, 0) AS n, coalesce(g.total, 0e0) AS total FROM sites LEFT JOIN a USING (site) LEFT JOIN h USING (site) LEFT JOIN g USING (site))
    """ + long_sql({"nwi_mapping_status": ("state", _is("state IS NOT NULL")), "nwi_image_year": ("year", _is("year IS NOT NULL")), "nwi_mapping_age_years": ("2026 - year", _is("year IS NOT NULL")), "nwi_project": ("'R' || site % 6", _is("site % 6 <> 0")), "nwi_at_point": ("CASE WHEN here THEN 'true' ELSE 'false' END", _is("true")),
        "nwi_type_at_point": ("ak", _is("here")), "nwi_code_at_point": ("ac", _is("here")), "nwi_nearest_m": ("round_even(hd / 1000e0, 1)", _is("seen")), "nwi_nearest_type": ("hk", _is("seen")), "nwi_nearest_code": ("hc", _is("seen")), "nwi_nearest_acres": ("round_even(ha, 3)", _is("seen")), "nwi_count_within_500m": ("n", _is("true")), "nwi_polygon_acres_within_500m": ("round_even(total, 3)", _is("true"))}, "w"))
def producer_wetlands(t: Tables) -> DataFrame:
    """Wetlands at the pin, the nearest, count and acres within 500 m, and the mapping's status and age."""
    p, site = F.col("p"), F.col("site")
    rows = around(t).where("d_mm <= 500000").select("site", "ordinal", "d_mm", one(("Riverine", "Lake", "Pond"), F.col("s") % 3).alias("kind"), F.concat(F.lit("P"), (p % 9).cast("string")).alias("code"), F.when(p % 4 != 0, p % 64 / 16.0).alias("acres"))
    mapping = sites(t).select("site", F.when(site % 7 != 0, "Digital").alias("state"), F.when(site % 4 != 0, 1980 + site % 40).alias("year"), F.when(site % 6 != 0, F.concat(F.lit("R"), (site % 6).cast("string"))).alias("project"))
    return s.wetlands(sites(t), "site", rows, mapping, 2026, site % 29 == 0).select(*OUT)


_TIED = "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY site ORDER BY -coalesce(kv, 0), ordinal) AS k FROM (SELECT *, min(d_mm) OVER (PARTITION BY site) AS least FROM {0} WHERE {1}) WHERE d_mm <= least + 1000) WHERE k = 1"


@query(f"""WITH {AROUND}, l AS (SELECT *, CASE WHEN s % 5 <> 0 THEN (s % 40) * 10e0 + 10 END AS kv, CASE WHEN s % 2 = 0 THEN 161e0 ELSE 99e0 END AS band FROM near WHERE n <= 3), b AS (SELECT *, CASE WHEN s % 6 <> 0 THEN (p % 30) * 10e0 + 5 END AS kv, CASE WHEN p % 8 = 0 THEN 'UNKNOWN' || p ELSE 'Sub ' || p % 50 END AS name, p % 5 <> 0 AS ok FROM near WHERE n > 3),
    c AS (SELECT site, bool_or(d_mm = 0) AS crosses FROM l GROUP BY site), nl AS ({_TIED.format("l", "coalesce(kv >= 69, band >= 100)")}), ns AS ({_TIED.format("b", "kv >= 69 AND ok")}), nh AS ({_TIED.format("b", "kv >= 115 AND ok")}),
    w AS (SELECT sites.site, sites.site % 3 <> 0 AS on_site, coalesce(crosses, false) AS crosses, nl.d_mm AS ld, nl.kv AS lk, ns.d_mm AS sd, ns.kv AS sk, ns.name AS sn, nh.d_mm AS hd, nh.kv AS hk, nh.name AS hn FROM sites LEFT JOIN c USING (site) LEFT JOIN nl USING (site) LEFT JOIN ns USING (site) LEFT JOIN nh USING (site))
    """ + long_sql({"pw_from": ("CASE WHEN on_site THEN 'parcel boundary' ELSE 'pin (no site outline)' END", _is("true")), "line_crosses_site": ("CASE WHEN on_site AND crosses THEN 'true' ELSE 'false' END", _is("true")), "line_kv_site_m": ("round_even(ld / 1000e0, 1)", _is("ld IS NOT NULL")), "line_kv_site_kv": ("lk", _is("ld IS NOT NULL")),
        **{f"{tag}_{f}": (v, _is(f"{d}d IS NOT NULL")) for tag, d in (("sub_kv_site", "s"), ("sub_115kv_site", "h")) for f, v in (("m", f"round_even({d}d / 1000e0, 1)"), ("name", f"CASE WHEN {d}n LIKE 'UNKNOWN%' THEN '[unnamed ' || {d}n || ']' ELSE {d}n END"), ("kv", f"{d}k"))}}, "w"))
def producer_power_site(t: Tables) -> DataFrame:
    """The nearest qualifying line and substations of a site; within a metre of the nearest the highest voltage wins."""
    p, sup, site = F.col("p"), F.col("s"), F.col("site")
    volts = kilovolts(F.when(sup % 5 != 0, (sup % 40 * 10.0 + 10).cast("string")), F.lit("x"))
    lines = around(t).where("n <= 3").select("site", "ordinal", "d_mm", volts["kv"].alias("kv"), F.when(sup % 2 == 0, 161.0).otherwise(99.0).alias("band_kv"), (F.col("d_mm") == 0).alias("crosses"))
    name = F.when(p % 8 == 0, F.concat(F.lit("UNKNOWN"), p.cast("string"))).otherwise(F.concat(F.lit("Sub "), (p % 50).cast("string")))
    subs = around(t).where("n > 3").select("site", "ordinal", "d_mm", name.alias("name"), F.when(sup % 6 != 0, p % 30 * 10.0 + 5).alias("kv"), F.when(p % 10 == 0, "RETIRED").otherwise("In Service").alias("state"), F.when(p % 5 == 0, "TAP").otherwise("SUBSTATION").alias("kind"))
    own = sites(t).select("site", (site % 3 != 0).alias("on_site"), F.lit("parcel boundary").alias("basis"))
    return s.power_site(own, "site", lines, subs, failed=site % 29 == 0).select(*OUT)


STAGE_SQL = "CASE WHEN site % 19 = 0 THEN 'county_failed' WHEN site % 17 = 0 THEN 'no_county' WHEN site % 5 = 0 THEN 'unresolved: no registered service' WHEN site % 13 = 0 THEN 'parcel_failed' WHEN site % 4 = 0 THEN 'unresolved: no polygon at the point' ELSE 'ok' END"
_late = lambda present="true": f"CASE WHEN stage IN ('county_failed', 'parcel_failed') THEN 'failed' WHEN stage = 'ok' AND {present} THEN 'ok' ELSE 'absent' END"
_early = "CASE stage WHEN 'county_failed' THEN 'failed' WHEN 'no_county' THEN 'absent' ELSE 'ok' END"
_OWNER = "CASE site % 3 WHEN 0 THEN 'Acme Land' WHEN 1 THEN 'Other' ELSE ' ' END"


@query(f"""WITH w AS (SELECT c_custkey AS site, {STAGE_SQL.replace("site", "c_custkey")} AS stage FROM customer) """
       + long_sql({"parcel_county": ("'c'", _early), "parcel_county_geoid": ("'48' || site % 254", _early), "parcel_source_scope": ("CASE WHEN site % 2 = 0 THEN 'county' ELSE 'statewide' END", _late()), "parcel_service_name": ("'s'", _late()), "parcel_apn": ("'12-' || site % 9", _late()), "parcel_owner": (_OWNER, _late()), "parcel_address": ("site || ' Oak St'", _late()),
        "parcel_acres_gis": ("round_even(site / 64e0, 4)", _late()), "parcel_acres_stated_by_county": ("round_even(site / 32e0, 4)", _late("site % 8 <> 1")), "parcel_acres_input": ("(site % 50) * 1e0", _late("site % 6 <> 1")), "parcel_apn_matches_input": ("CASE WHEN site % 9 = 3 THEN 'true' ELSE 'false' END", _late("site % 11 <> 0")),
        "parcel_owner_check": ("CASE site % 3 WHEN 0 THEN 'expected owner' WHEN 1 THEN 'different owner - review' ELSE 'no owner in source - review' END", _late("site % 7 <> 0")), "parcel_vertices": ("site % 40 + 3", _late()), "parcel_use": ("CASE WHEN site % 10 = 3 THEN 'internal use only (licensed county)' ELSE 'open' END", _late()),
        "parcel_status": ("stage", "CASE WHEN stage IN ('county_failed', 'parcel_failed') THEN 'failed' WHEN stage = 'no_county' THEN 'absent' ELSE 'ok' END")}, "w"))
def producer_parcel(t: Tables) -> DataFrame:
    """All records of the parcel lookup, from the stage each site came to."""
    k = F.col("site")
    text = lambda c: c.cast("string")
    rows = sites(t).withColumns(
        {
            "county_failed": k % 19 == 0, "county": F.when(k % 17 != 0, "c"), "service": F.when(k % 5 != 0, "s"), "service_failed": k % 13 == 0, "polygon": F.when(k % 4 != 0, "p"), "geoid": F.concat(F.lit("48"), text(k % 254)),
            "scope": F.when(k % 2 == 0, "county").otherwise("statewide"), "licensed": k % 10 == 3, "apn": F.concat(F.lit("12-"), text(k % 9)), "owner": one(("Acme Land", "Other", " "), k % 3), "address": F.concat(text(k), F.lit(" Oak St")), "acres_gis": k / 64.0,
            "acres_stated_by_county": F.when(k % 8 != 1, k / 32.0), "vertices": k % 40 + 3, "hits": k % 4, "acres_stated": F.when(k % 6 != 1, k % 50 * 1.0), "input_apn": F.when(k % 11 != 0, "12 3"), "pattern": F.when(k % 7 != 0, "acme"), "has_owner": F.lit(True),
        }
    )
    return s.parcel_records(parcel_stages(rows), "site").select(*OUT)


HAZARDS = ("overall", "hail", "tornado", "wildfire")


@query(f"WITH {AROUND}, h AS (SELECT *, row_number() OVER (PARTITION BY site ORDER BY ordinal) AS k FROM near WHERE d_mm = 0), w AS (SELECT sites.site, h.p, h.s FROM sites LEFT JOIN h ON h.site = sites.site AND k = 1) "
       + long_sql({"nri_tract": ("'T' || p", _is("p IS NOT NULL"))} | {f"nri_{n}": (f"['Very Low', 'Low', 'High', NULL][(s + {i}) % 4 + 1]", _is("p IS NOT NULL")) for i, n in enumerate(HAZARDS)}, "w"))
def producer_hazards(t: Tables) -> DataFrame:
    """The risk ratings of the tract at the pin."""
    from geosieve.operators.producers import lookup

    ratings = {n: one(("Very Low", "Low", "High", None), (F.col("s") + i) % 4) for i, n in enumerate(HAZARDS)}
    hits = around(t).where("d_mm = 0").select("site", "ordinal", F.concat(F.lit("T"), F.col("p").cast("string")).alias("tract"), *[c.alias(n) for n, c in ratings.items()])
    return lookup(sites(t), "site", hits, "ordinal", {"nri_tract": "tract"} | {f"nri_{n}": n for n in HAZARDS}, "hazards", F.col("site") % 29 == 0).select(*OUT)


@query("""WITH u AS (SELECT s_suppkey AS k, CASE s_suppkey % 5 WHEN 0 THEN '' WHEN 1 THEN '-1' WHEN 2 THEN 'x' WHEN 3 THEN CAST(s_suppkey / 16e0 AS VARCHAR) END AS v FROM supplier)
    SELECT k, CASE WHEN k % 5 = 3 THEN round_even(k / 16e0, 2) END AS cents_kwh, CASE WHEN k % 5 = 3 THEN 'ok' ELSE 'absent' END AS status FROM u""")
def utility_prices(t: Tables) -> DataFrame:
    """Average prices to two decimals; none where a class has no sales."""
    k = F.col("s_suppkey")
    v = F.when(k % 5 == 0, "").when(k % 5 == 1, "-1").when(k % 5 == 2, "x").when(k % 5 == 3, (k / 16.0).cast("string"))
    cents = s.price(v)
    return t.supplier.select(k.alias("k"), cents.alias("cents_kwh"), F.when(cents.isNull(), "absent").otherwise("ok").alias("status"))
