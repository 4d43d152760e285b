"""Text queries: quotes, owners, addresses, timing, endpoints, lists in words."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geosieve.functions import text as x
from geosieve.plans.registry import Tables, query

NORM = "trim(regexp_replace(lower(translate({0}, '‘’“”–—×', '''''\"\"--x')), '[ \\t\\n\\x0B\\f\\r]+', ' ', 'g'))"


@query(f"""SELECT b.item_id, d.doc_id IS NOT NULL AS has_cell, coalesce({NORM.format("b.text")} <> '' AND contains({NORM.format("d.text")}, {NORM.format("b.text")}), false) AS verbatim
    FROM benchmark b LEFT JOIN documents d ON d.doc_id = b.item_id""")
def quote_verbatim_check(t: Tables) -> DataFrame:
    """Whether each quote stands in the cell it cites."""
    cells = t.documents.select(F.col("doc_id").alias("item_id"), F.col("text").alias("cell"))
    out = t.benchmark.join(cells, "item_id", "left")
    return out.select("item_id", F.col("cell").isNotNull().alias("has_cell"), F.coalesce(x.quotes(F.col("cell"), F.col("text")), F.lit(False)).alias("verbatim"))


@query("""SELECT page_id, rtrim(lower(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)', 1) || regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)', 1)), '/') AS endpoint FROM pages""")
def endpoint_normalise(t: Tables) -> DataFrame:
    """The endpoint of each page's address."""
    return t.pages.select("page_id", x.endpoint(F.col("url")).alias("endpoint"))


OWNER_SQL = """CASE s_suppkey % 7 WHEN 0 THEN 'Acme Land Holdings LLC' WHEN 1 THEN 'The ACME Trust' WHEN 2 THEN 'Blue River Farms Inc' WHEN 3 THEN 'River Blue Family LP' WHEN 4 THEN 'Land Holdings LLC' WHEN 5 THEN 'FRANCIS E ONEILL FAMILY LP' ELSE 'Number ' || s_suppkey || ' Co' END"""


def owner(k):
    names = ["Acme Land Holdings LLC", "The ACME Trust", "Blue River Farms Inc", "River Blue Family LP", "Land Holdings LLC", "FRANCIS E ONEILL FAMILY LP"]
    return F.coalesce(F.get(F.array(*map(F.lit, names)), (k % 7).cast("int")), F.concat(F.lit("Number "), k.cast("string"), F.lit(" Co")))


def _tokens_sql(name: str) -> str:
    words = f"list_filter(list_distinct(regexp_extract_all(lower({name}), '[a-z0-9]{{2,}}')), lambda w: NOT list_contains(['et','al','etal','etux','llc','lp','llp','ltd','inc','co','corp','tr','trust','trustee','the','and','family','est','estate','of','ptshp','partnership','living','revocable'], w))"
    telling = f"list_filter({words}, lambda w: NOT list_contains(['land','lands','property','properties','holdings','development','investments','investment','partners','group','texas','association','owners','commercial','real','ranch','cattle','capital','ventures','enterprises','management','company'], w))"
    return f"CASE WHEN len({telling}) > 0 THEN {telling} ELSE {words} END"


@query(f"""WITH o AS (SELECT s_suppkey, s_nationkey, {OWNER_SQL} AS owner FROM supplier), w AS (SELECT *, {_tokens_sql("owner")} AS tokens FROM o), n AS (SELECT s_nationkey, arg_min(tokens, s_suppkey) AS first, min(s_suppkey) AS site FROM w GROUP BY 1)
    SELECT s_suppkey, site, array_to_string(list_sort(tokens), ' ') AS tokens, least(len(tokens), len(first)) > 0 AND (len(list_intersect(tokens, first)) = least(len(tokens), len(first)) OR len(list_intersect(tokens, first)) >= 2) AS same_owner FROM w JOIN n USING (s_nationkey)""")
def owner_token_match(t: Tables) -> DataFrame:
    """Whether a parcel's owner is the owner of its nation's first one."""
    rows = t.supplier.select("s_suppkey", "s_nationkey", x.owner_tokens(owner(F.col("s_suppkey"))).alias("tokens"))
    firsts = rows.groupBy("s_nationkey").agg(F.min(F.struct("s_suppkey", "tokens")).alias("f"))
    out = rows.join(firsts, "s_nationkey")
    return out.select("s_suppkey", F.col("f.s_suppkey").alias("site"), F.array_join(F.array_sort("tokens"), " ").alias("tokens"), x.same_owner(F.col("tokens"), F.col("f.tokens")).alias("same_owner"))


STREETS = ("Oak Street, Town, TX", "oak st.", "North Oak Avenue", "County Rd 52, Rosharon, TX", "CR 52", "Farm Road 12", "FM 12", "Main 2nd St")


def _address_sql(a: str) -> str:
    words = f"list_transform(regexp_extract_all(lower(regexp_extract(split_part({a}, ',', 1), '^\\s*[0-9]+\\s+(.+)', 1)), '[a-z0-9]+'), lambda w: CASE w WHEN 'county' THEN 'cr' WHEN 'co' THEN 'cr' WHEN 'road' THEN 'rd' WHEN 'street' THEN 'st' WHEN 'highway' THEN 'hwy' WHEN 'farm' THEN 'fm' WHEN 'drive' THEN 'dr' WHEN 'lane' THEN 'ln' ELSE w END)"
    return f"list_filter({words}, lambda w: NOT list_contains(['rd','st','dr','ln','ave','blvd','n','s','e','w','tx','us'], w))"


@query(f"""WITH a AS (SELECT c_custkey, CASE WHEN c_custkey % 11 = 0 THEN '' ELSE (c_custkey % 2 + 10) || ' ' END || {list(STREETS)}[c_custkey % 8 + 1] AS address, (c_custkey % 3 + 10) || ' ' || {list(STREETS)}[c_custkey // 8 % 8 + 1] AS other FROM customer)
    SELECT c_custkey, c_custkey % 11 <> 0 AND left(address, 2) = left(other, 2) AND len(list_intersect({_address_sql("address")}, {_address_sql("other")})) > 0 AS same_address FROM a""")
def address_match(t: Tables) -> DataFrame:
    """Whether two spellings name one address: house number and a telling word, county roads and farm roads folded."""
    k = F.col("c_custkey")
    streets = F.array(*map(F.lit, STREETS))
    address = F.concat(F.when(k % 11 == 0, "").otherwise(F.concat((k % 2 + 10).cast("string"), F.lit(" "))), F.get(streets, (k % 8).cast("int")))
    other = F.concat((k % 3 + 10).cast("string"), F.lit(" "), F.get(streets, (F.floor(k / 8) % 8).cast("int")))
    return t.customer.select("c_custkey", x.same_address(x.address_parts(address), x.address_parts(other)).alias("same_address"))


@query("""WITH t AS (SELECT o_orderkey, year(o_orderdate) AS y, month(o_orderdate) AS m, 2000 + (year(o_orderdate) + 5) % 100 AS n FROM orders),
    w AS (SELECT *, CASE o_orderkey % 12 WHEN 0 THEN 'available now' WHEN 1 THEN 'Q' || (o_orderkey % 4 + 1) || ' ' || n WHEN 2 THEN 'Summer ' || n WHEN 3 THEN 'by end of ' || n WHEN 4 THEN n || '-' || right(CAST(n + 2 AS VARCHAR), 2) WHEN 5 THEN 'sometime in ' || n WHEN 6 THEN 'to be decided' WHEN 7 THEN 'Winter ' || n
        WHEN 8 THEN 'end-' || n WHEN 9 THEN n || '–' || right(CAST(n + 1 AS VARCHAR), 2) WHEN 10 THEN 'energized spring of ' || n ELSE 'known: immediately after ' || n END AS timing FROM t)
    SELECT o_orderkey, timing, CAST(greatest(0, CASE o_orderkey % 12 WHEN 0 THEN 0 WHEN 1 THEN n * 12 + (o_orderkey % 4) * 3 + 2 - (y * 12 + m) WHEN 2 THEN n * 12 + 7 - (y * 12 + m) WHEN 3 THEN n * 12 + 6 - (y * 12 + m) WHEN 4 THEN (n + 2) * 12 + 6 - (y * 12 + m) WHEN 5 THEN n * 12 + 6 - (y * 12 + m) WHEN 7 THEN n * 12 + 1 - (y * 12 + m)
        WHEN 8 THEN n * 12 + 12 - (y * 12 + m) WHEN 9 THEN (n + 1) * 12 + 6 - (y * 12 + m) WHEN 10 THEN n * 12 + 4 - (y * 12 + m) ELSE 0 END) AS INTEGER) AS months
    FROM w WHERE o_orderkey % 12 <> 6 UNION ALL SELECT o_orderkey, timing, NULL FROM w WHERE o_orderkey % 12 = 6""")
def months_until(t: Tables) -> DataFrame:
    """Months from an order's date to a timing in words."""
    k, y = F.col("o_orderkey"), F.year("o_orderdate")
    n = 2000 + (y + 5) % 100
    text = lambda c: c.cast("string")
    year = text(n)
    short = lambda i: F.right(text(n + i), F.lit(2))
    forms = [F.lit("available now"), F.concat(F.lit("Q"), text(k % 4 + 1), F.lit(" "), year), F.concat(F.lit("Summer "), year), F.concat(F.lit("by end of "), year), F.concat(year, F.lit("-"), short(2)), F.concat(F.lit("sometime in "), year), F.lit("to be decided"), F.concat(F.lit("Winter "), year)]
    forms += [F.concat(F.lit("end-"), year), F.concat(year, F.lit("–"), short(1)), F.concat(F.lit("energized spring of "), year), F.concat(F.lit("known: immediately after "), year)]
    timing = F.get(F.array(*forms), (k % 12).cast("int"))
    return t.orders.select("o_orderkey", timing.alias("timing"), x.months_until(timing, y, F.month("o_orderdate")).cast("int").alias("months"))


@query("""SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'expected owner' WHEN 1 THEN 'not checkable: the source has no owner' WHEN 2 THEN 'no owner in source - review' ELSE 'different owner - review' END AS owner_check, c_custkey % 3 <> 0 AS apn_matches FROM customer""")
def owner_and_number_check(t: Tables) -> DataFrame:
    """The four-way owner check, and parcel numbers compared by letters and digits only."""
    from geosieve.functions.rules import owner_check

    k = F.col("c_custkey")
    name = F.when(k % 4 == 2, " ").when(k % 4 == 3, "Someone Else").otherwise("Acme Land")
    check = owner_check(F.lit("acme"), F.when(k % 4 != 1, name), k % 4 != 1, F.lit("12-34"))
    stated, found = F.concat(F.lit("12-34."), (k % 3).cast("string")), F.when(k % 3 == 0, "1234A").otherwise(F.concat(F.lit("12 34/"), (k % 3).cast("string")))
    return t.customer.select("c_custkey", check.alias("owner_check"), (x.alphanumeric(stated) == x.alphanumeric(found)).alias("apn_matches"))


@query("""SELECT s_suppkey, 'zone ' || s_suppkey % 7 AS label, CAST(s_suppkey % 90 AS DOUBLE) + 0.5 AS acres, CAST(s_suppkey % 100 AS DOUBLE) AS pct FROM supplier UNION ALL SELECT s_suppkey, 'unmapped', 2e0, 5e0 FROM supplier""")
def zone_list_parse(t: Tables) -> DataFrame:
    """Labels, acres and shares out of a breakdown in words."""
    k = F.col("s_suppkey")
    text = F.concat(F.lit("zone "), (k % 7).cast("string"), F.lit(" "), (k % 90).cast("string"), F.lit(".5 ac ("), (k % 100).cast("string"), F.lit("%); nothing; unmapped 2 ac (5%)"))
    return t.supplier.select("s_suppkey", F.inline(x.zone_list(text)))


@query("""SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN 'Power by June|Zoned heavy industrial' ELSE 'Power by June|industrial land ' || s_suppkey END AS kept FROM supplier""")
def statement_dedupe(t: Tables) -> DataFrame:
    """Statements without those whose words another one holds."""
    k = F.col("s_suppkey")
    second = F.when(k % 2 == 0, F.array(F.lit("heavy industrial"), F.lit("Zoned heavy industrial"), F.lit("zoned HEAVY industrial"))).otherwise(F.array(F.concat(F.lit("industrial land "), k.cast("string"))))
    return t.supplier.select("s_suppkey", F.array_join(x.without_contained(F.concat(F.array(F.lit("Power by June"), F.lit("by june")), second)), "|").alias("kept"))


@query("""SELECT regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)', 1) AS prefix, count(*) AS n, CAST(sum(strlen(html)) AS BIGINT) AS bytes, min(page_id) FILTER (big = strlen(html)) AS largest
    FROM (SELECT *, max(strlen(html)) OVER (PARTITION BY regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)', 1)) AS big FROM pages) GROUP BY 1""")
def size_inventory(t: Tables) -> DataFrame:
    """Count, bytes and the largest item by prefix."""
    size = F.octet_length("html").cast("long")
    rows = t.pages.select(F.try_parse_url("url", F.lit("AUTHORITY")).alias("prefix"), "page_id", size.alias("size"))
    best = F.max(F.struct("size", (-F.col("page_id")).alias("minus")))
    return rows.groupBy("prefix").agg(F.count("*").alias("n"), F.sum("size").alias("bytes"), (-best["minus"]).alias("largest"))


@query("""WITH b AS (SELECT p_partkey AS k, [NULL, ' ', 'UNKNOWN123', 'Not Available', ' East ', 'West'][p_partkey % 6 + 1] AS a, [NULL, 'Unknown 7', 'North', 'South'][p_partkey % 4 + 1] AS b, [NULL, '', 'True', 'False', '12', '-3.0', '2.5e1', 'x', '1e3', '.5'][p_partkey % 10 + 1] AS v, ['DALLAS MSA (TX) · north', 'SAN ANTONIO · hill', 'EL PASO'][p_partkey % 3 + 1] AS section FROM part),
    c AS (SELECT *, CASE WHEN trim(a) IN ('East', 'West') THEN trim(a) END AS x, CASE WHEN b IN ('North', 'South') THEN b END AS y, CASE WHEN v IN ('12', '-3.0', '2.5e1', '1e3', '.5') THEN CAST(v AS DOUBLE) END AS n FROM b)
    SELECT k, concat_ws(' - ', x, y) AS circuit, coalesce(x, CASE WHEN trim(coalesce(a, '')) = '' THEN '[unnamed]' ELSE '[unnamed ' || trim(a) || ']' END) AS label,
        CASE WHEN coalesce(v, '') = '' THEN 'none' WHEN v IN ('True', 'False') THEN 'bool' WHEN n IS NULL THEN 'text' WHEN v IN ('12', '1e3') THEN 'int' ELSE 'float' END AS kind, CASE v WHEN 'True' THEN 1e0 WHEN 'False' THEN 0e0 ELSE n END AS number,
        CASE section WHEN 'EL PASO' THEN 'El Paso' WHEN 'SAN ANTONIO · hill' THEN 'San Antonio' ELSE 'Dallas MSA' END AS market FROM c""")
def names_and_values(t: Tables) -> DataFrame:
    """Circuit names, labels of unnamed substations, typed CSV values and markets of sections."""
    k = F.col("p_partkey")
    one = lambda xs: F.get(F.array(*map(F.lit, xs)), (k % len(xs)).cast("int"))
    a, b = one((None, " ", "UNKNOWN123", "Not Available", " East ", "West")), one((None, "Unknown 7", "North", "South"))
    v = x.typed(one((None, "", "True", "False", "12", "-3.0", "2.5e1", "x", "1e3", ".5")))
    section = one(("DALLAS MSA (TX) · north", "SAN ANTONIO · hill", "EL PASO"))
    return t.part.select(k.alias("k"), x.circuit_name(a, b).alias("circuit"), x.substation_label(a).alias("label"), v["kind"].alias("kind"), v["number"].alias("number"), x.market_of(section).alias("market"))


@query("""WITH b AS (SELECT p_partkey AS k, p_partkey % 4 AS f, p_size / 2e0 AS acres, p_partkey % 7 = 0 AS blank FROM part)
    SELECT k, CASE f WHEN 0 THEN acres + 1 WHEN 1 THEN CASE WHEN blank THEN acres + 2 ELSE acres END WHEN 2 THEN acres END AS acres, CASE f WHEN 0 THEN 'DEED_ACRES' WHEN 1 THEN CASE WHEN blank THEN 'GIS_ACRES' ELSE 'ACRES_TOTAL' END WHEN 2 THEN 'Acres' END AS acre_field,
        CASE WHEN f = 2 THEN 'Oak LLC' WHEN f = 0 THEN 'Elm Trust' END AS owner, CASE WHEN f = 3 THEN 'PEM1A' END AS code FROM b""")
def property_lookups(t: Tables) -> DataFrame:
    """Properties by role and by suffix in any case, and the preferred acreage of a parcel's properties."""
    k = F.col("p_partkey")
    acres, blank = F.col("p_size") / 2.0, k % 7 == 0
    text = lambda c: c.cast("string")
    maps = [
        F.create_map(F.lit("owner_name"), F.lit("Elm Trust"), F.lit("Acres"), text(acres), F.lit("DEED_ACRES"), text(acres + 1)),
        F.create_map(F.lit("GIS_ACRES"), text(acres + 2), F.lit("ACRES_TOTAL"), F.when(blank, "NULL").otherwise(text(acres))),
        F.create_map(F.lit("OWNER_Name"), F.lit("Oak LLC"), F.lit("DEED_ACRES"), F.lit("-1"), F.lit("Acres"), text(acres)),
        F.create_map(F.lit("Wetlands.ATTRIBUTE"), F.lit("PEM1A"), F.lit("ACRES"), F.lit("0")),
    ]
    p = F.get(F.array(*maps), (k % 4).cast("int"))
    best = x.preferred_acres(p)
    return t.part.select(k.alias("k"), best["acres"].alias("acres"), best["name"].alias("acre_field"), x.property_by_name(p, "Owner_NAME").alias("owner"), x.property_by_suffix(p, "attribute").alias("code"))


@query("""WITH b AS (SELECT s_suppkey AS k, CASE WHEN s_suppkey % 9 = 0 THEN NULL ELSE (s_suppkey * 37 % 4000) / 8e0 END AS v, s_suppkey % 5 AS f, s_suppkey % 3 AS s FROM supplier)
    SELECT k, CASE WHEN v IS NULL THEN '—' WHEN v >= 100 OR v = floor(v) THEN format('{:,}', CAST(round_even(v, 0) AS BIGINT)) || ' ac' ELSE printf('%.1f', round_even(v, 1)) || ' ac' END AS acres_text,
        CASE WHEN v IS NOT NULL THEN format('{:,}', CAST(round_even(v, 0) AS BIGINT)) || ' m' WHEN s = 0 THEN 'none within 5 km' ELSE '—' END AS near_text,
        CASE f WHEN 0 THEN 'now' WHEN 1 THEN '2027' WHEN 2 THEN NULL WHEN 3 THEN '2030' ELSE 'now' END AS first_power, CASE f WHEN 0 THEN 25e0 WHEN 1 THEN 2.5e0 END AS tract_acres,
        CASE f WHEN 0 THEN 'adjacent' WHEN 1 THEN 'distance' WHEN 3 THEN 'distance' END AS claim, CASE f WHEN 1 THEN 2.5e0 WHEN 3 THEN 3e0 END AS miles,
        CASE f WHEN 0 THEN '' WHEN 1 THEN 'not available' WHEN 2 THEN 'Acme build $1.50M; routes 1,200 / 850 ft' WHEN 3 THEN 'quoted' ELSE ' build $1.50M' END AS fiber FROM b""")
def fact_phrases(t: Tables) -> DataFrame:
    """Numbers, distances, first power, tract acreage, substation claims and fibre in words."""
    k = F.col("s_suppkey")
    v = F.when(k % 9 != 0, k * 37 % 4000 / 8.0)
    one = lambda xs: F.get(F.array(*map(F.lit, xs)), (k % 5).cast("int"))
    claim = x.substation_claim(one(("Adjacent to East sub", "about ~2.5 mi away", "close", "3 mi north", "none")))
    fiber = x.fiber_text(one((None, "not_available", "quoted", "quoted", "quoted")), one((None, None, "Acme", "Acme", None)), one((None, None, 1.5e6, None, 1.5e6)), one((None, None, 1200.0, None, 900.0)), one((None, None, 850.0, 3.0, None)))
    near = x.nearest_text(v, F.when(k % 3 == 0, "absent").otherwise("ok"), F.lit("points within 5000 m of the pin"))
    return t.supplier.select(
        k.alias("k"), x.number_text(v, " ac").alias("acres_text"), near.alias("near_text"), x.first_power(one(("Immediate", "Q3 2027", "unknown", "by 2030 at the latest", "now"))).alias("first_power"),
        x.tract_acres(one(("25 ac Smith", "2.5 Acres", "none", "ac 3", "25 acreage"))).alias("tract_acres"), claim["claim"].alias("claim"), claim["miles"].alias("miles"), fiber.alias("fiber"),
    )


@query("""WITH b AS (SELECT o_custkey % 100 AS market, CASE o_orderkey % 7 WHEN 0 THEN 'now' WHEN 1 THEN NULL ELSE CAST(2024 + o_orderkey % 7 AS VARCHAR) END AS f FROM orders),
    g AS (SELECT market, bool_or(f = 'now') AS now, min(f) FILTER (f <> 'now') AS lo, max(f) FILTER (f <> 'now') AS hi, count(f) AS n FROM b GROUP BY 1)
    SELECT market, CASE WHEN n = 0 THEN '—' WHEN CASE WHEN now THEN 'now' ELSE lo END = coalesce(hi, 'now') THEN coalesce(hi, 'now') ELSE CASE WHEN now THEN 'now' ELSE lo END || '–' || coalesce(hi, 'now') END AS first_power FROM g""")
def first_power_by_market(t: Tables) -> DataFrame:
    """The span of first-power years of each market, "now" before years."""
    k = F.col("o_orderkey")
    said = F.when(k % 7 == 0, "available NOW").when(k % 7 == 1, "to be decided").otherwise(F.concat(F.lit("energized by "), (2024 + k % 7).cast("string")))
    return t.orders.select((F.col("o_custkey") % 100).alias("market"), x.first_power(said).alias("f")).groupBy("market").agg(x.power_span(F.col("f")).alias("first_power"))
