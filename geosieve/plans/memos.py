"""Queries for reports: location words, narrative sections, profiles, audience clearance, reused answers, groups by gap."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geosieve.functions import text as x
from geosieve.operators import overlay, relational, spatial
from geosieve.plans.registry import Tables, query
from geosieve.plans.spatial import SUPPLIERS, far, suppliers
from geosieve.plans.surroundings import one

GAPS = (0, 15_000, 30_000, 45_000, 60_000)


@query(f"""WITH RECURSIVE {SUPPLIERS}, gaps AS (SELECT unnest({list(GAPS)}) AS gap_m),
    links AS (SELECT gap_m, a.point AS a, b.point AS b FROM gaps, suppliers a JOIN suppliers b ON a.point <> b.point AND {far("a", "b", "lat", "lng")} <= gap_m * 1000),
    reach AS (SELECT gap_m, point, point AS other FROM gaps, suppliers UNION SELECT reach.gap_m, reach.point, links.b FROM reach JOIN links ON reach.gap_m = links.gap_m AND reach.other = links.a),
    grouped AS (SELECT gap_m, point, min(other) AS component FROM reach GROUP BY ALL)
    SELECT CAST(gap_m AS BIGINT) AS gap_m, count(DISTINCT component) AS components FROM grouped GROUP BY gap_m""")
def components_by_gap(t: Tables) -> DataFrame:
    """How many groups the supplier points form at five gaps."""
    return spatial.components_at_gaps(suppliers(t), "point", GAPS)


@query("""WITH c AS (SELECT l_orderkey AS site, CAST(l_partkey % 4 AS INTEGER) AS rank, l_partkey * 100000 + l_suppkey * 10 + l_linenumber AS ordinal,
        ['Name', 'Location', 'Acreage', 'Grid'][l_partkey % 4 + 1] AS label, ['Mill Rd', 'off Mill Rd, Troy', 'TROY', '12 ac', 'mill rd - 12 ac', 'Substation'][l_suppkey % 6 + 1] AS text FROM lineitem),
    k AS (SELECT *, trim(regexp_replace(lower(text), '[^a-z0-9_]+', ' ', 'g')) AS plain, row_number() OVER (PARTITION BY site ORDER BY rank, ordinal, label, text) AS n FROM c),
    kept AS (SELECT * FROM k WHERE NOT EXISTS (SELECT 1 FROM k b WHERE b.site = k.site AND b.n < k.n AND contains(b.plain, k.plain)))
    SELECT site, string_agg(label || ': ' || text, '; ' ORDER BY n) AS words FROM kept GROUP BY site""")
def location_words(t: Tables) -> DataFrame:
    """What was said of each site's place, in order of rank, without repeats of what another text holds."""
    a, s = F.col("l_partkey"), F.col("l_suppkey")
    cell = F.struct(
        (a % 4).cast("int").alias("rank"), (a.cast("long") * 100000 + s * 10 + F.col("l_linenumber")).alias("ordinal"), one(("Name", "Location", "Acreage", "Grid"), a % 4).alias("label"),
        one(("Mill Rd", "off Mill Rd, Troy", "TROY", "12 ac", "mill rd - 12 ac", "Substation"), s % 6).alias("text"),
    )
    cells = t.lineitem.groupBy(F.col("l_orderkey").alias("site")).agg(F.collect_list(cell).alias("cells"))  # the cells of one site's sheet
    words = F.transform(x.location_words(F.col("cells")), lambda w: F.concat(w["label"], F.lit(": "), w["text"]))
    return cells.select("site", F.array_join(words, "; ").alias("words"))


@query("""WITH b AS (SELECT o_orderkey AS k, o_orderkey % 5 AS v FROM orders)
    SELECT k, section, body FROM (SELECT k, unnest(CASE v WHEN 0 THEN [{'section': 'Summary', 'body': 'Intro ' || k}, {'section': 'Power', 'body': 'Line of ' || k}] WHEN 1 THEN [{'section': 'Power', 'body': 'One' || chr(10) || 'Two ' || k}]
        WHEN 2 THEN [{'section': 'Summary', 'body': 'Only ' || k}] WHEN 3 THEN [{'section': 'Land', 'body': 'Acres ' || k}] END, recursive := true) FROM b)""")
def narrative_sections(t: Tables) -> DataFrame:
    """Narratives split by their headings: text before them, sections of one name, empty ones, other headings."""
    k = F.col("o_orderkey").cast("string")
    text = one(("Intro @\n## Power\nLine of @\n", "## Power\nOne\n## Empty\n\n## Power\nTwo @", "# Title\nOnly @", "## Land\nAcres @\n### Detail\n", "## Nothing\n"), F.col("o_orderkey") % 5)
    rows = t.orders.select(F.col("o_orderkey").alias("k"), F.inline(x.narrative_sections(F.replace(text, F.lit("@"), k))))
    return rows.select("k", "section", "body")


@query("""WITH b AS (SELECT c_custkey AS k, c_custkey % 6 AS v FROM customer) SELECT k, CASE v WHEN 0 THEN 'no json block' WHEN 1 THEN 'the json block is not valid' WHEN 2 THEN 'unknown keys: colour' WHEN 3 THEN 'missing: product' END AS error,
    CASE WHEN v >= 4 THEN 'P' || k END AS product, CASE v WHEN 4 THEN '20' WHEN 5 THEN '35' END AS setback FROM b""")
def profile_blocks(t: Tables) -> DataFrame:
    """Profiles in fenced JSON blocks with defaults, or why one can't be used."""
    k = F.col("c_custkey")
    block = one(("no block", "```json\n{\"product\": \n```", "```json\n{\"product\": \"P@\", \"colour\": \"red\"}\n```", "```json\n{\"setback\": 5}\n```", "x\n```json\n{\"product\": \"P@\"}\n```\ny", "```json\n{\"product\": \"P@\",\n \"setback\": 35}\n```"), k % 6)
    got = x.profile_block(F.replace(block, F.lit("@"), k.cast("string")), {"product": None, "setback": "20"}, ("product",))
    return t.customer.select(k.alias("k"), got.alias("p")).select("k", "p.error", F.col("p.values")["product"].alias("product"), F.col("p.values")["setback"].alias("setback"))


@query("""SELECT o_orderkey AS k, CASE WHEN o_orderkey % 7 = 0 THEN 'unknown audience' WHEN n_nationkey IS NULL THEN 'unknown provider'
        WHEN o_orderkey % 3 = 0 AND n_regionkey IN (0, 1) OR o_orderkey % 3 = 1 AND n_regionkey IN (1, 2) OR o_orderkey % 3 = 2 AND n_regionkey = 3 THEN NULL
        ELSE 'cleared for ' || ['client', 'client, internal', 'internal', 'public', ''][n_regionkey + 1] || ' only' END AS refusal
    FROM orders LEFT JOIN nation ON o_orderkey % 28 = n_nationkey""")
def audience_gate(t: Tables) -> DataFrame:
    """Why a base map may not be shown to an audience."""
    k = F.col("o_orderkey")
    asked = t.orders.select(k.alias("k"), (k % 28).cast("long").alias("provider"), F.when(k % 7 == 0, "press").otherwise(one(("client", "internal", "public"), k % 3)).alias("audience"))
    cleared = F.filter(F.split(one(("client", "internal,client", "internal", "public", ""), F.col("n_regionkey")), ","), lambda a: a != "")
    providers = t.nation.select(F.col("n_nationkey").cast("long").alias("provider"), cleared.alias("cleared_for"))
    return relational.audience_gate(asked, providers, "provider", "audience", ("client", "internal", "public")).select("k", "refusal")


@query("""WITH b AS (SELECT p_partkey AS k, -(p_partkey % 900) * 1e0 AS x0, -(p_partkey * 7 % 700) * 1e0 AS y0, (p_partkey * 3 % 800) * 1e0 AS x1, (p_partkey * 11 % 600) * 1e0 AS y1 FROM part)
    SELECT k, CASE WHEN sqrt(greatest(x0 * x0, x1 * x1) + greatest(y0 * y0, y1 * y1)) <= 800 THEN 'radius' ELSE 'box' END AS source FROM b""")
def overlay_source(t: Tables) -> DataFrame:
    """Whether a footprint's overlay may use the answer by radius or needs its own box."""
    k = F.col("p_partkey").cast("long")
    inside = overlay.answered_within(-(k % 900) * 1.0, -(k * 7 % 700) * 1.0, (k * 3 % 800) * 1.0, (k * 11 % 600) * 1.0, F.lit(800.0))
    return t.part.select(k.alias("k"), F.when(inside, "radius").otherwise("box").alias("source"))
