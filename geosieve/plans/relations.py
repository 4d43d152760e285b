"""Relational queries: validation, provenance, roll-ups, drift, overlays on a line."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from geosieve.functions import status
from geosieve.operators import relational as rel
from geosieve.plans.registry import Tables, query
from geosieve.sources.sites import classify

RAW_SQL = """raw AS (SELECT c_custkey AS row_no, CASE WHEN c_custkey % 23 = 0 THEN ' ' ELSE 'S' || (c_custkey - CASE WHEN c_custkey % 7 = 0 THEN 1 ELSE 0 END) END AS site_id,
    CASE WHEN c_custkey % 11 = 0 THEN '' WHEN c_custkey % 13 = 0 THEN 'abc' WHEN c_custkey % 17 = 0 THEN '95' WHEN c_custkey % 19 = 0 THEN '-100.5' WHEN c_custkey % 29 = 0 THEN '5.25' ELSE CAST(25 + c_custkey % 20 AS VARCHAR) || '.5' END AS lat,
    CASE WHEN c_custkey % 31 = 0 THEN '200' WHEN c_custkey % 37 = 0 THEN '10' ELSE '-' || CAST(70 + c_custkey % 50 AS VARCHAR) || '.25' END AS lng,
    CASE c_custkey % 6 WHEN 0 THEN '25 ac' WHEN 1 THEN '±25 acres' WHEN 2 THEN '1,200' WHEN 3 THEN '20-30' WHEN 4 THEN 'TBD' ELSE ' 12.5 ' END AS acres FROM customer)"""


def raw_sites(t: Tables) -> DataFrame:
    k = F.col("c_custkey").cast("long")
    text = lambda c: c.cast("string")
    every = lambda n: k % n == 0
    lat = F.when(every(11), "").when(every(13), "abc").when(every(17), "95").when(every(19), "-100.5").when(every(29), "5.25").otherwise(F.concat(text(25 + k % 20), F.lit(".5")))
    lng = F.when(every(31), "200").when(every(37), "10").otherwise(F.concat(F.lit("-"), text(70 + k % 50), F.lit(".25")))
    acres = F.element_at(F.array(*map(F.lit, ["25 ac", "±25 acres", "1,200", "20-30", "TBD", " 12.5 "])), (k % 6 + 1).cast("int"))
    site = F.when(every(23), " ").otherwise(F.concat(F.lit("S"), text(k - F.when(every(7), 1).otherwise(0))))
    return t.customer.select(k.alias("row_no"), site.alias("site_id"), lat.alias("lat"), lng.alias("lng"), acres.alias("acres"))


@query(f"""WITH {RAW_SQL}, checked AS (SELECT *, CASE WHEN trim(lat) = '' OR trim(lng) = '' THEN 'missing coordinate'
        WHEN try_cast(lat AS DOUBLE) IS NULL OR try_cast(lng AS DOUBLE) IS NULL THEN 'coordinate not a number'
        WHEN abs(CAST(lat AS DOUBLE)) > 90 OR abs(CAST(lng AS DOUBLE)) > 180 THEN 'coordinate out of range'
        WHEN CAST(lat AS DOUBLE) NOT BETWEEN 17 AND 72 OR CAST(lng AS DOUBLE) NOT BETWEEN -180 AND -64 THEN 'outside the area' END AS bad FROM raw),
    firsts AS (SELECT trim(site_id) AS id, min(row_no) AS first FROM checked WHERE trim(site_id) <> '' AND bad IS NULL GROUP BY 1)
    SELECT row_no, trim(site_id) AS site_id, CASE WHEN trim(site_id) = '' THEN 'blank id' WHEN first < row_no THEN 'duplicate id' ELSE bad END AS reject_reason,
        CAST(CASE acres WHEN '25 ac' THEN 25 WHEN '±25 acres' THEN 25 WHEN '1,200' THEN 1200 WHEN ' 12.5 ' THEN 12.5 END AS DOUBLE) AS acres_stated
    FROM checked LEFT JOIN firsts ON trim(site_id) = id""")
def site_validation(t: Tables) -> DataFrame:
    """Every raw site row with its first failing rule, or none."""
    return classify(raw_sites(t)).select("row_no", "site_id", "reject_reason", "acres_stated")


TIER_SQL = """gates(tier, producer) AS (VALUES ('L3','transmission'),('L3','substations'),('L3','metro'),('L3','facility'),('L3','housing'),('L4','metro'),('L4','facility'),('L4','housing'),('L5','metro'),('L5','facility')),
    fields AS (SELECT o_orderkey AS site_id, CASE left(o_orderpriority, 1) WHEN '1' THEN 'L1' WHEN '2' THEN 'L3' WHEN '3' THEN 'L4' WHEN '4' THEN 'L5' ELSE NULL END AS tier,
        unnest(['transmission', 'metro', 'flood']) AS producer, o_orderstatus AS answer, CAST(round(o_totalprice) AS BIGINT) AS measure FROM orders),
    long AS (SELECT site_id, coalesce(tier, 'L2') AS tier, producer, CASE WHEN coalesce(tier, 'L2') NOT IN ('L1', 'L2') AND NOT EXISTS (SELECT 1 FROM gates g WHERE g.tier = fields.tier AND g.producer = fields.producer) THEN 'not_assessable'
        WHEN answer = 'P' THEN 'failed' WHEN answer = 'O' AND measure % 5 = 0 THEN 'absent' ELSE 'ok' END AS status, measure FROM fields)"""
#: The producers that rough locations still allow.
TIER_ALLOWS = {"L3": ("transmission", "substations", "metro", "facility", "housing"), "L4": ("metro", "facility", "housing"), "L5": ("metro", "facility")}


def tier_records(t: Tables) -> DataFrame:
    tier = F.element_at(F.create_map(*[F.lit(x) for kv in (("1", "L1"), ("2", "L3"), ("3", "L4"), ("4", "L5")) for x in kv]), F.left("o_orderpriority", F.lit(1)))
    fields = t.orders.select(
        F.col("o_orderkey").alias("site_id"), F.coalesce(tier, F.lit("L2")).alias("tier"), F.explode(F.array(*map(F.lit, ("transmission", "metro", "flood")))).alias("producer"),
        F.col("o_orderstatus").alias("answer"), F.round("o_totalprice").cast("long").alias("measure"),
    )
    return fields.withColumn("status", F.when(~tier_allows(F.col("tier"), F.col("producer")), status.NOT_ASSESSABLE).otherwise(status.found(F.col("measure"), ~((F.col("answer") == "O") & (F.col("measure") % 5 == 0)), F.col("answer") == "P")))


def tier_allows(tier, producer):
    """Whether a location of a tier is good enough for a producer; a tier not listed allows all."""
    out = F.lit(True)
    for name, allowed in TIER_ALLOWS.items():
        out = F.when(tier == name, producer.isin(*allowed)).otherwise(out)
    return out


@query(f"""WITH {TIER_SQL} SELECT site_id, producer AS field, status, CASE WHEN status = 'ok' THEN CAST(measure AS VARCHAR) END AS value,
    CASE WHEN status = 'not_assessable' THEN 'location tier ' || tier || ' is too rough' WHEN tier IN ('L3', 'L4', 'L5') THEN concat_ws('; ', CASE WHEN status = 'absent' THEN 'nothing found' END, 'approximate location (' || tier || ')') WHEN status = 'absent' THEN 'nothing found' END AS note FROM long""")
def tier_gate_provenance(t: Tables) -> DataFrame:
    """Records of three producers a site, gated by location tier, rough tiers noted on every value."""
    rough = F.col("tier").isin(*TIER_ALLOWS)
    absent = F.when(F.col("status") == status.ABSENT, "nothing found")
    note = F.when(F.col("status") == status.NOT_ASSESSABLE, F.concat(F.lit("location tier "), "tier", F.lit(" is too rough")))
    note = note.when(rough, F.concat_ws("; ", absent, F.concat(F.lit("approximate location ("), "tier", F.lit(")")))).otherwise(absent)
    rows = tier_records(t).withColumn("r", status.record(F.col("measure"), F.col("status"), note=note))
    return rows.select("site_id", F.col("producer").alias("field"), "status", "r.value", "r.note")


@query(f"WITH {TIER_SQL} SELECT producer, status, count(*) AS n FROM long GROUP BY ALL")
def status_tally(t: Tables) -> DataFrame:
    """Records by producer and status."""
    return status.tally(tier_records(t), "producer")


@query(f"WITH {TIER_SQL} SELECT site_id, producer AS field, status FROM long WHERE status IN ('absent', 'failed')")
def gaps_report(t: Tables) -> DataFrame:
    """Absent and failed records, failed first."""
    return status.gaps(tier_records(t).select("site_id", F.col("producer").alias("field"), "status"), "site_id", "field")


@query(f"WITH {TIER_SQL} SELECT site_id, max(measure) FILTER (status = 'ok' AND producer = 'transmission') AS transmission, max(measure) FILTER (status = 'ok' AND producer = 'metro') AS metro, max(measure) FILTER (status = 'ok' AND producer = 'flood') AS flood FROM long GROUP BY site_id")
def wide_from_long(t: Tables) -> DataFrame:
    """One row a site and one column a field, null unless ok."""
    rows = tier_records(t).select("site_id", F.col("producer").alias("field"), F.when(F.col("status") == status.OK, F.col("measure")).alias("value"))
    return status.to_wide(rows, "site_id", ["transmission", "metro", "flood"])


@query("SELECT row_type, event_type, n FROM (SELECT 'mode' AS row_type, event_type, count(*) AS n FROM events GROUP BY event_type) WHERE n >= 0")
def layer_probe(t: Tables) -> DataFrame:
    """Distinct classes of a layer and their counts."""
    return t.events.groupBy("event_type").agg(F.count("*").alias("n")).select(F.lit("mode").alias("row_type"), "event_type", "n")


@query("""WITH e AS (SELECT user_id, event_id, ts, event_type, event_type <> 'error' AND event_id % 9 <> 0 AS ok FROM events)
    SELECT user_id, arg_max(epoch_us(ts), row(ts, event_id)) FILTER (ok) AS ts_us, max(row(ts, event_id))FILTER (ok)[2] AS event_id, arg_max(event_type, row(ts, event_id)) FILTER (ok) AS event_type,
        count(*) FILTER (ok) AS n_ok, count(*) FILTER (NOT ok) AS n_failed FROM e GROUP BY user_id""".replace("max(row(ts, event_id))FILTER (ok)[2]", "arg_max(event_id, row(ts, event_id)) FILTER (ok)"))
def latest_ok_per_key(t: Tables) -> DataFrame:
    """The latest good response of each key; failed ones are counted and never taken."""
    rows = t.events.withColumn("ts_us", F.unix_micros(F.col("ts").cast("timestamp")))
    ok = (F.col("event_type") != "error") & (F.col("event_id") % 9 != 0)
    return rel.latest_ok(rows, ["user_id"], ok, ["ts_us", "event_id"], ["event_type"])


@query("""WITH mid AS (SELECT min(epoch_us(ts)) // 2 + max(epoch_us(ts)) // 2 AS m FROM events),
    half AS (SELECT event_type, epoch_us(ts) <= m AS old, user_id % 3 AS vintage, event_id FROM events, mid),
    b AS (SELECT event_type, count(*) AS n, max(event_id) AS v FROM half WHERE old GROUP BY 1), c AS (SELECT event_type, count(*) AS n, max(event_id) AS v FROM half WHERE NOT old GROUP BY 1)
    SELECT coalesce(b.event_type, c.event_type) AS layer, b.n AS baseline_records, c.n AS current_records,
        concat_ws(',', CASE WHEN c.n IS NULL THEN 'unreachable' END, CASE WHEN b.n IS NULL THEN 'new' END, CASE WHEN b.n > 0 AND abs(c.n - b.n) > greatest(50e0, 0.05e0 * b.n) THEN 'records' END, CASE WHEN c.v <> b.v THEN 'vintage' END) AS flags
    FROM b FULL JOIN c ON b.event_type = c.event_type""")
def source_drift(t: Tables) -> DataFrame:
    """Layers of a baseline against those of today: unreachable, new, record counts, vintage."""
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    mid = t.events.select((F.expr("min(unix_micros(cast(ts as timestamp))) div 2") + F.expr("max(unix_micros(cast(ts as timestamp))) div 2")).alias("m"))
    rows = t.events.select("event_type", "event_id", us.alias("us")).join(F.broadcast(mid)).withColumn("old", F.col("us") <= F.col("m"))  # one row is sent
    side = lambda old, p: rows.where(F.col("old") == old).groupBy("event_type").agg(F.count("*").alias(f"{p}n"), F.max("event_id").alias(f"{p}v"))
    both = side(True, "b").join(side(False, "c"), "event_type", "full")
    return drift(both)


def drift(both: DataFrame) -> DataFrame:
    """Drift flags of layers with baseline (bn, bv) and current (cn, cv) records and vintage; a zero or absent baseline is not compared."""
    moved = (F.col("bn") > 0) & (F.abs(F.col("cn") - F.col("bn")) > F.greatest(F.lit(50.0), 0.05 * F.col("bn")))
    flags = F.concat_ws(
        ",",
        F.when(F.col("cn").isNull(), "unreachable"),
        F.when(F.col("bn").isNull(), "new"),
        F.when(moved, "records"),
        F.when(F.col("cv") != F.col("bv"), "vintage"),
    )
    return both.select(F.col("event_type").alias("layer"), F.col("bn").alias("baseline_records"), F.col("cn").alias("current_records"), flags.alias("flags"))


@query("""WITH county AS (SELECT n_nationkey AS nation, n_regionkey AS region, 'county-' || n_name AS service FROM nation WHERE n_nationkey IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 8000)), state AS (SELECT r_regionkey AS region, 'state-' || r_name AS service FROM region WHERE r_name <> 'ASIA')
    SELECT s_suppkey, CASE WHEN c.service IS NOT NULL THEN 'county' WHEN s.service IS NOT NULL THEN 'state' END AS scope, coalesce(c.service, s.service) AS service
    FROM supplier JOIN nation n ON s_nationkey = n_nationkey LEFT JOIN county c ON c.nation = n_nationkey LEFT JOIN state s ON s.region = n_regionkey""")
def hierarchical_lookup(t: Tables) -> DataFrame:
    """The county's service, else the state's, whole."""
    served = t.supplier.where("s_acctbal > 8000").select(F.col("s_nationkey").alias("n_nationkey")).distinct()
    county = t.nation.join(served, "n_nationkey", "left_semi").select(F.col("n_nationkey").alias("nation"), F.concat(F.lit("county-"), "n_name").alias("service"))
    state = t.region.where("r_name <> 'ASIA'").select(F.col("r_regionkey").alias("region"), F.concat(F.lit("state-"), "r_name").alias("service"))
    sites = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", F.col("n_nationkey").alias("nation"), F.col("n_regionkey").alias("region"))
    return rel.coalesce_levels(sites, [county, state], [["nation"], ["region"]], ["service"], "scope", ["county", "state"]).select("s_suppkey", "scope", "service")


ZONES_SQL = "covers AS (SELECT l_orderkey AS site, CAST(l_partkey % 60 AS BIGINT) AS lo, CAST(l_partkey % 60 + 1 + l_quantity AS BIGINT) AS hi, CAST(l_linenumber AS BIGINT) AS zone FROM lineitem)"


@query(f"""WITH {ZONES_SQL}, cells AS (SELECT site, unnest(range(lo, hi)) AS x, zone FROM covers), owned AS (SELECT site, x, min(zone) AS zone FROM cells GROUP BY ALL)
    SELECT site, zone, count(*) AS length, round(count(*) * 100e0 / 120, 2) AS pct FROM owned GROUP BY site, zone
    UNION ALL SELECT site, NULL, 120 - count(*), round((120 - count(*)) * 100e0 / 120, 2) FROM owned GROUP BY site""")
def severity_precedence_shares(t: Tables) -> DataFrame:
    """Shares of a site by zone, each without what more severe zones cover, and the unmapped rest; they add up to 100."""
    covers = t.lineitem.select(
        F.col("l_orderkey").alias("site"), (F.col("l_partkey") % 60).cast("long").alias("lo"), (F.col("l_partkey") % 60 + 1 + F.col("l_quantity")).cast("long").alias("hi"), F.col("l_linenumber").cast("long").alias("zone")
    )
    mapped = rel.precedence_shares(covers, ["site"], "lo", "hi", "zone")
    rest = mapped.groupBy("site").agg(F.sum("length").alias("m")).select("site", F.lit(None).cast("long").alias("zone"), F.greatest(F.lit(0), 120 - F.col("m")).cast("long").alias("length"))
    return mapped.unionByName(rest).withColumn("pct", F.round(F.col("length") * F.lit(100.0) / 120, 2))


@query("""SELECT coalesce(n_name, 'Total') AS market, count(*) AS sites, CAST(round(sum(CAST(round(o_totalprice * 100) AS BIGINT)) FILTER (o_orderstatus = 'F')) AS BIGINT) AS confirmed, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) FILTER (o_orderstatus = 'O') AS BIGINT) AS requested,
        CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) FILTER (o_orderstatus NOT IN ('F', 'O')) AS BIGINT) AS other, CAST(min(CAST(round(o_totalprice) AS BIGINT)) AS VARCHAR) || '-' || CAST(max(CAST(round(o_totalprice) AS BIGINT)) AS VARCHAR) AS size_range
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY GROUPING SETS ((n_name), ())""")
def market_rollup_total(t: Tables) -> DataFrame:
    """Sites and amounts by market, split by status, with a Total row and a range text."""
    cents, whole = F.round(F.col("o_totalprice") * 100).cast("long"), F.round("o_totalprice").cast("long")
    part = lambda where, name: F.sum(F.when(where, cents)).alias(name)
    st = F.col("o_orderstatus")
    rows = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).withColumnRenamed("n_name", "market")
    span = F.concat(F.min(whole).cast("string"), F.lit("-"), F.max(whole).cast("string"))
    return rel.with_total(rows, "market", [F.count("*").alias("sites"), part(st == "F", "confirmed"), part(st == "O", "requested"), part(~st.isin("F", "O"), "other"), span.alias("size_range")])


@query("""WITH c AS (SELECT l_suppkey AS source, l_returnflag || l_linestatus AS method, count(*) AS n, min(l_orderkey * 10 + l_linenumber) AS first FROM lineitem GROUP BY ALL),
    r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY n DESC, first) AS k FROM c) SELECT source, method AS common, n AS common_count FROM r WHERE k = 1""")
def mode_first_seen(t: Tables) -> DataFrame:
    """The most common method of each source, the first seen on ties."""
    rows = t.lineitem.select(F.col("l_suppkey").alias("source"), F.concat("l_returnflag", "l_linestatus").alias("method"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ordinal"))
    return rel.mode_first_seen(rows, ["source"], "method", "ordinal", "common")


@query("""WITH r AS (SELECT o_orderpriority AS kind, CAST(round(o_totalprice * 100) AS BIGINT) AS v, row_number() OVER (PARTITION BY o_orderpriority ORDER BY CAST(round(o_totalprice * 100) AS BIGINT)) AS k, count(*) OVER (PARTITION BY o_orderpriority) AS n FROM orders),
    q AS (SELECT *, unnest([1, 2, 3]) AS i FROM r), a AS (SELECT *, least(n - 1, greatest(1, (n + 1) * i // 4)) AS pos FROM q)
    SELECT kind, sum(v * CASE WHEN k = pos THEN 4 - ((n + 1) * i - pos * 4) WHEN k = pos + 1 THEN (n + 1) * i - pos * 4 END) FILTER (i = 1) / 4e0 AS p25, sum(v * CASE WHEN k = pos THEN 4 - ((n + 1) * i - pos * 4) WHEN k = pos + 1 THEN (n + 1) * i - pos * 4 END) FILTER (i = 2) / 4e0 AS p50,
        sum(v * CASE WHEN k = pos THEN 4 - ((n + 1) * i - pos * 4) WHEN k = pos + 1 THEN (n + 1) * i - pos * 4 END) FILTER (i = 3) / 4e0 AS p75 FROM a GROUP BY kind""")
def quartile_exclusive(t: Tables) -> DataFrame:
    """Exclusive quartiles, which the built-in percentile does not give."""
    rows = t.orders.select(F.col("o_orderpriority").alias("kind"), F.round(F.col("o_totalprice") * 100).cast("long").alias("v"))
    return rel.quantiles_exclusive(rows, ["kind"], "v", 4, ["p25", "p50", "p75"])


@query("""SELECT conv_id, turn, role, last_value(CASE WHEN role = 'user' THEN text END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn) AS section,
    lag(role) OVER (PARTITION BY conv_id ORDER BY turn) IS DISTINCT FROM role AS new_block FROM conversations""")
def forward_fill_sections(t: Tables) -> DataFrame:
    """Each row's section, the last banner above it, and where a block of another kind begins."""
    out = rel.forward_fill(t.conversations, ["conv_id"], "turn", F.when(F.col("role") == "user", F.col("text")), "section")
    before = F.lag("role").over(W.partitionBy("conv_id").orderBy("turn"))
    return out.select("conv_id", "turn", "role", "section", (~before.eqNullSafe(F.col("role"))).alias("new_block"))


@query("""SELECT doc_id, CASE WHEN trim(coalesce(text, '')) = '' THEN 0 ELSE n END AS dup_n, CASE WHEN trim(coalesce(text, '')) <> '' THEN first END AS first_doc
    FROM (SELECT doc_id, text, count(*) OVER p AS n, min(doc_id) OVER p AS first FROM documents WINDOW p AS (PARTITION BY md5(text)))""")
def duplicate_text_groups(t: Tables) -> DataFrame:
    """How many rows share each text, and the first of them; blank texts share with none."""
    # Grouped by digest with map-side parts, so neither the texts nor a hot text's rows are gathered.
    rows = t.documents.select("doc_id", F.md5("text").alias("h"), (F.trim(F.coalesce("text", F.lit(""))) == "").alias("blank"))
    groups = rows.groupBy("h").agg(F.count("*").alias("n"), F.min("doc_id").alias("first")).withColumnRenamed("h", "g")
    out = rows.join(groups, F.col("h").eqNullSafe(F.col("g")))
    return out.select("doc_id", F.when(F.col("blank"), 0).otherwise(F.col("n")).alias("dup_n"), F.when(~F.col("blank"), F.col("first")).alias("first_doc"))


@query("""WITH e AS (SELECT o_orderkey AS id, o_orderstatus AS state, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders), a AS (SELECT l_orderkey AS id, max(l_linestatus) AS state, CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS cents FROM lineitem GROUP BY 1)
    SELECT coalesce(e.id, a.id) AS id, CASE WHEN a.id IS NULL THEN 'missing' WHEN e.id IS NULL THEN 'extra' WHEN e.state IS NOT DISTINCT FROM a.state AND abs(e.cents - a.cents) <= 5000000 THEN 'same'
        ELSE concat_ws(',', CASE WHEN e.state IS DISTINCT FROM a.state THEN 'state' END, CASE WHEN abs(e.cents - a.cents) > 5000000 THEN 'cents' END) END AS verdict FROM e FULL JOIN a ON e.id = a.id""")
def tolerance_regression(t: Tables) -> DataFrame:
    """Expected against actual rows: missing, extra, fields that differ by more than a tolerance, or same."""
    cents = lambda c: F.round(F.col(c) * 100).cast("long")
    expected = t.orders.select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("state"), cents("o_totalprice").alias("cents"))
    actual = t.lineitem.groupBy(F.col("l_orderkey").alias("id")).agg(F.max("l_linestatus").alias("state"), F.sum(cents("l_extendedprice")).alias("cents"))
    return rel.compare(expected, actual, ["id"], ["state"], {"cents": 5_000_000})


@query("""WITH over AS (SELECT l_suppkey AS k, 'reviewed ' || count(*) AS owner, count(*) >= 12 AS forced FROM lineitem WHERE l_quantity = 50 GROUP BY 1)
    SELECT s_suppkey, CASE WHEN forced THEN coalesce(owner, base) ELSE coalesce(base, owner) END AS owner, over.k IS NOT NULL AS reviewed FROM (SELECT *, CASE WHEN s_acctbal >= 3000 THEN s_name END AS base FROM supplier) LEFT JOIN over ON k = s_suppkey""")
def upsert_overrides(t: Tables) -> DataFrame:
    """Reviewed values fill gaps, and forced ones win."""
    base = t.supplier.select("s_suppkey", F.when(F.col("s_acctbal") >= 3000, F.col("s_name")).alias("owner"))
    over = t.lineitem.where("l_quantity = 50").groupBy(F.col("l_suppkey").alias("s_suppkey")).agg(F.count("*").alias("n"))
    over = over.select("s_suppkey", F.concat(F.lit("reviewed "), F.col("n").cast("string")).alias("owner"), "n")
    return rel.upsert(base, over, ["s_suppkey"], ["owner"], F.col("n") >= 12)


@query("""WITH tries AS (SELECT l_orderkey AS k, CAST(l_linenumber AS BIGINT) AS source, l_returnflag <> 'N' AS hit, l_partkey AS parcel FROM lineitem)
    SELECT k, min(row(source, parcel)) FILTER (hit)[1] AS source, 0 AS parcel, 0 AS missed_before FROM tries GROUP BY k""".replace("min(row(source, parcel)) FILTER (hit)[1] AS source, 0 AS parcel, 0 AS missed_before FROM tries GROUP BY k", "b[1] AS source, b[2] AS parcel, n AS missed_before FROM (SELECT tries.k, any_value(b) AS b, count(DISTINCT source) FILTER (NOT hit AND (b IS NULL OR source < b[1])) AS n FROM tries LEFT JOIN (SELECT k, min(row(source, parcel)) AS b FROM tries WHERE hit GROUP BY k) x USING (k) GROUP BY tries.k)"))
def ordered_source_fallback(t: Tables) -> DataFrame:
    """The first source with a hit; earlier failures are counted, not fatal."""
    tries = t.lineitem.select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").cast("long").alias("source"), (F.col("l_returnflag") != "N").alias("hit"), F.col("l_partkey").alias("parcel"))
    return rel.first_source(tries, ["k"], "source", F.col("hit"), ["parcel"])


@query("""WITH files AS (SELECT 1 AS file, p_partkey % 500 AS id, p_partkey AS ordinal FROM part UNION ALL SELECT 2, s_suppkey % 700, s_suppkey FROM supplier)
    SELECT id, file, ordinal FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY file, ordinal) AS n FROM files) WHERE n = 1""")
def first_file_wins(t: Tables) -> DataFrame:
    """Several feature files as one, the earlier file and row winning an id."""
    one = t.part.select(F.lit(1).alias("file"), (F.col("p_partkey") % 500).alias("id"), F.col("p_partkey").alias("ordinal"))
    two = t.supplier.select(F.lit(2).alias("file"), (F.col("s_suppkey") % 700).alias("id"), F.col("s_suppkey").alias("ordinal"))
    return rel.first_by(one.unionByName(two), ["id"], [F.col("file"), F.col("ordinal")]).select("id", "file", "ordinal")


@query("""WITH items AS (SELECT p_partkey AS item, (p_partkey * 7 + 1) % 97 + 1 AS child FROM part UNION SELECT p_partkey, (p_partkey * 5) % 89 + 1 FROM part),
    kids AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY item ORDER BY child) AS n FROM items WHERE child <> item) WHERE n <= 6),
    two AS (SELECT item, child, 1 AS depth FROM kids UNION ALL SELECT a.item, b.child, 2 FROM kids a JOIN kids b ON a.child = b.item WHERE b.child <> a.item)
    SELECT item, child, min(depth) AS depth FROM two GROUP BY ALL""")
def item_traversal(t: Tables) -> DataFrame:
    """What an item refers to, and what that refers to: at most six children each, no cycles, the shorter way."""
    p = F.col("p_partkey")
    items = t.part.select(p.alias("item"), F.explode(F.array((p * 7 + 1) % 97 + 1, (p * 5) % 89 + 1)).alias("child")).distinct().where("child <> item")
    kids = items.withColumn("n", F.row_number().over(W.partitionBy("item").orderBy("child"))).where("n <= 6").drop("n")
    second = kids.select("item", F.col("child").alias("mid")).join(kids.toDF("mid", "child"), "mid").where("child <> item")
    both = kids.withColumn("depth", F.lit(1)).unionByName(second.select("item", "child", F.lit(2).alias("depth")))
    return both.groupBy("item", "child").agg(F.min("depth").alias("depth"))


@query("""SELECT o_orderpriority AS priority, string_agg(CAST(s AS VARCHAR), ', ' ORDER BY s) AS statuses, CAST(sum(n) AS BIGINT) AS n FROM (SELECT o_orderpriority, o_orderstatus AS s, count(*) AS n FROM orders GROUP BY ALL) GROUP BY 1""")
def cause_grouping(t: Tables) -> DataFrame:
    """Causes under each priority, with how many sites they hold."""
    counted = t.orders.groupBy(F.col("o_orderpriority").alias("priority"), F.col("o_orderstatus").alias("s")).agg(F.count("*").alias("n"))
    return counted.groupBy("priority").agg(F.array_join(F.array_sort(F.collect_list("s")), ", ").alias("statuses"), F.sum("n").alias("n"))


@query("""SELECT o_orderstatus AS outcome, count(*) FILTER (o_orderpriority = '1-URGENT') AS urgent, count(*) FILTER (o_orderpriority = '2-HIGH') AS high, count(*) FILTER (o_orderpriority NOT IN ('1-URGENT', '2-HIGH')) AS rest FROM orders GROUP BY 1""")
def outcome_crosstab(t: Tables) -> DataFrame:
    """Outcomes against priorities."""
    p = F.col("o_orderpriority")
    return t.orders.groupBy(F.col("o_orderstatus").alias("outcome")).agg(F.count_if(p == "1-URGENT").alias("urgent"), F.count_if(p == "2-HIGH").alias("high"), F.count_if(~p.isin("1-URGENT", "2-HIGH")).alias("rest"))


@query("""SELECT p_brand AS brand, count(*) FILTER (p_size >= 40) AS ge40, count(*) FILTER (p_size >= 30 AND p_size < 40) AS from30, count(*) FILTER (p_size >= 20 AND p_size < 30) AS from20, count(*) FILTER (p_size >= 10 AND p_size < 20) AS from10, count(*) FILTER (p_size < 10) AS under10, count(DISTINCT p_size) AS sizes FROM part GROUP BY 1""")
def band_histogram(t: Tables) -> DataFrame:
    """Counts by voltage-like band and distinct values."""
    s = F.col("p_size")
    bands = {"ge40": s >= 40, "from30": (s >= 30) & (s < 40), "from20": (s >= 20) & (s < 30), "from10": (s >= 10) & (s < 20), "under10": s < 10}
    return t.part.groupBy(F.col("p_brand").alias("brand")).agg(*[F.count_if(w).alias(n) for n, w in bands.items()], F.count_distinct("p_size").alias("sizes"))


@query("""SELECT p_type AS name, p_partkey AS part, p_size AS length, CAST(n AS INTEGER) AS place FROM (SELECT *, row_number() OVER (PARTITION BY p_type ORDER BY p_size DESC, p_partkey) AS n FROM (SELECT *, row_number() OVER (PARTITION BY p_type, p_brand ORDER BY p_size DESC, p_partkey) AS k FROM part WHERE p_size >= 5) WHERE k = 1) WHERE n <= 3""")
def label_selection(t: Tables) -> DataFrame:
    """The longest line of each name, and at most three names a map."""
    best = rel.first_by(t.part.where("p_size >= 5"), ["p_type", "p_brand"], [F.desc("p_size"), F.asc("p_partkey")])
    n = F.row_number().over(W.partitionBy("p_type").orderBy(F.desc("p_size"), "p_partkey"))
    return best.withColumn("place", n).where("place <= 3").select(F.col("p_type").alias("name"), F.col("p_partkey").alias("part"), F.col("p_size").alias("length"), "place")


@query("""WITH c AS (SELECT p_partkey AS parcel, p_size % 50 + 1 AS acres, p_brand AS owner, p_partkey % 4 = 0 AS adjacent, o.n_nationkey AS target, 10 + o.n_nationkey AS want, (p_partkey * 31) % 997 AS d FROM part JOIN nation o ON p_partkey % 25 = o.n_nationkey)
    SELECT target, parcel, CAST(k AS INTEGER) AS rank, n AS candidates, n > 5 AS too_many FROM (SELECT *, row_number() OVER (PARTITION BY target ORDER BY CASE WHEN adjacent THEN 0 ELSE 1 END, CASE WHEN owner = 'Brand#11' THEN 0 ELSE 1 END, abs(acres - want), d, parcel) AS k, count(*) OVER (PARTITION BY target) AS n FROM c WHERE abs(acres - want) * 100 <= 15 * want) WHERE k <= 5""")
def candidate_rank(t: Tables) -> DataFrame:
    """Candidate parcels within 15 % of an area, ranked by four keys; more than five is a status, not a cut."""
    rows = t.part.withColumn("target", (F.col("p_partkey") % 25).cast("int")).join(t.nation.select(F.col("n_nationkey").cast("int").alias("target")), "target")
    acres, want = F.col("p_size") % 50 + 1, 10 + F.col("target")
    rows = rows.withColumn("gap", F.abs(acres - want)).where(F.col("gap") * 100 <= 15 * want)
    order = W.partitionBy("target").orderBy((F.col("p_partkey") % 4 != 0), F.col("p_brand") != "Brand#11", "gap", F.col("p_partkey") * 31 % 997, "p_partkey")
    counted = rows.groupBy("target").agg(F.count("*").alias("candidates"))
    out = rows.withColumn("rank", F.row_number().over(order)).where("rank <= 5").join(counted, "target")
    return out.select("target", F.col("p_partkey").alias("parcel"), "rank", "candidates", (F.col("candidates") > 5).alias("too_many"))


@query("""WITH b AS (SELECT n_nationkey AS block, (n_nationkey % 5) * 10e0 AS x, (n_nationkey // 5) * 10e0 AS y, 100 + n_nationkey AS homes FROM nation)
    SELECT s_suppkey, round(sum(homes * greatest(0e0, least(x + 10, cx + 6) - greatest(x, cx - 6)) * greatest(0e0, least(y + 10, cy + 6) - greatest(y, cy - 6)) / 100), 3) AS homes_near
    FROM (SELECT s_suppkey, (s_suppkey * 7 % 50) * 1e0 AS cx, (s_suppkey * 13 % 50) * 1e0 AS cy FROM supplier), b GROUP BY s_suppkey""")
def areal_interpolation(t: Tables) -> DataFrame:
    """Homes within a box about each site, blocks counted by the part of their area that lies in it."""
    from geosieve.operators.overlay import box_overlap

    k = F.col("n_nationkey")
    blocks = t.nation.select((k % 5 * 10.0).alias("x0"), (F.floor(k / 5) * 10.0).alias("y0"), (100 + k).alias("homes"))
    touched = lambda c: F.explode(F.sequence(F.floor((F.col(c) - 6) / 10), F.floor((F.col(c) + 6) / 10)))
    sites = t.supplier.select("s_suppkey", (F.col("s_suppkey") * 7 % 50 * 1.0).alias("cx"), (F.col("s_suppkey") * 13 % 50 * 1.0).alias("cy"))
    sites = sites.withColumn("i", touched("cx")).withColumn("j", touched("cy")).withColumns({"x0": F.col("i") * 10.0, "y0": F.col("j") * 10.0})
    part = box_overlap(F.col("x0"), F.col("y0"), F.col("x0") + 10, F.col("y0") + 10, F.col("cx") - 6, F.col("cy") - 6, F.col("cx") + 6, F.col("cy") + 6) / 100
    return sites.join(blocks, ["x0", "y0"]).groupBy("s_suppkey").agg(F.round(F.sum(F.col("homes") * part), 3).alias("homes_near"))
