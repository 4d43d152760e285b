"""Rule queries: attributes derived from keys, rules from geosieve.functions.rules, the same decisions as SQL cases."""

from __future__ import annotations

from dataclasses import asdict

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geosieve.functions import rules as r
from geosieve.plans.registry import Tables, query

def keyed(t: Tables) -> DataFrame:
    return t.orders.select(F.col("o_orderkey").cast("long").alias("k"))


POWER_SQL = """p AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE (o_orderkey % 9) * 1e0 END AS mw, CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE (o_orderkey * 7) % 50 END AS months,
    o_orderkey % 5 = 0 AS requested, o_orderkey % 3 = 0 AS early, ['written', 'prescreen', 'utility estimate', 'verbal'][o_orderkey % 4 + 1] AS mw_tag, CASE WHEN o_orderkey % 7 < 4 THEN 'written' ELSE 'verbal' END AS date_tag,
    o_orderkey % 17 = 0 AS no_capacity, o_orderkey % 6 = 0 AS path FROM orders),
    c AS (SELECT *, CASE WHEN months IS NULL THEN CASE WHEN requested THEN CASE WHEN early THEN 2 ELSE 3 END ELSE 2 END WHEN months > 36 THEN 3 WHEN requested THEN 2 WHEN mw_tag = 'written' AND date_tag = 'written' AND months <= 12 THEN 0 WHEN mw_tag IN ('written', 'prescreen', 'utility estimate') THEN 1 ELSE 2 END AS certainty FROM p)"""


def power_score_sql(full: float = 5, mid: float = 3) -> str:
    return f"""CASE WHEN no_capacity THEN 1 WHEN mw IS NULL THEN NULL WHEN mw < 2 THEN CASE WHEN path THEN NULL ELSE 1 END
        ELSE greatest(CASE WHEN certainty <= 1 THEN 3 ELSE 1 END, 5 - CASE WHEN mw >= {full} THEN 0 WHEN mw >= {mid} THEN 1 ELSE 2 END - certainty) END"""


def power_rows(t: Tables) -> DataFrame:
    K = F.col("k")  # noqa: N806
    tags = F.array(*map(F.lit, ("written", "prescreen", "utility estimate", "verbal")))
    rows = keyed(t).select(
        "k", F.when(K % 13 != 0, K % 9 * 1.0).alias("mw"), F.when(K % 11 != 0, K * 7 % 50).alias("months"), (K % 5 == 0).alias("requested"), (K % 3 == 0).alias("early"),
        F.get(tags, (K % 4).cast("int")).alias("mw_tag"), F.when(K % 7 < 4, "written").otherwise("verbal").alias("date_tag"), (K % 17 == 0).alias("no_capacity"), (K % 6 == 0).alias("path"),
    )
    return rows.withColumn("certainty", r.certainty(*[F.col(c) for c in ("months", "requested", "early", "mw_tag", "date_tag")]))


def power_of(p: r.Parameters = r.Parameters()):
    return r.power_score(*[F.col(c) for c in ("mw", "certainty", "no_capacity", "path")], p)


@query(f"WITH {POWER_SQL} SELECT k, certainty, {power_score_sql()} AS power, CASE WHEN certainty = 0 THEN 'high' WHEN certainty = 1 THEN 'medium' ELSE 'low' END AS confidence FROM c")
def power_grid(t: Tables) -> DataFrame:
    """Certainty, power score and its confidence."""
    c = F.col("certainty")
    return power_rows(t).select("k", "certainty", power_of().alias("power"), F.when(c == 0, "high").when(c == 1, "medium").otherwise("low").alias("confidence"))


DIMS = ("power", "investment", "land", "site_control", "community", "connectivity", "market")
LEVELS = ("high", "medium", "low", "none")


def _dim_sql(i: int, d: str) -> str:
    return f"CASE WHEN (k * {i + 3}) % 17 < 2 THEN NULL ELSE (k * {2 * i + 7} // 3) % 5 + 1 END AS raw_{d}, ['high', 'medium', 'low', 'high', 'none', 'medium', 'high'][(k * {i + 5} // 7) % 7 + 1] AS conf_{d}"


def dim_rows(t: Tables) -> DataFrame:
    K = F.col("k")  # noqa: N806
    mixed = F.array(*map(F.lit, ("high", "medium", "low", "high", "none", "medium", "high")))
    rows = keyed(t)
    for i, d in enumerate(DIMS):
        rows = rows.withColumns({f"raw_{d}": F.when(K * (i + 3) % 17 >= 2, F.floor(K * (2 * i + 7) / 3) % 5 + 1).cast("int"), f"conf_{d}": F.get(mixed, (F.floor(K * (i + 5) / 7) % 7).cast("int"))})
    screens = lambda n, a: F.when(K % n == 0, "failed").when(K % n < a, "not assessed").otherwise("passed")
    return rows.withColumns({"risk": screens(29, 4), "control": screens(31, 3)} | {f"s_{d}": r.capped(F.col(f"raw_{d}"), F.col(f"conf_{d}")) for d in DIMS})


def dims_sql() -> str:
    cap = lambda d: f"CASE conf_{d} WHEN 'high' THEN raw_{d} WHEN 'medium' THEN CASE WHEN raw_{d} > 4 THEN 4 ELSE raw_{d} END WHEN 'low' THEN CASE WHEN raw_{d} > 3 THEN 3 ELSE raw_{d} END END AS s_{d}"
    return f"""d0 AS (SELECT o_orderkey AS k FROM orders), d1 AS (SELECT *, {", ".join(_dim_sql(i, d) for i, d in enumerate(DIMS))},
        CASE WHEN k % 29 = 0 THEN 'failed' WHEN k % 29 < 4 THEN 'not assessed' ELSE 'passed' END AS risk, CASE WHEN k % 31 = 0 THEN 'failed' WHEN k % 31 < 3 THEN 'not assessed' ELSE 'passed' END AS control FROM d0),
    d2 AS (SELECT *, {", ".join(cap(d) for d in DIMS)} FROM d1)"""


def priority_sql(high: int = 4, weak: int = 2, known: int = 2, out: str = "priority", source: str = "d2") -> str:
    """CTEs that end in one with ``out``."""
    le = lambda d, n: f"coalesce(s_{d} <= {n}, false)"
    sure = lambda d: f"conf_{d} IN ('high', 'medium')"
    count = lambda xs: " + ".join(f"CAST({x} AS INTEGER)" for x in xs)
    return f"""{out}1 AS (SELECT *, {le("community", 1)} AND {sure("community")} AS mora FROM {source}),
    {out}2 AS (SELECT *, CASE WHEN s_power >= {high} THEN 2 WHEN s_power >= 3 THEN 1 ELSE 0 END AS ceiling, {count([le("investment", weak), le("land", weak), le("site_control", weak), f"(NOT mora AND {le('community', weak)})"])} AS weak,
        {count([f"({le('connectivity', 1)} AND {sure('connectivity')})", f"({le('market', 1)} AND {sure('market')})"])} AS supp, {count([f"(s_{d} IS NOT NULL)" for d in ("investment", "land", "site_control")])} AS known FROM {out}1),
    {out}3 AS (SELECT *, greatest(0, CASE WHEN weak >= 2 THEN 0 WHEN weak = 1 THEN greatest(0, ceiling - 1) ELSE ceiling END - supp) AS level FROM {out}2),
    {out}4 AS (SELECT *, CASE WHEN mora THEN 0 WHEN level = 2 AND (risk <> 'passed' OR control <> 'passed' OR known < {known}
        OR NOT ((coalesce(s_investment >= 4, false) OR coalesce(s_land >= 4, false) OR coalesce(s_site_control >= 4, false)) AND NOT ({le("investment", 2)} OR {le("land", 2)} OR {le("site_control", 2)}))) THEN 1 ELSE level END AS final FROM {out}3),
    {out} AS (SELECT *, CASE WHEN risk = 'failed' OR control = 'failed' THEN 'Screened out' WHEN s_power IS NULL THEN 'Insufficient information' ELSE ['Low', 'Medium', 'High'][final + 1] END AS {out} FROM {out}4)"""


ADJUST_SQL = "CASE WHEN k % 4 = 0 THEN 1 ELSE 0 END - CASE WHEN k % 6 = 0 THEN 2 ELSE 0 END"
ASSIGNED_SQL = f"CASE WHEN priority IN ('Low', 'Medium', 'High') THEN ['Low', 'Medium', 'High'][least(2, greatest(0, list_position(['Low', 'Medium', 'High'], priority) - 1 + {ADJUST_SQL})) + 1] ELSE priority END"


def adjustments():
    K = F.col("k")  # noqa: N806
    one = lambda n, d, why: F.when(n, F.array(F.struct(F.lit(d).alias("dir"), F.lit(why).alias("reason")))).otherwise(F.array().cast("array<struct<dir:int,reason:string>>"))
    return F.concat(one(K % 4 == 0, 1, "large request"), one(K % 6 == 0, -1, "long lead"), one(K % 6 == 0, -1, "one access road"))


@query(f"WITH {dims_sql()}, {priority_sql()} SELECT k, priority AS indicated, {ASSIGNED_SQL} AS assigned FROM priority")
def priority_rules(t: Tables) -> DataFrame:
    """Indicated priority, and the assigned one after named adjustments."""
    rows = r.with_indicated(dim_rows(t), ("risk", "control"))
    return rows.select("k", F.col("indicated.priority").alias("indicated"), r.assigned(F.col("indicated.priority"), adjustments()).alias("assigned"))


@query(f"WITH {dims_sql()}, {priority_sql()}, {priority_sql(high=5, out='strict', source='d2')}, {priority_sql(weak=1, out='lenient', source='d2')}, {priority_sql(known=3, out='thorough', source='d2')} "
       "SELECT variant, baseline, outcome, count(*) AS flips FROM (SELECT 'power at 5' AS variant, a.priority AS baseline, b.strict AS outcome FROM priority a JOIN strict b USING (k) UNION ALL SELECT 'weak at 1', a.priority, b.lenient FROM priority a JOIN lenient b USING (k) "
       "UNION ALL SELECT 'three known', a.priority, b.thorough FROM priority a JOIN thorough b USING (k)) WHERE baseline <> outcome GROUP BY ALL")  # fmt: skip
def sensitivity_flips(t: Tables) -> DataFrame:
    """How often each varied parameter changes a priority, all variants in one pass."""
    variants = {"power at 5": r.Parameters(high_power=5), "weak at 1": r.Parameters(weak=1), "three known": r.Parameters(known_for_high=3)}
    own = lambda p: F.struct(*[F.lit(v).alias(n) for n, v in asdict(p).items()])
    each = F.array(*[F.struct(F.lit(n).alias("variant"), own(p).alias("p")) for n, p in variants.items()])
    rows = r.with_indicated(dim_rows(t), ("risk", "control"), out="baseline").withColumn("v", F.explode(each)).withColumn("p", F.col("v.p"))
    rows = r.with_indicated(rows, ("risk", "control"), out="varied", varied="p")
    rows = rows.select("v.variant", F.col("baseline.priority").alias("baseline"), F.col("varied.priority").alias("outcome"))
    # Counted before it is filtered: a filter on the outcome would be pushed down and write the rules out again.
    counted = rows.groupBy("variant", "baseline", "outcome").agg(F.count_if(F.col("outcome") != F.col("baseline")).alias("flips"))
    return counted.where("flips > 0")


@query("""WITH b AS (SELECT o_orderkey AS k, ['high', 'medium', 'low', 'none', 'sure'][o_orderkey % 5 + 1] AS confidence, o_orderkey // 5 % 5 + 1 AS score, CASE WHEN o_orderkey % 9 = 0 THEN 'maybe' ELSE 'passed' END AS screener, CASE WHEN o_orderkey % 14 = 0 THEN ' ' ELSE 'why' END AS reason, CASE WHEN o_orderkey % 21 = 0 THEN 2 ELSE 1 END AS dir,
        ['Low', 'Medium', 'High', 'Screened out'][o_orderkey % 4 + 1] AS indicated, CASE WHEN o_orderkey % 10 = 0 THEN 'Low' ELSE ['Medium', 'High', 'High', 'Screened out'][o_orderkey % 4 + 1] END AS assigned, CASE WHEN o_orderkey % 25 = 0 THEN '0' ELSE '1' END AS version FROM orders),
    w AS (SELECT *, CASE indicated WHEN 'Low' THEN CASE WHEN dir = 2 THEN 'High' ELSE 'Medium' END WHEN 'Screened out' THEN indicated ELSE 'High' END AS want FROM b),
    v AS (SELECT k, unnest([CASE WHEN confidence = 'sure' THEN 'confidence' END, CASE WHEN score > CASE confidence WHEN 'high' THEN 5 WHEN 'medium' THEN 4 WHEN 'low' THEN 3 ELSE 0 END THEN 'over its cap' END, CASE WHEN screener = 'maybe' THEN 'screener' END,
        CASE WHEN trim(reason) = '' THEN 'adjustment without reason' END, CASE WHEN dir <> 1 THEN 'adjustment over one step' END, CASE WHEN assigned <> want THEN 'assigned' END, CASE WHEN version <> '1' THEN 'version' END]) AS violation FROM w)
    SELECT k, violation FROM v WHERE violation IS NOT NULL""")
def ratings_validator(t: Tables) -> DataFrame:
    """Every rule that a rating row breaks."""
    K = F.col("k")  # noqa: N806
    text = lambda xs, i: F.get(F.array(*map(F.lit, xs)), i.cast("int"))
    rows = keyed(t).select(
        "k", text((*LEVELS, "sure"), K % 5).alias("confidence"), (F.floor(K / 5) % 5 + 1).cast("int").alias("score"), F.when(K % 9 == 0, "maybe").otherwise("passed").alias("screener"),
        F.array(F.struct(F.when(K % 21 == 0, 2).otherwise(1).alias("dir"), F.when(K % 14 == 0, " ").otherwise("why").alias("reason"))).alias("adjustments"), text(("Low", "Medium", "High", "Screened out"), K % 4).alias("indicated"),
        F.when(K % 10 == 0, "Low").otherwise(text(("Medium", "High", "High", "Screened out"), K % 4)).alias("assigned"), F.when(K % 25 == 0, "0").otherwise("1").alias("version"),
    )
    return r.rating_violations(rows, "k")


@query("""WITH b AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 8 = 0 THEN NULL ELSE o_totalprice / 10000 END AS cost, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE (o_orderkey % 12) * 1e0 END AS mw, CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE (o_orderkey % 30) / 4e0 END AS acres FROM orders)
    SELECT k, CASE WHEN cost IS NULL THEN NULL WHEN cost / greatest(2e0, coalesce(mw, 2e0)) <= 0.1 THEN 5 WHEN cost / greatest(2e0, coalesce(mw, 2e0)) <= 0.25 THEN 4 WHEN cost / greatest(2e0, coalesce(mw, 2e0)) <= 1 THEN 3 WHEN cost / greatest(2e0, coalesce(mw, 2e0)) <= 3.4 THEN 2 ELSE 1 END AS investment,
        CASE WHEN acres IS NULL THEN NULL WHEN acres >= greatest(1e0, 0.5e0 * coalesce(mw, 0e0)) THEN 4 ELSE 3 END AS land FROM b""")
def investment_and_land(t: Tables) -> DataFrame:
    """Investment and land scores."""
    K = F.col("k")  # noqa: N806
    cost, mw = F.when(K % 8 != 0, F.col("o_totalprice") / 10000), F.when(K % 7 != 0, K % 12 * 1.0)
    rows = t.orders.withColumn("k", F.col("o_orderkey"))
    return rows.select("k", r.investment_score(cost, mw).alias("investment"), r.land_score(F.when(K % 9 != 0, K % 30 / 4.0), mw).alias("land"))


@query("""WITH b AS (SELECT o_orderkey AS k, [NULL, 'by_right', 'rezoning', 'conditional', 'none', 'moratorium', 'unclear', 'other'][o_orderkey % 8 + 1] AS zoning, [NULL, 'positive', 'negative', 'mixed', NULL][o_orderkey % 5 + 1] AS news, (o_orderkey * 37) % 2000 AS receptor, (o_orderkey * 11) % 700 AS homes, o_orderkey % 3 <> 0 AS confirmed, CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE (o_orderkey * 13) % 130 END AS m1, CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE (o_orderkey * 17) % 60 END AS m2, (o_orderkey * 19) % 80 AS hub FROM orders)
    SELECT k, CASE WHEN zoning IS NULL AND news IS NULL THEN NULL WHEN zoning = 'moratorium' THEN 1 WHEN zoning = 'rezoning' OR news = 'negative' OR confirmed AND (receptor <= 305 OR homes > 500) THEN 2 WHEN zoning IN ('conditional', 'unclear') OR news = 'mixed' OR confirmed AND homes > 100 THEN 3 WHEN zoning IN ('by_right', 'none') AND confirmed AND receptor > 805 AND homes <= 25 THEN 5 ELSE 4 END AS community,
        CASE WHEN m1 IS NULL AND m2 IS NULL THEN NULL WHEN m1 <= 10 AND hub <= 25 THEN 5 WHEN m1 <= 25 AND hub <= 50 THEN 4 WHEN m1 <= 50 OR m2 <= 25 THEN 3 WHEN m1 <= 100 THEN 2 ELSE 1 END AS market FROM b""")
def community_and_market(t: Tables) -> DataFrame:
    """Community and market scores."""
    K = F.col("k")  # noqa: N806
    text = lambda xs, i: F.get(F.array(*map(F.lit, xs)), i.cast("int"))
    zoning, news = text((None, "by_right", "rezoning", "conditional", "none", "moratorium", "unclear", "other"), K % 8), text((None, "positive", "negative", "mixed", None), K % 5)
    community = r.community_score(zoning, news, K * 37 % 2000, K * 11 % 700, K % 3 != 0)
    return keyed(t).select("k", community.alias("community"), r.market_score(F.when(K % 6 != 0, K * 13 % 130), F.when(K % 4 != 0, K * 17 % 60), K * 19 % 80).alias("market"))


STATED_SQL = """b AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE (o_orderkey % 40 + 1) * 1e0 END AS stated, (o_orderkey * 7 % 45 + 1) * 1e0 AS measured, o_orderkey % 3 <> 0 AS precise, ['none', 'consistent', 'contradicted'][o_orderkey // 2 % 3 + 1] AS claim, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderkey % 8 END AS found,
        [NULL, 'L1', 'L2', 'L3', 'L4', 'L5'][o_orderkey % 6 + 1] AS tier, o_orderkey % 11 = 0 AS no_site FROM orders),
    v AS (SELECT *, CASE WHEN stated IS NULL THEN CASE WHEN precise THEN 'confirmed' ELSE 'needs_input' END WHEN precise AND claim = 'contradicted' THEN 'needs_input' WHEN precise AND abs(stated - measured) / stated <= 0.15 THEN 'confirmed' WHEN precise AND stated < measured THEN 'confirmed_partial carve-out' WHEN precise THEN 'confirmed_partial spans'
        WHEN abs(stated - measured) / stated <= 0.15 AND claim <> 'contradicted' THEN 'confirmed' WHEN found IS NULL THEN 'needs_input' WHEN found = 0 OR found > 5 THEN 'not_locatable' ELSE 'needs_input' END AS verdict FROM b)"""


def stated_rows(t: Tables) -> DataFrame:
    K = F.col("k")  # noqa: N806
    text = lambda xs, i: F.get(F.array(*map(F.lit, xs)), i.cast("int"))
    rows = keyed(t).select(
        "k", F.when(K % 6 != 0, (K % 40 + 1) * 1.0).alias("stated"), ((K * 7 % 45 + 1) * 1.0).alias("measured"), (K % 3 != 0).alias("precise"), text(("none", "consistent", "contradicted"), F.floor(K / 2) % 3).alias("claim"),
        F.when(K % 7 != 0, K % 8).alias("found"), text((None, "L1", "L2", "L3", "L4", "L5"), K % 6).alias("tier"), (K % 11 == 0).alias("no_site"),
    )
    return rows.withColumn("verdict", r.parcel_verdict(*[F.col(c) for c in ("stated", "measured", "precise", "claim", "found")]))


@query(f"WITH {STATED_SQL} SELECT k, verdict, stated IS NOT NULL AND abs(stated - measured) / stated > 0.25 AS conflict FROM v")
def parcel_verdict(t: Tables) -> DataFrame:
    """The parcel verdict, and whether stated and measured acres conflict."""
    return stated_rows(t).select("k", "verdict", r.conflict(F.col("stated"), F.col("measured")).alias("conflict"))


@query(f"""WITH {STATED_SQL} SELECT k, CASE WHEN tier IN ('L1', 'L2') THEN CASE WHEN k % 5 = 0 THEN 'confirmed' ELSE verdict END WHEN no_site THEN 'no_site' WHEN tier = 'L3' AND found IS NOT NULL THEN CASE WHEN found BETWEEN 1 AND 5 THEN 'needs_input' ELSE 'not_locatable' END ELSE 'not_locatable' END AS status FROM v""")
def location_status(t: Tables) -> DataFrame:
    """The status of each location; L1 and L2 without a parcel check are confirmed."""
    K = F.col("k")  # noqa: N806
    return stated_rows(t).select("k", r.location_status(F.col("tier"), F.when(K % 5 != 0, F.col("verdict")), F.col("no_site"), F.col("found")).alias("status"))


@query(f"""WITH {STATED_SQL}, c AS (SELECT *, k % 60 AS sfha, k % 30 AS wet, CASE WHEN k % 10 = 0 THEN NULL ELSE measured / 20 END AS acres FROM v), d AS (SELECT *, acres * (1 - least(1e0, (sfha + wet) / 100e0)) AS clear FROM c)
    SELECT k, CASE WHEN clear IS NULL THEN 'not assessed' WHEN verdict = 'confirmed' THEN CASE WHEN clear < 1 THEN 'failed' ELSE 'passed' END WHEN verdict = 'confirmed_partial spans' THEN CASE WHEN clear >= 1 THEN 'passed' ELSE 'not assessed' END WHEN verdict = 'confirmed_partial carve-out' THEN CASE WHEN clear < 1 THEN 'failed' ELSE 'not assessed' END ELSE 'not assessed' END AS site_risk FROM d""")
def site_risk_screener(t: Tables) -> DataFrame:
    """Whether enough ground is clear of flood zones and wetlands."""
    K = F.col("k")  # noqa: N806
    v = F.col("verdict")
    return stated_rows(t).select("k", r.site_risk(F.substring_index(v, " ", 1), v.endswith("carve-out"), F.when(K % 10 != 0, F.col("measured") / 20), (K % 60).cast("double"), (K % 30).cast("double")).alias("site_risk"))


@query("""WITH b AS (SELECT o_orderkey AS k, (o_orderkey * 29) % 700 AS d, CASE WHEN o_orderkey % 4 = 0 THEN (o_orderkey * 3) % 9 END AS host, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE (o_orderkey % 14) / 8e0 END AS mi FROM orders)
    SELECT k, CASE WHEN d <= 150 OR coalesce(host <= 3, false) THEN 'adjacent' WHEN d <= 400 THEN 'near' ELSE 'apart' END AS relation, CASE WHEN mi IS NULL THEN 'none' WHEN abs(mi - d / 1609.344e0) <= greatest(0.5e0, 0.5e0 * mi) THEN 'consistent' ELSE 'contradicted' END AS claim FROM b""")
def substation_relation(t: Tables) -> DataFrame:
    """How a parcel lies to a substation, and whether a claimed distance fits."""
    K = F.col("k")  # noqa: N806
    rel = r.substation_relation(K * 29 % 700, F.when(K % 4 == 0, K * 3 % 9), F.when(K % 3 != 0, K % 14 / 8.0))
    return keyed(t).select("k", rel["relation"].alias("relation"), rel["claim"].alias("claim"))


@query("""WITH b AS (SELECT p_partkey AS k, CASE p_partkey % 6 WHEN 0 THEN '-999999' WHEN 1 THEN 'x' WHEN 2 THEN '0' ELSE CAST(p_size * 10 AS VARCHAR) END AS v, CASE WHEN p_partkey % 4 = 0 THEN 'NOT AVAILABLE' ELSE '100-161' END AS band, p_size FROM part), c AS (SELECT *, CASE WHEN try_cast(v AS DOUBLE) > 0 THEN CAST(v AS DOUBLE) END AS kv FROM b)
    SELECT k, kv, CASE WHEN kv IS NOT NULL THEN 'numeric' WHEN band = '100-161' THEN 'class_band' ELSE 'not_published' END AS basis, CASE WHEN kv IS NULL THEN 'unknown' WHEN kv >= 400 THEN '400+' WHEN kv >= 300 THEN '300-400' WHEN kv >= 200 THEN '200-300' WHEN kv >= 100 THEN '100-200' ELSE '<100' END AS style,
        CASE WHEN kv IS NULL THEN 40e0 WHEN kv >= 345 THEN 60e0 WHEN kv >= 138 THEN 45e0 WHEN kv >= 69 THEN 30e0 ELSE 20e0 END AS row_width, coalesce(kv >= 100, band = '100-161') AS line_ok, coalesce(kv >= 115, false) AND k % 3 <> 0 AND k % 5 <> 0 AS sub_ok FROM c""")
def voltage_rules(t: Tables) -> DataFrame:
    """Voltage and its basis, style band, row width, and whether lines and substations qualify."""
    K = F.col("k")  # noqa: N806
    k = F.col("p_partkey")
    volts = F.when(k % 6 == 0, "-999999").when(k % 6 == 1, "x").when(k % 6 == 2, "0").otherwise((F.col("p_size") * 10).cast("string"))
    band = F.when(k % 4 == 0, "NOT AVAILABLE").otherwise("100-161")
    rows = t.part.select(k.alias("k"), r.kilovolts(volts, band).alias("v"), F.regexp_extract(band, r"^(\d+)", 1).try_cast("double").alias("band_kv")).select("k", "v.kv", "v.basis", "band_kv")
    kv = F.col("kv")
    status, kind = F.when(K % 3 == 0, "PROPOSED").otherwise("in service"), F.when(K % 5 == 0, "Tap").otherwise("SUBSTATION")
    return rows.select("k", "kv", "basis", r.voltage_band(kv).alias("style"), r.row_width(kv, [(0, 20.0), (69, 30.0), (138, 45.0), (345, 60.0)], 40.0).alias("row_width"), r.line_qualifies(kv, F.col("band_kv"), 100).alias("line_ok"), r.substation_qualifies(kv, status, kind, 115).alias("sub_ok"))


@query("""SELECT c_custkey AS k, CASE WHEN c_custkey % 5 = 0 THEN 'mapped' WHEN c_custkey % 7 = 0 THEN 'failed' WHEN c_custkey % 4 = 0 THEN 'area_not_included' WHEN c_custkey % 3 = 0 THEN 'no_nfhl_data' ELSE 'no_zone_returned' END AS determination FROM customer""")
def flood_determination(t: Tables) -> DataFrame:
    """Why each point has a flood zone or none."""
    k = F.col("c_custkey")
    return t.customer.select(k.alias("k"), r.flood_determination(k % 5 == 0, k % 7 == 0, k % 4 == 0, k % 3 != 0).alias("determination"))


VOCABULARY = {"power": {"mw": ("number", "MW"), "date": ("text", None)}, "land": {"acres": ("number", "ac")}}


@query("""WITH e AS (SELECT l_orderkey * 10 + l_linenumber AS id, ['power', 'power', 'land', 'water'][l_partkey % 4 + 1] AS dimension, ['mw', 'date', 'acres', 'depth'][l_partkey % 4 + 1] AS field, CASE WHEN l_suppkey % 5 = 0 THEN 'many' ELSE CAST(l_suppkey AS VARCHAR) END AS value, CASE WHEN l_suppkey % 6 = 0 THEN 'kW' ELSE [ 'MW', NULL, 'ac', NULL][l_partkey % 4 + 1] END AS unit, CASE WHEN l_linenumber = 7 THEN 'guess' ELSE 'actual' END AS kind FROM lineitem),
    v AS (SELECT id, unnest([CASE WHEN field = 'depth' THEN 'vocabulary' END, CASE WHEN field IN ('mw', 'acres') AND value = 'many' THEN 'type' END, CASE WHEN field = 'mw' AND unit <> 'MW' OR field = 'acres' AND unit <> 'ac' OR field = 'date' AND unit IS NOT NULL THEN 'unit' END, CASE WHEN kind = 'guess' THEN 'kind' END]) AS violation FROM e) SELECT id, violation FROM v WHERE violation IS NOT NULL""")
def evidence_validator(t: Tables) -> DataFrame:
    """Evidence rows against the vocabulary: unknown fields, wrong types, units and kinds."""
    text = lambda xs, i: F.get(F.array(*map(F.lit, xs)), i.cast("int"))
    p, s = F.col("l_partkey") % 4, F.col("l_suppkey")
    rows = t.lineitem.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), text(("power", "power", "land", "water"), p).alias("dimension"), text(("mw", "date", "acres", "depth"), p).alias("field"),
        F.when(s % 5 == 0, "many").otherwise(s.cast("string")).alias("value"), F.when(s % 6 == 0, "kW").otherwise(text(("MW", None, "ac", None), p)).alias("unit"), F.when(F.col("l_linenumber") == 7, "guess").otherwise("actual").alias("kind"),
    )
    known = [(d, f, kind, unit) for d, fields in VOCABULARY.items() for f, (kind, unit) in fields.items()]
    words = t.spark.createDataFrame(known, "dimension string, field string, want string, want_unit string")
    rows = rows.join(F.broadcast(words), ["dimension", "field"], "left")  # the vocabulary is a fixed few rows
    checks = {
        "vocabulary": F.col("want").isNull(),
        "type": (F.col("want") == "number") & F.col("value").try_cast("double").isNull(),
        "unit": F.col("want").isNotNull() & ~F.col("unit").eqNullSafe(F.col("want_unit")),
        "kind": ~F.col("kind").isin("actual", "target", "range_low", "range_high", "estimate"),
    }
    return rows.select("id", F.explode(F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in checks.items()]))).alias("violation"))


CAUSE = r.CAUSES


@query(f"""WITH {dims_sql()}, {priority_sql()}, m AS (SELECT *, s_connectivity = 1 AND {"conf_connectivity IN ('high', 'medium')"} AS w1, s_market = 1 AND conf_market IN ('high', 'medium') AS w2, risk <> 'passed' OR control <> 'passed' AS open_,
        CASE WHEN weak >= 2 THEN 0 WHEN weak = 1 THEN greatest(0, ceiling - 1) ELSE ceiling END AS after FROM priority),
    steps AS (SELECT *, list_concat(list_filter([{{'c': CASE ceiling WHEN 2 THEN '{CAUSE["ceiling_high"]}' WHEN 1 THEN '{CAUSE["ceiling_medium"]}' ELSE '{CAUSE["ceiling_low"]}' END, 'l': ceiling}},
        CASE WHEN weak >= 1 THEN {{'c': concat_ws(' + ', CASE WHEN s_investment <= 2 THEN '{CAUSE["investment"]}' END, CASE WHEN s_land <= 2 THEN '{CAUSE["land"]}' END, CASE WHEN s_site_control <= 2 THEN '{CAUSE["site_control"]}' END, CASE WHEN s_community <= 2 AND NOT mora THEN '{CAUSE["community"]}' END), 'l': after}} END,
        CASE WHEN w1 THEN {{'c': '{CAUSE["connectivity"]}', 'l': greatest(0, after - 1)}} END, CASE WHEN w2 THEN {{'c': '{CAUSE["market"]}', 'l': greatest(0, after - 1 - CASE WHEN w1 THEN 1 ELSE 0 END)}} END,
        CASE WHEN level = 2 AND open_ THEN {{'c': '{CAUSE["screeners"]}', 'l': 1}} WHEN level = 2 AND known < 2 THEN {{'c': '{CAUSE["known"]}', 'l': 1}} WHEN level = 2 AND NOT ((coalesce(s_investment >= 4, false) OR coalesce(s_land >= 4, false) OR coalesce(s_site_control >= 4, false)) AND NOT (coalesce(s_investment <= 2, false) OR coalesce(s_land <= 2, false) OR coalesce(s_site_control <= 2, false))) THEN {{'c': '{CAUSE["core"]}', 'l': 1}} END, CASE WHEN mora THEN {{'c': '{CAUSE["moratorium"]}', 'l': 0}} END], lambda x: x IS NOT NULL),
        list_filter([CASE WHEN k % 4 = 0 THEN {{'c': 'large request (up)', 'l': least(2, final + 1)}} END, CASE WHEN k % 6 = 0 THEN {{'c': 'long lead', 'l': greatest(0, least(2, final - 1 + CASE WHEN k % 4 = 0 THEN 1 ELSE 0 END))}} END,
            CASE WHEN k % 6 = 0 THEN {{'c': 'one access road', 'l': greatest(0, final - 2 + CASE WHEN k % 4 = 0 THEN 1 ELSE 0 END)}} END], lambda x: x IS NOT NULL)) AS s FROM m),
    c AS (SELECT *, [s[i].c for i in range(1, len(s) + 1) if s[i].l <> CASE WHEN i = 1 THEN 2 ELSE s[i - 1].l END] AS moved FROM steps)
    SELECT k, CASE WHEN priority = 'Screened out' THEN '{CAUSE["screened"]}' WHEN priority = 'Insufficient information' THEN '{CAUSE["no_power"]}' WHEN len(moved) = 0 THEN '{CAUSE["ceiling_high"]}' ELSE array_to_string(moved, ' > ') END AS causes,
        CASE WHEN priority = 'Screened out' THEN '' ELSE concat_ws('; ', CASE WHEN s_connectivity = 1 AND NOT coalesce(w1, false) THEN 'connectivity' END, CASE WHEN s_market = 1 AND NOT coalesce(w2, false) THEN 'market' END) END AS flagged FROM c""".replace("AS w1", "AS w1").replace("s_connectivity = 1 AND conf_", "coalesce(s_connectivity = 1, false) AND conf_").replace("s_market = 1 AND conf_", "coalesce(s_market = 1, false) AND conf_"))
def priority_causes(t: Tables) -> DataFrame:
    """Every step that moved a site's priority, adjustments included, in order, and the flags."""
    rows = r.with_indicated(dim_rows(t), ("risk", "control"), adjustments=adjustments())
    flagged = F.transform(F.col("indicated.flags"), lambda f: F.split(f, " ", 2)[0])
    return rows.select("k", F.array_join("indicated.causes", " > ").alias("causes"), F.array_join(flagged, "; ").alias("flagged"))


@query(f"""WITH {dims_sql()}, {priority_sql()}, c AS (SELECT k, priority, CASE WHEN priority IN ('Screened out', 'Insufficient information') THEN priority WHEN weak >= 2 THEN 'two weak' WHEN weak = 1 THEN 'one weak' ELSE 'none weak' END AS cause FROM priority),
    g AS (SELECT priority, cause, count(*) AS n, min(k) AS first FROM c GROUP BY ALL), f AS (SELECT priority, cause, k, row_number() OVER (PARTITION BY priority, cause ORDER BY k) AS i FROM c)
    SELECT g.priority, g.cause, n, string_agg(CAST(k AS VARCHAR), ', ' ORDER BY k) || CASE WHEN n > 5 THEN ' +' || (n - 5) || ' more' ELSE '' END AS sites, CAST(row_number() OVER (PARTITION BY g.priority ORDER BY n DESC, first) AS INTEGER) AS place FROM g JOIN f ON g.priority = f.priority AND g.cause = f.cause AND i <= 5 GROUP BY g.priority, g.cause, n, first""")
def cause_paths(t: Tables) -> DataFrame:
    """Priorities with the cause of each site, how many sites share it and which, the largest first."""
    rows = r.with_indicated(dim_rows(t), ("risk", "control"))

    def caused(s):
        weak = F.regexp_extract(F.array_join(s["reasons"], ";"), r"(\d) weak", 1)
        cause = F.when(s["priority"].isin(r.SCREENED, r.INSUFFICIENT), s["priority"]).when(weak == "", "none weak").when(weak == "1", "one weak").otherwise("two weak")
        return F.struct(s["priority"].alias("priority"), cause.alias("cause"))

    # Inlined, so that the rules are worked out once and not written out again for each use of their result.
    return cause_groups(rows.select("k", F.inline(F.transform(F.array("indicated"), caused))))


def cause_groups(rows: DataFrame, listed: int = 5) -> DataFrame:
    """rows(k, priority, cause) by priority and cause: how many, the first few keys with how many more, and the place by number, then first key."""
    from pyspark.sql.window import Window as W

    counted = rows.groupBy("priority", "cause").agg(F.count("*").alias("n"), F.min("k").alias("first"))
    # The first few keys: a rank within the group that stops early, not a list of the group.
    few = rows.withColumn("i", F.row_number().over(W.partitionBy("priority", "cause").orderBy("k"))).where(F.col("i") <= listed)
    few = few.groupBy("priority", "cause").agg(F.array_sort(F.collect_list("k")).alias("few"))
    more = F.when(F.col("n") > listed, F.concat(F.lit(" +"), (F.col("n") - listed).cast("string"), F.lit(" more"))).otherwise("")
    place = F.row_number().over(W.partitionBy("priority").orderBy(F.desc("n"), "first"))
    sites = F.concat(F.array_join(F.transform("few", lambda k: k.cast("string")), ", "), more)
    return counted.join(few, ["priority", "cause"]).select("priority", "cause", "n", sites.alias("sites"), place.alias("place"))


#: The thresholds moved one notch each.
OVERRIDES = {
    "near window 6 months": {"near_months": 6}, "near window 18 months": {"near_months": 18}, "far window 30 months": {"far_months": 30}, "far window 42 months": {"far_months": 42},
    "full at 4 MW": {"full_mw": 4.0}, "full at 7.5 MW": {"full_mw": 7.5}, "step at 2.5 MW": {"mid_mw": 2.5}, "land 0.3 ac/MW": {"acres_a_mw": 0.3}, "land 0.7 ac/MW": {"acres_a_mw": 0.7}, "audit off": {"audit_mw": 1e9},
}
RATED = "CASE WHEN k % 10 = 0 THEN NULL ELSE (k % 17) / 4e0 END"


def _rated_sql(name: str, over: dict) -> str:
    """CTEs that end in one with the assigned priority under some parameters."""
    v = {"near_months": 12, "far_months": 36, "full_mw": 5, "mid_mw": 3, "acres_a_mw": 0.5, "audit_mw": 25} | over
    sure = f"CASE WHEN months IS NULL THEN CASE WHEN requested THEN CASE WHEN early THEN 2 ELSE 3 END ELSE 2 END WHEN months > {v['far_months']} THEN 3 WHEN requested THEN 2 WHEN mw_tag = 'written' AND date_tag = 'written' AND months <= {v['near_months']} THEN 0 WHEN mw_tag IN ('written', 'prescreen', 'utility estimate') THEN 1 ELSE 2 END"
    keep = "k, risk, control, " + ", ".join(f"s_{d}, conf_{d}" for d in DIMS if d not in ("power", "land"))
    return f"""{name}_a AS (SELECT *, {sure} AS certainty FROM p), {name}_b AS (SELECT *, {power_score_sql(v["full_mw"], v["mid_mw"])} AS raw FROM {name}_a),
    {name}_c AS (SELECT {keep.replace("k,", "d2.k,", 1)}, mw, CASE certainty WHEN 0 THEN raw WHEN 1 THEN least(raw, CASE WHEN raw IS NOT NULL THEN 4 END) ELSE least(raw, CASE WHEN raw IS NOT NULL THEN 3 END) END AS s_power, CASE certainty WHEN 0 THEN 'high' WHEN 1 THEN 'medium' ELSE 'low' END AS conf_power,
        CASE WHEN d2.k % 10 = 0 THEN NULL WHEN (d2.k % 17) / 4e0 >= greatest(1e0, {v["acres_a_mw"]}e0 * coalesce(mw, 0e0)) THEN 4 ELSE 3 END AS s_land, 'medium' AS conf_land FROM d2 JOIN {name}_b USING (k)),
    {priority_sql(out=name, source=f"{name}_c")},
    {name}_z AS (SELECT k, CASE WHEN {name} IN ('Low', 'Medium', 'High') AND mw * 5 >= {v["audit_mw"]} THEN ['Low', 'Low', 'Medium'][list_position(['Low', 'Medium', 'High'], {name})] ELSE {name} END AS assigned FROM {name})"""


@query(f"WITH {dims_sql()}, {POWER_SQL}, {_rated_sql('baseline', {})}, " + ", ".join(_rated_sql(f"v{i}", o) for i, o in enumerate(OVERRIDES.values()))
       + " SELECT variant, before, outcome, count(*) AS flips FROM (" + " UNION ALL ".join(f"SELECT '{n}' AS variant, a.assigned AS before, b.assigned AS outcome FROM baseline_z a JOIN v{i}_z b USING (k)" for i, n in enumerate(OVERRIDES)) + ") WHERE before <> outcome GROUP BY ALL")
def sensitivity_overrides(t: Tables) -> DataFrame:
    """How often each of ten moved thresholds changes an assigned priority, the whole rating run again for each."""
    base = r.Parameters()
    own = lambda p: F.struct(*[F.lit(v).alias(n) for n, v in asdict(p).items()])
    variants = {"": base} | {n: r.Parameters(**(asdict(base) | o)) for n, o in OVERRIDES.items()}
    each = F.array(*[F.struct(F.lit(n).alias("variant"), own(p).alias("p")) for n, p in variants.items()])
    rows = dim_rows(t).drop("s_power", "conf_power", "s_land", "conf_land").join(power_rows(t).drop("certainty"), "k")
    rows = rows.withColumn("v", F.explode(each)).withColumns({"p": F.col("v.p"), "variant": F.col("v.variant")})
    rows = rows.withColumn("certainty", r.certainty(*[F.col(c) for c in ("months", "requested", "early", "mw_tag", "date_tag")], "p"))
    c, K = F.col("certainty"), F.col("k")  # noqa: N806
    rows = rows.withColumns({"conf_power": F.when(c == 0, "high").when(c == 1, "medium").otherwise("low"), "conf_land": F.lit("medium")})
    score = r.power_score(*[F.col(x) for x in ("mw", "certainty", "no_capacity", "path")], "p")
    land = r.land_score(F.when(K % 10 != 0, K % 17 / 4.0), F.col("mw"), "p")
    rows = rows.withColumns({"s_power": r.capped(score, F.col("conf_power")), "s_land": r.capped(land, F.lit("medium")), "changes": r.audit_adjustment(F.col("mw") * 5, "p")})
    rows = r.with_indicated(rows, ("risk", "control"), varied="p")
    rated = rows.select("k", "variant", r.assigned(F.col("indicated.priority"), F.col("changes")).alias("outcome"))
    # A priority is one of a few words: variants are counted against the baseline in one grouped pass by key.
    by_key = rated.groupBy("k").agg(F.max(F.when(F.col("variant") == "", F.col("outcome"))).alias("before"), F.collect_list(F.struct("variant", "outcome")).alias("all"))  # eleven a key
    flat = by_key.select("before", F.inline("all")).where("variant <> ''")
    counted = flat.groupBy("variant", "before", "outcome").agg(F.count("*").alias("flips"))
    return counted.where("before <> outcome")


@query("""WITH b AS (SELECT o_orderkey AS k, [NULL, 'under_contract', 'owner_identified', 'loi_or_negotiating', 'no_site_yet', 'other'][o_orderkey % 6 + 1] AS stage, CASE WHEN o_orderkey % 4 = 0 THEN 'signed LOI' ELSE 'LOIs in talks' END AS quote, CASE WHEN o_orderkey % 13 = 0 THEN 2 END AS reading,
        CASE WHEN o_orderkey % 3 = 0 THEN 'quoted' WHEN o_orderkey % 3 = 1 THEN 'nearby' END AS status, o_orderkey % 4 AS carriers, o_orderkey % 5 = 0 AS routes, [NULL, 'Level 1', 'desktop', 'Level 2'][o_orderkey % 4 + 1] AS level, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderkey % 4 END AS providers,
        ['by_right', 'no_zoning', 'unclear', 'conditional'][o_orderkey % 4 + 1] AS zoning, CASE WHEN o_orderkey % 5 = 0 THEN 'written' ELSE 'verbal' END AS tag, o_orderkey % 3 <> 0 AS confirmed, ['none', 'negative', 'mixed', NULL][o_orderkey // 4 % 4 + 1] AS news FROM orders),
    c AS (SELECT *, coalesce(reading, CASE stage WHEN 'under_contract' THEN 5 WHEN 'owner_identified' THEN 3 WHEN 'loi_or_negotiating' THEN CASE WHEN k % 4 = 0 THEN 4 ELSE 3 END WHEN 'no_site_yet' THEN 1 END) AS control, CASE WHEN zoning = 'no_zoning' OR tag = 'written' THEN 3 WHEN zoning = 'unclear' THEN 1 ELSE 2 END AS z FROM b)
    SELECT k, control AS control_score, CASE WHEN control IS NULL THEN 'none' ELSE 'medium' END AS control_confidence, CASE WHEN status = 'quoted' THEN CASE WHEN carriers >= 2 THEN 5 WHEN routes THEN 4 ELSE 3 END ELSE CASE WHEN providers IS NULL THEN NULL WHEN providers >= 2 THEN 3 WHEN providers = 1 THEN 2 ELSE 1 END END AS link_score,
        CASE WHEN status = 'quoted' THEN CASE WHEN level = 'Level 2' THEN 'high' ELSE 'medium' END WHEN providers IS NULL THEN 'none' ELSE 'low' END AS link_confidence,
        ['low', 'medium', 'high'][greatest(least(z, CASE WHEN confirmed THEN 3 ELSE 2 END), CASE WHEN news IN ('negative', 'moratorium') THEN 2 ELSE 1 END)] AS community_confidence FROM c""".replace("news IN ('negative', 'moratorium') THEN 2 ELSE 1", "coalesce(news = 'negative', false) THEN 2 ELSE 1"))
def control_and_connectivity(t: Tables) -> DataFrame:
    """Site control by stage, connectivity by quote or providers, and how sure a community score is."""
    K = F.col("k")  # noqa: N806
    one = lambda xs, i: F.get(F.array(*map(F.lit, xs)), i.cast("int"))
    control = r.site_control(one((None, "under_contract", "owner_identified", "loi_or_negotiating", "no_site_yet", "other"), K % 6), F.when(K % 4 == 0, "signed LOI").otherwise("LOIs in talks"), F.when(K % 13 == 0, 2))
    link = r.connectivity(F.when(K % 3 == 0, "quoted").when(K % 3 == 1, "nearby"), K % 4, K % 5 == 0, one((None, "Level 1", "desktop", "Level 2"), K % 4), F.when(K % 7 != 0, K % 4))
    community = r.community_confidence(one(("by_right", "no_zoning", "unclear", "conditional"), K % 4), F.when(K % 5 == 0, "written").otherwise("verbal"), K % 3 != 0, one(("none", "negative", "mixed", None), F.floor(K / 4) % 4))
    return keyed(t).select("k", control["score"].alias("control_score"), control["confidence"].alias("control_confidence"), link["score"].alias("link_score"), link["confidence"].alias("link_confidence"), community.alias("community_confidence"))


@query("""WITH p AS (SELECT l_orderkey AS k, CAST(l_linenumber AS BIGINT) * 1000000000 + l_partkey * 10000 + l_suppkey AS i, (l_partkey % 9) * 1e0 AS mw, CASE WHEN l_suppkey % 6 = 0 THEN NULL ELSE l_partkey % 50 END AS months, l_suppkey % 5 = 0 AS requested, l_suppkey % 3 = 0 AS early, CASE WHEN l_partkey % 2 = 0 THEN 'written' ELSE 'verbal' END AS mw_tag, CASE WHEN l_partkey % 3 = 0 THEN 'written' ELSE 'verbal' END AS date_tag FROM lineitem),
    c AS (SELECT *, CASE WHEN months IS NULL THEN CASE WHEN requested THEN CASE WHEN early THEN 2 ELSE 3 END ELSE 2 END WHEN months > 36 THEN 3 WHEN requested THEN 2 WHEN mw_tag = 'written' AND date_tag = 'written' AND months <= 12 THEN 0 WHEN mw_tag = 'written' THEN 1 ELSE 2 END AS certainty FROM p),
    s AS (SELECT *, CASE WHEN mw < 2 THEN 1 ELSE greatest(CASE WHEN certainty <= 1 THEN 3 ELSE 1 END, 5 - CASE WHEN mw >= 5 THEN 0 WHEN mw >= 3 THEN 1 ELSE 2 END - certainty) END AS score FROM c)
    SELECT k, CAST(score AS INTEGER) AS score, mw, CAST(months AS BIGINT) AS months, CAST(certainty AS INTEGER) AS certainty FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY score DESC, i) AS n FROM s) WHERE n = 1""")
def phased_power(t: Tables) -> DataFrame:
    """The best phase of each order's lines as phases of its power, the first of equally good ones."""
    p, s = F.col("l_partkey"), F.col("l_suppkey")
    tag = lambda c: F.when(c, "written").otherwise("verbal")
    rows = t.lineitem.select(F.col("l_orderkey").alias("k"), (F.col("l_linenumber").cast("long") * 1000000000 + p * 10000 + s).alias("i"), (p % 9 * 1.0).alias("mw"), F.when(s % 6 != 0, p % 50).cast("long").alias("months"), (s % 5 == 0).alias("requested"), (s % 3 == 0).alias("early"), tag(p % 2 == 0).alias("mw_tag"), tag(p % 3 == 0).alias("date_tag"))
    return r.best_phase(rows, "k", "i")
