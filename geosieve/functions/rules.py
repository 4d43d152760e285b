"""The rating rules as column expressions: scores, caps, priority, location and parcel verdicts.

Confidence is high, medium, low or none; an unknown score is null. Decision
tables are read from the top, the first match wins.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

METHOD_VERSION = "1"
#: The most a confidence lets a score be.
CAPS = {"high": 5, "medium": 4, "low": 3}
PRIORITIES = ("Low", "Medium", "High")
SCREENED, INSUFFICIENT = "Screened out", "Insufficient information"
IMPORTANT, SUPPORTING = ("investment", "land", "site_control", "community"), ("connectivity", "market")
CARRYING = ("investment", "land", "site_control")
#: The wording of what moved a priority.
CAUSES = {
    "ceiling_high": "pass on every key dimension",
    "ceiling_medium": "power not firm near term (Power 3)",
    "ceiling_low": "power too little or too late (Power 2 or below)",
    "investment": "high cost to get ready",
    "land": "not enough buildable land",
    "site_control": "no site control",
    "community": "community opposition or close neighbors",
    "connectivity": "weak connectivity",
    "market": "far from a major market",
    "screeners": "site risk not checked",
    "known": "too little site information",
    "core": "cost, land and site control not strong enough for High",
    "moratorium": "local moratorium",
    "no_power": "no power information",
    "screened": "failed a screener",
}
#: What a stage of site control scores, but for letters of intent and negotiations.
STAGES = {"under_contract": 5, "owner_identified": 3, "tract_identified": 3, "no_site_yet": 1, "no_site_control": 1}


@dataclass(frozen=True)
class Parameters:
    """Thresholds that sensitivity runs vary."""

    full_mw: float = 5.0
    mid_mw: float = 3.0
    least_mw: float = 2.0
    high_power: int = 4
    weak: int = 2
    most_weak: int = 2
    known_for_high: int = 2
    strong: int = 4
    near_months: int = 12
    far_months: int = 36
    acres_a_mw: float = 0.5
    audit_mw: float = 25.0


def parameter(name: str, p: Parameters | str) -> Column:
    """A parameter's value, or a row's own where p names a struct column with Parameters."""
    return F.col(f"{p}.{name}") if isinstance(p, str) else F.lit(getattr(p, name))


def power_score(mw: Column, certainty: Column, no_capacity: Column, path_to_more: Column, p: Parameters | str = Parameters()) -> Column:
    """5 less a step for the amount and one for each level of certainty (0 to 3), at least 3 for the two surest."""
    step = F.when(mw >= parameter("full_mw", p), 0).when(mw >= parameter("mid_mw", p), 1).otherwise(2)
    base = F.greatest(F.lit(1), 5 - step - certainty)
    score = F.when(certainty <= 1, F.greatest(F.lit(3), base)).otherwise(base)
    return (
        F.when(no_capacity, 1)
        .when(mw.isNull() | certainty.isNull(), F.lit(None))
        .when(mw < parameter("least_mw", p), F.when(path_to_more, F.lit(None)).otherwise(1))
        .otherwise(score)
    ).cast("int")


def certainty(months: Column, requested: Column, early: Column, mw_tag: Column, date_tag: Column, p: Parameters | str = Parameters()) -> Column:
    """0 (written, near) to 3 (far or only asked for). early: the timing speaks of a near term or a study."""
    dated = (
        F.when(months > parameter("far_months", p), 3)
        .when(requested, 2)
        .when((mw_tag == "written") & (date_tag == "written") & (months <= parameter("near_months", p)), 0)
        .when(mw_tag.isin("written", "prescreen", "utility estimate"), 1)
        .otherwise(2)
    )
    undated = F.when(requested, F.when(early, 2).otherwise(3)).otherwise(2)
    return F.when(months.isNull(), undated).otherwise(dated).cast("int")


def capped(score: Column, confidence: Column) -> Column:
    """A score no higher than its confidence allows; none makes it unknown."""
    cap = F.element_at(F.create_map(*[F.lit(x) for kv in CAPS.items() for x in kv]), confidence)
    return F.when(cap.isNotNull(), F.least(score, F.when(score.isNotNull(), cap))).cast("int")


def with_indicated(df: DataFrame, screeners: tuple[str, ...], p: Parameters = Parameters(), out: str = "indicated", prefix: str = "s_", confidence: str = "conf_", varied: str | None = None, adjustments: Column | None = None) -> DataFrame:
    """Add ``out``, struct(priority, reasons, flags), with adjustments also causes: screens, then power's ceiling, then steps down and caps, in order.

    Flags name weak supporting dimensions that nothing sure is known of. Causes
    are what moved the priority, in order, the adjustments given included.

    Capped scores are in prefix + dimension, confidences in confidence +
    dimension; screeners are passed, failed or not assessed. ``varied`` names a
    struct column with Parameters of a row's own. Steps are columns of their
    own, so no step's expression is written out again in those after it.
    """
    param = lambda n: parameter(n, varied or p)
    score = lambda d: F.col(prefix + d)
    sure = lambda d: F.coalesce(F.col(confidence + d).isin("high", "medium"), F.lit(False))
    low = lambda d, n: F.coalesce(score(d) <= n, F.lit(False))
    add = lambda xs: sum((x.cast("int") for x in xs), F.lit(0))
    any_ = lambda xs: F.coalesce(F.greatest(*xs, F.lit(False)), F.lit(False))
    df = df.withColumn("_moratorium", low("community", 1) & sure("community"))
    df = df.withColumns(
        {
            "_ceiling": F.when(score("power") >= param("high_power"), 2).when(score("power") >= 3, 1).otherwise(0),
            "_weak": add(low(d, param("weak")) & (~F.col("_moratorium") if d == "community" else F.lit(True)) for d in IMPORTANT),
            "_supporting": add(low(d, 1) & sure(d) for d in SUPPORTING),
            "_open": any_([F.col(s) != "passed" for s in screeners]),
            "_failed": any_([F.col(s) == "failed" for s in screeners]),
            "_few": add(score(d).isNotNull() for d in CARRYING) < param("known_for_high"),
            "_idle": ~(any_([score(d) >= param("strong") for d in CARRYING]) & ~any_([low(d, 2) for d in CARRYING])),
        }
    )
    step = F.when(F.col("_weak") >= param("most_weak"), 0).when(F.col("_weak") == 1, F.greatest(F.lit(0), F.col("_ceiling") - 1)).otherwise(F.col("_ceiling"))
    df = df.withColumn("_level", F.greatest(F.lit(0), step - F.col("_supporting")))
    capping = {"_open": "a screener is not passed", "_few": "too little is known", "_idle": "nothing carries it"}
    high = F.col("_level") == 2
    df = df.withColumn("_final", F.when(F.col("_moratorium"), 0).when(high & any_([F.col(c) for c in capping]), 1).otherwise(F.col("_level")))
    reasons = F.array_compact(
        F.array(
            F.concat(F.lit("power "), score("power").cast("string")),
            F.when(F.col("_weak") >= 1, F.concat(F.col("_weak").cast("string"), F.lit(" weak"))),
            F.when(F.col("_supporting") >= 1, F.concat(F.col("_supporting").cast("string"), F.lit(" supporting at 1"))),
            *[F.when(high & F.col(c), why) for c, why in capping.items()],
            F.when(F.col("_moratorium"), "moratorium"),
        )
    )
    name = F.get(F.array(*map(F.lit, PRIORITIES)), F.col("_final"))
    priority = F.when(F.col("_failed"), SCREENED).when(score("power").isNull(), INSUFFICIENT).otherwise(name)
    unsure = [F.when(~F.col("_failed") & low(d, 1) & ~sure(d), F.lit(f"{d} 1 at low confidence: flagged, not applied")) for d in SUPPORTING]
    told = F.when(F.col("_failed"), F.array(F.lit("screener failed"))).otherwise(reasons)
    fields = [priority.alias("priority"), told.alias("reasons"), F.array_compact(F.array(*unsure)).alias("flags")]
    if adjustments is not None:
        df = _with_causes(df, score, low, sure, param, adjustments)
        causes = F.when(F.col("_failed"), F.array(F.lit(CAUSES["screened"]))).when(score("power").isNull(), F.array(F.lit(CAUSES["no_power"]))).otherwise(F.col("_causes"))
        fields.append(causes.alias("causes"))
    return df.withColumn(out, F.struct(*fields)).drop("_causes", "_moratorium", "_ceiling", "_weak", "_supporting", "_open", "_failed", "_few", "_idle", "_level", "_final")


def _with_causes(df: DataFrame, score, low, sure, param, adjustments: Column) -> DataFrame:
    """Add _causes, those of all steps after which the priority is another than before, from the steps' columns of with_indicated."""
    step = lambda cause, level: F.struct(cause.alias("cause"), level.cast("int").alias("level"))
    ceiling, weak, level = F.col("_ceiling"), F.col("_weak"), F.col("_level")
    is_weak = {d: low(d, param("weak")) & (~F.col("_moratorium") if d == "community" else F.lit(True)) for d in IMPORTANT}
    after = F.when(weak >= param("most_weak"), 0).when(weak == 1, F.greatest(F.lit(0), ceiling - 1)).otherwise(ceiling)
    first, second = [(low(d, 1) & sure(d)).cast("int") for d in SUPPORTING]
    high, opened, few = level == 2, F.col("_open"), F.col("_few")
    moratorium = F.col("_moratorium")
    steps = [
        step(F.when(ceiling == 2, CAUSES["ceiling_high"]).when(ceiling == 1, CAUSES["ceiling_medium"]).otherwise(CAUSES["ceiling_low"]), ceiling),
        F.when(weak >= 1, step(F.concat_ws(" + ", *[F.when(w, CAUSES[d]) for d, w in is_weak.items()]), after)),
        F.when(first == 1, step(F.lit(CAUSES[SUPPORTING[0]]), F.greatest(F.lit(0), after - 1))),
        F.when(second == 1, step(F.lit(CAUSES[SUPPORTING[1]]), F.greatest(F.lit(0), after - first - 1))),
        F.when(high & opened, step(F.lit(CAUSES["screeners"]), F.lit(1))),
        F.when(high & ~opened & few, step(F.lit(CAUSES["known"]), F.lit(1))),
        F.when(high & ~opened & ~few & F.col("_idle"), step(F.lit(CAUSES["core"]), F.lit(1))),
        F.when(moratorium, step(F.lit(CAUSES["moratorium"]), F.lit(0))),
    ]
    # Columns of their own, so that no step is written out again for each that looks at the one before it.
    df = df.withColumns({"_steps": F.array(*steps), "_adjustments": adjustments})
    name = lambda a: F.concat(F.trim(F.split(a["reason"], ":", 2)[0]), F.when(a["dir"] > 0, " (up)").otherwise(""))
    total = lambda i: F.aggregate(F.slice("_adjustments", 1, i + 1), F.col("_final").cast("int"), lambda s, a: s + a["dir"].cast("int"))
    moved = F.transform("_adjustments", lambda a, i: step(name(a), F.least(F.lit(2), F.greatest(F.lit(0), total(i)))))
    df = df.withColumn("_all", F.concat(F.array_compact("_steps"), moved))
    before = lambda i: F.coalesce(F.get("_all", i - 1)["level"], F.lit(2))
    df = df.withColumn("_kept", F.filter("_all", lambda s, i: s["level"] != before(i)))
    named = F.when(F.size("_kept") > 0, F.transform("_kept", lambda s: s["cause"])).otherwise(F.array(F.lit(CAUSES["ceiling_high"])))
    return df.withColumn("_causes", named).drop("_steps", "_adjustments", "_all", "_kept")


def assigned(priority: Column, adjustments: Column) -> Column:
    """A priority moved by the sum of adjustments (struct(dir, reason)); the two special results stay."""
    at = F.array_position(F.array(*map(F.lit, PRIORITIES)), priority).cast("int") - 1
    moved = at + F.aggregate(adjustments, F.lit(0), lambda s, a: s + a["dir"].cast("int"))
    return F.when(at >= 0, F.get(F.array(*map(F.lit, PRIORITIES)), F.least(F.lit(2), F.greatest(F.lit(0), moved)))).otherwise(priority)


def causes(priority: Column, adjustments: Column) -> Column:
    """The reasons of adjustments that moved the priority, one after the other; steps against the end move nothing."""
    at = F.array_position(F.array(*map(F.lit, PRIORITIES)), priority).cast("int") - 1
    start = F.struct(at.alias("at"), F.array().cast("array<string>").alias("why"))

    def step(acc: Column, a: Column) -> Column:
        to = F.least(F.lit(2), F.greatest(F.lit(0), acc["at"] + a["dir"].cast("int")))
        why = F.when(to != acc["at"], F.concat(acc["why"], F.array(a["reason"]))).otherwise(acc["why"])
        return F.struct(to.alias("at"), why.alias("why"))

    return F.when(at >= 0, F.aggregate(adjustments, start, step, lambda acc: acc["why"])).otherwise(F.array().cast("array<string>"))


def investment_score(cost_musd: Column, mw: Column) -> Column:
    """By millions a megawatt, over at least two of them."""
    each = cost_musd / F.greatest(F.lit(2.0), F.coalesce(mw, F.lit(2.0)))
    return F.when(cost_musd.isNull(), F.lit(None)).when(each <= 0.1, 5).when(each <= 0.25, 4).when(each <= 1.0, 3).when(each <= 3.4, 2).otherwise(1).cast("int")


def land_score(acres: Column, mw: Column, p: Parameters | str = Parameters()) -> Column:
    """4 with room for the load at half an acre a megawatt, at least one acre, else 3."""
    need = F.greatest(F.lit(1.0), parameter("acres_a_mw", p) * F.coalesce(mw, F.lit(0.0)))
    return F.when(acres.isNull(), F.lit(None)).when(acres >= need, 4).otherwise(3).cast("int")


def buildable_acres(acres: Column, sfha_pct: Column, wetland_pct: Column, checked: Column) -> Column:
    """Acres less the shares in flood zones and wetlands, which are taken off only where the ground was checked."""
    share = F.least(F.lit(1.0), (F.coalesce(sfha_pct, F.lit(0.0)) + F.coalesce(wetland_pct, F.lit(0.0))) / 100)
    return acres * (1 - F.when(checked, share).otherwise(0.0))


def best_phase(phases: DataFrame, key: str, ordinal: str, p: Parameters | str = Parameters()) -> DataFrame:
    """The phase of each key whose megawatts by its date score best, the first of equals: score, mw, months, certainty.

    phases: key, ordinal, mw, months, requested, early, mw_tag, date_tag; an unknown score counts as 0 here.
    """
    sure = certainty(*[F.col(c) for c in ("months", "requested", "early", "mw_tag", "date_tag")], p)
    rows = phases.withColumn("_c", sure)
    rows = rows.withColumn("_s", F.coalesce(power_score(F.col("mw"), F.col("_c"), F.lit(False), F.lit(False), p), F.lit(0)))
    best = F.max(F.struct("_s", (-F.col(ordinal)).alias("_minus"), "mw", "months", "_c"))
    out = rows.groupBy(key).agg(best.alias("b"))
    return out.select(key, F.col("b._s").alias("score"), F.col("b.mw").alias("mw"), F.col("b.months").alias("months"), F.col("b._c").alias("certainty"))


def site_control(stage: Column, quote: Column, reading: Column) -> Column:
    """struct(score, confidence) of the stage of site control; a reading of ours comes first, a letter of intent makes a 4."""
    known = F.element_at(F.create_map(*[F.lit(x) for kv in STAGES.items() for x in kv]), stage)
    score = F.when(stage == "loi_or_negotiating", F.when(F.coalesce(quote, F.lit("")).rlike(r"\bLOI\b"), 4).otherwise(3)).otherwise(known)
    score = F.coalesce(reading, score).cast("int")
    return F.struct(score.alias("score"), F.when(score.isNull(), "none").otherwise("medium").alias("confidence"))


def connectivity(status: Column, carriers: Column, two_routes: Column, level: Column, providers: Column) -> Column:
    """struct(score, confidence): from a quote's carriers and routes, else from how many providers are near."""
    quoted = F.when(carriers >= 2, 5).when(two_routes, 4).otherwise(3)
    rough = F.coalesce(level, F.lit("")).rlike("(?i)1|desktop") | (F.coalesce(level, F.lit("")) == "")
    near = F.when(providers >= 2, 3).when(providers == 1, 2).when(providers.isNotNull(), 1)
    is_ = F.coalesce(status == "quoted", F.lit(False))
    confidence = F.when(is_, F.when(rough, "medium").otherwise("high")).when(providers.isNull(), "none").otherwise("low")
    return F.struct(F.when(is_, quoted).otherwise(near).cast("int").alias("score"), confidence.alias("confidence"))


def community_confidence(zoning: Column, tag: Column, confirmed: Column, news: Column) -> Column:
    """How sure a community score is: by the zoning's tag, at most medium off confirmed sites, at least medium with bad news."""
    by_zoning = F.when((zoning == "no_zoning") | (tag == "written"), "high").when(zoning == "unclear", "low").otherwise("medium")
    held = F.when(~confirmed & (by_zoning == "high"), "medium").otherwise(by_zoning)
    return F.when(F.coalesce(news.isin("moratorium", "negative"), F.lit(False)) & (held == "low"), "medium").otherwise(held)


def audit_adjustment(mw: Column, p: Parameters | str = Parameters()) -> Column:
    """The adjustments that a large request brings: one step down while its grid audit is open."""
    one = F.array(F.struct(F.lit(-1).alias("dir"), F.concat(F.lit("Grid audit: "), mw.cast("string"), F.lit(" MW request")).alias("reason")))
    return F.when(mw >= parameter("audit_mw", p), one).otherwise(F.array().cast("array<struct<dir:int,reason:string>>"))


def community_score(zoning: Column, news: Column, receptor_m: Column, homes: Column, confirmed: Column) -> Column:
    """From zoning and news; receptors and homes count on confirmed sites only."""
    near = lambda m: F.coalesce(confirmed & (receptor_m <= m), F.lit(False))
    many = lambda n: F.coalesce(confirmed & (homes > n), F.lit(False))
    clear = F.coalesce(confirmed & (receptor_m > 805) & (homes <= 25), F.lit(False))
    is_ = lambda c, *v: F.coalesce(c.isin(*v), F.lit(False))
    return (
        F.when(zoning.isNull() & news.isNull(), F.lit(None))
        .when(is_(zoning, "moratorium") | is_(news, "moratorium"), 1)
        .when(is_(zoning, "rezoning") | is_(news, "negative") | near(305) | many(500), 2)
        .when(is_(zoning, "conditional", "unclear") | is_(news, "mixed") | many(100), 3)
        .when(is_(zoning, "by_right", "none") & clear, 5)
        .otherwise(4)
    ).cast("int")


def market_score(metro_1m_km: Column, metro_250k_km: Column, hub_km: Column) -> Column:
    """By distance to a metro of a million, one of 250,000 and a hub."""
    within = lambda c, km: F.coalesce(c <= km, F.lit(False))
    return (
        F.when(metro_1m_km.isNull() & metro_250k_km.isNull(), F.lit(None))
        .when(within(metro_1m_km, 10) & within(hub_km, 25), 5)
        .when(within(metro_1m_km, 25) & within(hub_km, 50), 4)
        .when(within(metro_1m_km, 50) | within(metro_250k_km, 25), 3)
        .when(within(metro_1m_km, 100), 2)
        .otherwise(1)
    ).cast("int")


def site_risk(status: Column, carve_out: Column, acres: Column, sfha_pct: Column, wetland_pct: Column) -> Column:
    """passed, failed or not assessed by the acres clear of flood zones and wetlands."""
    clear = acres * (1 - F.least(F.lit(1.0), (F.coalesce(sfha_pct, F.lit(0.0)) + F.coalesce(wetland_pct, F.lit(0.0))) / 100))
    return (
        F.when(clear.isNull(), "not assessed")
        .when(status == "confirmed", F.when(clear < 1, "failed").otherwise("passed"))
        .when((status == "confirmed_partial") & ~carve_out, F.when(clear >= 1, "passed").otherwise("not assessed"))
        .when((status == "confirmed_partial") & carve_out, F.when(clear < 1, "failed").otherwise("not assessed"))
        .otherwise("not assessed")
    )


def parcel_verdict(stated: Column, measured: Column, precise: Column, claim: Column, candidates: Column) -> Column:
    """confirmed, confirmed_partial carve-out or spans, needs_input or not_locatable.

    claim is none, consistent or contradicted; candidates is null where no
    search ran or it failed.
    """
    off = F.abs(stated - measured) / F.nullif(stated, F.lit(0.0))
    match = F.coalesce(off <= 0.15, F.lit(False))
    return (
        F.when(stated.isNull(), F.when(precise, "confirmed").otherwise("needs_input"))
        .when(precise & (claim == "contradicted"), "needs_input")
        .when(precise & match, "confirmed")
        .when(precise & (stated < measured), "confirmed_partial carve-out")
        .when(precise, "confirmed_partial spans")
        .when(match & (claim != "contradicted"), "confirmed")
        .when(candidates.isNull(), "needs_input")
        .when((candidates == 0) | (candidates > 5), "not_locatable")
        .otherwise("needs_input")
    )


def location_status(tier: Column, verdict: Column, no_site: Column, candidates: Column) -> Column:
    """The status of a location from its tier, its parcel verdict and a search of 1 to 5 candidates."""
    few = F.when(candidates.between(1, 5), "needs_input").otherwise("not_locatable")
    return (
        F.when(tier.isin("L1", "L2"), F.coalesce(verdict, F.lit("confirmed")))
        .when(no_site, "no_site")
        .when((tier == "L3") & candidates.isNotNull(), few)
        .otherwise("not_locatable")
    )


def substation_relation(distance_m: Column, host_m: Column, claimed_mi: Column) -> Column:
    """struct(relation, claim): adjacent, near or apart, and whether a claimed distance fits."""
    relation = F.when((distance_m <= 150) | F.coalesce(host_m <= 3, F.lit(False)), "adjacent").when(distance_m <= 400, "near").otherwise("apart")
    measured = distance_m / 1609.344
    fits = F.abs(claimed_mi - measured) <= F.greatest(F.lit(0.5), 0.5 * claimed_mi)
    return F.struct(relation.alias("relation"), F.when(claimed_mi.isNull(), "none").when(fits, "consistent").otherwise("contradicted").alias("claim"))


def owner_check(pattern: Column, owner: Column, has_owner: Column, number: Column) -> Column:
    """What a source's owner says about the expected one; a match is looked for first, in owner and parcel number."""
    text = F.concat_ws(" ", owner, number)
    return (
        F.when(pattern.isNull() | (pattern == ""), F.lit(None))
        .when(F.regexp_like(text, F.concat(F.lit("(?i)"), pattern)), "expected owner")
        .when(~has_owner, "not checkable: the source has no owner")
        .when(F.trim(F.coalesce(owner, F.lit(""))) == "", "no owner in source - review")
        .otherwise("different owner - review")
    )


def kilovolts(volts: Column, band: Column) -> Column:
    """struct(kv, basis): a positive number, else a class band, else not published."""
    kv = volts.try_cast("double")
    good = F.coalesce((kv > 0) & ~F.isnan(kv), F.lit(False))
    basis = F.when(good, "numeric").when(F.coalesce(F.trim(band), F.lit("")).rlike(r"\d"), "class_band").otherwise("not_published")
    return F.struct(F.when(good, kv).alias("kv"), basis.alias("basis"))


def voltage_band(kv: Column) -> Column:
    """The style band of a voltage."""
    return F.when(kv.isNull(), "unknown").when(kv >= 400, "400+").when(kv >= 300, "300-400").when(kv >= 200, "200-300").when(kv >= 100, "100-200").otherwise("<100")


def row_width(kv: Column, bands: list[tuple[float, float]], default: float) -> Column:
    """The width of the highest band whose least voltage is reached; unknown takes the default."""
    out = F.lit(bands[0][1])
    for least, width in bands[1:]:
        out = F.when(kv >= least, width).otherwise(out)
    return F.when(kv.isNull(), default).otherwise(out)


def line_qualifies(kv: Column, band_kv: Column, least: float) -> Column:
    """Whether a line reaches a voltage; an unpublished one counts by its band, for least voltages up to 100."""
    return F.coalesce(kv >= least, (F.lit(least) <= 100) & F.coalesce(band_kv >= 100, F.lit(False)))


def substation_qualifies(kv: Column, status: Column, kind: Column, least: float) -> Column:
    """Whether a substation reaches a voltage, is in service and no tap."""
    return F.coalesce((kv >= least) & (F.upper(status) == "IN SERVICE") & (F.upper(kind) != "TAP"), F.lit(False))


def flood_determination(mapped: Column, failed: Column, excluded: Column, available: Column) -> Column:
    """Why a point has a flood zone or none."""
    return (
        F.when(mapped, "mapped").when(failed, "failed").when(excluded, "area_not_included").when(~available, "no_nfhl_data").otherwise("no_zone_returned")
    )


def conflict(stated: Column, measured: Column, tolerance: float = 0.25) -> Column:
    """Whether a stated number is off by more than a part of itself; nothing stated is no conflict."""
    return F.coalesce(F.abs(stated - measured) / F.nullif(stated, F.lit(0.0)) > tolerance, F.lit(False))


def rating_violations(rows: DataFrame, key: str) -> DataFrame:
    """One row a violation: confidence, cap, screener values, adjustments without a reason, stale versions, and results that don't follow."""
    checks = {
        "confidence": ~F.col("confidence").isin("high", "medium", "low", "none"),
        "over its cap": F.col("score") > F.coalesce(capped(F.lit(5), F.col("confidence")), F.lit(0)),
        "screener": ~F.col("screener").isin("passed", "failed", "not assessed"),
        "adjustment without reason": F.exists("adjustments", lambda a: F.trim(F.coalesce(a["reason"], F.lit(""))) == ""),
        "adjustment over one step": F.exists("adjustments", lambda a: F.abs(a["dir"]) != 1),
        "assigned": ~assigned(F.col("indicated"), F.col("adjustments")).eqNullSafe(F.col("assigned")),
        "version": F.col("version") != METHOD_VERSION,
    }
    found = F.array_compact(F.array(*[F.when(F.coalesce(bad, F.lit(True)), F.lit(name)) for name, bad in checks.items()]))
    return rows.select(key, F.explode(found).alias("violation"))


#: Lengths of a scale bar, in feet.
SCALE_FEET = (25, 50, 100, 200, 250, 500, 1000, 1500, 2000, 2500, 3000, 4000)


def counts_as_home(occupancy: Column, square_feet: Column, area_square_feet: Column, on_site: Column, least: float, low: float, high: float) -> Column:
    """Whether a building is a home: residential and no shed, or unclassified, off the site and of a house's size; a size of 0 is the polygon's."""
    size = F.coalesce(F.nullif(square_feet, F.lit(0.0)), area_square_feet)
    return F.coalesce(((occupancy == "Residential") & (size >= least)) | ((occupancy == "Unclassified") & ~on_site & size.between(low, high)), F.lit(False))


def headline_mw(rows: DataFrame, key: str, ordinal: str) -> DataFrame:
    """key, mw and kind of what is said of power: an actual figure, the full one, a request, an "up to"; the first of each."""
    wanted = (("mw", "actual", "actual"), ("mw_full", "actual", "actual"), ("mw", "target", "request"), ("mw", "range_high", "up_to"))
    first = [F.min(F.when((F.col("field") == f) & (F.col("kind") == k), F.struct(ordinal, F.col("value").try_cast("double").alias("mw"), F.lit(said).alias("said")))).alias(f"_{i}") for i, (f, k, said) in enumerate(wanted)]
    best = F.coalesce(*[F.col(f"_{i}") for i in range(len(wanted))])
    return rows.groupBy(key).agg(*first).select(key, best["mw"].alias("mw"), best["said"].alias("kind"))


def scale_feet(span_m: Column) -> Column:
    """The nice length nearest to a fifth of a map's width, the shorter of two as near."""
    return F.array_min(F.array(*[F.struct(F.abs(F.lit(float(v)) - span_m * 0.2 / 0.3048).alias("off"), F.lit(v).alias("feet")) for v in SCALE_FEET]))["feet"]


def frame(west: Column, south: Column, east: Column, north: Column, margin: float, aspect: float) -> Column:
    """struct(west, south, east, north) of a map about a box with a margin, at an aspect."""
    high = F.greatest(north - south + 2 * margin, (east - west + 2 * margin) / aspect)
    x, y = (west + east) / 2, (south + north) / 2
    return F.struct((x - high * aspect / 2).alias("west"), (y - high / 2).alias("south"), (x + high * aspect / 2).alias("east"), (y + high / 2).alias("north"))


def drift_flags(answered: Column, fields_gone: Column, was: Column, now: Column, old_vintage: Column, vintage: Column, old_name: Column, name: Column, upstream: Column) -> Column:
    """What changed at a source: nothing else counts where it didn't answer; a count of 0 or none before is not compared."""
    moved = (was > 0) & (F.abs(now - was) > F.greatest(F.lit(50.0), 0.05 * was))
    parts = [
        F.when(fields_gone != "", F.concat(F.lit("fields gone: "), fields_gone)),
        F.when(moved, "records"),
        F.when(old_vintage != vintage, "vintage"),
        F.when(old_name != name, "renamed"),
        F.when(upstream > vintage, "newer release upstream"),
    ]
    return F.when(~answered, "unreachable").otherwise(F.concat_ws("; ", *parts))
