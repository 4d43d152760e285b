"""Power near a site held against brute force, and how often its pairs are read."""

import random

from pyspark.sql import functions as F

from geosieve.functions.rules import line_qualifies, substation_qualifies
from geosieve.operators import surroundings

LINES = "site int, ordinal long, d_mm long, kv double, band_kv double, crosses boolean"
SUBS = "site int, ordinal long, d_mm long, name string, kv double, state string, kind string"


def layers(spark):
    """Sites of which one comes twice and one has no key, and lines and substations with ties, gaps and rows that come twice."""
    rng = random.Random(4)
    some = lambda *of: rng.choice((*of, None))
    far = lambda: None if rng.random() < 0.05 else 1000 * rng.randrange(4) + rng.choice((0, 1, 999))
    who = lambda: rng.choice((*range(1, 40), *[3] * 20, None))
    lines = [(who(), i, d := far(), some(10.0, 69.0, 138.0, 345.0), some(99.0, 161.0), None if d is None else rng.random() < 0.1) for i in range(200)]
    subs = [(who(), i, far(), some("A", "B"), some(10.0, 69.0, 115.0, 345.0), some("IN SERVICE", "RETIRED"), some("SUBSTATION", "TAP")) for i in range(300)]
    lines, subs = lines + lines[:30], subs + subs[:30]
    sites = [(i, i is None or i % 3 != 0, "parcel boundary") for i in (*range(1, 42), 5, None)]
    return sites, lines, subs, *(spark.createDataFrame(r, s) for r, s in ((sites, "site int, on_site boolean, basis string"), (lines, LINES), (subs, SUBS)))


def tied(rows, columns):
    """d_mm and columns of the best of rows as dicts, None where there are none."""
    rows = [r for r in rows if r["d_mm"] is not None]
    near = [r for r in rows if r["d_mm"] <= min(x["d_mm"] for x in rows) + 1000]
    low = lambda v: (v is not None, 0 if v is None else v)
    order = lambda r: (-(r["kv"] or 0.0), r["ordinal"], r["d_mm"], *[low(r[c]) for c in columns])
    best = min(near, key=order, default=None)
    return best and tuple(best[c] for c in ("d_mm", *columns))


def test_power_site_equals_brute_force(spark):
    sites, _, _, own, lines, subs = layers(spark)
    ok = {"line": line_qualifies(F.col("kv"), F.col("band_kv"), 69.0)} | {n: substation_qualifies(F.col("kv"), F.col("state"), F.col("kind"), v) for n, v in (("sub", 69.0), ("head", 115.0))}
    l = [r.asDict() for r in lines.select("*", ok["line"].alias("line")).collect()]
    b = [r.asDict() for r in subs.select("*", ok["sub"].alias("sub"), ok["head"].alias("head")).collect()]
    got = sorted((r.site or -1, r.field, r.value, r.status) for r in surroundings.power_site(own, "site", lines, subs).collect())
    want = []
    for k, on_site, basis in sites:
        of = lambda rows, n=None: [r for r in rows if k is not None and r["site"] == k and (n is None or r[n])]
        values = {"pw_from": basis if on_site else "pin (no site outline)", "line_crosses_site": str(on_site and any(r["crosses"] for r in of(l))).lower()}
        for tag, rows, n in (("line_kv_site", l, "line"), ("sub_kv_site", b, "sub"), ("sub_115kv_site", b, "head")):
            best = tied(of(rows, n), ("kv",) if n == "line" else ("kv", "name"))
            values |= {f"{tag}_m": best and str(round(best[0] / 1000, 1)), f"{tag}_kv": best and best[1] and str(best[1])}
            want.append((k or -1, f"{tag}_m", values[f"{tag}_m"], "ok" if best else "absent"))
            want.append((k or -1, f"{tag}_kv", values[f"{tag}_kv"], "ok" if best else "absent"))
        want += [(k or -1, f, values[f], "ok") for f in ("pw_from", "line_crosses_site")]
    named = [r for r in got if not r[1].endswith("_name")]
    assert named == sorted(want) and len(got) == len(named) + 2 * len(sites)
    assert {"absent", "ok"} == {r[3] for r in got} and any(r[2] == "true" for r in got)


def test_lines_and_substations_are_read_and_dealt_once(spark):
    """Whatever is asked of a site's pairs, their plan is in that of the result once."""
    _, _, _, own, lines, subs = layers(spark)
    plan = surroundings.power_site(own, "site", lines, subs)._jdf.queryExecution().optimizedPlan()
    assert plan.collectLeaves().size() == 3
