"""The rating rules on profiles whose priority was set down beforehand, and single rules at their edges."""

import pytest
from pyspark.sql import functions as F

from geosieve.functions import rules

PASSED = ("passed", "passed")
OPEN = ("not assessed", "passed")
GOOD = {"investment": (5, "high"), "land": (5, "high"), "site_control": (5, "high"), "connectivity": (4, "medium"), "market": (5, "high"), "community": (4, "medium")}
NONE = (None, "none")
#: mw, certainty, confidence of power (or a score), what differs from GOOD, screeners, adjustments, priority.
PROFILES = [
    ((5, 0, "high"), {}, PASSED, [], "High"),
    ((3, 0, "high"), {}, PASSED, [], "High"),
    ((2, 0, "high"), {}, PASSED, [], "Medium"),
    (NONE, {}, PASSED, [], "Insufficient information"),
    ((3, "low"), {}, PASSED, [], "Medium"),
    ((20, 1, "medium"), {"site_control": (1, "medium"), "land": NONE, "investment": NONE}, OPEN, [], "Medium"),
    ((5, 0, "high"), {"land": (4, "medium"), "investment": NONE, "site_control": (4, "medium")}, OPEN, [], "Medium"),
    ((5, 0, "high"), {}, ("failed", "passed"), [], "Screened out"),
    ((5, 0, "high"), {"community": (1, "medium")}, PASSED, [], "Low"),
    ((5, 0, "high"), {"investment": (2, "medium"), "site_control": (2, "medium")}, PASSED, [], "Low"),
    ((5, 0, "high"), {"connectivity": (1, "low")}, PASSED, [], "High"),
    ((5, 3, "medium"), {}, PASSED, [], "Low"),
    ((3, 0, "high"), {"investment": (1, "high")}, PASSED, [], "Medium"),
    ((5, 0, "high"), {"land": NONE, "investment": NONE}, PASSED, [], "Medium"),
    ((3, 0, "high"), {"connectivity": (1, "medium")}, PASSED, [], "Medium"),
    ((2.5, 1, "medium"), {}, PASSED, [], "Medium"),
    ((5, 0, "high"), {d: NONE for d in GOOD}, PASSED, [], "Medium"),
    ((5, 0, "high"), {d: (3, "medium") for d in GOOD}, PASSED, [], "Medium"),
    ((3, 0, "high"), {"site_control": (2, "medium")}, PASSED, [], "Medium"),
    ((5, 2, "low"), {"site_control": (1, "medium"), "land": NONE, "investment": NONE}, OPEN, [], "Low"),
    ((35, 0, "high"), {}, PASSED, [(-1, "audit open")], "Medium"),
]


def test_profiles(spark):
    rows = []
    for i, (power, over, screens, adjust, _) in enumerate(PROFILES):
        mw, certainty, confidence = power if len(power) == 3 else (None, None, power[1])
        d = GOOD | over
        rows.append((i, mw and float(mw), certainty, power[0] if len(power) == 2 else None, confidence, *[x for k in GOOD for x in d[k]], *screens, adjust))
    names = ["id int", "mw double", "certainty int", "given int", "conf_power string", *[x for k in GOOD for x in (f"raw_{k} int", f"conf_{k} string")], "risk string", "control string", "adjustments array<struct<dir:int,reason:string>>"]
    df = spark.createDataFrame(rows, ", ".join(names))
    power = F.coalesce("given", rules.power_score(F.col("mw"), F.col("certainty"), F.lit(False), F.lit(False)))
    df = df.withColumn("raw_power", power)
    df = df.withColumns({f"s_{k}": rules.capped(F.col(f"raw_{k}"), F.col(f"conf_{k}")) for k in ("power", *GOOD)})
    out = rules.with_indicated(df, ("risk", "control")).orderBy("id")
    got = out.select(rules.assigned(F.col("indicated.priority"), F.col("adjustments")).alias("p"), rules.causes(F.col("indicated.priority"), F.col("adjustments")).alias("why")).collect()
    assert [r.p for r in got] == [p[-1] for p in PROFILES]
    assert got[-1].why == ["audit open"]


@pytest.mark.parametrize(
    ("certainty", "mw", "want"),
    [(0, 5, 5), (0, 4.9, 4), (0, 2, 3), (1, 2, 3), (2, 5, 3), (3, 5, 2), (3, 2, 1), (0, 1.9, 1), (None, 5, None)],
)
def test_power_grid(spark, certainty, mw, want):
    df = spark.createDataFrame([(certainty, float(mw))], "c int, mw double")
    assert df.select(rules.power_score(F.col("mw"), F.col("c"), F.lit(False), F.lit(False))).first()[0] == want


def test_adjustments_clamp(spark):
    df = spark.createDataFrame([("Low", [(-1, "a"), (1, "b")]), ("High", [(1, "a"), (1, "b")]), ("Screened out", [(1, "a")])], "p string, a array<struct<dir:int,reason:string>>")
    got = df.select(rules.assigned(F.col("p"), F.col("a")).alias("p"), rules.causes(F.col("p"), F.col("a")).alias("w")).collect()
    assert [(r.p, r.w) for r in got] == [("Low", ["b"]), ("High", []), ("Screened out", [])]


def test_title_case_and_statement_words(spark):
    from geosieve.functions import text

    names = ["o'neill-smith msa (TX) · x", "DALLAS-FT. WORTH MSA", "são JOSÉ 2nd · b", "", None]
    df = spark.createDataFrame([(n,) for n in names], "s string").select(text.market_of(F.col("s")).alias("m"))
    assert [r.m for r in df.collect()] == [None if n is None else n.split(" (")[0].split(" · ")[0].title().replace("Msa", "MSA") for n in names]
    kept = spark.createDataFrame([(["a_b c", "a b", "A-B", "x", "é"],)], "s array<string>").select(text.without_contained(F.col("s")).alias("k")).first().k
    assert kept == ["a_b c", "x"]
