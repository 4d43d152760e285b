"""Words of a site's sheet held against brute force, and how often they are made."""

import random
import re

from pyspark.sql import functions as F

from geosieve.functions import text as x

SHEETS = "site int, cells array<struct<rank:int,ordinal:long,label:string,text:string>>"


def fresh(cells):
    """Cells in order whose words no earlier one holds; after a missing text only what came before it is known."""
    low = lambda v: (v is not None, v if v is not None else 0)
    order = sorted(cells, key=lambda c: (low(c[0]), low(c[1])))
    plain = [None if t is None else re.sub(r"[^\w]+", " ", t.lower()).strip(" ") for *_, t in order]
    kept = [i for i in range(len(order)) if i == 0 or None not in plain[: i + 1] and not any(plain[i] in p for p in plain[:i])]
    return [order[i][2:] for i in kept]


def test_location_words_equal_brute_force(spark):
    rng = random.Random(2)
    words = ("Mill", "mill rd", "Rd", "a", "ab", "é", "12", "__", "-", "", "x\ny", "TROY")
    text = lambda: None if rng.random() < 0.05 else rng.choice((" ", "\n", ", ")).join(rng.choice(words) for _ in range(rng.randrange(4)))
    sheets = [(i, [(rng.choice((None, 0, 1)), n, rng.choice(("L", None)), text()) for n in rng.sample(range(20), rng.randrange(9))]) for i in range(400)]
    sheets += [(400, None), (401, [(0, n, "L", f"lot {n % 7} of {n % 3}") for n in range(2000)])]
    got = {r.site: r.words for r in spark.createDataFrame(sheets, SHEETS).select("site", x.location_words(F.col("cells")).alias("words")).collect()}
    assert got.pop(400) is None
    assert {k: [tuple(w) for w in v] for k, v in got.items()} == {k: fresh(c) for k, c in sheets if c is not None}


def test_location_words_are_made_once_a_cell(spark):
    """What a function over an array names of the array is made anew for each cell: cells are sorted and their words taken outside of it."""
    plan = spark.createDataFrame([], SHEETS).select(x.location_words(F.col("cells")).alias("words"))._jdf.queryExecution().analyzed().toString()
    assert plan.count("array_sort(") == 1 and plan.count("regexp_replace(") == 1
