"""Lengths by rank against plain loops."""

import random

from geosieve.operators import relational


def test_precedence_shares_equal_plain_cells(spark):
    rng = random.Random(8)
    rows = [(k, lo, lo + rng.randrange(0, 30), rng.choice([1, 2, 3, None])) for k in range(40) for lo in (rng.randrange(50) for _ in range(rng.randrange(1, 12)))]
    rows += [(None, 0, 5, 1), (99, None, 5, 1), (99, 3, 3, 1)]
    want = {}
    for k in range(40):
        for x in range(90):
            over = [r[3] for r in rows if r[0] == k and r[1] is not None and r[1] <= x < r[2]]
            if over:
                least = min((r for r in over if r is not None), default=None)
                want[k, least] = want.get((k, least), 0) + 1
    df = spark.createDataFrame(rows, "k int, lo long, hi long, rank int")
    shares = relational.precedence_shares(df, ["k"], "lo", "hi", "rank")
    assert {(r.k, r["rank"]): r.length for r in shares.collect()} == want and shares.count() == len(want)
    assert dict(shares.dtypes) == {"k": "int", "rank": "int", "length": "bigint"}
    # Only covers are grouped: pieces are no rows to be joined or windowed.
    plan = shares._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Window" not in plan
    assert relational.precedence_shares(df.limit(0), ["k"], "lo", "hi", "rank").count() == 0
