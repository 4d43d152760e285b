"""Raking under the bound against plain Python, against DuckDB and on the marginals of what is kept."""

import itertools
import random
from collections import defaultdict

import duckdb
from pyspark.sql import functions as F

from geosieve.llm import mixing
from geosieve.llm.common import documents

SF = "/root/testdata/sf0.1"


def test_query_against_sql_and_its_kept_shares(spark):
    rows = mixing.op1_source_mixing(spark, SF).collect()
    db = duckdb.connect()
    db.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = db.sql(mixing.OP1_SQL)
    assert sorted(tuple(r[c] for c in want.columns) for r in rows) == sorted(want.fetchall())

    total = sum(r.tokens for r in rows)
    own, kept, short = defaultdict(float), defaultdict(float), set()
    for r in rows:
        for k, v in (("source", r.source_class), ("lang", r.lang_class), ("topic", r.topic)):
            own[k, v] += r.tokens / total
            kept[k, v] += r.tokens * r.probability / total / mixing.KEEP
            short |= {(k, v)} if k in r.short_of.split(",") else set()
    assert abs(sum(r.tokens * r.probability for r in rows) / total - mixing.KEEP) < 1e-3
    assert abs(sum(r.tokens for r in rows if r.sampled) / total - mixing.KEEP) < 0.03
    assert all(0 <= r.probability <= 1 for r in rows)
    for k, goals in mixing.TARGETS.items():
        there = {v: g for v, g in goals.items() if (k, v) in own}
        reached = []
        for v, g in there.items():
            asked = g / sum(there.values())
            assert ((k, v) in short) == (own[k, v] < asked * mixing.KEEP)
            if own[k, v] / mixing.KEEP - kept[k, v] < 1e-3:  # kept whole: it holds no more than its goal
                assert own[k, v] / mixing.KEEP < asked * 1.5
            else:
                reached.append(kept[k, v] / asked)
        assert max(reached) - min(reached) < 0.01  # the others are as their targets are to one another


def brute(cells, targets, keep, rounds):
    """The same by bisection: goals as even multiples of the targets, then scalings counted up to each cell's own."""
    total = sum(cells.values())
    share = {c: t / total for c, t in cells.items()}

    def solve(f, goal):
        low, high = 0.0, 1e12
        for _ in range(300):
            mid = (low + high) / 2
            low, high = (mid, high) if f(mid) < goal else (low, mid)
        return high

    goals = []
    for k, target in enumerate(targets.values()):
        held = defaultdict(float)
        for c, s in share.items():
            held[c[k]] += s
        there = {v: target.get(v, 0.0) for v in held}
        whole = sum(there.values())
        if not whole:
            goals.append(None)
            continue
        t = {v: g / whole for v, g in there.items()}
        m = solve(lambda x: sum(min(held[v], x * t[v]) for v in t), min(keep, sum(h for v, h in held.items() if t[v])))  # noqa: B023
        goals.append({v: min(held[v], m * t[v]) for v in t})
    x = dict(share)
    for _ in range(rounds):
        for k, goal in enumerate(goals):
            for v, g in (goal or {}).items():
                mine = [c for c in x if c[k] == v]
                some = [c for c in mine if x[c]]
                if not some or not g:
                    f = 0.0
                elif g >= sum(share[c] for c in some) * (1 - 1e-9):  # kept whole
                    f = max(share[c] / x[c] for c in some)
                else:
                    f = solve(lambda f: sum(min(share[c], f * x[c]) for c in mine), g)  # noqa: B023
                x.update({c: min(x[c] * f, 1e200) for c in mine})
    return {c: min(share[c], x[c]) / share[c] for c in x}


def test_against_brute_force(spark):
    cells = {("a", "x"): 500, ("a", "y"): 20, ("b", "x"): 90, ("b", "y"): 300, ("other", "x"): 5, ("other", "other"): 40}
    cases = [
        (cells, {"p": {"a": 0.2, "b": 0.7, "other": 0.1}, "q": {"x": 0.5, "y": 0.3, "z": 0.2}}, 0.4),
        (cells, {"p": {"a": 0.6, "b": 0.3, "other": 0.1}, "q": {"x": 0.6, "y": 0.4}}, 0.7),
        (cells, {"p": {"none": 1.0}, "q": {"x": 1.0}}, 0.3),
    ]
    rng = random.Random(4)
    many = {c: rng.randrange(1, 1000) for c in itertools.product("abcd", "uvwxyz")}
    cases.append((many, {"p": dict(zip("abcd", (0.1, 0.2, 0.3, 0.4))), "q": dict(zip("uvwxyz", (0.3, 0.1, 0.2, 0.1, 0.2, 0.1)))}, 0.5))
    for held, targets, keep in cases:
        df = spark.createDataFrame([(*c, t) for c, t in held.items()], "p string, q string, tokens long")
        got = {(r.p, r.q): r for r in mixing.rake(df, targets, keep).collect()}
        want = brute(held, targets, keep, mixing.ROUNDS)
        assert got.keys() == want.keys() and all(abs(got[c].probability - want[c]) < 1e-5 for c in want)
    realised = defaultdict(float)  # of the last, whose targets can be reached
    for c, r in got.items():
        realised["p", c[0]] += r.probability * many[c] / sum(many.values()) / 0.5
        realised["q", c[1]] += r.probability * many[c] / sum(many.values()) / 0.5
    assert all(r.short == "" for r in got.values())
    assert all(abs(realised[k, v] - g) < 0.01 for k, t in targets.items() for v, g in t.items())


def test_odd_rows(spark):
    rows = [(1, None, None, None, "k"), (2, "", "en", "src0", "k"), (2, "", "en", "src0", "k"), (None, "x y", "zz", "src1", None), (3, "a" * 200_000, "en", "src1", "k")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, mix_weight string")
    got = mixing.mix_documents(docs).collect()
    assert len(got) == 5 and all(r.mix_sampled is not None and 0 <= r.mix_probability <= 1 for r in got)
    assert {r.mix_tokens for r in got if not r.text} == {1} and mixing.mix_documents(docs.limit(0)).count() == 0
    lone = docs.select("doc_id", "text", F.lit("q").alias("lang"), F.lit("q").alias("source"))
    assert mixing.mix_documents(lone, {"lang": {"en": 1.0}, "source": {"a": 1.0}, "topic": {"none": 1.0}}).where("mix_probability is null").count() == 0


def test_given_tokens_and_topics(spark):
    rows = [(i, "w " * i, "en", "s", i % 2) for i in range(1, 400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, even int")
    topic = F.when(F.col("even") == 0, "a").otherwise("b")
    got = mixing.mix_documents(docs, {"source": {}, "lang": {"en": 1.0}, "topic": {"a": 0.75, "b": 0.25}}, 0.4, tokens=F.col("doc_id"), topic=topic).collect()
    assert [r.mix_tokens for r in sorted(got, key=lambda r: r.doc_id)] == [r[0] for r in rows]
    kept = defaultdict(float)
    for r in got:
        kept[r.mix_topic] += r.mix_tokens * r.mix_probability
    assert abs(kept["a"] / sum(kept.values()) - 0.75) < 1e-6 and documents(spark, SF).count() == 10_000
