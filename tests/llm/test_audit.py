"""The filter audit against DuckDB and against walking every order by hand."""

import random
from fractions import Fraction
from itertools import permutations

import duckdb
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from geosieve.llm import audit
from geosieve.llm.common import Scratch

SF = "/root/testdata/sf0.01"
DOCS = T.StructType([T.StructField(n, t) for n, t in (("doc_id", T.LongType()), ("text", T.StringType()), ("lang", T.StringType()), ("mask", T.StringType()), ("part", T.StringType()), ("digest", T.StringType()))])
LABELS = "doc_id long, quality int, toxic int, good string"


def test_query_against_sql(spark):
    db = duckdb.connect()
    for t in ("documents", "labels"):
        db.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = db.sql(audit.OP12_SQL)
    got = audit.op12_filter_audit(spark, SF).collect()
    assert len(got) % 600 == 0
    assert sorted(tuple(r[c] for c in want.columns) for r in got) == sorted(want.fetchall())


@settings(max_examples=50, deadline=None)
@given(st.dictionaries(st.integers(0, 31), st.tuples(*[st.integers(0, 50)] * 3), max_size=32))
def test_orders_by_hand(counts):
    rows = {(r[0], r[1]): r[2:] for r in audit.part_rows([(m, *n) for m, n in counts.items()])}
    total, value = sum(n[0] for n in counts.values()), [0] * 5
    for order in permutations(range(5)):
        gone, name = 0, "".join("ABCDE"[i] for i in order)
        for step, i in enumerate(order, 1):
            here = [m for m in counts if m >> i & 1 and not m & gone]
            gone |= 1 << i
            removed = sum(counts[m][0] for m in here)
            kept = sum(n[0] for m, n in counts.items() if not m & gone)
            fails = sum(n[0] for m, n in counts.items() if m >> i & 1)
            lost = [sum(counts[m][j] for m in here) for j in (1, 2)]
            assert rows[name, step][:-1] == (kept, removed, fails - removed, counts.get(1 << i, (0,))[0], *lost)
            value[i] += removed
    assert all(r[-1] == value["ABCDE".index(name[step - 1])] for (name, step), r in rows.items())
    assert sum(value) == 120 * (total - counts.get(0, (0,))[0])


def test_polynomial_between_corners():
    counts = {0b00011: 3, 0b10100: 2, 0b00001: 5, 0: 4}
    c = audit.polynomial(counts)
    x = [Fraction(1, 2), Fraction(1, 3), Fraction(1, 5), Fraction(0), Fraction(1)]
    chance = lambda m: 1 - _product(1 - x[i] for i in range(5) if m >> i & 1)
    at = sum(k * _product(x[i] for i in range(5) if t >> i & 1) for t, k in enumerate(c))
    assert at == sum(n * chance(m) for m, n in counts.items())


def _product(xs):
    out = Fraction(1)
    for x in xs:
        out *= x
    return out


def fails(text):
    words = [w for w in text.replace("\t", " ").replace("\n", " ").replace("\v", " ").replace("\f", " ").replace("\r", " ").split(" ") if w]
    upper = sum("A" <= c <= "Z" for c in text)
    return [len(words) < 100, 100 * len(set(words)) < 80 * len(words), 100 * upper > 10 * len(text), any(c in "#$%&*|" for c in text)]


@settings(max_examples=300, deadline=None)
@given(st.text("aAbBé漢 \t\n\x0b\x1c\xa0#|\U0001f600", max_size=300))
def test_own_mask(text):
    assert audit.own_mask(text.encode()) == sum(1 << i for i, x in enumerate(fails(text)) if x)


def test_nulls_copies_labels_and_clashing_names(spark):
    rng = random.Random(3)
    long = " ".join(f"w{rng.randrange(10**6)}" for _ in range(200_000))
    docs = [(1, "x", "en"), (2, "x", None), (2, "x", None), (None, "x", "en"), (3, None, "en"), (4, "", "en"), (5, long, ""), (6, long, "en"), (7, "A" * 50, "en")]
    known = [(1, 1, None, ""), (1, 0, 1, ""), (2, 1, 0, ""), (None, 1, 1, ""), (6, None, 1, ""), (99, 1, 1, "")]
    frame = spark.createDataFrame([(*d, "m", "p", "g") for d in docs], DOCS)
    counts = audit.mask_counts(frame, spark.createDataFrame(known, LABELS), Scratch(spark))
    got = sorted(tuple(r) for r in counts.collect())
    want = {}
    first = {}
    for d, t, _ in docs:
        if d is not None:
            first[t or ""] = min(d, first.get(t or "", d))
    for d, t, lang in docs:
        m = sum(1 << i for i, x in enumerate(fails(t or "")) if x) + 16 * (d is not None and d > first[t or ""])
        n = want.setdefault((lang or "", m), [0, 0, 0])
        n[0] += 1
        n[1] += d is not None and any(k[0] == d and k[1] == 1 for k in known)
        n[2] += d is not None and any(k[0] == d and k[2] == 1 for k in known)
    assert got == sorted((*k, *v) for k, v in want.items())
    assert audit.audit(counts).count() == 600 * len({k[0] for k in want})
    assert audit.audit(audit.mask_counts(frame.limit(0), spark.createDataFrame(known, LABELS), Scratch(spark))).count() == 0
