"""Whitening against exact integers and full eigendecompositions."""

from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import types as T

from geosieve.llm import whitening

SF = "/root/testdata/sf0.01"
SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("x", T.StringType()), T.StructField("n", T.StringType())])


def brute(vectors, k=4):
    """n, deviations, |whitened| and shares of the trace for usable vectors by numpy and exact integers."""
    x = np.array([[int(np.floor(256 * float(np.float32(c)))) for c in v] for v in vectors], object)
    fit = [list(t) for t in {tuple(r) for r in x}]
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    mean = [Fraction(s, n) for s in sums]
    c = np.array([[float(a - m) for a, m in zip(r, mean)] for r in fit])
    value, basis = np.linalg.eigh(c.T @ c / n)
    value, basis = value[::-1], basis[:, ::-1]
    y = np.array([[float(a - m) for a, m in zip(r, mean)] for r in x]) @ basis[:, :k] / np.sqrt(value[:k])
    return n, [sum((n * a - s) ** 2 for a, s in zip(r, sums)) for r in x], np.abs(y), value[:k] / value.sum()


def check(rows, ids, vectors, k=4):
    n, deviation, y, share = brute(vectors, k)
    assert len(rows) == len(ids) * k
    by = {}
    for r in rows:
        by.setdefault(r.vec_id, {}).setdefault(r.component, []).append(r)
    for i, d, w in zip(ids, deviation, y):
        for j in range(k):
            for r in by[i][j + 1]:
                assert (r.n, r.deviation) == (n, d)
                assert abs(r.whitened) == pytest.approx(w[j], rel=1e-8, abs=1e-9)
                assert r.explained == pytest.approx(share[j], rel=1e-10)
                assert r.identity_error < 1e-9


def test_query(spark):
    got = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()
    check(whitening.op11_embedding_whitening(spark, SF).collect(), [r.vec_id for r in got], [r.embedding for r in got])


def test_far_from_the_origin_and_repeated(spark):
    rng = np.random.default_rng(5)
    spread = np.array([9, 5, 3, 2, 1, 0.5])
    vectors = (1e4 + rng.standard_normal((300, 6)) * spread).tolist() * 2 + [[1e4] * 6] * 500
    rows = [(i, v, "x", "n") for i, v in enumerate(vectors)]
    check(whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect(), list(range(len(rows))), vectors)


def test_unusable_rows_and_small_tables(spark):
    nan, inf = float("nan"), float("inf")
    bad = [(1, None, "", ""), (2, [1.0, None], "", ""), (3, [nan, 1.0], "", ""), (4, [inf, 1.0], "", ""), (5, [], "", ""), (6, [1.0, 2.0, 3.0], "", "")]
    good = [(None, [0.0, 1.0], "", ""), (8, [1.0, 0.0], "", ""), (9, [3.0, 2.5], "", ""), (9, [3.0, 2.5], "", "")]
    rows = whitening.whiten(spark.createDataFrame(bad + good, SCHEMA)).collect()
    assert sorted((r.vec_id or 0, r.component) for r in rows) == [(0, 1), (0, 2), (8, 1), (8, 2), (9, 1), (9, 1), (9, 2), (9, 2)]
    assert {r.n for r in rows} == {3}
    # One distinct vector has no spread, so no component; nor has an empty table.
    assert whitening.whiten(spark.createDataFrame(good[-2:], SCHEMA)).count() == 0
    assert whitening.whiten(spark.createDataFrame([], SCHEMA)).count() == 0
    # On a line there is one component.
    line = whitening.whiten(spark.createDataFrame([(i, [float(i), 2.0 * i], "", "") for i in range(9)], SCHEMA)).collect()
    assert {r.component for r in line} == {1} and all(r.explained == pytest.approx(1) for r in line)


def test_deviations_past_a_long():
    x = np.array([[1 << 40, 0], [0, 0]])
    assert whitening.deviations(x, 2, [1 << 40, 0]) == [None, None]
    assert whitening.deviations(x, 2, [3, 4])[1] == 25


@pytest.mark.parametrize("spectrum, expands", [([1000, 400, 150, 60, *[1e-7] * 36], False), ([5.0 - 0.01 * i for i in range(40)], True)])
def test_passes_or_expansion(spectrum, expands):
    q = np.linalg.qr(np.random.default_rng(1).standard_normal((40, 40)))[0]
    v = (q * spectrum) @ q.T
    basis, values, passes, expanded = whitening.leading(lambda b: v @ b, 40, 4, 8, 3, 1e-11)
    assert expanded == expands and passes <= 4
    assert np.allclose(values, spectrum[:4], rtol=1e-12)
    assert np.allclose(np.abs(basis.T @ q[:, :4]), np.eye(4), atol=1e-9)
