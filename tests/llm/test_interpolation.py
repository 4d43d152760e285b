"""Interpolated scores against plain counting, and what makes them probabilities."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from geosieve.llm import interpolation as lm

SF = "/root/testdata/sf0.01"


def words(text):
    return (text or "").encode().lower().split() + [lm.END]


def contexts(w):
    padded = [lm.BEFORE, lm.BEFORE, *w]
    return [(padded[i], padded[i + 1], x) for i, x in enumerate(w)]


class Counted:
    """n-grams of some texts in dictionaries."""

    def __init__(self, texts):
        self.one, self.two, self.three = Counter(), Counter(), Counter()
        self.second, self.third = Counter(), Counter()  # how often (v) and (u, v) were followed
        for t in texts:
            for u, v, w in contexts(words(t)):
                self.one[w] += 1
                self.two[v, w] += 1
                self.three[u, v, w] += 1
                self.second[v] += 1
                self.third[u, v] += 1
        self.n, self.v = sum(self.one.values()), len(self.one)

    def fractions(self, u, v, w):
        a, b = self.third[u, v], self.second[v]
        f = [self.three[u, v, w] / a if a else 0.0, self.two[v, w] / b if b else 0.0, self.one[w] / max(self.n, 1), 1 / (self.v + 1)]
        return f, min(a.bit_length(), lm.LEVELS - 1), min(b.bit_length(), lm.LEVELS - 1)


def parts(docs):
    learn = [t for d, t in docs if d is not None and zlib.crc32(str(d).encode()) % 7 != 2]
    return learn, [t for t in learn if zlib.crc32((t or "").encode().lower()) % lm.DELETED == 0], [t for t in learn if zlib.crc32((t or "").encode().lower()) % lm.DELETED]


def run(spark, docs, **settings):
    frame = spark.createDataFrame([(d, t, "x", 1) for d, t in docs], "doc_id long, text string, uid string, kind int").repartition(3)
    tested = lm.fold(7, 2)
    out, model = lm.interpolate(frame, tested, ~tested & F.col("doc_id").isNotNull(), **settings)
    return out.collect(), model


def compare(docs, rows, model):
    learn, _, _ = parts(docs)
    c = Counted(learn)
    assert (model.counts.tokens, model.counts.types, model.counts.texts) == (c.n, c.v, len(learn))
    want = []
    for d, t in docs:
        w, score = words(t), 0.0
        for g in contexts(w):
            f, i, j = c.fractions(*g)
            score += math.log10(float(np.dot(model.weights[i, j], f)))
        base = sum(math.log10((c.one[x] + 1) / (c.n + c.v + 1)) for x in w)
        want.append((-1 if d is None else d, d is not None and zlib.crc32(str(d).encode()) % 7 == 2, len(w), sum(c.one[x] > 0 for x in w), round(base, 6), round(score, 6)))
    got = [(-1 if r.doc_id is None else r.doc_id, r.held_out, r.n_tokens, r.n_known, round(r.base_score, 6), round(r.score, 6)) for r in rows]
    for a, b in zip(sorted(got), sorted(want), strict=True):
        assert a[:4] == b[:4] and a[4:] == pytest.approx(b[4:], abs=2e-6, rel=1e-9)
    return c


@pytest.fixture(scope="module")
def table(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]


def test_query_and_weights(spark, table):
    rows, model = run(spark, table)
    compare(table, rows, model)
    query = lm.op13_interpolated_lm(spark, SF).collect()
    assert {(r.doc_id, round(r.score, 6)) for r in query} == {(r.doc_id, round(r.score, 6)) for r in rows}
    assert {r.train_tokens for r in query} == {model.counts.tokens}
    # Better than add-one unigrams on texts not learned from.
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held) * 0.9
    # The weights by the same steps over every deleted token alone.
    _, deleted, kept = parts(table)
    c, by = Counted(kept), {}
    for t in deleted:
        for g in contexts(words(t)):
            f, i, j = c.fractions(*g)
            by.setdefault((i, j), []).append(f)
    for (i, j), fs in by.items():
        if len(fs) >= 300:
            a = lm.maximised(np.ones(len(fs)), np.array(fs).T)
            assert np.abs(a - model.weights[i, j]).max() < 0.05, (i, j, a, model.weights[i, j])


def test_pieces_and_blocks_change_nothing(spark, table):
    some = table[:150]
    whole, model = run(spark, some)
    cut, again = run(spark, some, block_bytes=3000, range_bytes=20_000, piece_bytes=200)
    assert np.allclose(model.weights, again.weights, atol=1e-4)
    c = compare(some, cut, again)
    # Over the known tokens and one unknown one, probabilities add up to one after any context.
    rng = random.Random(2)
    pairs = [*rng.sample(sorted(c.third), 5), (b"never", b"seen"), (b"never", rng.choice(sorted(c.second)))]
    for u, v in pairs:
        total = 0.0
        for w in [*c.one, b"an unknown token"]:
            f, i, j = c.fractions(u, v, w)
            total += float(np.dot(again.weights[i, j], f))
        assert total == pytest.approx(1, abs=1e-9)


def test_nulls_empty_repeated_and_long(spark):
    long = " ".join(random.Random(1).choices(["red", "green", "blue", "x" * 300], k=30_000))
    docs = [(1, None), (2, ""), (2, ""), (None, "red Green"), (3, " \t\n" * 500), (4, "red GREEN\x0bblue é\xa0b"), (5, long), (5, long), (6, "Red green")]
    rows, model = run(spark, docs, piece_bytes=5000, block_bytes=20_000)
    compare(docs, rows, model)
    rows, model = run(spark, [(None, "a b"), (None, None)])  # nothing to learn from
    assert [(r.n_known, r.base_score, r.score) for r in rows] == [(0, 0.0, 0.0)] * 2
    assert run(spark, docs)[0] and not run(spark, [])[0]


def test_cut():
    for most in (1, 3, 7, 100):
        for text in (b"", b"a", b"aa bb  cc\tdd", b"  aa ", b"a" * 20 + b" b"):
            pieces = [p.split() for p in lm.cut(text, most)]
            assert [x for p in pieces for x in p[2:]] == text.split() + [lm.END]
            seen = [lm.BEFORE, lm.BEFORE]
            for p in pieces:
                assert p[:2] == seen[-2:]
                seen += p[2:]


def test_packed_and_borders():
    x = np.array([0, 1, 255, 256, (1 << 64) - 1], np.uint64)
    assert lm.unpacked(lm.packed(x)).tolist() == x.tolist() and not len(lm.unpacked(lm.packed(x[:0])))
    assert np.cumsum(lm.steps(x, np.uint64(0))).tolist() == x.tolist()
    for ranges in (1, 3, 7, 1000):
        at = lm.borders(0, ranges)
        h = np.random.default_rng(0).integers(0, 1 << 64, 1000, dtype=np.uint64)
        assert (np.searchsorted(at, h, "right") - 1 == ((h >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)).all()
