"""The rule ensemble: held-out accuracy, compiled rules against their meaning, odd rows."""

import math
import zlib

import numpy as np

from geosieve.llm import quality
from geosieve.llm.common import documents, labels


def test_held_out_accuracy(spark):
    rows = quality.op9_quality_rules(spark, "/root/testdata/sf0.01").collect()
    known = {r.doc_id: r.quality for r in labels(spark, "/root/testdata/sf0.01").collect()}
    assert len(rows) == 1000 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in known]
    assert len(held) > 40 and sum(r.predicted == known[r.doc_id] for r in held) >= 0.95 * len(held)


def test_rules_compile(spark):
    texts = ["", "one two two three.", "A! B! C!", "x | y | z", "Le Le Le Le 12", "w" * 100_000, " " * 50_000, "! " * 30_000]
    df = spark.createDataFrame([(t, i) for i, t in enumerate(texts)], "text string, score int").fillna("", ["text"])
    names = list(quality.statistics(df.text))
    rules = quality.Rules(((((1, True, 3.0), (2, False, 0.5)), 1.5), (((4, False, 0.2),), -2.0)), 0.25)
    values = df.select("text", *[c.alias(n) for n, c in quality.statistics(df.text).items()]).collect()
    want = {}
    for r in values:
        s = [r[n] for n in names]
        z = 0.25 + 1.5 * (s[1] <= 3.0 and s[2] > 0.5) - 2.0 * (s[4] > 0.2)
        want[r.text] = 1 / (1 + math.exp(-z))
    nulls = df.replace("", None, ["text"])
    got = {r.text or "": r.score for r in nulls.withColumn("score", rules.score("text")).collect()}
    assert got.keys() == want.keys() and all(abs(got[t] - want[t]) < 1e-12 for t in got)


def test_few_labels(spark):
    docs = spark.createDataFrame([(1, "a b", "x"), (1, "a b", "x"), (2, None, "y"), (None, "c", None)], "doc_id long, text string, label string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    one = spark.createDataFrame([(1, 1), (2, None), (None, 0)], "doc_id long, quality int")
    assert quality.fit(docs, none).intercept == 0 and quality.fit(docs, one).intercept > 0
    assert docs.select(quality.fit(docs, one).score("text").alias("s")).where("s > 0.5").count() == 4
    both = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")
    assert docs.select(quality.fit(docs, both).score("text").alias("s")).where("s between 0 and 1").count() == 4
    assert docs.limit(0).select(quality.fit(docs.limit(0), both).score("text")).count() == 0

def test_fit_and_score_by_hand(spark):
    """Rules are the paths of trees, weights those at which no coordinate can be bettered, and scores their logistic sum."""
    docs, known = documents(spark, "/root/testdata/sf0.01"), labels(spark, "/root/testdata/sf0.01")
    rules = quality.fit(docs, known, held_out=quality.fold(5, 0))
    named = quality.statistics(docs.text)
    rows = docs.join(known, "doc_id").where(~quality.fold(5, 0)).where("quality is not null")
    rows = rows.select("doc_id", "quality", *[c.alias(n) for n, c in named.items()]).collect()
    x = np.array([[r[n] for n in named] for r in rows])
    y = np.array([r.quality for r in rows], float)
    hold = lambda rule: np.all([(x[:, i] <= t) if low else (x[:, i] > t) for i, low, t in rule], axis=0)
    bits = np.array([hold(rule) for rule, _ in rules.weighted], float).T
    weights = np.array([w for _, w in rules.weighted])
    assert 0 < len(weights) < 8 * 14 * quality.TREES and all(1 <= len(r) <= 2 * quality.DEPTH for r, _ in rules.weighted)
    assert all(0 <= i < len(named) for r, _ in rules.weighted for i, _, _ in r)
    p = 1 / (1 + np.exp(-(bits @ weights + rules.intercept)))
    # Lasso: the gradient of the mean loss is the penalty against the sign of each weight that isn't 0, and 0 for the intercept.
    gradient = bits.T @ (p - y) / len(y)
    assert np.abs(gradient + quality.LASSO * np.sign(weights)).max() < 5e-4 and abs((p - y).mean()) < 5e-4
    scored = {r.doc_id: r.score for r in docs.withColumn("score", rules.score("text")).select("doc_id", "score").collect()}
    assert max(abs(scored[r.doc_id] - s) for r, s in zip(rows, p)) < 1e-9


def test_paths_of_trees():
    class Split:
        def __init__(self, i, t):
            self.i, self.t = i, t

        def featureIndex(self):  # noqa: N802
            return self.i

        def threshold(self):
            return self.t

    class Node:
        def __init__(self, split=None, left=None, right=None):
            self.s, self.left, self.right = split, left, right

        def numDescendants(self):  # noqa: N802
            return 2 if self.s else 0

        def split(self):
            return self.s

        def leftChild(self):  # noqa: N802
            return self.left

        def rightChild(self):  # noqa: N802
            return self.right

    tree = Node(Split(0, 5.0), Node(Split(0, 3.0), Node(), Node()), Node(Split(1, 2.0), Node(), Node()))
    assert set(quality.paths(tree)) == {
        ((0, True, 5.0),), ((0, False, 5.0),), ((0, True, 3.0),), ((0, False, 3.0), (0, True, 5.0)), ((0, False, 5.0), (1, True, 2.0)), ((0, False, 5.0), (1, False, 2.0)),
    }
