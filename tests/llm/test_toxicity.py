"""Multiple-instance toxicity: held-out accuracy, located sentences, odd rows."""

import math
import random
import re
import zlib

import numpy as np

from geosieve.llm import toxicity
from geosieve.llm.common import documents, fold, labels


def test_held_out_accuracy(spark):
    rows = toxicity.op10_toxicity_mil(spark, "/root/testdata/sf0.1").collect()
    known = {r.doc_id: r.toxic for r in labels(spark, "/root/testdata/sf0.1").collect()}
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in known]
    toxic = [r.predicted for r in held if known[r.doc_id]]
    clean = [r.predicted for r in held if not known[r.doc_id]]
    assert sum(toxic) >= 0.85 * len(toxic) and sum(clean) <= 0.01 * len(clean)


def test_trained_weights_locate_sentences(spark):
    bad, good = "You utter blorptroll{}.", "A calm line number {} here."
    rows = [(i, "\n".join([good.format(i), bad.format(i) if i % 4 == 0 else good.format(-i), "Done! Well?"])) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(160)], "doc_id long, toxic int")
    model = toxicity.fit(docs, known)
    got = {r.doc_id: r for r in toxicity.score_toxicity(docs, model).collect()}
    for i, text in rows[160:]:
        assert (got[i].score > 0.5) == (i % 4 == 0)
        spans = [tuple(map(int, s.split(":"))) for s in got[i].offending.split(",") if s]
        assert [text[a:b] for a, b in spans] == ([bad.format(i)[:-1]] if i % 4 == 0 else [])


def test_odd_rows(spark):
    odd = [(1, None, "x", 9), (2, "", "x", 9), (2, "", "x", 9), (None, "a" * 200_000, None, 9), (3, "x. " * 50_000, "y", 9)]
    docs = spark.createDataFrame(odd, "doc_id long, text string, score string, _z int")
    for known in ([], [(1, 1)], [(1, 0), (2, None), (None, 1)]):
        model = toxicity.fit(docs, spark.createDataFrame(known, "doc_id long, toxic int"))
        got = toxicity.score_toxicity(docs, model).collect()
        assert len(got) == 5 and all(0 <= r.score <= 1 for r in got)
    assert toxicity.score_toxicity(docs.limit(0), model).count() == 0


def test_scores_and_spans_by_hand(spark):
    """Noisy-or over sentences of the logistic sums of words' features, all recomputed; training lowers the bags' loss."""
    docs, known = documents(spark, "/root/testdata/sf0.01"), labels(spark, "/root/testdata/sf0.01")
    model = toxicity.fit(docs, known, held_out=fold(4, 2))
    texts = {r.doc_id: r.text or "" for r in docs.collect()}

    def weight(word):
        named = ["=" + word] + ["^" + word[:k] for k in (3, 4, 5, 6) if len(word) > k] + (["$" + word[-4:]] if len(word) > 4 else [])
        return sum(model.weight.get(f, 0.0) for f in {zlib.crc32(x.encode()) % (1 << 18) for x in named})

    def by_hand(text):
        clean, spans, at = 1.0, [], 0
        for part in re.split(r"([.!?\n]+)", text) if re.search(r"[^.!?\n]", text) else [text]:
            if part and (not re.fullmatch(r"[.!?\n]+", part) or part == text):
                z = model.bias + sum(weight(w) for w in re.findall(r"\w+", part.lower()))
                p = 1 / (1 + math.exp(-z))
                clean *= 1 - p
                spans += [f"{at}:{at + len(part)}"] if p >= 0.5 else []
            at += len(part)
        return (1 - clean if text else 1 / (1 + math.exp(-model.bias))), ",".join(spans)

    rows = toxicity.score_toxicity(docs.select("doc_id", "text"), model).collect()
    assert len(rows) == len(texts)
    for r in rows:
        score, spans = by_hand(texts[r.doc_id])
        assert abs(r.score - score) < 1e-9 and r.offending == spans
    assert any(r.offending for r in rows)


def test_training_follows_the_gradient():
    """The trained loss is near the least that small steps from it reach."""
    rng = random.Random(2)
    bags = [(i % 3 == 0, rng.randrange(4), [[rng.randrange(5)] + ([7] if i % 3 == 0 and j == 0 else []) for j in range(3)]) for i in range(90)]
    theta, bias = toxicity.train([(float(y), n, held) for y, n, held in bags])

    def loss(theta, bias):
        out = toxicity.RIDGE / 2 * sum(x * x for x in theta)
        for y, plain, held in bags:
            clean = math.log(1 - 1 / (1 + math.exp(-bias))) * plain
            clean += sum(math.log(1 - 1 / (1 + math.exp(-bias - sum(theta[f] for f in s)))) for s in held)
            out -= (math.log(-math.expm1(clean)) if y else clean) / len(bags)
        return out

    least = loss(theta, bias)
    assert theta[7] > 3 and least < 0.2 < loss(theta * 0, bias)
    for f in range(8):
        for step in (-0.3, 0.3):
            moved = theta.copy()
            moved[f] += step
            assert loss(moved, bias) > least - 5e-3


def test_gradient_and_sums_over_tasks(spark):
    """The gradient is the loss's slope, and a table's sums are those of its bags held in memory."""
    rng = np.random.default_rng(3)
    bags = [(float(i % 3 == 0), int(rng.integers(4)), [rng.integers(0, 9, rng.integers(1, 4)).tolist() for _ in range(rng.integers(0, 4))]) for i in range(60)]
    held = [s for b in bags for s in b[2]]
    arrays = [np.array(x) for x in ([b[0] for b in bags], [float(b[1]) for b in bags], [len(b[2]) for b in bags], [len(s) for s in held], [f for s in held for f in s])]
    theta = rng.normal(0, 1, 10)
    loss, gradient = toxicity.pull(theta, *arrays)
    for k in range(10):
        step = np.eye(10)[k] * 1e-5
        slope = (toxicity.pull(theta + step, *arrays)[0] - toxicity.pull(theta - step, *arrays)[0]) / 2e-5
        assert abs(slope - gradient[k]) < 1e-5 * max(1, abs(slope))
    table = spark.createDataFrame(bags, "label double, plain long, held array<array<long>>").repartition(3)
    got = toxicity.summed(table, theta)
    assert abs(got[0] - loss) < 1e-9 and np.allclose(got[1], gradient, atol=1e-9)
    assert toxicity.summed(table.limit(0), theta)[0] == 0


def test_descent_reaches_the_least():
    """A stretched bowl's bottom is found, and a loss that no step lowers ends it."""
    scale, middle = np.array([1.0, 30.0, 900.0]), np.array([2.0, -1.0, 0.5])
    got = toxicity.descend(lambda x: (float(scale @ (x - middle) ** 2), 2 * scale * (x - middle)), np.zeros(3))
    assert np.abs(got - middle).max() < 1e-4
    assert np.array_equal(toxicity.descend(lambda x: (float(np.abs(x).sum()), np.ones(2)), np.zeros(2)), np.zeros(2))
