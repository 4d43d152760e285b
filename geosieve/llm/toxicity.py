"""Toxicity by multiple-instance learning: sentences are scored, documents are labelled.

A sentence's score is a logistic sum over its words; a word adds the weights
of its features, which are hashed: the word itself, its beginnings and its
ending. A document is toxic unless none of its sentences is: noisy-or,
1 - prod(1 - p). Weights are trained from document labels alone; the sentence
scores then locate the offending sentences.

Fitting reads a sample of about FIT_ROWS labelled rows chosen by a hash of
their ids. Spark counts in how many documents of either label each of BUCKETS
features stands; the FEATURES most typical of toxic ones are trained, on bags
that hold nothing else, kept as a table: each task sums the gradient of its
bags, and the driver sees one sum a task. Everything is scored. The label, the language, the
source and the id are no inputs. With no labelled rows of one class no feature
has a weight and every sentence has the same small score.

A null text is read as empty, and an empty text is one empty sentence. Texts
are read whole. Repeated labels and ids count once in fitting, an id's texts
by the least of them. Of features typical to the same degree the smaller number
is taken first. Labels that are null are left out. Other columns pass through, and an input column
with the name of an output column is replaced.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch, batched, documents, fold, labelled_texts, labels, small_batches, texts_of

FIT_ROWS = 20_000
BUCKETS, FEATURES = 1 << 18, 1024
LEAST_DOCUMENTS, LEAST_Z = 4, 4.5
RIDGE, PRIOR = 1e-4, -6.0
STEPS, MEMORY, HALVINGS, LONGEST, GRADIENT = 60, 10, 12, 4.0, 1e-5
THRESHOLD, OFFENDING = 0.3, 0.5
PARTS, CACHE = 8, 100_000

_sentence = re.compile(r"[^.!?\n]+")
_word = re.compile(r"\w+")


def features(word: str) -> list[int]:
    """The hashed features of a lower-case word."""
    named = {"=" + word, *("^" + word[:k] for k in (3, 4, 5, 6) if len(word) > k), *("$" + word[-4:] for _ in range(len(word) > 4))}
    return [zlib.crc32(x.encode()) % BUCKETS for x in named]


def sentences(text: str) -> list[tuple[int, int]]:
    """(start, end) of a text's sentences, at least one."""
    return [m.span() for m in _sentence.finditer(text)] or [(0, len(text))]


def words(sentence: str) -> list[str]:
    """The lower-case words of a sentence."""
    return _word.findall(sentence.lower())


@dataclass(frozen=True)
class Weights:
    """Trained feature weights and the bias of a sentence."""

    weight: dict[int, float]
    bias: float


class Scorer:
    """Scores sentences; a bounded cache keeps each word's total weight."""

    def __init__(self, model: Weights):
        self.model, self.known = model, {}

    def logit(self, sentence: str) -> float:
        """The logistic sum of a sentence."""
        total, known = self.model.bias, self.known
        for w in words(sentence):
            x = known.get(w)
            if x is None:
                if len(known) > CACHE:
                    known.clear()
                x = known[w] = sum(self.model.weight.get(f, 0.0) for f in features(w))
            total += x
        return total

    def score(self, text: str) -> tuple[float, list[tuple[int, int]]]:
        """The noisy-or score and the spans of offending sentences."""
        spans = sentences(text)
        z = np.array([self.logit(text[a:b]) for a, b in spans])
        none = -np.logaddexp(0.0, z)  # log(1 - p)
        return float(-np.expm1(none.sum())), [s for s, x in zip(spans, none) if x <= np.log1p(-OFFENDING)]


def pull(theta: np.ndarray, label: np.ndarray, plain: np.ndarray, sentences_of: np.ndarray, features_of: np.ndarray, places: np.ndarray) -> tuple[float, np.ndarray]:
    """The noisy-or loss of bags and its gradient, summed over them.

    A bag has a label, a number of sentences without features and
    ``sentences_of`` others, each of those ``features_of`` places in theta,
    whose last entry is the bias.
    """
    of = np.repeat(np.arange(len(label)), sentences_of)
    row = np.repeat(np.arange(len(of)), features_of)
    p0 = 1 / (1 + np.exp(-theta[-1]))
    p = 1 / (1 + np.exp(-theta[-1] - np.bincount(row, theta[places], len(of))))
    clean = np.bincount(of, np.log1p(-np.minimum(p, 1 - 1e-12)), len(label)) + plain * np.log1p(-min(p0, 1 - 1e-12))
    toxic = np.maximum(-np.expm1(clean), 1e-12)
    # Negative log-likelihood by a sentence's logit: p for a clean bag, -p * (1 - toxic) / toxic for a toxic one.
    slope = np.where(label == 1, -np.exp(clean) / toxic, 1.0)
    by = slope[of] * p
    gradient = np.append(np.bincount(places, by[row], len(theta) - 1), by.sum() + (slope * plain).sum() * p0)
    return -float(np.where(label == 1, np.log(toxic), clean).sum()), gradient


def descend(evaluate: Callable[[np.ndarray], tuple[float, np.ndarray]], start: np.ndarray) -> np.ndarray:
    """Where a smooth loss is least, by limited-memory quasi-Newton steps; evaluate gives the loss and its gradient.

    A step is halved until the loss falls enough. It ends where the gradient's
    largest entry is under GRADIENT, where no step helps, or after STEPS.
    """
    at, (loss, gradient) = start, evaluate(start)
    memory: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(STEPS):
        if np.abs(gradient).max() < GRADIENT:
            break
        way, back = -gradient, []
        for moved, turned in reversed(memory):
            back.append(moved @ way / (moved @ turned))
            way = way - back[-1] * turned
        way = way * (memory[-1][0] @ memory[-1][1] / (memory[-1][1] @ memory[-1][1]) if memory else 1 / max(np.abs(gradient).max(), 1.0))
        for (moved, turned), x in zip(memory, reversed(back)):
            way = way + (x - turned @ way / (moved @ turned)) * moved
        size, fall = min(1.0, LONGEST / max(np.abs(way).max(), 1e-12)), gradient @ way
        for _ in range(HALVINGS):
            new_loss, new_gradient = evaluate(at + size * way)
            if new_loss <= loss + 1e-4 * size * fall:
                break
            size /= 2
        else:
            break
        moved, turned = size * way, new_gradient - gradient
        if moved @ turned > 1e-12:
            memory = [*memory[1 - MEMORY :], (moved, turned)]
        at, loss, gradient = at + moved, new_loss, new_gradient
    return at


def trained(sums: Callable[[np.ndarray], tuple[float, np.ndarray]], bags: float, width: int) -> tuple[np.ndarray, float]:
    """Feature weights and bias where the mean loss of bags with its ridge is least; sums gives the loss and gradient over all bags."""

    def evaluate(theta: np.ndarray) -> tuple[float, np.ndarray]:
        loss, gradient = sums(theta)
        ridge = np.append(RIDGE * theta[:-1], 0.0)
        return loss / bags + ridge @ theta / 2, gradient / bags + ridge

    theta = descend(evaluate, np.append(np.zeros(width), PRIOR))
    return theta[:-1], float(theta[-1])


def train(bags: list[tuple[float, int, list[list[int]]]]) -> tuple[np.ndarray, float]:
    """Feature weights and bias of bags held in memory: (label, sentences without features, features of each other sentence)."""
    held = [s for b in bags for s in b[2]]
    arrays = np.array([b[0] for b in bags]), np.array([b[1] for b in bags], float), np.array([len(b[2]) for b in bags], int), np.array([len(s) for s in held], int), np.array([f for s in held for f in s], int)
    return trained(lambda theta: pull(theta, *arrays), len(bags), FEATURES)


def summed(bags: DataFrame, theta: np.ndarray) -> tuple[float, np.ndarray]:
    """The loss of a table of bags (label, plain, held) and its gradient: each task sums its own, and one row a task comes back."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loss, gradient = 0.0, np.zeros_like(theta)
        for b in batches:
            held = b.column("held")
            inner = held.flatten()
            lengths = held.value_lengths().to_numpy(zero_copy_only=False), inner.value_lengths().to_numpy(zero_copy_only=False)
            x, g = pull(theta, b.column("label").to_numpy(zero_copy_only=False), b.column("plain").to_numpy(zero_copy_only=False).astype(float), *lengths, inner.flatten().to_numpy(zero_copy_only=False))
            loss, gradient = loss + x, gradient + g
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()]), pa.array([loss]), pa.array([gradient.tobytes()], pa.binary())], names=["part", "loss", "gradient"])

    got = sorted(bags.mapInArrow(part, "part long, loss double, gradient binary").collect())  # PARTS rows at most
    return sum(r.loss for r in got), sum((np.frombuffer(r.gradient) for r in got), np.zeros_like(theta))


def fit(docs: DataFrame, known: DataFrame, label: str = "toxic", held_out=None) -> Weights:
    """Weights fitted on a sample of the labelled rows that aren't held out."""
    small_batches(docs.sparkSession)
    scratch = Scratch(docs.sparkSession)
    rows = labelled_texts(docs, known, label, held_out if held_out is not None else F.lit(False), FIT_ROWS)
    rows = scratch.keep(rows.repartition(PARTS, "doc_id").coalesce(PARTS).sortWithinPartitions("doc_id", "text", "label"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((2, BUCKETS), np.int64)
        for b in batches:
            for text, y in zip(texts_of(b.column("text")), b.column("label").to_pylist()):
                own: set[int] = set()
                for w in set(words(text)):
                    own.update(features(w))
                seen[int(y), list(own)] += 1
        some = np.flatnonzero(seen.sum(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(seen[0, some]), pa.array(seen[1, some])], names=["feature", "clean", "toxic"])

    clean, toxic = (float(x or 0) for x in rows.agg(F.sum(1 - F.col("label")), F.sum("label")).first())
    if not clean or not toxic:
        scratch.drop(rows)
        return Weights({}, PRIOR if not toxic else -PRIOR)
    share = toxic / (clean + toxic)
    found = rows.mapInArrow(count, "feature long, clean long, toxic long").groupBy("feature").agg(F.sum("clean").alias("c"), F.sum("toxic").alias("t"))
    total = F.col("c") + F.col("t")
    found = found.withColumn("z", (F.col("t") - share * total) / F.sqrt(share * (1 - share) * total))
    found = found.where((F.col("t") >= LEAST_DOCUMENTS) & (F.col("z") >= LEAST_Z)).orderBy(F.desc("z"), "feature").limit(FEATURES)
    chosen = [r.feature for r in found.collect()]  # at most FEATURES
    place = {f: i for i, f in enumerate(chosen)}

    def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict[str, tuple[int, ...]] = {}

        def places(word: str) -> tuple[int, ...]:
            if word not in memo:
                if len(memo) > CACHE:
                    memo.clear()
                memo[word] = tuple(place[f] for f in features(word) if f in place)
            return memo[word]

        for b in batches:
            plain, held = [], []
            for text in texts_of(b.column("text")):
                kept = [[p for w in words(text[s:e]) for p in places(w)] for s, e in sentences(text)]
                plain.append(sum(not x for x in kept))
                held.append([x for x in kept if x])
            yield pa.RecordBatch.from_arrays([b.column("label"), pa.array(plain, pa.int64()), pa.array(held, pa.list_(pa.list_(pa.int64())))], names=["label", "plain", "held"])

    table = scratch.keep(rows.mapInArrow(bags, "label double, plain long, held array<array<long>>"))
    theta, bias = trained(lambda at: summed(table, at), clean + toxic, len(chosen))
    scratch.drop(table)
    scratch.drop(rows)
    return Weights({f: float(theta[i]) for f, i in place.items() if abs(theta[i]) > 1e-6}, bias)


RESULT = T.StructType([T.StructField("score", T.DoubleType()), T.StructField("offending", T.StringType())])


def score_toxicity(df: DataFrame, model: Weights, text: str = "text") -> DataFrame:
    """Add score and offending, the start:end of sentences that score 0.5 or more."""

    small_batches(df.sparkSession)

    def make():
        scorer = Scorer(model)

        def one(column: pa.Array) -> pa.Array:
            got = [scorer.score(t) for t in texts_of(column)]
            spans = [",".join(f"{a}:{b}" for a, b in s) for _, s in got]
            return pa.StructArray.from_arrays([pa.array([p for p, _ in got], pa.float64()), pa.array(spans, pa.string())], names=["score", "offending"])

        return one

    made = df.withColumn("_toxicity", batched(make, RESULT, F.col(text)))
    return made.withColumn("score", F.col("_toxicity.score")).withColumn("offending", F.col("_toxicity.offending")).drop("_toxicity")


def op10_toxicity_mil(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its toxicity and its offending sentences, learned without the held-out fold."""
    docs = documents(spark, sf_dir)
    model = fit(docs, labels(spark, sf_dir), held_out=fold(4, 2))
    scored = score_toxicity(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", fold(4, 2).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "offending")
