"""Quality classifier: a sparse rule ensemble compiled into column expressions.

Statistics of a text are column expressions. A small forest is fitted on them;
each path of a tree from its root is a rule, a conjunction of comparisons. A
lasso logistic regression gives most rules no weight; the rest become one
column expression, so scoring is a projection over the text.

Fitting reads a sample of labelled rows, about FIT_ROWS of them chosen by a
hash of their ids; everything is scored. The label, the language, the source
and the id are no inputs. With no labelled rows every score is 0.5, with one
class it is that class's smoothed share.

A null text is read as empty; an empty text has the statistics 0 and a score.
Texts are read whole. Repeated labels and ids count once in fitting, an id's
texts by the least of them. Labels that are null are left out. Other columns pass through, and an input
column with the name of an output column is replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, documents, fold, labelled_texts, labels

FIT_ROWS = 20_000
TREES, DEPTH, LASSO, SEED = 16, 3, 0.0008, 7
THRESHOLD = 0.3
PARTS = 8

Rule = tuple[tuple[int, bool, float], ...]  # (statistic, at most?, threshold), all of which hold


def statistics(text: Column) -> dict[str, Column]:
    """Named statistics of a text, each a double."""
    n = F.greatest(F.length(text), F.lit(1))
    words = F.filter(F.split(text, r"\s+"), lambda w: w != "")
    count = F.greatest(F.size(words), F.lit(1))
    hits = lambda pattern: F.regexp_count(text, F.lit(pattern))
    found = {
        "log_chars": F.log1p(F.length(text)),
        "chars_a_word": F.length(text) / count,
        "distinct_words": F.size(F.array_distinct(words)) / count,
        "doubled_words": hits(r"(?<!\S)(\S+)\s+\1(?!\S)") / count,
        "capitals": hits(r"\p{Lu}") / n,
        "digits": hits(r"\d") / n,
        "symbols": hits(r"[^\p{L}\p{N}\s.,]") / n,
        "symbol_words": hits(r"[\p{L}.,][*#$%&!|]") / count,
        "bare_symbols": hits(r"(?<!\S)[^\p{L}\p{N}\s]+(?!\S)") / count,
        "stops": hits(r"\.(?!\S)") / count,
        "lines": hits(r"\n") / count,
        "longest_word": F.coalesce(F.array_max(F.transform(words, F.length)), F.lit(0)),
    }
    return {name: column.cast("double") for name, column in found.items()}


@dataclass(frozen=True)
class Rules:
    """Weighted rules over the statistics; score() is their logistic sum as a column."""

    weighted: tuple[tuple[Rule, float], ...]
    intercept: float

    def score(self, text: Column | str, statistic: list[Column] | None = None) -> Column:
        """The score of a text column, 0 to 1."""
        statistic = statistic or list(statistics(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))).values())
        total = F.lit(self.intercept)
        for rule, weight in self.weighted:
            total = total + F.when(holds(rule, statistic), F.lit(weight)).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-total))


def holds(rule: Rule, statistic: list[Column]) -> Column:
    """Whether all comparisons of a rule hold."""
    out = F.lit(True)
    for i, low, threshold in rule:
        out = out & ((statistic[i] <= threshold) if low else (statistic[i] > threshold))
    return out


def paths(node, before: Rule = ()) -> list[Rule]:
    """The rules of a fitted tree: the path to each node but the root, the narrowest bounds only."""
    found = [tuple(sorted(before))] if before else []
    if node.numDescendants():
        split = node.split()
        for low, child in ((True, node.leftChild()), (False, node.rightChild())):
            at, threshold = split.featureIndex(), split.threshold()
            kept = tuple(x for x in before if x[:2] != (at, low))
            found += paths(child, (*kept, (at, low, threshold)))
    return found


def fit(docs: DataFrame, known: DataFrame, label: str = "quality", held_out: Column | None = None) -> Rules:
    """Rules fitted on a sample of the labelled rows that aren't held out."""
    scratch = Scratch(docs.sparkSession)
    rows = labelled_texts(docs, known, label, held_out if held_out is not None else F.lit(False), FIT_ROWS)
    named = statistics(F.col("text"))
    rows = rows.select("doc_id", "label", *[c.alias(n) for n, c in named.items()])
    rows = scratch.keep(rows.repartition(PARTS, "doc_id").coalesce(PARTS).sortWithinPartitions("doc_id", *named))
    total, ones = rows.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    if not 0 < ones < total:
        scratch.drop(rows)
        share = (ones + 1) / (total + 2)
        return Rules((), _logit(share))
    table = VectorAssembler(inputCols=list(named), outputCol="features").transform(rows)
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, featureSubsetStrategy="onethird", subsamplingRate=0.7).fit(table)
    rules = sorted({rule for tree in forest.trees for rule in paths(tree._call_java("rootNode"))})
    statistic = [F.col(n) for n in named]
    bits = rows.select("label", *[holds(r, statistic).cast("double").alias(f"r{i}") for i, r in enumerate(rules)])
    table = VectorAssembler(inputCols=[f"r{i}" for i in range(len(rules))], outputCol="features").transform(bits).select("features", "label")
    table = table.cache()
    model = LogisticRegression(elasticNetParam=1.0, regParam=LASSO, maxIter=60, standardization=False).fit(table)
    table.unpersist()
    scratch.drop(rows)
    return Rules(tuple((r, float(w)) for r, w in zip(rules, model.coefficients) if w), float(model.intercept))


def _logit(p: float) -> float:
    from math import log

    return log(p / (1 - p))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its quality score, learned without the held-out fold."""
    docs = documents(spark, sf_dir)
    rules = fit(docs, labels(spark, sf_dir), held_out=fold(5, 0))
    scored = docs.select("doc_id", fold(5, 0).alias("held_out"), rules.score("text").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
