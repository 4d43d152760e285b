"""Mixing sources to target weights by iterative proportional fitting.

Documents fall into cells by source, language and topic. The cells' token
weights are raked: in turn the weights of each source, language and topic are
scaled to its goal, ROUNDS times. No cell can give more tokens than it holds,
so a scaling counts a cell's weight up to its own share only, and a class that
holds fewer tokens than its target asks for is kept whole, while the others
share the rest in the proportions of their targets. A cell's raked weight over
its own share is the probability of its documents, so tokens times probability
have the goals as marginals; mix_short names the marginals in which a
document's class can't reach its target.

The values of a marginal without a target form the class "other", so there
are at most as many cells as combinations of targets and "other", whatever the
corpus. Targets of classes that don't occur are shared out among the rest, and
a marginal none of whose targets occurs is left as it is. A
document's draw is a hash of its id, so runs agree and repeated rows share
their fate.

Token counts and topics are columns that the caller gives; mix_documents fills
in pre-tokens, counted by pattern, and the form of a text where there are none.
A null or empty text counts one token, its end; a null count is one token. Null sources, languages and
topics are "other"; a null id draws as the empty string. Other columns pass
through, and an input column with the name of an output column is replaced.
Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import Scratch, documents

ROUNDS = 6
#: The raked cells are written out after so many rounds, which keeps the plan short.
ROUNDS_PER_TABLE = 3
KEEP = 0.6
OTHER = "other"
#: Fixed target shares of the registered query.
TARGETS = {
    "source": {"src0": 0.15, **{f"src{i}": 0.04 for i in range(1, 20)}, OTHER: 0.09},
    "lang": {"en": 0.55, "de": 0.15, "fr": 0.15, "es": 0.1, OTHER: 0.05},
    "topic": {"prose": 0.6, "tabular": 0.15, "legal": 0.1, "contact": 0.15},
}


PRETOKEN = r"[\p{L}\p{M}]+|\p{N}|[^\p{L}\p{M}\p{N} \t\n\r\f\x0B]+"
MOST = 1e200


def pretokens(text: Column) -> Column:
    """Runs of letters, single digits and runs of other signs, and the end of the text."""
    return (F.regexp_count(text, F.lit(PRETOKEN)) + 1).cast("long")


def surface_topic(text: Column) -> Column:
    """A topic by what a text holds: licence lines, table bars, contacts, or else prose."""
    return (
        F.when(F.contains(text, F.lit("icense")), "legal")
        .when(F.contains(text, F.lit(" | ")), "tabular")
        .when(F.contains(text, F.lit("@")) | F.contains(text, F.lit("+1 (")), "contact")
        .otherwise("prose")
    )


def _class(value: Column, targets: dict[str, float]) -> Column:
    return F.when(value.isin(*targets), value).otherwise(F.lit(OTHER))


def wanted(cells: DataFrame, targets: dict[str, dict[str, float]], keep: float) -> DataFrame:
    """Add to cells(one column a marginal, tokens) their share, and of each marginal its class's held and asked shares and the goal.

    held is the class's share of all tokens, asked its target's part of keep,
    goal the most even multiple of the target that no class holds too little
    for; the goals of a marginal add up to keep, or to all that is there.
    """
    whole, names = W.partitionBy(), list(targets)
    out = cells.withColumn("share", F.col("tokens") / F.sum("tokens").over(whole))
    for name in names:
        target = F.create_map(*[F.lit(x) for kv in (targets[name] | {OTHER: targets[name].get(OTHER, 0.0)}).items() for x in kv])[F.col(name)]
        first = F.row_number().over(W.partitionBy(name).orderBy(*names)) == 1
        out = out.withColumns({"_t": F.coalesce(target, F.lit(0.0)), f"held_{name}": F.sum("share").over(W.partitionBy(name)), "_first": first})
        total = F.sum(F.when(F.col("_first"), F.col("_t")).otherwise(0.0)).over(whole)
        out = out.withColumn("_t", F.when(total > 0, F.col("_t") / total)).withColumn(f"asked_{name}", F.col("_t") * keep)
        out = out.withColumn("_r", F.when(F.col("_t") > 0, F.col(f"held_{name}") / F.col("_t")))
        order = W.orderBy(F.asc_nulls_last("_r"), *names)
        one = lambda c: F.when(F.col("_first"), F.col(c)).otherwise(0.0)
        before = F.coalesce(F.sum(one(f"held_{name}")).over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))
        after = F.sum(one("_t")).over(order.rowsBetween(0, W.unboundedFollowing))
        out = out.withColumn("_f", F.when(F.col("_first") & F.col("_r").isNotNull(), (keep - before) / after))
        # Of the multiples at which the classes before one are whole and it isn't, the largest is the one that adds up.
        f = F.coalesce(F.max(F.when(F.col("_f") <= F.col("_r"), F.col("_f"))).over(whole), F.max("_r").over(whole))
        out = out.withColumn(f"goal_{name}", F.least(f * F.col("_t"), F.when(F.col("_t").isNotNull(), F.col(f"held_{name}")))).drop("_t", "_first", "_r", "_f")
    return out


def rake(cells: DataFrame, targets: dict[str, dict[str, float]], keep: float = KEEP, rounds: int = ROUNDS) -> DataFrame:
    """cells(one column a marginal, tokens) with probability, weight (kept share over own share) and short, the marginals out of reach."""
    names, scratch = list(targets), Scratch(cells.sparkSession)
    # A row per combination of target classes: one partition, so that no step shuffles.
    out = wanted(scratch.keep(cells, 1).coalesce(1), targets, keep).withColumn("_x", F.col("share"))
    for i in range(rounds):
        for name in names:
            part, goal = W.partitionBy(name), F.col(f"goal_{name}")
            ratio = F.when(F.col("_x") > 0, F.col("share") / F.col("_x"))
            order = part.orderBy(F.asc_nulls_last(ratio), *names)
            before = F.coalesce(F.sum("share").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))
            after = F.sum("_x").over(order.rowsBetween(0, W.unboundedFollowing))
            out = out.select("*", ratio.alias("_r"), F.when(ratio.isNotNull(), (goal - before) / after).alias("_f"))
            f = F.coalesce(F.max(F.when(F.col("_f") <= F.col("_r"), F.col("_f"))).over(part), F.max("_r").over(part), F.lit(0.0))
            scaled = F.when(goal.isNull(), F.col("_x")).otherwise(F.least(F.col("_x") * f, F.lit(MOST)))
            out = out.select(*[c for c in out.columns if c not in ("_x", "_r", "_f")], scaled.alias("_x"))
        if i % ROUNDS_PER_TABLE == ROUNDS_PER_TABLE - 1:
            out = scratch.last(out, 1).coalesce(1)
    out = out.withColumn("_kept", F.least("_x", "share"))
    total = F.sum("_kept").over(W.partitionBy())
    short = F.concat_ws(",", *[F.when(F.col(f"asked_{n}") > F.col(f"held_{n}"), F.lit(n)) for n in names])
    return out.select(
        *names, "tokens", (F.col("_kept") / F.col("share")).alias("probability"), F.when(total > 0, F.col("_kept") / F.col("share") / total).otherwise(0.0).alias("weight"), short.alias("short")
    )


def mix(
    df: DataFrame,
    targets: dict[str, dict[str, float]],
    marginals: dict[str, Column],
    tokens: Column,
    keep: float = KEEP,
    rounds: int = ROUNDS,
    doc_id: str = "doc_id",
) -> DataFrame:
    """df with mix_<marginal>, mix_tokens, mix_weight, mix_probability, mix_short and mix_sampled."""
    names = [f"mix_{n}" for n in targets]
    made = {f"mix_{n}": _class(marginals[n], t) for n, t in targets.items()} | {"mix_tokens": F.coalesce(tokens, F.lit(1)).cast("long")}
    classed = df.withColumns(made)
    cells = classed.groupBy(*names).agg(F.sum("mix_tokens").alias("tokens"))
    cells = rake(cells.toDF(*targets, "tokens"), targets, keep, rounds)
    cells = cells.select(*[F.col(n).alias(f"mix_{n}") for n in targets], F.col("weight").alias("mix_weight"), F.col("probability").alias("mix_probability"), F.col("short").alias("mix_short"))
    draw = F.conv(F.substring(F.md5(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), 1, 8), 16, 10).cast("double") / 2**32
    # At most one row per combination of target classes, so it is small enough to send.
    out = classed.drop("mix_weight", "mix_probability", "mix_short").join(F.broadcast(cells), names)
    return out.withColumn("mix_sampled", draw < F.col("mix_probability"))


def mix_documents(docs: DataFrame, targets: dict[str, dict[str, float]] | None = None, keep: float = KEEP, tokens: Column | None = None, topic: Column | None = None) -> DataFrame:
    """mix() of documents; token counts and topics are the given columns, or the pre-tokens and the form of the text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    marginals = {"source": F.col("source"), "lang": F.col("lang"), "topic": surface_topic(text) if topic is None else topic}
    return mix(docs, targets or TARGETS, marginals, pretokens(text) if tokens is None else tokens, keep)


def op1_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its cell, its tokens, its weight and probability, what its classes fall short in, and whether it is sampled."""
    return mix_documents(documents(spark, sf_dir)).select(
        "doc_id",
        F.col("mix_source").alias("source_class"),
        F.col("mix_lang").alias("lang_class"),
        F.col("mix_topic").alias("topic"),
        F.col("mix_tokens").alias("tokens"),
        F.round("mix_weight", 6).alias("weight"),
        F.round("mix_probability", 6).alias("probability"),
        F.col("mix_short").alias("short_of"),
        F.col("mix_sampled").alias("sampled"),
    )


def _sql() -> str:
    """The same in DuckDB."""
    names = ("source", "lang", "topic")
    quoted = lambda t: ", ".join(f"'{k}'" for k in t)
    case = lambda n: "CASE " + n + "".join(f" WHEN '{k}' THEN CAST({v} AS DOUBLE)" for k, v in TARGETS[n].items()) + " ELSE 0.0 END"
    steps = [
        f"""docs AS (SELECT doc_id,
            CASE WHEN source IN ({quoted(TARGETS["source"])}) THEN source ELSE 'other' END AS source,
            CASE WHEN lang IN ({quoted(TARGETS["lang"])}) THEN lang ELSE 'other' END AS lang,
            CASE WHEN contains(t, 'icense') THEN 'legal' WHEN contains(t, ' | ') THEN 'tabular'
                 WHEN contains(t, '@') OR contains(t, '+1 (') THEN 'contact' ELSE 'prose' END AS topic,
            CAST(len(regexp_extract_all(t, '{PRETOKEN}')) + 1 AS BIGINT) AS tokens
            FROM (SELECT *, coalesce(text, '') AS t FROM documents))""",
        "cells AS (SELECT source, lang, topic, sum(tokens) / sum(sum(tokens)) OVER () AS share FROM docs GROUP BY ALL)",
    ]
    for n in names:
        steps += [
            f"held_{n} AS (SELECT {n}, sum(share) AS held, {case(n)} / sum({case(n)}) OVER () AS t FROM cells GROUP BY {n})",
            f"multiple_{n} AS (SELECT *, held / nullif(t, 0) AS r, ({KEEP} - coalesce(sum(held) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0)) / nullif(sum(t) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 0) AS f FROM held_{n} WINDOW o AS (ORDER BY held / nullif(t, 0) NULLS LAST))",
            f"goal_{n} AS (SELECT {n}, {KEEP} * t > held AS short_{n}, least(held, t * coalesce((SELECT max(f) FROM multiple_{n} WHERE f <= r), (SELECT max(r) FROM multiple_{n}))) AS goal_{n} FROM held_{n})",
        ]
    steps.append("w0 AS (SELECT *, share AS x FROM cells " + " ".join(f"JOIN goal_{n} USING ({n})" for n in names) + ")")
    for at in range(ROUNDS * len(names)):
        n = names[at % len(names)]
        steps.append(f"""w{at + 1} AS MATERIALIZED (SELECT * EXCLUDE (r, f) REPLACE (CASE WHEN goal_{n} IS NULL THEN x ELSE least(x * coalesce(max(CASE WHEN f <= r THEN f END) OVER p, max(r) OVER p, 0.0), {MOST}) END AS x) FROM (
            SELECT *, CASE WHEN r IS NOT NULL THEN (goal_{n} - coalesce(sum(share) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0)) / sum(x) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) END AS f
            FROM (SELECT *, CASE WHEN x > 0 THEN share / x END AS r FROM w{at}) WINDOW o AS (PARTITION BY {n} ORDER BY r NULLS LAST, source, lang, topic)) WINDOW p AS (PARTITION BY {n}))""")
    steps.append(f"p AS (SELECT source, lang, topic, least(x, share) / share AS probability, coalesce(least(x, share) / share / nullif(sum(least(x, share)) OVER (), 0), 0.0) AS weight, concat_ws(',', {', '.join(f"CASE WHEN short_{n} THEN '{n}' END" for n in names)}) AS short_of FROM w{ROUNDS * len(names)})")
    return f"""WITH {", ".join(steps)}
        SELECT doc_id, source AS source_class, lang AS lang_class, topic, tokens, round(weight, 6) AS weight, round(probability, 6) AS probability, short_of,
            CAST('0x' || left(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 8) AS BIGINT) / 4294967296.0 < probability AS sampled
        FROM docs JOIN p USING (source, lang, topic)"""


OP1_SQL = _sql()
