"""Relational helpers that keep source order, first-seen ties and status semantics."""

from __future__ import annotations

from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W


def joined_some(df: DataFrame, key: str, value: str, limit: int, out: str) -> DataFrame:
    """The distinct values of a group in order, joined by "; ", those over the limit as "+N more".

    Only the first ``limit`` are gathered; the rest are counted, so a group may be of any size.
    """
    distinct = df.select(key, value).distinct()
    first = distinct.withColumn("_k", F.row_number().over(W.partitionBy(key).orderBy(value))).where(F.col("_k") <= limit)
    listed = first.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(value)))[value].alias("_v"))
    counted = distinct.groupBy(key).agg(F.count("*").alias("_n"))
    text = F.array_join(F.transform("_v", lambda x: x.cast("string")), "; ")
    more = F.when(F.col("_n") > limit, F.concat(F.lit(" +"), (F.col("_n") - limit).cast("string"), F.lit(" more"))).otherwise("")
    return counted.join(listed, key).select(key, F.concat(text, more).alias(out))


def numbered_id(df: DataFrame, prefix: str, order: list[Column], out: str, width: int = 3) -> DataFrame:
    """A running id in each prefix, such as TX-001."""
    n = F.row_number().over(W.partitionBy(prefix).orderBy(*order)).cast("string")
    return df.withColumn(out, F.concat_ws("-", F.col(prefix).cast("string"), F.when(F.length(n) < width, F.lpad(n, width, "0")).otherwise(n)))


def first_by(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in an order."""
    n = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_n", n).where("_n = 1").drop("_n")


def mode_first_seen(df: DataFrame, keys: list[str], value: str, ordinal: str, out: str) -> DataFrame:
    """The most common value of each key; of equally common ones the one seen first."""
    counted = df.groupBy(*keys, value).agg(F.count("*").alias("_n"), F.min(ordinal).alias("_first"))
    best = F.max(F.struct("_n", (-F.col("_first")).alias("_minus"), value))
    return counted.groupBy(*keys).agg(best.alias("_best")).select(*keys, F.col(f"_best.{value}").alias(out), F.col("_best._n").alias(f"{out}_count"))


def quantiles_exclusive(df: DataFrame, keys: list[str], value: str, parts: int, names: list[str], buckets: int = 1000) -> DataFrame:
    """Cut points at i(n + 1)/parts of the order, between neighbours by weight; null under two values.

    Values are counted in equal steps between a key's least and greatest; only
    those of the few steps that hold a cut point are put in order, so no key is
    sorted whole.
    """
    some = df.where(F.col(value).isNotNull()).select(*keys, F.col(value).alias("_v"))
    sized = some.groupBy(*keys).agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"), F.count("*").alias("_n"))
    wide = F.greatest((F.col("_hi") - F.col("_lo")) / buckets, F.lit(1e-300))
    stepped = some.join(sized, keys).withColumn("_b", F.least(F.floor((F.col("_v") - F.col("_lo")) / wide), F.lit(buckets)).cast("int"))
    counted = stepped.groupBy(*keys, "_b").agg(F.count("*").alias("_c"))
    upto = F.sum("_c").over(W.partitionBy(*keys).orderBy("_b"))  # at most buckets + 1 rows a key
    counted = counted.withColumn("_upto", upto).join(sized.select(*keys, "_n"), keys)
    at = [F.least(F.col("_n") - 1, F.greatest(F.lit(1), F.floor((F.col("_n") + 1) * i / parts))) for i in range(1, parts)]
    before = F.col("_upto") - F.col("_c")
    holds = [(before < p + k) & (p + k <= F.col("_upto")) for p in at for k in (0, 1)]
    needed = counted.where(F.greatest(*holds)).select(*keys, "_b", before.alias("_before"))
    order = F.row_number().over(W.partitionBy(*keys, "_b").orderBy("_v"))
    rows = stepped.join(needed, [*keys, "_b"]).withColumn("_k", F.col("_before") + order)
    cuts = []
    for i, (p, name) in enumerate(zip(at, names), 1):
        part = (F.col("_n") + 1) * i - p * parts
        weight = F.when(F.col("_k") == p, parts - part).when(F.col("_k") == p + 1, part)
        cuts.append(F.when(F.max("_n") > 1, F.sum(F.col("_v") * weight) / parts).alias(name))
    return df.select(*keys).distinct().join(rows.groupBy(*keys).agg(*cuts), keys, "left")


def forward_fill(df: DataFrame, keys: list[str], order: str, value: Column, out: str) -> DataFrame:
    """The last non-null value at or before each row."""
    w = W.partitionBy(*keys).orderBy(order).rowsBetween(W.unboundedPreceding, W.currentRow)
    return df.withColumn(out, F.last(value, ignorenulls=True).over(w))


def latest_ok(df: DataFrame, keys: list[str], ok: Column, order: list[str], columns: list[str]) -> DataFrame:
    """The latest ok row of each key, with counts of ok and other rows; rows that failed are never taken."""
    last = F.max(F.when(ok, F.struct(*order, *columns)))
    out = df.groupBy(*keys).agg(last.alias("_last"), F.count_if(ok).alias("n_ok"), F.count_if(~ok).alias("n_failed"))
    return out.select(*keys, *[F.col(f"_last.{c}").alias(c) for c in (*order, *columns)], "n_ok", "n_failed")


def coalesce_levels(df: DataFrame, levels: list[DataFrame], keys: list[list[str]], columns: list[str], scope: str, names: list[str]) -> DataFrame:
    """Whole rows of the first level that has the key, and the name of that level."""
    found = []
    for i, (level, on) in enumerate(zip(levels, keys)):
        df = df.join(level.select(*on, F.struct(*columns).alias(f"_l{i}")), on, "left")
        found.append(F.col(f"_l{i}"))
    which = F.coalesce(*[F.when(f.isNotNull(), F.lit(n)) for f, n in zip(found, names)])
    best = F.coalesce(*found)
    return df.withColumns({scope: which} | {c: best[c] for c in columns}).drop(*[f"_l{i}" for i in range(len(levels))])


def first_source(df: DataFrame, keys: list[str], rank: str, hit: Column, columns: list[str]) -> DataFrame:
    """The first source by rank that has a hit, with how many came before it in vain."""
    best = F.min(F.when(hit, F.struct(rank, *columns)))
    tried = df.groupBy(*keys).agg(best.alias("_best"), F.sort_array(F.collect_set(F.when(~hit, F.col(rank)))).alias("_missed"))
    missed = F.size(F.filter("_missed", lambda r: F.col("_best").isNull() | (r < F.col(f"_best.{rank}")))).cast("long")
    return tried.select(*keys, *[F.col(f"_best.{c}").alias(c) for c in (rank, *columns)], missed.alias("missed_before"))


def upsert(base: DataFrame, over: DataFrame, keys: list[str], columns: list[str], forced: Column) -> DataFrame:
    """base with the values of over where base has none, or where forced takes them anyway."""
    renamed = over.select(*keys, *[F.col(c).alias(f"_o_{c}") for c in columns], F.lit(True).alias("_over"), forced.alias("_forced"))
    out = base.join(renamed, keys, "left")
    take = lambda c: F.when(F.coalesce("_forced", F.lit(False)), F.coalesce(f"_o_{c}", c)).otherwise(F.coalesce(c, f"_o_{c}"))
    return out.withColumns({c: take(c) for c in columns} | {"reviewed": F.coalesce("_over", F.lit(False))}).drop("_over", "_forced", *[f"_o_{c}" for c in columns])


def compare(expected: DataFrame, actual: DataFrame, keys: list[str], exact: list[str], near: dict[str, float]) -> DataFrame:
    """Every key of either side with its verdict: missing, extra, the fields that differ, or same. Nulls equal nulls."""
    fields = [*exact, *near]
    e = expected.select(*keys, *[F.col(c).alias(f"_e_{c}") for c in fields], F.lit(1).alias("_e"))
    a = actual.select(*keys, *[F.col(c).alias(f"_a_{c}") for c in fields], F.lit(1).alias("_a"))
    differs = []
    for c in fields:
        x, y = F.col(f"_e_{c}"), F.col(f"_a_{c}")
        same = x.eqNullSafe(y) if c in exact else (x.isNull() & y.isNull()) | F.coalesce(F.abs(x - y) <= near[c], F.lit(False))
        differs.append(F.when(~same, F.lit(c)))
    verdict = F.when(F.col("_a").isNull(), "missing").when(F.col("_e").isNull(), "extra")
    fields_text = F.concat_ws(",", *differs)
    return e.join(a, keys, "full").select(*keys, verdict.otherwise(F.when(fields_text == "", "same").otherwise(fields_text)).alias("verdict"))


def with_total(df: DataFrame, key: str, aggregates: list[Column], total: str = "Total") -> DataFrame:
    """Aggregates by key and over all, the whole labelled ``total`` even if the key has nulls."""
    label = F.when(F.grouping(key) == 1, F.lit(total)).otherwise(F.coalesce(F.col(key).cast("string"), F.lit("(none)")))
    return df.rollup(key).agg(label.alias("_label"), *aggregates).drop(key).withColumnRenamed("_label", key)


def precedence_shares(covers: DataFrame, keys: list[str], low: str, high: str, rank: str) -> DataFrame:
    """Length by rank on a line where the least rank of overlapping covers counts.

    The ends of all covers cut the line into pieces; each piece belongs to the
    least rank that covers it, so lengths add up to the covered whole. A key's
    covers are one array, so nothing but covers is shuffled and no piece is a
    row; pieces under covers are held a million at a time.
    """
    kinds = dict(covers.select(F.col(rank).alias("rank"), F.sum(F.col(high) - F.col(low)).over(W.partitionBy(F.lit(0))).alias("length")).dtypes)
    known = covers.where(reduce(and_, [F.col(c).isNotNull() for c in (*keys, low, high)]))
    held = known.groupBy(*keys).agg(F.collect_list(F.struct(F.col(low).alias("lo"), F.col(high).alias("hi"), F.col(rank).alias("rank"))).alias("_c"))
    shares = F.arrow_udf(_owned, f"array<struct<rank: {kinds['rank']}, length: {kinds['length']}>>")
    found = held.select(*keys, F.explode(shares("_c")).alias("_r"))
    return found.select(*keys, F.col("_r.rank").alias(rank), F.col("_r.length").cast(kinds["length"]).alias("length"))


def _owned(rows: pa.Array) -> pa.Array:
    """For each list of covers (lo, hi, rank) the ranks that own some of its line, with lengths; a null rank yields to all others."""
    counts, (lo, hi, rank) = rows.value_lengths().to_numpy(zero_copy_only=False), (rows.flatten().field(c) for c in ("lo", "hi", "rank"))
    row = np.repeat(np.arange(len(rows)), counts)
    ranks = pc.unique(rank).drop_null().sort() if rank.null_count < len(rank) else rank[:0]
    code = pc.index_in(rank, ranks).fill_null(len(ranks)).to_numpy()
    ends, of = np.concatenate([lo.to_numpy(), hi.to_numpy()]), np.concatenate([row, row])
    order = np.lexsort((ends, of))
    new = np.append(True, (of[order][1:] != of[order][:-1]) | (ends[order][1:] != ends[order][:-1]))[: len(order)]
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(new) - 1
    x, owner_row = ends[order][new], of[order][new]
    begin, end = number[: len(row)], number[len(row) :]
    owner = np.full(len(x), -1)
    # The least rank is written last.
    last = np.argsort(-code, kind="stable")
    size = np.maximum(end - begin, 0)[last]
    block = np.cumsum(size) // 1_000_000
    for c in np.split(last, np.flatnonzero(np.diff(block)) + 1):
        n = np.maximum(end[c] - begin[c], 0)
        owner[np.repeat(begin[c] - np.cumsum(n) + n, n) + np.arange(n.sum())] = np.repeat(code[c], n)
    piece = np.flatnonzero(owner >= 0)
    piece = piece[np.lexsort((owner[piece], owner_row[piece]))]
    first = np.flatnonzero(np.append(True, (np.diff(owner_row[piece]) != 0) | (np.diff(owner[piece]) != 0))[: len(piece)])
    length = np.add.reduceat(x[piece + 1] - x[piece], first) if len(first) else x[:0]
    at = piece[first]
    offsets = np.append(0, np.cumsum(np.bincount(owner_row[at], minlength=len(rows)))).astype(np.int32)
    named = ranks.take(pa.array(owner[at], mask=owner[at] == len(ranks)))
    return pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays([named, pa.array(length)], ["rank", "length"]))


def audience_gate(asked: DataFrame, providers: DataFrame, name: str, audience: str, audiences: tuple[str, ...]) -> DataFrame:
    """asked with refusal: why a provider may not be shown to an audience, or null. providers: name, cleared_for array."""
    known = providers.select(name, F.col("cleared_for"), F.lit(True).alias("_known"))
    refusal = (
        F.when(~F.coalesce(F.col(audience).isin(*audiences), F.lit(False)), "unknown audience")
        .when(F.col("_known").isNull(), "unknown provider")
        .when(~F.coalesce(F.array_contains("cleared_for", F.col(audience)), F.lit(False)), F.concat(F.lit("cleared for "), F.array_join(F.array_sort("cleared_for"), ", "), F.lit(" only")))
    )
    return asked.join(known, name, "left").withColumn("refusal", refusal).drop("cleared_for", "_known")
