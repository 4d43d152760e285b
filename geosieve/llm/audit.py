"""How filters overlap: what each removes in every order of applying them.

A document's mask says which of the five filters it fails, and everything
asked of the 120 orders follows from how many documents of a part have each of
the 32 masks. From these counts each part gets its removal polynomial: with x
the chances that the filters are on, the expected number of documents removed,

    p(x) = sum over masks m of n(m) * (1 - product over filters i in m of (1 - x_i)),

which is multilinear. At a corner of the cube it is the number removed by a set
of filters, so the corners along an order give what is kept and removed at each
step. The Shapley value of a filter is the integral of its partial derivative
along the diagonal; it is taken with exact rationals, and 120 times it, the sum
over all orders, is a whole number.

Texts are read once, where they lie; what is shuffled is an id, a digest and a
mask a document. A text is known by the 128-bit digest of its bytes. Copies
are found by the least id of each digest, which is a grouped minimum, and then
a join on digest and id together, so a text that very many documents share is
no hot key of the join.

A null text is read as empty, a null part as the empty string. A null id is
smaller than no id and no id is smaller than it, so its row fails no copy test;
rows that repeat id and text don't make each other copies. Labels of one id
count as good or toxic if any of them says so; null ids and labels that are
null have none. An empty table gives no rows. Columns other than those named
aren't read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from fractions import Fraction
from itertools import permutations
from math import factorial

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, documents, labels, small_batches

FILTERS = "ABCDE"
LEAST_WORDS, DISTINCT_PERCENT, UPPER_PERCENT = 100, 80, 10
UPPER, MARKS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", re.compile(rb"[#$%&*|]")


def own_mask(raw: bytes) -> int:
    """The bits of filters A to D that a UTF-8 text fails."""
    words = raw.split()  # of bytes: at x20 and x09 to x0D
    distinct = len(set(words))
    points = len(raw) if raw.isascii() else len(raw.decode("utf-8", "replace"))
    upper = len(raw) - len(raw.translate(None, UPPER))
    fails = (len(words) < LEAST_WORDS, 100 * distinct < DISTINCT_PERCENT * len(words), 100 * upper > UPPER_PERCENT * points, MARKS.search(raw) is not None)
    return sum(1 << i for i, x in enumerate(fails) if x)


def masked(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """(doc_id, part, digest, mask) of each document, the mask by its text alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            mask, digest = [], []
            for raw in b.column("text").cast(pa.binary()).to_pylist():
                mask.append(own_mask(raw))
                digest.append(hashlib.blake2b(raw, digest_size=16).digest())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("part"), pa.array(digest, pa.binary()), pa.array(mask, pa.int32())], names=["doc_id", "part", "digest", "mask"])

    small_batches(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(part), F.lit("")).alias("part"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return rows.mapInArrow(run, "doc_id long, part string, digest binary, mask int")


def mask_counts(docs: DataFrame, known: DataFrame, scratch: Scratch) -> DataFrame:
    """(part, mask, n, good, toxic): documents of each part by what they fail, those labelled good and toxic among them."""
    rows = scratch.keep(masked(docs))
    first = rows.where("doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    said = known.select(F.col("doc_id").cast("long").alias("doc_id"), *[F.coalesce(F.col(c) == 1, F.lit(False)).alias(o) for c, o in (("quality", "good"), ("toxic", "toxic"))])
    said = said.where("doc_id is not null").groupBy("doc_id").agg(F.max("good").alias("good"), F.max("toxic").alias("toxic"))
    copy = F.col("first").isNull() & F.col("doc_id").isNotNull()
    full = rows.join(first, ["digest", "doc_id"], "left").withColumn("mask", F.col("mask") + F.when(copy, 1 << FILTERS.index("E")).otherwise(0))
    full = full.select("doc_id", "part", "mask").join(said, "doc_id", "left")
    one = lambda c: F.sum(F.coalesce(F.col(c), F.lit(False)).cast("long")).alias(c)
    return full.groupBy("part", "mask").agg(F.count("*").alias("n"), one("good"), one("toxic"))


def polynomial(counts: dict[int, int], filters: int = len(FILTERS)) -> list[int]:
    """The coefficients of a removal polynomial by the set of variables, from documents by mask."""
    coefficient = [0] * (1 << filters)
    for s in range(1, 1 << filters):
        above = sum(n for mask, n in counts.items() if mask & s == s)
        coefficient[s] = above if s.bit_count() % 2 else -above
    return coefficient


def corners(coefficient: list[int]) -> list[int]:
    """The polynomial's values at the corners: what each set of filters removes."""
    return [sum(c for t, c in enumerate(coefficient) if t & s == t) for s in range(len(coefficient))]


def shapley(coefficient: list[int], i: int) -> Fraction:
    """The integral over the diagonal of the partial derivative by variable i."""
    along: dict[int, int] = {}  # coefficients of the derivative as a polynomial of the place on the diagonal
    for t, c in enumerate(coefficient):
        if t >> i & 1:
            along[t.bit_count() - 1] = along.get(t.bit_count() - 1, 0) + c
    return sum((Fraction(c, power + 1) for power, c in along.items()), Fraction(0))


_COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def part_rows(counts: list[tuple[int, int, int, int]], filters: str = FILTERS) -> Iterator[tuple]:
    """(order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) of one part from (mask, n, good, toxic)."""
    k, whole = len(filters), (1 << len(filters)) - 1
    total = sum(c[1] for c in counts)
    polynomials = [polynomial({c[0]: c[j] for c in counts}, k) for j in (1, 2, 3)]
    n, good, toxic = map(corners, polynomials)
    value = []
    for i in range(k):
        scaled = factorial(k) * shapley(polynomials[0], i)
        assert scaled.denominator == 1
        value.append(int(scaled))
    for order in permutations(range(k)):
        before = 0
        for step, i in enumerate(order, 1):
            after = before | 1 << i
            here = n[after] - n[before]
            yield (
                "".join(filters[j] for j in order), step, total - n[after], here, n[1 << i] - here, n[whole] - n[whole ^ 1 << i],
                good[after] - good[before], toxic[after] - toxic[before], value[i],
            )
            before = after


def audit(counts: DataFrame) -> DataFrame:
    """Every order and step of every part from its mask counts, at most 32 rows a part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part, own in zip(b.column("part").to_pylist(), b.column("counts").to_pylist()):
                rows = list(zip(*part_rows([(x["mask"], x["n"], x["good"], x["toxic"]) for x in own])))
                first = [pa.array([part] * len(rows[0])), pa.array(rows[0]), pa.array(rows[1], pa.int32())]
                yield pa.RecordBatch.from_arrays([*first, *(pa.array(x, pa.int64()) for x in rows[2:])], names=["part", "filter_order", "step", *_COUNTS])

    whole = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("counts"))
    return whole.mapInArrow(run, "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in _COUNTS))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every part, order and step with what is kept, removed and lost, and the filter's Shapley value times 120."""
    scratch = Scratch(spark)
    counts = scratch.last(mask_counts(documents(spark, sf_dir), labels(spark, sf_dir), scratch))
    return audit(counts)


def _sql() -> str:
    """The same in DuckDB, by walking the orders over the masks."""
    letters = ", ".join(f"('{x}', {1 << i})" for i, x in enumerate(FILTERS))
    names = "abcde"
    distinct = " AND ".join(f"{y}.l <> {x}.l" for i, x in enumerate(names) for y in names[i + 1 :])
    steps = " UNION ALL ".join(
        f"SELECT {' || '.join(f'{x}.l' for x in names)} AS filter_order, {i + 1} AS step, {x}.bit AS bit, {' + '.join([f'{y}.bit' for y in names[:i]] or ['0'])} AS before FROM {', '.join(f'f {y}' for y in names)} WHERE {distinct}"
        for i, x in enumerate(names)
    )
    total = lambda c, where: f"CAST(coalesce(sum({c}) FILTER (WHERE {where}), 0) AS BIGINT)"
    here = "mask & before = 0 AND mask & bit <> 0"
    return f"""WITH f(l, bit) AS (VALUES {letters}),
        docs AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
        cut AS (SELECT *, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS words, min(doc_id) OVER (PARTITION BY t) AS first FROM docs),
        said AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
        masks AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
            CASE WHEN len(words) < {LEAST_WORDS} THEN 1 ELSE 0 END + CASE WHEN 100 * len(list_distinct(words)) < {DISTINCT_PERCENT} * len(words) THEN 2 ELSE 0 END
            + CASE WHEN 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > {UPPER_PERCENT} * length(t) THEN 4 ELSE 0 END
            + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END + CASE WHEN doc_id > first THEN 16 ELSE 0 END AS mask
            FROM cut LEFT JOIN said USING (doc_id)),
        counts AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM masks GROUP BY part, mask),
        steps AS ({steps}),
        out AS (SELECT part, filter_order, step, bit, {total("n", "mask & (before + bit) = 0")} AS kept, {total("n", here)} AS removed,
            {total("n", "mask & bit <> 0 AND mask & before <> 0")} AS redundant, {total("n", "mask = bit")} AS unique_fails,
            {total("good", here)} AS good_lost, {total("toxic", here)} AS toxic_lost FROM counts, steps GROUP BY ALL)
        SELECT * EXCLUDE (bit), CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley FROM out"""


OP12_SQL = _sql()
