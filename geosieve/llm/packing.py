"""Best-fit packing of tokenised documents by linear grouping.

A document is its token ids and an end id; only one longer than the capacity
is cut, its first piece being the shorter one. Lengths are at most the
capacity, so their histogram is a table of at most that many rows whatever the
corpus. The plan is made on the histogram:

1. Linear grouping: lengths over a third of the capacity, longest first, are
   split into GROUPS groups of equal cardinality and rounded up to the longest
   of their group, so few sizes are left.
2. At most two of these fit a sequence, so its configurations are pairs of
   sizes and single ones. Taking the largest size left with the largest that
   fits beside it, as often as both last, gives the most pairs there can be:
   what fits beside a larger size also fits beside a smaller one.
3. Actual lengths take the places of the rounded ones in the pairs. Pairs that
   rounding leaves with more room than a tolerance are undone.
4. What is single, and the small lengths, are best-fit into what
   room there is, longest first, by their actual lengths; the rest open new
   sequences. So rounding costs few sequences although groups are few.
5. Of the plans of several tolerances the one with the fewest sequences is taken. One
   of them undoes every pair, so no plan needs more than best-fit alone.

A plan is a list of ranges: of the pieces of a length, numbers lo to lo + n
go to sequences base to base + n at an offset. Pieces get their number within
their length by a salted count, so no length is gathered in one task, and each
looks its range up in the broadcast plan, whose size depends on the capacity
and not on the corpus.

A null or empty text is a document of the end id alone. Repeated rows are
packed each. Null ids are kept. Of pieces of one length it doesn't matter
which goes where; their order is by id, piece and digest within a salt of the
same three, and equal pieces of equal rows may change places. Other columns
don't matter.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import Scratch, documents, small_batches, texts_of

CAPACITY, END_ID = 1024, 2
GROUPS, LARGE = 192, CAPACITY // 3
TOLERANCES = (16, 4, 1, 0)
ENDOFTEXT, ENDOFTEXT_ID = "<|endoftext|>", 50256
ROWS_PER_SALT = 20_000


def load_encoder() -> Callable[[str], list[int]]:
    """Token ids of a text by the byte-level vocabulary; its special string becomes its own id, as in its file."""
    from .secrets import load_encoding

    encode = load_encoding()

    def ids(text: str) -> list[int]:
        if ENDOFTEXT not in text:
            return encode(text)
        first, *rest = map(encode, text.split(ENDOFTEXT))
        for part in rest:
            first.append(ENDOFTEXT_ID)
            first += part
        return first

    return ids


def cut(length: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces; only the first may be shorter than the capacity."""
    first = (length - 1) % capacity + 1
    return [(0, first), *((s, capacity) for s in range(first, length, capacity))]


_PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])
_PIECE_TYPES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    encode = load_encoder()
    for batch in batches:
        for part in (batch.slice(i, 250) for i in range(0, batch.num_rows, 250)):
            rows = []
            for d, text in zip(part.column(0).to_pylist(), texts_of(part.column(1))):
                ids = encode(text)
                ids.append(END_ID)
                ids = np.array(ids, "<u4")
                rows += [(d, i, s, n, zlib.crc32(ids[s : s + n])) for i, (s, n) in enumerate(cut(len(ids)))]
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows), _PIECES)], schema=_PIECES)


class Plan:
    """Where the pieces of each length go. A class is n alike sequences: [n, room, [(length, lo), ...]]."""

    def __init__(self, histogram: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS, large: int = LARGE, tolerance: int = CAPACITY):
        self.capacity, self.tolerance, self.taken = capacity, tolerance, dict.fromkeys(histogram, 0)
        self.open: list[list[list]] = [[] for _ in range(capacity + 1)]
        left = self.place_large({s: c for s, c in histogram.items() if s > large}, groups)
        left.update({s: c for s, c in histogram.items() if s <= large})
        for s in sorted(left, reverse=True):
            self.best_fit(s, left[s])

    def take(self, s: int, n: int) -> int:
        lo = self.taken[s]
        self.taken[s] += n
        return lo

    def add(self, n: int, slots: list[tuple[int, int]]) -> None:
        room = self.capacity - sum(s for s, _ in slots)
        self.open[room].append([n, room, slots])

    def place_large(self, count: dict[int, int], groups: int) -> Counter[int]:
        """Place pairs of large lengths by their groups; the lengths left single."""
        single: Counter[int] = Counter()
        total = sum(count.values())
        if not total:
            return single
        share = -(-total // groups)
        group: list[list[list[int]]] = [[]]  # runs of (length, count), longest first
        room = share
        for s in sorted(count, reverse=True):
            left = count[s]
            while left:
                if not room:
                    group.append([])
                    room = share
                n = min(left, room)
                group[-1].append([s, n])
                left, room = left - n, room - n
        size = [g[0][0] for g in group]
        left = [sum(n for _, n in g) for g in group]
        for n, use in configurations(size, left, self.capacity):
            if sum(use.values()) > 1:
                single.update(self.substitute([(group[g], k) for g, k in use.items()], n))
        for runs in group:
            for s, n in runs:
                single[s] += n
        return single

    def substitute(self, slots: list[tuple[list[list[int]], int]], n: int) -> Counter[int]:
        """n sequences of a configuration with actual lengths; runs of equal lengths keep the classes few. The lengths of those undone."""
        places = [runs for runs, k in slots for _ in range(k)]
        undone: Counter[int] = Counter()
        while n:
            # As many sequences as every place can fill from the run that is first in its group; one, if places share a short run.
            m = min(n, min(max(1, runs[0][1] // sum(p is runs for p in places)) for runs in places))
            chosen = []
            for runs in places:
                chosen.append(runs[0][0])
                runs[0][1] -= m
                if not runs[0][1]:
                    runs.pop(0)
            if self.capacity - sum(chosen) <= self.tolerance:
                self.add(m, [(s, self.take(s, m)) for s in chosen])
            else:
                for s in chosen:
                    undone[s] += m
            n -= m
        return undone

    def best_fit(self, s: int, n: int) -> None:
        room = s
        while n:
            while room <= self.capacity and not self.open[room]:
                room += 1
            if room > self.capacity:
                break
            have, _, slots = self.open[room].pop()
            m = min(have, n)
            if m < have:
                self.open[room].append([have - m, room, [(t, lo + m) for t, lo in slots]])
            self.add(m, [*slots, (s, self.take(s, m))])
            n -= m
            room = s
        each = self.capacity // s
        if n >= each:
            m = n // each
            lo = self.take(s, m * each)
            self.add(m, [(s, lo + i * m) for i in range(each)])
            n -= m * each
        if n:
            lo = self.take(s, n)
            self.add(1, [(s, lo + i) for i in range(n)])

    def sequences(self) -> int:
        """How many sequences the plan opens."""
        return sum(n for classes in self.open for n, _, _ in classes)

    def ranges(self) -> np.ndarray:
        """Rows (length, lo, first sequence, offset), sorted; a range ends where the length's next begins."""
        rows, base = [], 0
        for classes in self.open:
            for n, _, slots in classes:
                offset = 0
                for s, lo in slots:
                    rows.append((s, lo, base, offset))
                    offset += s
                base += n
        return np.array(sorted(rows), np.int64).reshape(-1, 4)


def best_plan(histogram: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS) -> Plan:
    """The plan with the fewest sequences of several tolerances, the last of which undoes all pairs."""
    plans = (Plan(histogram, capacity, groups, capacity // 3, t) for t in (capacity, *TOLERANCES, -1))
    return min(plans, key=Plan.sequences)


def configurations(size: list[int], left: list[int], capacity: int = CAPACITY) -> Iterator[tuple[int, dict[int, int]]]:
    """(times, {group: how many}) until all groups are used: the largest size left with the largest that fits beside it, or alone."""
    left = list(left)
    while any(left):
        at = next(i for i, n in enumerate(left) if n)
        beside = next((i for i in range(at, len(size)) if left[i] > (i == at) and size[at] + size[i] <= capacity), None)
        use = {at: 1} if beside is None else {at: 2} if beside == at else {at: 1, beside: 1}
        times = min(left[i] // k for i, k in use.items())
        for i, k in use.items():
            left[i] -= times * k
        yield times, use


def numbered(pieces: DataFrame, rows: int) -> tuple[DataFrame, dict[int, int]]:
    """The pieces with their number within their length, and the histogram of lengths."""
    salts = max(8, rows // ROWS_PER_SALT)
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts)))
    counts = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most CAPACITY rows
    before = W.partitionBy("length").orderBy("salt").rowsBetween(W.unboundedPreceding, -1)
    firsts = counts.select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    own = F.row_number().over(W.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32"))
    return salted.withColumn("own", own).join(firsts, ["length", "salt"]).withColumn("number", F.col("first") + F.col("own") - 1), histogram


def pack(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    spark = df.sparkSession
    small_batches(spark)
    scratch = Scratch(spark)
    docs = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    pieces = scratch.keep(docs.mapInArrow(_pieces, _PIECE_TYPES))
    rows, histogram = numbered(pieces, pieces.count())
    ranges = spark.sparkContext.broadcast(best_plan(histogram).ranges())

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = ranges.value
        keys = (plan[:, 0] << 48) + plan[:, 1] if len(plan) else np.empty(0, np.int64)
        for b in batches:
            length, number = (np.asarray(b.column(c)) for c in ("length", "number"))
            at = np.searchsorted(keys, (length << 48) + number, "right") - 1
            sequence = plan[at, 2] + number - plan[at, 1]
            columns = [*(b.column(c) for c in _PIECES.names), pa.array(sequence), pa.array(plan[at, 3])]
            yield pa.RecordBatch.from_arrays(columns, names=[*_PIECES.names, "sequence_id", "offset"])

    return rows.select(*_PIECES.names, "number").mapInArrow(place, f"{_PIECE_TYPES}, sequence_id long, offset long")


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document with its sequence and its place there."""
    return pack(documents(spark, sf_dir))
