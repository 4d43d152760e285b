"""Language-model scores by deleted interpolation of maximum-likelihood n-grams.

The probability of a token after two others is a mixture

    P(w | u, v) = a3 * c(u, v, w) / c(u, v) + a2 * c(v, w) / c(v) + a1 * c(w) / N + a0 / (V + 1),

V known tokens and one for all unknown ones. The weights a hang on how often
the contexts (u, v) and (v) were seen, in powers of two, and are learned by
expectation-maximisation: a tenth of the training texts, chosen by a checksum of
the text so that exact copies stay together, is deleted from the counts, and the
weights are those under which it is likeliest by the counts of the rest. The
scores then use the counts of all training texts. A context that was never seen
gives its weight to the others, so probabilities add up to one.

How it runs, N-gram counts growing with the corpus:

1. Texts are laid in blocks of about BLOCK_BYTES, training, deleted and other ones
   apart; a text over PIECE_BYTES is cut between words, each piece with the two words
   before it, so no task holds a long text's n-grams.
2. Each block counts its own distinct n-grams, which are hashed, in sorted order,
   and sends every range of the hash values its part of them: one row a block and
   range, keys and counts packed (distances between sorted keys, compressed). However common an n-gram is, a block sends it once.
3. Each range adds up its n-grams over all blocks and returns to every block the
   totals of the n-grams that it asked for, in the order they came.
4. Each deleted block meets its totals and gives a histogram of the fractions by
   bucket, which Spark adds up; each bucket's weights come from its own part in one
   task. Fractions are binned by powers of two with their means kept; there are at most
   BINS ** 3 bins a bucket, whatever the corpus.
5. Each block meets its totals again and scores its texts.

Blocks and ranges both grow with the corpus, so their sizes, which are parameters,
should grow with the memory of the executors.

Words are hashed to 64 bits; longer n-grams to 40 bits within a range of at most
about a million, so one in a million of them shares a count with another one.

Null and empty texts consist of their end alone. Rows with a null id are scored but
not learned from, as they have no remainder. Repeated rows count each and are scored
each. With nothing to learn from every token has the probability 1 / (V + 1) = 1; with
no deleted text the weights are equal. Other columns aren't read; an empty table
gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, documents, fold, small_batches
from .hashing import mix, word_hashes

ORDER = 3
BLOCK_BYTES, RANGE_BYTES, PIECE_BYTES, CHUNK_BYTES = 4_000_000, 4_000_000, 2_000_000, 1_000_000
DELETED = 10
LEVELS, BINS = 16, 33
STEPS, ENOUGH, PRIOR = 200, 1e-7, 0.5
KEPT, HELD, OTHER = 0, 1, 2
#: Bytes that no UTF-8 text has: what stands before a text, and its end.
BEFORE, END = b"\xfe", b"\xff"
_U = np.uint64
_TIMES = [_U(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]
_LOW = _U((1 << 40) - 1)
_space = re.compile(rb"[ \t-\r]")
_BEFORE = word_hashes(BEFORE)[0][0]


def cut(raw: bytes, most: int = PIECE_BYTES) -> Iterator[bytes]:
    """The pieces of a lower-cased text, each with the two tokens before it, the last with the end."""
    at, before = 0, [BEFORE, BEFORE]
    while True:
        found = _space.search(raw, at + most) if len(raw) - at > most else None
        own = raw[at : found.start() if found else len(raw)]
        yield b" ".join([*before, own, *([] if found else [END]), b""])
        if not found:
            return
        before = (before + own.rsplit(None, 2)[-2:])[-2:]
        at = found.end()


_BLOCK = "block long, kind int, texts long, uid array<long>, doc_id array<long>, held_out array<boolean>, size array<long>, packed binary, bytes long"


def blocks(docs: DataFrame, block_bytes: int = BLOCK_BYTES, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """The texts of (doc_id, text, held_out, learn) in blocks of one kind."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        made = rows = 0
        open_: dict[int, list[tuple]] = {}
        room = dict.fromkeys((KEPT, HELD, OTHER), block_bytes)

        def close(kind: int) -> pa.RecordBatch:
            nonlocal made
            got = open_.pop(kind)
            room[kind] = block_bytes
            uid, doc_id, held_out, piece = zip(*got)
            raw = b"".join(piece)
            texts = raw.count(END)
            columns = [[first + made], [kind], [texts], [uid], [doc_id], [held_out], [list(map(len, piece))], [zstandard.compress(raw, 1)], [len(raw)]]
            types = [pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int64()), pa.binary(), pa.int64()]
            made += 1
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=[x.split()[0] for x in _BLOCK.split(", ")])

        for b in batches:
            for doc_id, raw, held_out, learn in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist(), b.column(2).to_pylist(), b.column(3).to_pylist()):
                raw = raw.lower()
                kind = OTHER if not learn else HELD if zlib.crc32(raw) % DELETED == 0 else KEPT
                for piece in cut(raw, piece_bytes):
                    open_.setdefault(kind, []).append((first + rows, doc_id, held_out, piece))
                    room[kind] -= len(piece)
                    if room[kind] <= 0:
                        yield close(kind)
                rows += 1
        for kind in list(open_):
            yield close(kind)

    return docs.mapInArrow(run, _BLOCK)


@dataclass
class Tokens:
    """The tokens of a block: their hashes by order, which are scored, and where each piece begins."""

    keys: list[np.ndarray]  # of order 1, 2, ...; the first of a piece has no longer ones
    own: np.ndarray
    first: np.ndarray


def tokens(raw: bytes, size: list[int]) -> Tokens:
    """Read a block."""
    raw = zstandard.decompress(raw)
    ends = np.cumsum(np.array(size, np.int64))
    starts = ends - size
    word, first, at = [], [], 0
    count = 0
    while at < len(size):
        to = max(at + 1, int(np.searchsorted(ends, starts[at] + CHUNK_BYTES, "right")))
        h, begin = word_hashes(raw[starts[at] : ends[to - 1]])
        word.append(h)
        first.append(np.searchsorted(begin, starts[at:to] - starts[at]) + count)
        count += len(h)
        at = to
    h, first = np.concatenate(word), np.concatenate(first)
    own = np.ones(len(h), bool)
    own[first] = own[first + 1] = False
    keys = [h]
    for k in range(1, ORDER):
        longer = h * _TIMES[0]
        for j in range(1, k + 1):
            longer[j:] += h[:-j] * _TIMES[j]
        keys.append(mix(longer + _U(k)))
    return Tokens(keys, own, first)


def named(t: Tokens, k: int, ranges: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The block's distinct n-grams of order k + 1 in the order of their ranges, how often each is counted, and each token's identity.

    Those of a piece's first two tokens that are words are there too, as contexts.
    """
    x = t.keys[k]
    if k:
        x = ((((x >> _U(32)) * _U(ranges)) >> _U(32)) << _U(40)) | (x & _LOW)
    u, n = np.unique(x[t.own], return_counts=True)
    more = t.first + 1
    more = more[t.keys[0][more] != _BEFORE] if k < ORDER - 1 else more[:0]
    if len(more):
        both = np.union1d(u, x[more])
        count = np.zeros(len(both), np.int64)
        count[np.searchsorted(both, u)] = n
        u, n = both, count
    return u, n, x


def borders(k: int, ranges: int) -> np.ndarray:
    """The least identity of each range, and one past the last."""
    r = np.arange(ranges, dtype=np.uint64)
    if k:
        return r << _U(40)
    return (((r << _U(32)) + _U(ranges - 1)) // _U(ranges)) << _U(32)


def packed(x: np.ndarray) -> bytes:
    """Numbers compressed byte by byte, all lowest ones first, so that high ones, mostly zero, take no room."""
    return zstandard.compress(np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes(), 1) if len(x) else b""


def unpacked(b: bytes) -> np.ndarray:
    """The numbers of packed()."""
    raw = zstandard.decompress(b) if len(b) else b""
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, -1).T).reshape(-1).view("<u8")


def steps(x: np.ndarray, border: np.uint64) -> np.ndarray:
    """Rising identities as the distance of each from the one before, the first from the border of their range."""
    return np.diff(x, prepend=border)


_ASK = "range int, block long, kind int, " + ", ".join([*(f"k{k} binary" for k in range(ORDER)), *(f"n{k} binary" for k in range(ORDER))])
_TOTAL = "block long, kind int, range int, " + ", ".join([*(f"t{k} binary" for k in range(ORDER)), *(f"s{k} binary" for k in range(ORDER))]) + ", tokens long, types long, kept_tokens long, kept_types long"


def _schema(of: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "double": pa.float64(), "boolean": pa.bool_()}
    return pa.schema([(n, kinds[t]) for n, t in (x.split() for x in of.split(", "))])


def asked(laid: DataFrame, ranges: int) -> DataFrame:
    """What every block counts and asks of every range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for block, kind, raw, size in zip(*(b.column(c).to_pylist() for c in ("block", "kind", "packed", "size"))):
                t = tokens(raw, size)
                keys, counts = [], []
                for k in range(ORDER):
                    u, n, _ = named(t, k, ranges)
                    low = borders(k, ranges)
                    at = np.append(np.searchsorted(u, low), len(u))
                    keys.append([packed(steps(u[i:j], x)) for i, j, x in zip(at[:-1], at[1:], low)])
                    counts.append([packed(n[i:j]) if kind != OTHER else b"" for i, j in zip(at[:-1], at[1:])])
                columns = [range(ranges), [block] * ranges, [kind] * ranges, *keys, *counts]
                schema = _schema(_ASK)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return laid.select("block", "kind", "packed", "size").mapInArrow(run, _ASK)


def answered(table: pa.Table) -> pa.Table:
    """One range's totals for each block that asked, and a row of what it holds in all."""
    kind = np.asarray(table.column("kind"))
    t: list[list[bytes]] = []
    s: list[list[bytes]] = []
    tokens_ = types = kept_tokens = kept_types = 0
    for k in range(ORDER):
        # As distances from the border of the range, which all have in common.
        parts = [np.cumsum(unpacked(x.as_buffer())) for x in table.column(f"k{k}")]
        u = np.unique(np.concatenate(parts))
        places = [np.searchsorted(u, p).astype(np.int32) for p in parts]
        kept, train = np.zeros(len(u), np.int64), np.zeros(len(u), np.int64)
        for i, n in enumerate(table.column(f"n{k}")):
            if kind[i] != OTHER:
                n = unpacked(n.as_buffer()).astype(np.int64)
                train[places[i]] += n
                if kind[i] == KEPT:
                    kept[places[i]] += n
        t.append([packed(train[p]) for p in places] + [b""])
        s.append([packed(kept[p]) if kind[i] == HELD else b"" for i, p in enumerate(places)] + [b""])
        if not k:
            tokens_, types, kept_tokens, kept_types = int(train.sum()), int((train > 0).sum()), int(kept.sum()), int((kept > 0).sum())
    rows = len(kind)
    last = lambda x: [0] * rows + [x]
    columns = [[*table.column("block").to_pylist(), -1], [*kind.tolist(), -1], [table.column("range")[0].as_py()] * (rows + 1), *t, *s, last(tokens_), last(types), last(kept_tokens), last(kept_types)]
    schema = _schema(_TOTAL)
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


@dataclass(frozen=True)
class Counts:
    """The sums of a set of training texts: tokens, distinct tokens, texts."""

    tokens: int
    types: int
    texts: int


def fractions(t: Tokens, totals: pa.Table, ranges: int, which: str, c: Counts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the block's own tokens the counts of the token alone, the fractions of each order, longest first, and the buckets of the contexts."""
    order = np.argsort(np.asarray(totals.column("range")))
    have = []
    for k in range(ORDER):
        u, _, x = named(t, k, ranges)
        column = totals.column(f"{which}{k}")
        n = np.concatenate([unpacked(column[int(i)].as_buffer()) for i in order]).astype(np.int64)
        at = np.searchsorted(u, x)
        at[at == len(u)] = 0
        have.append(np.where(u[at] == x, n[at], 0) if len(u) else np.zeros(len(x), np.int64))
    own = np.flatnonzero(t.own)
    start = t.keys[0][own - 1] == _BEFORE
    fraction, level = [], []
    for k in range(ORDER - 1, 0, -1):
        seen = np.where(start, c.texts, have[k - 1][own - 1])
        fraction.append(np.where(seen > 0, have[k][own] / np.maximum(seen, 1), 0.0))
        level.append(np.minimum(np.frexp(seen + 0.0)[1], LEVELS - 1))  # 0, or one more than the power of two
    alone = have[0][own]
    fraction += [alone / max(c.tokens, 1), np.full(len(own), 1 / (c.types + 1))]
    return alone, np.array(fraction), np.array(level)


_BINS = "level0 int, level1 int, bin long, n double, " + ", ".join(f"f{k} double" for k in range(ORDER + 1))


def binned(block: pa.Table, totals: pa.Table, ranges: int, c: Counts) -> pa.Table:
    """The histogram of a deleted block's fractions: how many tokens a bin has and the sums of their fractions."""
    (raw,), (size,) = (block.column(c).to_pylist() for c in ("packed", "size"))
    _, f, level = fractions(tokens(raw, size), totals, ranges, "s", c)
    power = np.where(f[:ORDER] > 0, np.minimum(1 - np.frexp(f[:ORDER])[1], BINS - 2) + 1, 0)
    place = np.ravel_multi_index([*level, *power], (*[LEVELS] * (ORDER - 1), *[BINS] * ORDER))
    u, at = np.unique(place, return_inverse=True)
    level0, level1, _ = np.unravel_index(u, (*[LEVELS] * (ORDER - 1), BINS**ORDER))
    parts = [level0, level1, u % BINS**ORDER, np.bincount(at, minlength=len(u)), *(np.bincount(at, x, len(u)) for x in f)]
    schema = _schema(_BINS)
    return pa.Table.from_arrays([pa.array(np.asarray(p, f.type.to_pandas_dtype())) for p, f in zip(parts, schema)], schema=schema)


def maximised(n: np.ndarray, f: np.ndarray, prior: float = PRIOR) -> np.ndarray:
    """The weights of fractions f (a row each) under which n tokens are likeliest, each given ``prior`` tokens to begin with.

    A fraction that is nowhere over zero has no weight, which is how an unseen context is left out.
    """
    some = (f > 0).any(axis=1)
    a = some / max(some.sum(), 1)
    for _ in range(STEPS):
        p = np.maximum(a @ f, 1e-300)
        expected = a * (f * (n / p)).sum(axis=1) + prior * some
        new = expected / max(expected.sum(), 1e-300)
        done = np.abs(new - a).max() < ENOUGH
        a = new
        if done:
            break
    return a


_WEIGHTS = "level0 int, level1 int, " + ", ".join(f"a{k} double" for k in range(ORDER + 1))


def learned(table: pa.Table) -> pa.Table:
    """One bucket's weights from its bins."""
    n = np.asarray(table.column("n"))
    a = maximised(n, np.array([np.asarray(table.column(f"f{k}")) for k in range(ORDER + 1)]) / n)
    schema = _schema(_WEIGHTS)
    columns = [[table.column(c)[0].as_py()] for c in ("level0", "level1")] + [[float(x)] for x in a]
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def filled(rows: dict[tuple[int, int], list[float]], tokens: int) -> np.ndarray:
    """Weights by the levels of both contexts: a bucket's own, else those of the longer context's level, else of all; none for what was never seen."""
    out = np.zeros((LEVELS, LEVELS, ORDER + 1))
    for i in range(LEVELS):
        for j in range(LEVELS):
            a = np.array(rows.get((i, j)) or rows.get((i, -1)) or rows.get((-1, -1)) or [1.0] * (ORDER + 1))
            a = a * [i > 0, j > 0, tokens > 0, True]
            out[i, j] = a / a.sum() if a.sum() > 0 else [0.0] * ORDER + [1.0]
    return out


@dataclass(frozen=True)
class Mixture:
    """A fitted model: the sums of all training texts and the weights by context level."""

    counts: Counts
    weights: np.ndarray


_SCORE = "uid long, doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def scored(block: pa.Table, totals: pa.Table, ranges: int, model: Mixture) -> pa.Table:
    """The scores of a block's pieces."""
    (raw,), (size,) = (block.column(c).to_pylist() for c in ("packed", "size"))
    t = tokens(raw, size)
    alone, f, level = fractions(t, totals, ranges, "t", model.counts)
    p = np.zeros(len(alone))
    flat = model.weights.reshape(-1, ORDER + 1)
    bucket = level[0] * LEVELS + level[1]
    for k in range(ORDER + 1):
        p += flat[bucket, k] * f[k]
    edge = np.append(np.searchsorted(np.flatnonzero(t.own), t.first), len(alone))
    total = lambda x: np.diff(np.append(0, np.cumsum(x))[edge])
    n = np.diff(edge)
    summed = lambda x: np.where(n > 0, np.add.reduceat(np.append(x, 0.0), edge[:-1]), 0.0)
    base = summed(np.log10(alone + 1.0)) - n * np.log10(model.counts.tokens + model.counts.types + 1.0)
    columns = [*(block.column(c)[0].values for c in ("uid", "doc_id", "held_out")), pa.array(n), pa.array(total(alone > 0)), pa.array(base), pa.array(summed(np.log10(p)))]
    schema = _schema(_SCORE)
    return pa.Table.from_arrays([c.cast(f.type) for c, f in zip(columns, schema)], schema=schema)


def interpolate(docs: DataFrame, held_out: Column, learn: Column, doc_id: str = "doc_id", text: str = "text", block_bytes: int = BLOCK_BYTES, range_bytes: int = RANGE_BYTES, piece_bytes: int = PIECE_BYTES) -> tuple[DataFrame, Mixture]:
    """The scores of all rows (doc_id, held_out, n_tokens, n_known, base_score, score) under a model of those to learn from, and the model."""
    small_batches(docs.sparkSession)
    scratch = Scratch(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"), held_out.alias("held_out"), F.coalesce(learn, F.lit(False)).alias("learn"))
    laid = scratch.keep(blocks(rows, block_bytes, piece_bytes))
    texts = {r.kind: r for r in laid.groupBy("kind").agg(F.sum("bytes").alias("bytes"), F.sum("texts").alias("texts")).collect()}
    ranges = max(1, -(-sum(r.bytes for r in texts.values()) // range_bytes))
    totals = scratch.keep(asked(laid, ranges).groupBy("range").applyInArrow(answered, _TOTAL))
    sums = totals.where("block = -1").agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("tokens", "types", "kept_tokens", "kept_types")]).first()
    kept, more = (texts[k].texts if k in texts else 0 for k in (KEPT, HELD))
    every, less = Counts(sums[0], sums[1], kept + more), Counts(sums[2], sums[3], kept)
    answer = totals.where("block >= 0").select("block", "kind", "range", *[f"{c}{k}" for c in "ts" for k in range(ORDER)])

    def meet(kind: str, function, schema: str) -> DataFrame:
        left = laid.where(kind).select("block", "uid", "doc_id", "held_out", "size", "packed").groupBy("block")
        return left.cogroup(answer.where(kind).drop("kind").groupBy("block")).applyInArrow(function, schema)

    found = meet(f"kind = {HELD}", lambda b, t: binned(b, t, ranges, less), _BINS)
    whole = found.groupBy("level0", "level1", "bin").agg(F.sum("n").alias("n"), *[F.sum(f"f{k}").alias(f"f{k}") for k in range(ORDER + 1)])
    # Each bin counts for its bucket, for all of the longer context's level, and for all.
    wider = F.explode(F.array(F.struct("level0", "level1"), F.struct("level0", F.lit(-1).alias("level1")), F.struct(F.lit(-1).alias("level0"), F.lit(-1).alias("level1"))))
    whole = whole.withColumn("at", wider).select("at.*", "bin", "n", *[f"f{k}" for k in range(ORDER + 1)])
    whole = whole.groupBy("level0", "level1", "bin").agg(F.sum("n").alias("n"), *[F.sum(f"f{k}").alias(f"f{k}") for k in range(ORDER + 1)])
    got = whole.groupBy("level0", "level1").applyInArrow(learned, _WEIGHTS).collect()  # a row a bucket
    weights = {(r.level0, r.level1): list(r[2:]) for r in got} if less.tokens else {}
    model = Mixture(every, filled(weights, every.tokens))
    pieces = meet("true", lambda b, t: scored(b, t, ranges, model), _SCORE)
    out = pieces.groupBy("uid").agg(*[F.max(c).alias(c) for c in ("doc_id", "held_out")], *[F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base_score", "score")])
    return scratch.last(out.drop("uid")), model


def op13_interpolated_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's log10 probability under the mixture and under add-one unigrams, learned without the held-out fold."""
    tested = fold(7, 2)
    out, model = interpolate(documents(spark, sf_dir), tested, ~tested & F.col("doc_id").isNotNull())
    return out.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(model.counts.tokens).cast("long").alias("train_tokens"), "base_score", "score")
