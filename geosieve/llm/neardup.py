"""Near-duplicate documents by MinHash, banding, verification and star components.

A document's set is its distinct word shingles. Documents whose sets have a
Jaccard similarity at or over the threshold are linked, and the components of
links are the classes.

1. One pass over the texts makes each set's size, a digest of the set, many
   universal hash minima cut to one byte each (the signature) and the band
   keys. Equal sets become one node by their digest, so a group of copies of
   any size costs one row from then on.
2. Nodes that share a band key are candidates. A key's smallest node is
   paired with the others, so a key with n nodes gives n - 1 pairs. Pairs are
   sifted by size and signature, then confirmed on the full sets; first each
   node's best pair, then only the pairs that still join two components.
3. The nodes of keys whose members lie in several components are joined exactly
   among themselves, by their rarest shingles: of two similar sets, which are of known
   sizes, the first few shingles in an order common to all have one in common. A
   passage that very many texts share is common, so it comes last and pairs nobody.
   Pairs within a component are left out; the rest are sifted and confirmed like
   the others. So no pair that shares a key goes unseen unless both are already in
   one component.
4. Components come from alternating large-star and small-star steps; each is
   a grouped minimum and a join, so a node with very many links is split as
   any skewed key.

Bands miss a pair at exactly 0.75 with a probability under 4e-6, the signature
under 1e-8; more similar pairs are missed far less often.

Null and empty texts and texts of white space alone have the size 0 and are
linked with nothing. Rows with a null id are returned alone, with a null
component, and kept. Repeated rows give equal rows. Different texts under one
id are one document: it is linked through each of them, and so are they with
one another. Only the id and the text are read; other columns don't matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geosieve.operators.components import components

from .common import Scratch, documents, small_batches, texts_of
from .hashing import mix, odd, word_hashes

WORDS, THRESHOLD = 5, 75
BANDS, ROWS = 64, 6
SIGNATURE = 256
#: Signature estimates have a deviation of 0.027 at 0.75; six of them are left as margin.
SIFT = 0.59
#: Shingles are told rare or common by how often their class of 2 ** COMMON_BITS occurs; sizes differ by CLASS_RATIO within a class.
COMMON_BITS, CHUNKS, CLASS_RATIO = 18, 64, 1.15
_U = np.uint64
_MUL = odd(BANDS * ROWS, 12, 32).astype(np.uint32)
_ADD = np.random.default_rng(13).integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint64).astype(np.uint32)
_PLACE = odd(64, 14, 64)
_P = 0x9E3779B97F4A7C15


def shingle_set(text: str, words: int = WORDS) -> np.ndarray:
    """The sorted distinct 64-bit hashes of a text's word shingles."""
    word, _ = word_hashes(text.encode("utf-8", "replace").lower())
    m = len(word)
    if not m:
        return word
    if m < words:
        return mix((word * _PLACE[:m]).sum(keepdims=True) + _U(m))
    h = np.zeros(m - words + 1, np.uint64)
    for j in range(words):
        h += word[j : m - words + 1 + j] * _PLACE[j]
    return np.unique(mix(h + _U(words)))


def minima(hashes: np.ndarray, mul: np.ndarray = _MUL, add: np.ndarray = _ADD) -> np.ndarray:
    """The minima of a set under universal hash functions."""
    x = hashes.astype(np.uint32) ^ (hashes >> _U(32)).astype(np.uint32)
    low = np.full(len(mul), 0xFFFFFFFF, np.uint32)
    for i in range(0, len(x), 512):
        np.minimum(low, (x[i : i + 512, None] * mul[None, :] + add[None, :]).min(axis=0), out=low)
    return low


def band_keys(low: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band of minima."""
    rows = low.reshape(BANDS, ROWS).astype(np.uint64)
    return mix(mix((rows * _PLACE[None, :ROWS]).sum(axis=1)) + np.arange(1, BANDS + 1, dtype=np.uint64) * _U(_P)).view(np.int64)


def similar(a: np.ndarray, b: np.ndarray, threshold: int = THRESHOLD) -> bool:
    """Whether 100 * intersection >= threshold * union for two sorted sets."""
    both = len(a) + len(b) - len(np.union1d(a, b))
    return len(a) > 0 and len(b) > 0 and 100 * both >= threshold * (len(a) + len(b) - both)


_FEATURES = "doc_id long, n_shingles long, digest binary, bands array<long>, signature binary"


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in (batch.slice(i, 500) for i in range(0, batch.num_rows, 500)):
            size, digest, bands, signature = [], [], [], []
            for text in texts_of(part.column("text")):
                s = shingle_set(text)
                size.append(len(s))
                digest.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                low = minima(s) if len(s) else None
                bands.append(band_keys(low) if len(s) else [])
                signature.append(low[:SIGNATURE].astype(np.uint8).tobytes() if len(s) else b"")
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(size, pa.int64()), pa.array(digest, pa.binary()), pa.array(bands, pa.list_(pa.int64())), pa.array(signature, pa.binary())],
                names=["doc_id", "n_shingles", "digest", "bands", "signature"],
            )


@F.arrow_udf(T.DoubleType())
def _likeness(a: pa.Array, b: pa.Array) -> pa.Array:
    """Jaccard similarity as one-byte signatures estimate it."""
    x = np.frombuffer(b"".join(a.to_pylist()), np.uint8).reshape(-1, SIGNATURE)
    y = np.frombuffer(b"".join(b.to_pylist()), np.uint8).reshape(-1, SIGNATURE)
    return pa.array(((x == y).mean(axis=1) - 1 / 256) / (1 - 1 / 256))


@F.arrow_udf(T.BooleanType())
def _linked(a: pa.Array, b: pa.Array) -> pa.Array:
    """Whether two texts' full sets are similar; the last left text's set is used again."""
    out, last, s = [], None, None
    for x, y in zip(a.to_pylist(), b.to_pylist()):
        if last is None or x != last:
            last, s = x, shingle_set(x)
        out.append(similar(s, shingle_set(y)))
    return pa.array(out, pa.bool_())


def _occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many sets hold shingles of each class, in chunks."""
    n = np.zeros(1 << COMMON_BITS, np.int64)
    for batch in batches:
        for text in texts_of(batch.column("text")):
            n += np.bincount((shingle_set(text) >> _U(64 - COMMON_BITS)).astype(np.int64), minlength=len(n))
    chunks = [c.tobytes() for c in np.split(n, CHUNKS)]
    yield pa.RecordBatch.from_arrays([pa.array(range(CHUNKS), pa.int32()), pa.array(chunks, pa.binary())], names=["chunk", "n"])


def _added(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(x.as_buffer(), np.int64) for x in table.column("n"))
    return pa.table({"chunk": table.column("chunk")[:1], "n": pa.array([total.tobytes()], pa.binary())})


def size_class(n: int) -> int:
    """The class of a set's size."""
    return int(np.log(n) / np.log(CLASS_RATIO) + 1e-9)


def prefix(s: np.ndarray, common: np.ndarray, threshold: int = THRESHOLD) -> tuple[np.ndarray, np.ndarray]:
    """The shingles of a set by which it can meet similar ones, and the largest size of a set that it can meet by each.

    Shingles are put in one order for all sets, rare ones first. Similar sets of sizes n and m have a
    number of shingles in common that the sizes give, so the first one in common leaves room for the others in both.
    """
    n = len(s)
    ordered = s[np.lexsort((s, common[(s >> _U(64 - COMMON_BITS)).astype(np.int64)]))]
    left = n - np.arange(n)
    most = np.minimum((100 + threshold) * left // threshold - n, 100 * n // threshold)
    some = most >= -(-threshold * n // 100)
    return ordered[some], most[some]


def classes(n: int, most: np.ndarray, threshold: int = THRESHOLD) -> tuple[np.ndarray, np.ndarray]:
    """(place, class) for every class of sizes that the shingle at the place can meet."""
    first = size_class(-(-threshold * n // 100))
    last = (np.log(most) / np.log(CLASS_RATIO) + 1e-9).astype(np.int64)
    count = last - first + 1
    place = np.repeat(np.arange(len(most)), count)
    return place, first + np.arange(len(place)) - np.repeat(np.cumsum(count) - count, count)


_RARE = "token long, lo int, hi int, side int, node long, root long, size long, most long"


def _rare(common) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The shingles by which each set can meet similar ones, once for each class of their sizes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for node, root, text in zip(batch.column("node").to_pylist(), batch.column("root").to_pylist(), texts_of(batch.column("text"))):
                s = shingle_set(text)
                token, most = prefix(s, common.value)
                at, other = classes(len(s), most)
                mine = size_class(len(s))
                same = [np.full(len(at), x, np.int64) for x in (node, root, len(s))]
                rows.append((token[at].view(np.int64), np.minimum(mine, other), np.maximum(mine, other), np.sign(mine - other), *same, most[at]))
            if rows:
                columns = [np.concatenate(c) for c in zip(*rows)]
                kinds = [pa.int32() if " int" in x else pa.int64() for x in _RARE.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=[x.split()[0] for x in _RARE.split(", ")])

    return run


def near_duplicates(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of df: doc_id, n_shingles, component_id, kept."""
    small_batches(df.sparkSession)
    scratch = Scratch(df.sparkSession)
    docs = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    made = scratch.keep(docs.mapInArrow(_features, _FEATURES))
    n = made.count()
    sized = made.where("n_shingles > 0 and doc_id is not null")
    nodes = sized.groupBy("digest").agg(F.min("doc_id").alias("node"), *[F.first(c).alias(c) for c in ("n_shingles", "bands", "signature")])
    nodes = scratch.keep(nodes)
    rows = scratch.keep(made.select("doc_id", "n_shingles", "digest"), n)
    scratch.drop(made)

    keys = nodes.select("node", F.explode("bands").alias("key"))
    shared = keys.groupBy("key").agg(F.min("node").alias("leader"), F.max("node").alias("last")).where("leader <> last").drop("last")
    members = scratch.keep(keys.join(shared, "key"))
    full, nodes = nodes, scratch.keep(nodes.drop("bands"))
    scratch.drop(full)
    texts = docs.join(members.select(F.col("node").alias("doc_id")).distinct(), "doc_id", "left_semi").withColumn("_h", F.md5("text"))
    texts = scratch.keep(texts.dropDuplicates(["doc_id", "_h"]).drop("_h"))
    shared_rows = members.count()
    marks = nodes.select("node", "n_shingles", "signature")

    def sifted(pairs: DataFrame) -> DataFrame:
        """Pairs (a, b) that sizes and signatures leave, with their estimated likeness."""
        x, y = (marks.toDF(c, f"n_{c}", f"s_{c}") for c in "ab")
        near = pairs.distinct().join(x, "a").join(y, "b").where("100 * least(n_a, n_b) >= 75 * greatest(n_a, n_b)")
        near = near.select("a", "b", _likeness("s_a", "s_b").alias("likeness")).where(F.col("likeness") >= SIFT)
        return scratch.keep(near, shared_rows)

    def confirmed(pairs: DataFrame, most: int) -> DataFrame:
        x, y = (texts.toDF(c, f"t_{c}") for c in "ab")
        found = pairs.select("a", "b").join(y, "b").join(x, "a").select("a", "b", _linked("t_a", "t_b").alias("linked"))
        return scratch.keep(found.where("linked").select("a", "b"), most)

    def across(pairs: DataFrame, roots: DataFrame) -> DataFrame:
        """The pairs that lie in two components."""
        x, y = (roots.toDF(c, f"r_{c}") for c in "ab")
        both = pairs.join(x, "a", "left").join(y, "b", "left")
        return both.where("coalesce(r_a, a) <> coalesce(r_b, b)").select(*pairs.columns)

    pairs = sifted(members.where("node <> leader").select(F.col("leader").alias("a"), F.col("node").alias("b")))
    best = pairs.groupBy("b").agg(F.max_by("a", F.struct("likeness", "a")).alias("a"))
    most = pairs.count()
    # Different texts under one id: their nodes are linked by it.
    several = rows.where("n_shingles > 0 and doc_id is not null").groupBy("doc_id").agg(F.min("digest").alias("lo"), F.max("digest").alias("hi")).where("lo <> hi")
    named = rows.join(several.select("doc_id"), "doc_id", "left_semi").join(nodes.select("digest", "node"), "digest")
    own = scratch.keep(named.select(F.col("doc_id").alias("a"), F.col("node").alias("b")).where("a <> b").distinct(), most)
    links = own.union(confirmed(best, min(most, texts.count())))
    roots = components(scratch, links, most)
    links = links.union(confirmed(across(pairs, roots).join(best, ["a", "b"], "left_anti"), most))
    roots = components(scratch, links, most)

    x, y = roots.toDF("node", "root"), roots.toDF("leader", "leader_root")
    placed = members.join(x, "node", "left").join(y, "leader", "left")
    placed = scratch.keep(placed.select("key", "node", "leader", F.coalesce("root", "node").alias("root"), F.coalesce("leader_root", "leader").alias("leader_root")), shared_rows)
    apart = placed.where("root <> leader_root")
    mixed = placed.join(apart.select("key").distinct(), "key", "left_semi")
    some = scratch.keep(texts.withColumnRenamed("doc_id", "node").join(mixed.select("node", "root").distinct(), "node"))
    parts = some.select("text").mapInArrow(_occurrences, "chunk int, n binary").groupBy("chunk").applyInArrow(_added, "chunk int, n binary").collect()
    common = np.concatenate([np.frombuffer(r.n, np.int64) for r in sorted(parts)] or [np.zeros(1 << COMMON_BITS, np.int64)])
    sent = df.sparkSession.sparkContext.broadcast(common)  # 2 ** COMMON_BITS numbers whatever the corpus

    # Sets that share a rare shingle, of all components that have it those apart from the most frequent one with all others.
    held = scratch.keep(some.mapInArrow(_rare(sent), _RARE))
    of = ["token", "lo", "hi"]
    by_root = held.groupBy(*of, "root").agg(F.count("*").alias("n"))
    lead = by_root.groupBy(*of).agg(F.max_by("root", F.struct("n", "root")).alias("lead"), F.count("*").alias("roots")).where("roots > 1").drop("roots")
    held = scratch.keep(held.join(lead, of))
    x = held.where("root <> lead").drop("lead").withColumnsRenamed({c: f"s_{c}" for c in ("side", "node", "root", "size", "most")})
    rest = x.join(held, of).where("root <> s_root and side = -s_side and (root = lead or s_node < node) and size <= s_most and s_size <= most")
    rest = sifted(rest.select(F.least("s_node", "node").alias("a"), F.greatest("s_node", "node").alias("b")))
    left = rest.count()
    roots = components(scratch, links.union(confirmed(rest, left)), most + left)

    classes = nodes.select("digest", "node").join(roots, "node", "left").select("digest", F.coalesce("root", "node").alias("root"))
    out = rows.join(classes, "digest", "left").select(
        "doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("root")).otherwise(F.col("doc_id")).alias("component_id")
    )
    out = out.withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.col("component_id")))
    return scratch.last(out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))), n)


def op4_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its set size, its class and whether it represents the class."""
    return near_duplicates(documents(spark, sf_dir))
