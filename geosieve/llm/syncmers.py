"""Document fingerprints by closed syncmers, with DataFrame functions only.

A text is read as units: words of at most UNIT code points, and of longer runs,
and runs with letters of scripts that don't part words, each code point. So no
unit's bounds hang on where a run begins. A k-mer is K units in a row; it is chosen if the least of its inner
substrings, single units ordered by a hash, is the first or the last. Letters,
digits and signs of small alphabets alone say little, so where all K units are
such, a k-mer is LONG of them and its inner substrings are INNER long. Whether
a k-mer is chosen depends on the k-mer alone, so two texts that share a
passage choose the same k-mers there whatever stands around it, and the places
of chosen k-mers are anchors for matching passages by position. A text
none of whose k-mers is chosen has its words as anchors, and its single letters,
digits and signs as one.

A fingerprint is all anchors of a text with their places, in the text's order,
and the likeness of two is the Jaccard similarity of their distinct hashes.
Two texts without units are alike (1).

Null texts are read as empty. Texts are read whole. Equal texts have equal
fingerprints. The next document is by ascending id, nulls first, equal ids by
a hash of the text; a sole document is its own next. Repeated rows each have
their place. Other columns don't matter.
"""

from __future__ import annotations

from collections import Counter
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import Scratch, documents

UNIT, K = 24, 4
LONG, INNER = 24, 9
#: Code points from here on, three bytes and more in UTF-8, are of alphabets large enough for short k-mers.
LARGE_ALPHABETS = 0x0800
#: Scripts whose texts have no spaces between words.
UNPARTED = "".join(rf"\p{{Is{s}}}" for s in ("Han", "Hiragana", "Katakana", "Thai", "Lao", "Khmer", "Myanmar"))
#: A short word between spaces, or else one code point.
UNITS = rf"(?<!\S)[^\s{UNPARTED}]{{1,{UNIT}}}+(?!\S)|\S"
ROWS_PER_BUCKET, MOST_CUTS, COARSE = 1000, 4096, 64
NULL_KEY = -(2**63)


def with_anchors(df: DataFrame, text: str, out: str, places: bool = False) -> DataFrame:
    """Add ``out``: the hashes of chosen k-mers in order, or with ``places`` structs of (unit, hash)."""
    units = F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(UNITS), F.lit(0))
    # The lowest bit of a unit's hash tells a single letter, digit or sign.
    single = lambda u: (F.octet_length(u) <= len(chr(LARGE_ALPHABETS - 1).encode())) & (F.length(u) == 1)
    df = df.withColumn("_units", F.transform(units, lambda u: F.when(single(u), F.xxhash64(u).bitwiseOR(1)).otherwise(F.xxhash64(u).bitwiseAND(-2))))
    h = F.col("_units")

    def inner(first: Column, i: Column) -> Column:
        rest = [F.get(h, i + j) for j in range(1, INNER)]
        return F.when(first.bitwiseAND(1) == 1, F.when(reduce(Column.bitwiseAND, rest).bitwiseAND(1) == 1, F.xxhash64(first, *rest)))

    df = df.withColumn("_inner", F.transform(h, inner))
    g, ends = F.col("_inner"), LONG - INNER

    def kmer(first: Column, i: Column) -> Column:
        last, others = h[i + (K - 1)], [h[i + j] for j in range(1, K - 1)]
        a, b, c, d = (F.get(g, i + j) for j in (0, INNER - 2, INNER - 1, ends))  # together they show that all LONG units are single
        whole = b.isNotNull() & (F.least(a, d) <= F.array_min(F.slice(g, i + 1, ends + 1)))
        long = F.when(a.isNotNull() & d.isNotNull(), F.when(whole, F.xxhash64(a, c, d)))
        short = F.when(F.least(first, last) <= F.least(*others), F.xxhash64(first, *others, last))
        single = reduce(Column.bitwiseAND, others, last).bitwiseAND(1) == 1
        value = F.when(first.bitwiseAND(1) == 0, short).when(single, long).otherwise(short).bitwiseAND(0xFFFFFFFF)
        return F.when(value.isNotNull(), F.struct(i.alias("unit"), value.alias("hash"))) if places else value

    chosen = F.filter(F.transform(F.slice(h, 1, F.greatest(F.size(h) - (K - 1), F.lit(0))), kmer), lambda x: x.isNotNull())
    anchor = lambda x, i: F.struct(i.alias("unit"), x.bitwiseAND(0xFFFFFFFF).alias("hash")) if places else x.bitwiseAND(0xFFFFFFFF)
    words = F.filter(F.transform(h, lambda x, i: F.when(x.bitwiseAND(1) == 0, anchor(x, i))), lambda x: x.isNotNull())
    letters = F.filter(h, lambda x: x.bitwiseAND(1) == 1)
    first = (F.array_position(F.transform(h, lambda x: x.bitwiseAND(1)), F.lit(1).cast("long")) - 1).cast("int")
    plain = F.when(F.size(letters) == 0, words).otherwise(F.array_sort(F.concat(words, F.array(anchor(F.xxhash64(letters), first)))))
    df = df.withColumn("_chosen", chosen)
    return df.withColumn(out, F.when(F.size("_chosen") == 0, plain).otherwise(F.col("_chosen"))).drop("_units", "_inner", "_chosen")


def with_fingerprint(df: DataFrame, text: str, out: str) -> DataFrame:
    """Add ``out``: all anchors of a text, (unit, hash) in order."""
    return with_anchors(df, text, out, places=True)


def hashes(fingerprint: Column) -> Column:
    """The hashes of a fingerprint."""
    return F.transform(fingerprint, lambda x: x["hash"])


def as_text(fingerprint: Column) -> Column:
    """A fingerprint as a string: unit * 2 ** 32 + hash of each anchor, comma-joined."""
    return F.array_join(F.transform(fingerprint, lambda x: (F.shiftleft(x["unit"].cast("long"), 32) + x["hash"]).cast("string")), ",")


def likeness(a: Column, b: Column) -> Column:
    """The Jaccard similarity of two fingerprints' hashes."""
    either = F.size(F.array_union(a, b))
    return F.when(either == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / F.greatest(either, F.lit(1)))


def with_next(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Add next_<column>: the values of the row with the next key, for the last row those of the first.

    Rows are in the order of the key, then of a hash of the columns. At most
    MOST_CUTS quantiles of the key cut them coarsely; between two cuts keys are
    dealt to finer buckets by their place there, rows without a key and those
    of a key that several quantiles fall on by the hash. So a bucket has about
    ROWS_PER_BUCKET rows however many there are. Each bucket also gets the
    first row of the one after it, is put in order alone, and the texts are
    shuffled once. Rows that repeat key and columns can't be parted; their next
    ones are equal.
    """
    rows = df.withColumns({"_key": F.coalesce(F.col(key).cast("long"), F.lit(NULL_KEY)), "_tie": F.xxhash64(*columns)})
    n, known = df.select(F.count("*"), F.count(key)).first()
    cuts = max(1, min(MOST_CUTS, n // ROWS_PER_BUCKET))
    fine = max(1, n // (cuts * ROWS_PER_BUCKET))
    at = [i / cuts for i in range(1, cuts)] or [0.5]
    of_key = F.percentile_approx(F.col(key).cast("long"), at, max(10_000, 10 * cuts)), F.min(F.col(key).cast("long")), F.max(F.col(key).cast("long"))
    places, least, most = df.select(*of_key).first()
    falls = Counter(places or [])
    if n > known:
        falls[NULL_KEY] += 1 + (n - known) * cuts // n
    ends = sorted(falls)
    lows = [(least or 0) - 1, *ends] if n == known else [NULL_KEY, (least or 0) - 1, *ends[1:]]
    highs = [*ends, most or 0]
    k, longs = F.col("_key"), lambda xs: F.array(*map(F.lit, xs)).cast("array<bigint>")
    groups = [ends[i : i + COARSE] for i in range(0, len(ends), COARSE)] or [[]]
    below = lambda xs: F.size(F.filter(xs, lambda x: x < k))
    group = below(longs([g[0] for g in groups if g]))
    within = F.element_at(F.array(*map(longs, groups)), F.greatest(group, F.lit(1)))
    coarse = F.when(group == 0, 0).otherwise((group - 1) * COARSE + below(within))
    low, high = (F.element_at(longs(xs), F.col("_coarse") + 1).cast("double") for xs in (lows, highs))
    times = F.element_at(longs([falls[e] for e in ends] + [1]), F.col("_coarse") + 1)
    part = lambda share, parts: F.least(F.floor(share * parts), parts - 1)
    split = (times > 1) & (k == F.element_at(longs(highs), F.col("_coarse") + 1))
    by_place = part((k.cast("double") - low - 1) / F.greatest(high - low, F.lit(1.0)), F.lit(fine).cast("long"))
    by_tie = fine + part(F.col("_tie").cast("double") / 2.0**64 + 0.5, times * fine)
    step = fine * (1 + max(falls.values(), default=1))
    rows = rows.withColumn("_coarse", coarse).withColumn("_bucket", F.col("_coarse") * F.lit(step).cast("long") + F.when(split, by_tie).otherwise(F.greatest(by_place, F.lit(0).cast("long"))))

    scratch = Scratch(df.sparkSession)
    firsts = scratch.keep(rows.groupBy("_coarse", "_bucket").agg(F.min(F.struct("_key", "_tie")).alias("first")), n // ROWS_PER_BUCKET)
    lasts = firsts.groupBy("_coarse").agg(F.max("_bucket").alias("last"))
    over = W.orderBy("_coarse")  # a row a cut
    lasts = lasts.select("_coarse", F.coalesce(F.lag("last").over(over), F.max("last").over(W.partitionBy())).alias("before"))
    before = F.coalesce(F.lag("_bucket").over(W.partitionBy("_coarse").orderBy("_bucket")), F.col("before"))
    firsts = firsts.join(F.broadcast(lasts), "_coarse").select(F.col("first._key").alias("_key"), F.col("first._tie").alias("_tie"), before.alias("_to"))
    firsts = scratch.last(firsts, n // ROWS_PER_BUCKET)  # written, so that its size decides how it is joined
    guests = rows.join(firsts, ["_key", "_tie"]).drop("_bucket").withColumnRenamed("_to", "_bucket").dropDuplicates(["_key", "_tie"])
    rows = rows.withColumn("_guest", F.lit(False)).unionByName(guests.withColumn("_guest", F.lit(True)))
    # By number, since what is made of texts is much work for few bytes, which would else be joined into few tasks.
    rows = rows.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), "_bucket")
    order = W.partitionBy("_bucket").orderBy("_guest", "_key", "_tie")
    rows = rows.withColumns({f"next_{c}": F.lead(c).over(order) for c in columns})
    return rows.where(~F.col("_guest")).drop("_key", "_tie", "_coarse", "_bucket", "_guest")


def op8_syncmer_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its fingerprint, its edited text's, and the likenesses.

    Anchors take more room than their texts, so only texts are shuffled, and the next document's anchors are found again.
    """
    docs = documents(spark, sf_dir).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = with_next(docs, "doc_id", ["text"])
    rows = rows.withColumn("n_chars", F.length("text").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), F.col("n_chars").cast("int") - half), F.substring(F.col("next_text"), F.lit(1), half))
    rows = with_fingerprint(rows.withColumn("edited", edited), "text", "own")
    rows = with_anchors(with_fingerprint(rows, "edited", "other"), "next_text", "_next")
    rows = rows.withColumns({"_own": hashes(F.col("own")), "_other": hashes(F.col("other"))})
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        as_text(F.col("own")).alias("fingerprint"),
        as_text(F.col("other")).alias("edited_fingerprint"),
        likeness(F.col("_own"), F.col("_other")).alias("near_edited"),
        likeness(F.col("_own"), F.col("_next")).alias("near_next"),
    )
