"""Token counts: a broadcast table of frequent pre-token lengths, then worker caches.

Texts are normalised and cut into pre-tokens as the tokenizer file says; a
text's count is the sum of its pre-tokens' counts, since merges never cross
them. Most pre-tokens are in a small table that is broadcast; the rest are
encoded by the library, a batch's misses at once, and kept in a bounded cache
of the worker. Pre-tokens are never shuffled.

The table is fitted on about FIT_ROWS rows, drawn whatever their ids, and
holds at most TABLE entries. It decides only how often the library is called,
never a count. A tokenizer file whose normaliser, pre-tokens or special strings
are others than those spelled out here is refused.

Null and empty texts have 0 tokens. Texts are read whole. Repeated rows give
equal rows; other columns pass through, and an input column with the name of
an output column is replaced.
"""

from __future__ import annotations

import json
import os
import unicodedata
from functools import cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import batched, documents, small_batches, text_or_empty, texts_of

FIT_ROWS, TABLE = 2000, 32_768
CACHE, LONGEST_CACHED = 200_000, 64
BATCH = 256
LIMIT = 2048
#: Fixed values of the tokenizer file: its special strings and its pre-token pattern.
SPECIAL = ("<|startoftext|>", "<|endoftext|>")
PRETOKEN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\p{White_Space}\p{L}\p{N}]+"

_pretoken = regex.compile(PRETOKEN)
_special = regex.compile("|".join(map(regex.escape, SPECIAL)))


def pretokens(text: str) -> tuple[list[str], int]:
    """The normalised pre-tokens of a text and how many special strings stand between them."""
    if "<|" not in text:
        parts = [text]
    else:
        parts = _special.split(text)
    words: list[str] = []
    for part in parts:
        if not part.isascii():
            part = unicodedata.normalize("NFC", part).replace("Σ", "σ")  # lower case goes by single characters
        words += _pretoken.findall(part.lower())
    return words, len(parts) - 1


#: Fixed values of the tokenizer file: how it names its normalisers and its pre-token rule.
NORMALIZERS = ["NFC", "Replace", "Lowercase"]
RULE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


@cache
def load_tokenizer(path: str | None = None):
    """The tokenizer of a file; by default the public one with word ends. ValueError if pretokens() isn't how it cuts."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
    import public_tokenizers
    from tokenizers import Tokenizer

    path = path or public_tokenizers.path("word_bpe_49k.json")
    with open(path, encoding="utf-8") as file:
        made = json.load(file)
    steps = [x.get("type") for x in (made.get("normalizer") or {}).get("normalizers", [])]
    rule = next((x["pattern"].get("Regex") for x in (made.get("pre_tokenizer") or {}).get("pretokenizers", []) if x.get("type") == "Split"), None)
    if (steps, rule, {x["content"] for x in made.get("added_tokens", [])}) != (NORMALIZERS, RULE, set(SPECIAL)):
        raise ValueError(f"{path}: cuts texts in another way than pretokens() does")
    return Tokenizer.from_file(path)


class Lengths:
    """Pre-token lengths: a fixed table, then a bounded cache over the library."""

    def __init__(self, table: dict[str, int], path: str | None = None):
        self.tokenizer, self.table, self.known = load_tokenizer(path), table, dict(table)

    def count(self, texts: list[str]) -> list[int]:
        """Tokens of each text."""
        cut = [pretokens(t) for t in texts]
        missing: set[str] = set()
        for words, _ in cut:
            missing.update(words)
        missing.difference_update(self.known)
        new = list(missing)
        for i in range(0, len(new), 4096):
            some = new[i : i + 4096]
            self.known.update(zip(some, (len(e) for e in self.tokenizer.encode_batch_fast(some, add_special_tokens=False))))
        length = self.known.__getitem__
        out = [sum(map(length, words)) + n for words, n in cut]
        if len(self.known) > CACHE + len(self.table):
            self.known = dict(self.table)
        else:
            for w in new:
                if len(w) > LONGEST_CACHED:
                    del self.known[w]
        return out


_own: dict[str | None, Lengths] = {}


def worker_lengths(table: dict[str, int], path: str | None) -> Lengths:
    """The lengths of this worker, kept from task to task as long as the table is the same."""
    if path not in _own or _own[path].table is not table:
        _own[path] = Lengths(table, path)
    return _own[path]


def frequent_lengths(df: DataFrame, text: str = "text", path: str | None = None) -> dict[str, int]:
    """At most TABLE pre-tokens, the most frequent of about FIT_ROWS rows, with their lengths."""
    chosen = df.select(text).where(F.rand(7) < FIT_ROWS / max(df.count(), FIT_ROWS))
    words = batched(lambda: lambda x: pa.array([pretokens(t)[0] for t in texts_of(x)], pa.list_(pa.string())), T.ArrayType(T.StringType()), F.col(text))
    top = chosen.select(F.explode(words).alias("w")).where(F.length("w") <= LONGEST_CACHED).groupBy("w").count()
    found = [r.w for r in top.orderBy(F.desc("count"), "w").limit(TABLE).collect()]
    return dict(zip(found, (len(e) for e in load_tokenizer(path).encode_batch_fast(found, add_special_tokens=False))))


def count_tokens(df: DataFrame, text: str = "text", out: str = "n_tokens", path: str | None = None) -> DataFrame:
    """Add column ``out``: how many tokens the library gives for each whole text."""
    small_batches(df.sparkSession)
    table = df.sparkSession.sparkContext.broadcast(frequent_lengths(df, text, path))

    def make():
        lengths = worker_lengths(table.value, path)

        def one(column: pa.Array) -> pa.Array:
            parts = (texts_of(column.slice(i, BATCH)) for i in range(0, len(column), BATCH))
            return pa.array([n for texts in parts for n in lengths.count(texts)], pa.int64())

        return one

    return df.withColumn(out, batched(make, T.LongType(), F.col(text)))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its bytes, its tokens and whether they are over the limit."""
    counted = count_tokens(documents(spark, sf_dir).select("doc_id", text_or_empty().alias("text")))
    return counted.select(
        "doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "n_tokens", (F.col("n_tokens") > LIMIT).alias("over_limit")
    )
