"""Secret scans: assignments, access keys, hex runs and token-inefficient strings.

Base kinds are plain patterns. The method adds kind ``random``: a long run of
key characters is encoded with a tiktoken vocabulary, and few characters a
token show that the run is not language. Known digests (hexadecimal of usual
digest lengths), UUIDs and identifiers (names in parts, paths, plain words
and numbers) are excluded first. A run of name parts is an identifier only if
its case seldom switches within a part and its letters, read in lower case,
take few tokens as words do. Runs of fewer than MIN_CANDIDATE characters tell
too little and are not tested, nor are the payloads of base64 data URLs.

A span's score is 1, but 0 for a hex run of a usual digest's length: it counts
as a base span, and redact() leaves it unless another span covers it.

Null and empty texts have no spans. Texts are read whole. Repeated rows give
equal rows. Other columns of the input pass through untouched, and an input
column with the name of an output column is replaced.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPAN_ARROW, SPAN_TYPE, batched, count_spans, documents, joined_spans, small_batches, texts_of

KINDS = ("assign", "access", "hex", "random")
#: Characters per token at or under which a candidate counts as random.
MAX_CHARS_PER_TOKEN = 2.2
MIN_CANDIDATE = 20
#: Letters per token in lower case over which a run of name parts counts as words; of fewer than MIN_LETTERS nothing can be told.
MIN_LETTERS_PER_TOKEN, MIN_LETTERS = 1.8, 12
#: Letters between case switches of a part of both cases, on average, under which it is no name.
MIN_HUMP = 3

_ASSIGN = re.compile(
    r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
_HEX = re.compile(r"[0-9a-f]{16,}")
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % MIN_CANDIDATE)
_DIGEST = re.compile(r"(?:[0-9a-f]+|[0-9A-F]+)\Z")
_DIGEST_LENGTHS = {32, 40, 56, 64, 96, 128}
_UUID = re.compile(r"[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}\Z")
_NAME_PART = re.compile(r"(?:[A-Z]?[a-z]*|[A-Z]+|[0-9]+|[A-Za-z]+[0-9]{1,4})\Z")

_HUMP = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


def is_known(run: str, encode: Callable[[str], list[int]]) -> bool:
    """Whether a run is a digest, a UUID or an identifier rather than a key."""
    if _UUID.match(run) or (len(run) in _DIGEST_LENGTHS and _DIGEST.match(run)):
        return True
    parts = re.split(r"[-_/+=]", run)
    if not all(_NAME_PART.match(part) for part in parts):
        return False
    for part in parts:
        name = part.rstrip("0123456789")
        if len(name) >= MIN_LETTERS and not (name.islower() or name.isupper()) and len(name) < MIN_HUMP * len(_HUMP.findall(name)):
            return False
    letters = re.sub("[^A-Za-z]", "", run).lower()
    return len(letters) < MIN_LETTERS or len(letters) > MIN_LETTERS_PER_TOKEN * len(encode(letters))


@cache
def load_encoding(vocabulary: str | None = None) -> Callable[[str], list[int]]:
    """The encoder of a tiktoken rank file; by default the public byte-level one."""
    import public_tokenizers
    import tiktoken

    path = vocabulary or public_tokenizers.path("byte_bpe_50k.tiktoken")
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("secrets", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


def find_secrets(text: str, encode: Callable[[str], list[int]]) -> list[tuple[str, int, int]]:
    """(kind, start, end) by start, then kind; code points, end exclusive."""
    found = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    for m in _CANDIDATE.finditer(text):
        run = m.group()
        if text.endswith(";base64,", 0, m.start()):
            continue
        if not is_known(run, encode) and len(run) <= MAX_CHARS_PER_TOKEN * len(encode(run)):
            found.append((m.start(), 3, m.end()))
    return [(KINDS[k], start, end) for start, k, end in sorted(found)]


def scan_secrets(df: DataFrame, text: str = "text", out: str = "secret_spans", vocabulary: str | None = None) -> DataFrame:
    """Add column ``out``: array of (kind, start, end, score), sorted by start, then kind; empty if there are none."""

    small_batches(df.sparkSession)

    def make():
        encode = load_encoding(vocabulary)
        return lambda texts: pa.array(
            [[{"kind": k, "start": a, "end": b, "score": float(k != "hex" or b - a not in _DIGEST_LENGTHS)} for k, a, b in find_secrets(x, encode)] for x in texts_of(texts)], SPAN_ARROW
        )

    return df.withColumn(out, batched(make, SPAN_TYPE, F.col(text)))


def redact(df: DataFrame, text: str = "text", spans: str = "secret_spans") -> DataFrame:
    """Replace each span of ``spans`` that scores in ``text`` by ``[SECRET]``; overlapping spans are replaced as one.

    Rows without such spans keep their text, null included.
    """
    scoring = F.filter(F.col(spans), lambda s: s["score"] > 0)
    end = F.aggregate(
        scoring,
        F.struct(F.lit("").alias("done"), F.lit(0).cast("long").alias("at")),
        lambda acc, s: F.struct(
            F.when(
                s["start"] >= acc["at"],
                F.concat(acc["done"], F.substring(F.col(text), (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int")), F.lit("[SECRET]")),
            )
            .otherwise(acc["done"])
            .alias("done"),
            F.greatest(acc["at"], s["end"]).alias("at"),
        ),
    )
    rest = F.concat(F.col("_cut.done"), F.substring(F.col(text), (F.col("_cut.at") + 1).cast("int"), F.length(F.col(text))))
    return df.withColumn("_cut", end).withColumn(text, F.when(F.size(scoring) > 0, rest).otherwise(F.col(text))).drop("_cut")


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its counts of base kinds, the digest of base spans and all spans."""
    found = scan_secrets(documents(spark, sf_dir).select("doc_id", "text")).select("doc_id", "secret_spans")
    spans = F.col("secret_spans")
    return found.select(
        "doc_id",
        *[count_spans(spans, k).alias(f"n_{k}") for k in KINDS],
        F.sha2(joined_spans(spans, KINDS[:3]), 256).alias("base_sha256"),
        joined_spans(spans, KINDS).alias("spans"),
    )
