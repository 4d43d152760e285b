"""The corpus pipeline: five stages, each over all that the one before kept.

quality     drops documents that the rule ensemble rejects
near_dedup  keeps the first document of each near-duplicate group
secrets     replaces secrets in texts by [SECRET]; no document goes
mixing      samples documents by weights raked to the source, language and topic targets
packing     packs what is left into sequences of at most 1024 tokens

Every stage but the last returns the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geosieve.llm import mixing, neardup, packing, quality, secrets
from geosieve.llm.common import Scratch, documents, labels


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is at or over the threshold, null and empty texts by theirs, rows without an id too."""
    rules = quality.fit(docs, labels(spark, sf_dir), held_out=quality.fold(5, 0))
    return docs.where(rules.score("text") >= quality.THRESHOLD)


def keep_distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group, one row of those that repeat whole id and text; rows without an id stay."""
    found = neardup.near_duplicates(docs)
    gone = found.where(~F.col("kept")).select("doc_id").distinct()
    again = found.where("kept and doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id")
    once = docs.join(gone.union(again), "doc_id", "left_anti")
    # Ids that stand in several rows: the least row of each text.
    several = docs.join(again, "doc_id", "left_semi").withColumn("_h", F.md5(F.coalesce("text", F.lit("")))).dropDuplicates(["doc_id", "_h"])
    return once.select(docs.columns).union(several.select(docs.columns))


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced, lengths counted anew where a text changed.

    Null and empty texts, null ids and repeated rows pass as they are; digests stay, since they are no secrets.
    """
    found = secrets.redact(secrets.scan_secrets(docs, out="_secrets"), spans="_secrets")
    changed = F.exists("_secrets", lambda s: s["score"] > 0)
    return found.withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(docs.columns)


def sample_mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn by their calibrated probabilities.

    Null sources and languages are "other", a null or empty text one token, a null id draws as the empty string,
    and repeated rows share their fate; an empty table stays empty.
    """
    return mixing.mix_documents(docs).where("mix_sampled").select(docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequences and places."""
    return packing.pack(docs)


STAGES = [
    ("quality", keep_good),
    ("near_dedup", keep_distinct),
    ("secrets", hide_secrets),
    ("mixing", sample_mixture),
    ("packing", pack_sequences),
]

#: SQL can express neither the fitted rules nor tokenization; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each one's result written and read again."""
    scratch = Scratch(spark)
    docs = documents(spark, sf_dir)
    for _, stage in STAGES[:-1]:
        docs = scratch.keep(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
