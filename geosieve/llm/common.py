"""What the corpus operators share: reading documents, shared scratch tables, span columns."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geosieve.sources.scratch import Scratch as Scratch

DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents table of a data folder, whole."""
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labels table of a data folder, whole."""
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def text_or_empty(column: str = "text"):
    """The text column with null read as the empty string."""
    return F.coalesce(F.col(column), F.lit(""))


def labelled_sample(known: DataFrame, label: str, held_out: Column, fit_rows: int) -> DataFrame:
    """(doc_id, label) of about fit_rows labelled ids that aren't held out, chosen by a hash of the id; repeated rows count once."""
    usable = known.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("double").alias("label"))
    usable = usable.where(F.col("label").isin(0.0, 1.0) & F.col("doc_id").isNotNull() & ~held_out).distinct()
    rows = usable.count()
    return usable.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < F.lit(-(-1_000_000 * fit_rows // max(rows, fit_rows))))


def labelled_texts(docs: DataFrame, known: DataFrame, label: str, held_out: Column, fit_rows: int) -> DataFrame:
    """(doc_id, label, text) of the sample, one row an id and label: of several texts under one id the least."""
    sample = labelled_sample(known, label, held_out, fit_rows)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    # Distinct ids of about fit_rows rows, two numbers each, whatever the corpus and however often ids repeat.
    return texts.join(F.broadcast(sample), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))


def fold(modulus: int, remainder: int, doc_id: str = "doc_id") -> Column:
    """Whether crc32 of the id as text has this remainder; a null id has none."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % modulus == remainder, F.lit(False))


SPAN_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))
SPAN_TYPE = T.ArrayType(
    T.StructType(
        [
            T.StructField("kind", T.StringType()),
            T.StructField("start", T.LongType()),
            T.StructField("end", T.LongType()),
            T.StructField("score", T.DoubleType()),
        ]
    )
)


BATCH_ROWS = 500


def small_batches(spark: SparkSession) -> None:
    """Texts are long, so Arrow batches hold fewer rows than Spark's default, unless the session sets its own number."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(name) == "10000":
        spark.conf.set(name, str(BATCH_ROWS))


def texts_of(array: pa.Array) -> list[str]:
    """The texts of an Arrow array, null as the empty string."""
    return [x or "" for x in array.to_pylist()]


def batched(make: Callable[[], Callable[[pa.Array], pa.Array]], result: T.DataType | str, column) -> Column:
    """A column made from another by Arrow batches; make() runs once a task and returns what maps a batch."""

    def run(batches):
        one = make()
        for x in batches:
            yield one(x)

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, result)(column)


def joined_spans(spans: Column, kinds: tuple[str, ...]) -> Column:
    """kind:start:end of the spans of these kinds, comma-joined in the order they have."""
    text = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(F.filter(spans, lambda s: s["kind"].isin(*kinds)), text), ",")


def count_spans(spans: Column, kind: str) -> Column:
    """How many spans are of a kind."""
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
