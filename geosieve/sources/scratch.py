"""Tables written to the folder that all executors share, to cut lineage between rounds."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


class Scratch:
    """Written tables of one job.

    The folder is the one in spark.checkpoint.dir. Only where that is unset,
    as in tests, a temporary folder stands in and is set in the session.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        root = spark.conf.get("spark.checkpoint.dir", None)
        if not root:
            if not spark.sparkContext.master.startswith("local"):
                raise ValueError("spark.checkpoint.dir is not set: executors need a folder that all of them reach")
            root = f"file://{tempfile.mkdtemp(prefix='geosieve-')}"
            spark.conf.set("spark.checkpoint.dir", root)
        self.root = f"{root.rstrip('/')}/scratch-{uuid.uuid4().hex}"
        self.n = 0
        self.kept: dict[str, DataFrame] = {}

    def keep(self, df: DataFrame, rows: int | None = None, per_file: int = 100_000) -> DataFrame:
        """Write df and return it as read back from the written table.

        With ``rows``, about how many there are at most, a small table is dealt
        to files of ``per_file`` rows; the number of files follows the rows, so
        a large one is written by the tasks that make it.
        """
        self.n += 1
        if rows is not None and (files := max(1, -(-rows // per_file))) < int(self.spark.conf.get("spark.sql.shuffle.partitions")):
            df = df.repartition(files)
        path = f"{self.root}/{self.n}"
        with self._tidy():
            df.write.mode("overwrite").parquet(path)
        out = self.kept[path] = self.spark.read.schema(df.schema).parquet(path)
        return out

    @contextmanager
    def _tidy(self) -> Iterator[None]:
        """Let go of the shuffle files of what runs inside as soon as it ends; what it wrote is read from then on."""
        name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
        before = self.spark.conf.get(name, None)
        self.spark.conf.set(name, "true")
        try:
            yield
        finally:
            if before is None:
                self.spark.conf.unset(name)
            else:
                self.spark.conf.set(name, before)

    def drop(self, *frames: DataFrame) -> None:
        """Delete written tables that no later plan reads."""
        jvm, conf = self.spark._jvm, self.spark._jsparkSession.sessionState().newHadoopConf()
        for at in [p for p, k in self.kept.items() if any(k is df for df in frames)]:
            del self.kept[at]
            path = jvm.org.apache.hadoop.fs.Path(at)
            path.getFileSystem(conf).delete(path, True)

    def last(self, df: DataFrame, rows: int | None = None) -> DataFrame:
        """Keep df and delete everything kept before."""
        before = list(self.kept.values())
        out = self.keep(df, rows)
        self.drop(*before)
        return out
