"""The bronze table of service responses: fetched by tasks, kept as they came, read offline.

Queries never fetch. A fetch job asks for the keys that have no good answer
yet, so a rerun fills gaps; failures go to the table as failures and are never
taken for answers.
"""

from __future__ import annotations

import time
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geosieve.functions.text import endpoint
from geosieve.operators.relational import latest_ok

SCHEMA = "producer string, key string, url string, fetched_at timestamp, ok boolean, body string, error string, complete boolean"
TRIES, BACKOFF_S, MOST_PAGES = 3, 1.5, 50


def valid(responses: DataFrame, requests: DataFrame) -> DataFrame:
    """The latest good and complete answer for each request whose endpoint it still has."""
    wanted = requests.select("producer", "key", endpoint(F.col("url")).alias("_wanted"))
    same = responses.join(wanted, ["producer", "key"]).where(endpoint(F.col("url")) == F.col("_wanted"))
    found = latest_ok(same, ["producer", "key"], F.col("ok") & F.coalesce("complete", F.lit(True)), ["fetched_at"], ["url", "body"])
    return found.where("body is not null")


def missing(responses: DataFrame, requests: DataFrame) -> DataFrame:
    """Requests without a valid answer: what a fetch job asks for, and what offline readers report as failed."""
    return requests.join(valid(responses, requests).select("producer", "key"), ["producer", "key"], "left_anti")


def fetch(requests: DataFrame, get: Callable[[str, int], tuple[str, bool]], sleep: Callable[[float], None] = time.sleep) -> DataFrame:
    """Rows of SCHEMA for requests (producer, key, url).

    get(url, page) gives (body, more?) and raises ConnectionError to be tried
    again; other errors are the service's own and are not. Pages are followed
    to the end; an answer with pages missing is kept as incomplete.
    """

    def one(url: str) -> dict:
        bodies: list[str] = []
        for page in range(MOST_PAGES):
            for i in range(TRIES):
                try:
                    body, more = get(url, page)
                    break
                except ConnectionError as e:
                    if i == TRIES - 1:
                        return {"ok": False, "body": None, "error": str(e), "complete": False}
                    sleep(BACKOFF_S * (i + 1))
                except Exception as e:  # noqa: BLE001 - whatever a service answers is recorded
                    return {"ok": False, "body": None, "error": f"{type(e).__name__}: {e}", "complete": False}
            bodies.append(body)
            if not more:
                return {"ok": True, "body": "\n".join(bodies), "error": None, "complete": True}
        return {"ok": True, "body": "\n".join(bodies), "error": f"more than {MOST_PAGES} pages", "complete": False}

    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                got = one(r["url"])
                now = pa.array([int(time.time() * 1e6)], pa.timestamp("us", "UTC"))
                cells = [[r["producer"]], [r["key"]], [r["url"]], now, [got["ok"]], pa.array([got["body"]], pa.string()), pa.array([got["error"]], pa.string()), [got["complete"]]]
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in cells], names=[c.split()[0] for c in SCHEMA.split(", ")])

    return requests.select("producer", "key", "url").mapInArrow(run, SCHEMA)


def sniffed(files: DataFrame) -> DataFrame:
    """Binary files (path, content) with whether they can be a raster: not JSON, XML or HTML, and 64 bytes at least."""
    head = F.ltrim(F.decode(F.substring("content", 1, 64), "ISO-8859-1"))
    text = head.startswith("{") | head.startswith("[") | head.startswith("<")
    return files.withColumn("usable", (F.length("content") >= 64) & ~text)
