"""Site lists, map archives, sheets, responses, publishing and the fetch log."""

import hashlib
import json
import zipfile
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from geosieve.functions import status, text
from geosieve.operators import producers, relational
from geosieve.sources import documents, responses, sinks, sites
from geosieve.streaming import fetchlog


def test_site_list(spark, tmp_path):
    lines = ["﻿Site ID,Latitude,long,Acres,Owner", "a,40,-90,\"1,200\",x", "a,95,-90,1,y", " ,40,-90,1,y", "b,,-90,20-30,y", "b,abc,-90,±25 acres,y", "c,-90,40,1,y", "b,41.5,-100,25 ac,z", "d,nan,-90,,"]
    (tmp_path / "s.csv").write_text("\n".join(lines), encoding="utf-8")
    good, bad = sites.load_sites(spark, str(tmp_path / "s.csv"))
    assert [(r.site_id, r.lat, r.acres_stated, r.extra["owner"]) for r in good.orderBy("row_no").collect()] == [("a", 40.0, 1200.0, "x"), ("b", 41.5, 25.0, "z")]
    assert [r.reject_reason for r in bad.orderBy("row_no").collect()] == ["duplicate id", "blank id", "missing coordinate", "coordinate not a number", "outside the area", "coordinate not a number"]


def test_map_archives(spark, tmp_path):
    square = [[(0.0, 0.0), (1.0, 0.0), (1.0, 1.0)], [(0.2, 0.2), (0.3, 0.2), (0.3, 0.3)]]
    doc = documents.kml({"lines": [("l", "LineString", [[(0.0, 0.0), (2.0, 1.0)]])], "areas": [("a & b", "Polygon", square)]})
    with zipfile.ZipFile(tmp_path / "x.kmz", "w") as z:
        z.writestr("doc.kml", doc.replace("<LineString>", "<ExtendedData><Data name='apn'><value>7</value></Data></ExtendedData><LineString>"))
    rows = documents.read_placemarks(spark, str(tmp_path / "x.kmz")).orderBy("ordinal").collect()
    assert [(r.folder, r.name, r.kind) for r in rows] == [("/lines", "l", "LineString"), ("/areas", "a & b", "Polygon")]
    assert rows[0].data == {"apn": "7"} and [[(v.lng, v.lat) for v in ring] for ring in rows[1].parts[0]] == square
    (tmp_path / "g").mkdir()
    features = [{"type": "Feature", "properties": {"n": 1, "s": "x", "none": None}, "geometry": {"type": "MultiPolygon", "coordinates": [[[[0, 0], [1, 0], [1, 1]]]]}}, {"geometry": None, "properties": None}]
    (tmp_path / "g" / "a.geojson").write_text(json.dumps({"features": features}))
    rows = documents.read_geojson(spark, str(tmp_path / "g")).orderBy("ordinal").collect()
    assert [(r.kind, len(r.parts), r.data) for r in rows] == [("Polygon", 1, {"n": "1", "s": "x"}), (None, 0, {})]
    df = spark.createDataFrame([("s1", "f", "n", "Polygon", [[(0.0, 0.0), (1.0, 0.0), (1.0, 1.0)]])], "site string, folder string, name string, kind string, rings array<array<struct<lng:double,lat:double>>>")
    (back,) = documents.placemarks(bytes(documents.kmz_per_group(df, "site").first().kmz))
    assert (back["folder"], back["name"], back["kind"]) == ("/f", "n", "Polygon")


def test_sheets(spark):
    rows = [(1, "A banner", None, None), (2, None, "x", "1"), (3, None, " ", "2"), (4, "B", None, None), (5, None, "skip", "3"), (6, None, "y", None)]
    df = spark.createDataFrame([("sheet", *r) for r in rows], "sheet string, n int, banner string, a string, b string")
    got = documents.sheet_cells(df, ["sheet"], "n", F.col("banner"), F.col("a") == "skip", ["a", "b"]).orderBy("n", "column").collect()
    assert [(r.n, r.section, r["column"], r.text) for r in got] == [(2, "A banner", "a", "x"), (2, "A banner", "b", "1"), (3, "A banner", "b", "2"), (6, "B", "a", "y")]
    blocks = documents.detail_blocks(df, ["sheet"], "n", F.col("banner"), F.col("banner") == "A banner").orderBy("n").collect()
    assert [(r.n, r.block) for r in blocks] == [(2, "A banner"), (3, "A banner")]
    tagged = spark.createDataFrame([("20 MW [Written offer]",), ("no tag",)], "t string")
    parts = tagged.select(*text.split_tag(F.col("t")), text.tag_level(text.split_tag(F.col("t"))[1], [("written", "written"), (".", "other")])).collect()
    assert [tuple(r) for r in parts] == [("20 MW", "written offer", "written"), ("no tag", None, None)]


def test_responses(spark):
    requests = spark.createDataFrame([("p", str(i), f"https://Host/{'bad' if i == 2 else 'ok'}/{i}") for i in range(4)], "producer string, key string, url string")

    def get(url, page):
        if url.endswith("/3"):
            raise ConnectionError("down")
        if "/bad/" in url:
            raise ValueError("not known")
        return f"{url}#{page}", page < 1

    log = responses.fetch(requests, get, sleep=lambda s: None).cache()
    assert {(r.key, r.ok, r.body) for r in log.collect()} == {("0", True, "https://Host/ok/0#0\nhttps://Host/ok/0#1"), ("1", True, "https://Host/ok/1#0\nhttps://Host/ok/1#1"), ("2", False, None), ("3", False, None)}
    moved = requests.withColumn("url", F.when(F.col("key") == "1", "https://other/ok/1").otherwise(F.concat(F.lower("url"), F.lit("/?x=1"))))
    assert {r.key for r in responses.valid(log, moved).collect()} == {"0"} and {r.key for r in responses.missing(log, moved).collect()} == {"1", "2", "3"}
    endless = responses.fetch(requests.limit(1), lambda url, page: ("x", True)).first()
    assert endless.complete is False
    files = spark.createDataFrame([(b"II*\0" + bytes(80),), (b"  {\"error\": 1}" + b" " * 80,), (b"II*",)], "content binary")
    assert [r.usable for r in responses.sniffed(files).collect()] == [True, False, False]


def test_publish_and_manifest(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None)], "k int, v string")
    at = str(tmp_path / "t")
    assert sinks.publish(df, at, "one", spark) and not sinks.publish(df.orderBy(F.desc("k")), at, "two", spark)
    assert sinks.publish(df.union(df), at, "two", spark) and spark.read.parquet(at).count() == 4 and spark.read.parquet(f"{at}.two").count() == 2
    long = status.to_long(df, "k", {"f": status.record(F.col("v"), status.found(F.col("v"), F.col("v").isNotNull()), source="s")})
    assert [(r.value, r.status) for r in long.orderBy("k").collect()] == [("a", "ok"), (None, "absent")]
    assert status.contract(long, "k", ["f"]).count() == 0 and status.contract(long, "k", ["g"]).count() == 2
    row = sinks.manifest(long, df, df.limit(0), "now").first()
    assert (row.sites_accepted, row.sites_rejected, row.producers[0].status_counts) == (2, 0, {"absent": 1, "ok": 1})
    assert (row.producers[0].fields, row.inputs, row.cache_hits) == (["f"], None, None)
    (tmp_path / "in.csv").write_bytes(b"site_id\n1\n")
    kept = spark.createDataFrame([("p", "a", "http://h/u", datetime(2024, 1, 1), True, "{}", None, True), ("p", "b", "http://h/u", datetime(2024, 1, 1), False, None, "down", False)], responses.SCHEMA)
    asked = spark.createDataFrame([("p", k, "http://h/u?q") for k in "abc"], "producer string, key string, url string")
    row = sinks.manifest(long, df, df, "now", 1.5, sinks.file_digests(spark, str(tmp_path / "in.csv")), kept, asked).first()
    assert (row.elapsed_s, row.cache_hits, row.cache_misses) == (1.5, 1, 2)
    assert [(r.bytes, r.sha256) for r in row.inputs] == [(10, hashlib.sha256(b"site_id\n1\n").hexdigest())]
    assert sinks.manifest(long.limit(0), df.limit(0), df.limit(0), "now").first().producers == []
    sinks.write_batch(df, long, str(tmp_path / "b"), "x")
    sinks.write_batch(df, long, str(tmp_path / "b"), "y")
    assert spark.read.parquet(str(tmp_path / "b/sites")).count() == 4


def test_failed_layers_fail_and_never_count_zero(spark):
    own = spark.createDataFrame([(1, False), (2, True), (3, False)], "site int, down boolean")
    pairs = spark.createDataFrame([(1, 5, 1500)], "site int, f int, d_mm long")
    spec = producers.Spec("p", 5000, (producers.Near({"m": "distance"}),), (producers.Ring("n", 1000),))
    got = {(r.site, r.field): (r.value, r.status) for r in producers.records(own, "site", pairs, "f", spec, F.col("down")).collect()}
    assert got == {(1, "m"): ("2", "ok"), (1, "n"): ("1", "ok"), (2, "m"): (None, "failed"), (2, "n"): (None, "failed"), (3, "m"): (None, "absent"), (3, "n"): ("0", "ok")}
    hits = spark.createDataFrame([(1, 2, "b"), (1, 1, "a")], "site int, o int, name string")
    found = {r.site: (r.value, r.status) for r in producers.lookup(own, "site", hits, "o", {"zone": "name"}, "z", F.col("down")).collect()}
    assert found == {1: ("a", "ok"), 2: (None, "failed"), 3: (None, "absent")}


def test_ties_and_order(spark):
    df = spark.createDataFrame([("k", "b", 1), ("k", "a", 2), ("k", "a", 3), ("k", "b", 4)], "k string, v string, n int")
    assert relational.mode_first_seen(df, ["k"], "v", "n", "m").first().m == "b"
    assert relational.joined_some(df, "k", "n", 2, "t").first().t == "1; 2 +2 more"
    few = spark.createDataFrame([(1, float(v)) for v in (1, 2, 3, 4, 5, 6, 7, 10)], "g int, v double")
    assert tuple(relational.quantiles_exclusive(few, ["g"], "v", 4, ["a", "b", "c"]).first())[1:] == (2.25, 4.5, 6.75)
    two = spark.createDataFrame([("(x)", 1)], "k string, n int").union(spark.createDataFrame([(None, 2)], "k string, n int"))
    assert {r.k: r.s for r in relational.with_total(two, "k", [F.sum("n").alias("s")]).collect()} == {"(x)": 1, "(none)": 2, "Total": 3}


def test_fetch_log_stream(spark, tmp_path):
    at = datetime(2024, 1, 1)
    schema = "producer string, key string, url string, fetched_at timestamp, ok boolean, body string"
    for i, rows in enumerate([[("p", "a", "u", at, True, "1"), ("p", "b", "u", at, False, None)], [("p", "a", "u", at + timedelta(hours=1), False, None), ("p", "b", "u", at + timedelta(hours=1), True, "2")]]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "log"))
        log = spark.readStream.schema(schema).parquet(str(tmp_path / "log"))
        fetchlog.keep_latest(log, str(tmp_path / "latest"), str(tmp_path / "c")).awaitTermination()
        kept = {r.key: r.body for r in spark.read.parquet(str(tmp_path / f"latest/v{i}")).collect()}
        assert kept == ({"a": "1"} if i == 0 else {"a": "1", "b": "2"})
    query = fetchlog.tallies(spark.readStream.schema(schema).parquet(str(tmp_path / "log"))).writeStream.format("memory").queryName("tallies").outputMode("complete").trigger(availableNow=True).start()
    query.awaitTermination()
    assert sum(r.n for r in spark.table("tallies").collect()) == 4
