"""The site table: headers by alias, rows classified by the first rule they fail, nothing dropped silently."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

REQUIRED = ("site_id", "lat", "lng")
OPTIONAL = ("name", "address", "apn", "acres_stated", "state", "county", "group", "notes")
#: Other headers for known columns, taken only where the known one is missing.
ALIASES = {"id": "site_id", "latitude": "lat", "longitude": "lng", "lon": "lng", "long": "lng", "acres": "acres_stated", "acreage": "acres_stated", "parcel": "apn", "pin": "apn"}
#: The area sites must lie in.
LATITUDES, LONGITUDES = (17.0, 72.0), (-180.0, -64.0)


def header(name: str) -> str:
    """A header in lower case with single underscores, without a byte order mark."""
    return re.sub(r"[^a-z0-9]+", "_", name.lstrip("﻿").strip().lower()).strip("_")


def parse_acres(text: Column) -> Column:
    """The number of a whole text such as 25, 1,200 or ±25 acres; null for ranges and words."""
    number = F.regexp_extract(text, r"^\s*[±~]?\s*([0-9][0-9,]*(?:\.[0-9]+)?|\.[0-9]+)\s*(?:ac|acre|acres)?\.?\s*$", 1)
    return F.nullif(F.regexp_replace(number, ",", ""), F.lit("")).try_cast("double")


def classify(raw: DataFrame) -> DataFrame:
    """raw(row_no, site_id, lat, lng, acres or acres_stated, ...) with reject_reason, null where accepted.

    Rules in order: blank id, duplicate id, missing coordinate, not a number,
    out of range, outside the area. An id is taken only by an accepted row, so
    a rejected first row doesn't block a later good one, and a later row of a
    taken id is a duplicate whatever its coordinates.
    """
    blank = lambda c: F.trim(F.coalesce(c, F.lit(""))) == ""
    number = lambda c: F.trim(c).try_cast("double")
    lat, lng = number(F.col("lat").cast("string")), number(F.col("lng").cast("string"))
    bad = (
        F.when(blank(F.col("lat")) | blank(F.col("lng")), "missing coordinate")
        .when(lat.isNull() | lng.isNull() | F.isnan(lat) | F.isnan(lng), "coordinate not a number")
        .when((F.abs(lat) > 90) | (F.abs(lng) > 180), "coordinate out of range")
        .when(~lat.between(*LATITUDES) | ~lng.between(*LONGITUDES), "outside the area")
    )
    acres = "acres_stated" if "acres_stated" in raw.columns else "acres"
    rows = raw.withColumns({"site_id": F.trim("site_id"), "_bad": bad, "_lat": lat, "_lng": lng})
    taken = rows.where(F.col("_bad").isNull() & (F.col("site_id") != "")).groupBy("site_id").agg(F.min("row_no").alias("_first"))
    rows = rows.join(taken, "site_id", "left")
    reason = F.when(blank(F.col("site_id")), "blank id").when(F.col("_first") < F.col("row_no"), "duplicate id").otherwise(F.col("_bad"))
    out = rows.withColumns({"reject_reason": reason, "lat": F.col("_lat"), "lng": F.col("_lng")})
    if acres in raw.columns:
        out = out.withColumn("acres_text", F.col(acres)).withColumn("acres_stated", parse_acres(F.col("acres_text")))
    return out.drop("_bad", "_first", "_lat", "_lng")


def load_sites(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) rows of a CSV file; unknown columns go to the map ``extra``.

    The row number is the line's place in the file, so the file is read in one
    part; site lists are small next to feature layers.
    """
    raw = spark.read.csv(path, header=True, multiLine=True, encoding="UTF-8")
    names = [header(c) for c in raw.columns]
    final = [ALIASES[n] if n in ALIASES and ALIASES[n] not in names else n for n in names]
    raw = raw.toDF(*final)
    if missing := [c for c in REQUIRED if c not in final]:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    extra = [c for c in final if c not in (*REQUIRED, *OPTIONAL)]
    entries = F.map_from_arrays(F.array(*map(F.lit, extra)), F.array(*[F.col(c) for c in extra])) if extra else F.create_map().cast("map<string,string>")
    known = raw.coalesce(1).withColumn("row_no", F.monotonically_increasing_id() + 1)
    known = known.withColumn("extra", entries).select("row_no", *[c for c in (*REQUIRED, *OPTIONAL) if c in final], "extra")
    rows = classify(known)
    return rows.where("reject_reason is null").drop("reject_reason"), rows.where("reject_reason is not null").select("row_no", "site_id", "reject_reason")
