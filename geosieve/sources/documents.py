"""Map archives, GeoJSON and table sheets as DataFrames, and a map archive as a sink.

Files are read whole by Spark's binary reader, one file a row, and parsed in
Arrow batches; a folder of many files is many tasks.
"""

from __future__ import annotations

import io
import json
import zipfile
from collections.abc import Callable
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

VERTEX = T.StructType([T.StructField("lng", T.DoubleType()), T.StructField("lat", T.DoubleType())])
RING = T.ArrayType(VERTEX)
PLACEMARK = T.StructType(
    [
        T.StructField("ordinal", T.LongType()),
        T.StructField("folder", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("kind", T.StringType()),
        T.StructField("parts", T.ArrayType(T.ArrayType(RING))),
        T.StructField("data", T.MapType(T.StringType(), T.StringType())),
    ]
)
_VERTEX = pa.struct([("lng", pa.float64()), ("lat", pa.float64())])
_PLACEMARK = pa.struct(
    [
        ("ordinal", pa.int64()),
        ("folder", pa.string()),
        ("name", pa.string()),
        ("kind", pa.string()),
        ("parts", pa.list_(pa.list_(pa.list_(_VERTEX)))),
        ("data", pa.map_(pa.string(), pa.string())),
    ]
)


def _tag(e) -> str:
    return e.tag.rpartition("}")[2]


def _vertices(text: str | None) -> list[dict]:
    points = [p.split(",") for p in (text or "").split()]
    return [{"lng": float(p[0]), "lat": float(p[1])} for p in points if len(p) >= 2]


def _parts(mark) -> tuple[str | None, list]:
    """The kind of a placemark's geometry and its parts, each a list of rings; points and lines have one ring."""
    kind, parts = None, []
    for e in mark.iter():
        if _tag(e) in ("Point", "LineString"):
            kind = kind or _tag(e)
            parts += [[_vertices(c.text)] for c in e if _tag(c) == "coordinates"]
        elif _tag(e) == "Polygon":
            kind = kind or "Polygon"
            parts.append([_vertices(c.text) for side in ("outerBoundaryIs", "innerBoundaryIs") for b in e if _tag(b) == side for c in b.iter() if _tag(c) == "coordinates"])
    return kind, parts


def _data(mark) -> list[tuple[str, str]]:
    out = {}
    for e in mark.iter():
        if _tag(e) == "Data":
            out[e.get("name", "")] = next(((v.text or "") for v in e if _tag(v) == "value"), "")
        elif _tag(e) == "SimpleData":
            out[e.get("name", "")] = e.text or ""
    return list(out.items())


def placemarks(content: bytes) -> list[dict]:
    """The placemarks of a KML document or of the first one in a KMZ archive, in document order."""
    if content[:2] == b"PK":
        with zipfile.ZipFile(io.BytesIO(content)) as z:
            content = z.read(next(n for n in z.namelist() if n.lower().endswith(".kml")))
    found: list[dict] = []

    def walk(e, folders: tuple[str, ...]) -> None:
        if _tag(e) == "Placemark":
            kind, parts = _parts(e)
            name = next((c.text for c in e if _tag(c) == "name"), None)
            found.append({"ordinal": len(found), "folder": "/".join(folders), "name": name, "kind": kind, "parts": parts, "data": _data(e)})
            return
        if _tag(e) in ("Folder", "Document"):
            folders = (*folders, next((c.text or "" for c in e if _tag(c) == "name"), ""))
        for c in e:
            walk(c, folders)

    walk(ElementTree.fromstring(content), ())
    return found


def geojson_features(content: bytes) -> list[dict]:
    """The features of a GeoJSON collection in the shape of placemarks."""
    found = []
    ring = lambda r: [{"lng": float(p[0]), "lat": float(p[1])} for p in r]
    for i, f in enumerate(json.loads(content).get("features") or []):
        g = f.get("geometry") or {}
        c, kind = g.get("coordinates"), g.get("type")
        parts = {
            "Point": lambda: [[ring([c])]],
            "MultiPoint": lambda: [[ring([p])] for p in c],
            "LineString": lambda: [[ring(c)]],
            "MultiLineString": lambda: [[ring(x)] for x in c],
            "Polygon": lambda: [[ring(x) for x in c]],
            "MultiPolygon": lambda: [[ring(x) for x in p] for p in c],
        }.get(kind, list)()
        data = [(k, v if isinstance(v, str) else json.dumps(v)) for k, v in (f.get("properties") or {}).items() if v is not None]
        found.append({"ordinal": i, "folder": "", "name": None, "kind": (kind or "").removeprefix("Multi") or None, "parts": parts, "data": data})
    return found


def _read(spark: SparkSession, path: str, parse: Callable[[bytes], list[dict]]) -> DataFrame:
    @F.arrow_udf(T.ArrayType(PLACEMARK))
    def parsed(contents: pa.Array) -> pa.Array:
        return pa.array([parse(c) for c in contents.to_pylist()], pa.list_(_PLACEMARK))

    files = spark.read.format("binaryFile").load(path)
    return files.select(F.col("path").alias("file"), F.explode(parsed("content")).alias("p")).select("file", "p.*")


def read_placemarks(spark: SparkSession, path: str) -> DataFrame:
    """file, ordinal, folder, name, kind, parts and data of every placemark of KML and KMZ files."""
    return _read(spark, path, placemarks)


def read_geojson(spark: SparkSession, path: str) -> DataFrame:
    """The features of GeoJSON files in the shape of placemarks."""
    return _read(spark, path, geojson_features)


def kml(folders: dict[str, list[tuple[str, str, list[list[tuple[float, float]]]]]]) -> str:
    """A KML document of folders of (name, kind, rings of (lng, lat))."""
    root = ElementTree.Element("kml", xmlns="http://www.opengis.net/kml/2.2")
    document = ElementTree.SubElement(root, "Document")
    for folder, marks in folders.items():
        f = ElementTree.SubElement(document, "Folder")
        ElementTree.SubElement(f, "name").text = folder
        for name, kind, rings in marks:
            mark = ElementTree.SubElement(f, "Placemark")
            ElementTree.SubElement(mark, "name").text = name
            shape = ElementTree.SubElement(mark, kind)
            for i, ring in enumerate(rings):
                at = shape
                if kind == "Polygon":
                    at = ElementTree.SubElement(ElementTree.SubElement(shape, "innerBoundaryIs" if i else "outerBoundaryIs"), "LinearRing")
                ElementTree.SubElement(at, "coordinates").text = " ".join(f"{x},{y},0" for x, y in ring)
    return ElementTree.tostring(root, encoding="unicode")


def kmz_per_group(df: DataFrame, key: str) -> DataFrame:
    """One map archive a key: (key, kmz) from rows key, folder, name, kind and rings.

    An archive is a single file and so is made whole; a key is a site or a
    market, whose features fit one document.
    """

    def one(table: pa.Table) -> pa.Table:
        folders: dict[str, list] = {}
        for r in sorted(table.to_pylist(), key=lambda r: (r["folder"], r["name"] or "")):
            folders.setdefault(r["folder"], []).append((r["name"] or "", r["kind"], [[(v["lng"], v["lat"]) for v in ring] for ring in r["rings"]]))
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
            z.writestr(zipfile.ZipInfo("doc.kml"), kml(folders))
        return pa.table({key: table.column(key).slice(0, 1), "kmz": pa.array([out.getvalue()], pa.binary())})

    return df.groupBy(key).applyInArrow(one, f"{key} {dict(df.dtypes)[key]}, kmz binary")


def sheet_cells(rows: DataFrame, keys: list[str], ordinal: str, banner: Column, skip: Column, columns: list[str]) -> DataFrame:
    """Long cells of a table sheet: each row's non-blank columns under the last banner above it.

    Banner rows name a section and give no cells; rows to skip give none either.
    """
    w = W.partitionBy(*keys).orderBy(ordinal).rowsBetween(W.unboundedPreceding, W.currentRow)
    named = rows.withColumn("section", F.last(banner, ignorenulls=True).over(w)).where(banner.isNull() & ~F.coalesce(skip, F.lit(False)))
    cells = named.unpivot([*keys, ordinal, "section"], columns, "column", "text")
    return cells.where(F.trim(F.coalesce("text", F.lit(""))) != "")


def detail_blocks(rows: DataFrame, keys: list[str], ordinal: str, title: Column, known: Column) -> DataFrame:
    """Key and value rows with the title of their block; a title that isn't known ends the block before it."""
    w = W.partitionBy(*keys).orderBy(ordinal).rowsBetween(W.unboundedPreceding, W.currentRow)
    start = F.when(title.isNotNull(), F.struct(F.when(known, title).alias("title")))
    out = rows.withColumn("_block", F.last(start, ignorenulls=True).over(w)).where(title.isNull())
    return out.withColumn("block", F.col("_block.title")).drop("_block").where("block is not null")
