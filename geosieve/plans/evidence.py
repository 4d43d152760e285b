"""Evidence read out of documents, held against them and the vocabulary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geosieve.operators import evidence as ev
from geosieve.plans.registry import Tables, query
from geosieve.plans.texts import NORM

_FIELDS = ev.fields()
_TEXT = lambda s: "NULL" if s is None else f"'{s}'"
_WORDS = "words(i, dimension, field, type, want, allowed) AS (VALUES " + ", ".join(f"({i}, '{d}', '{f}', '{t}', {_TEXT(u)}, {a or 'CAST([] AS VARCHAR[])'})" for i, (d, f, t, u, a) in enumerate(_FIELDS)) + ")"
_DIMENSIONS = list(ev.VOCABULARY)
_EVIDENCE = f"""{_WORDS}, known AS (SELECT s_suppkey AS site_id FROM supplier WHERE s_suppkey % 13 <> 0),
    cells AS (SELECT doc_id % 97 AS site_id, 'B' || doc_id AS source_cell, text, {_DIMENSIONS}[1 + doc_id % 13] || ';' || {_DIMENSIONS}[1 + doc_id * 5 % 13] AS dimensions, source AS section, lang AS "column" FROM documents),
    rows AS (SELECT o_orderkey AS k, o_custkey % 400 AS doc, CASE WHEN o_orderkey % 17 = 0 THEN o_custkey % 400 % 97 + 1 ELSE o_custkey % 400 % 97 END AS site_id, w.*, CASE WHEN o_orderkey % 11 = 0 THEN 'maybe' WHEN type = 'list' THEN allowed[1] WHEN type = 'number' THEN '1,200' WHEN o_orderkey % 7 = 0 THEN '' ELSE 'x' END AS value,
        CASE WHEN o_orderkey % 9 = 0 THEN 'kW' ELSE want END AS unit, CASE WHEN o_orderkey % 19 = 0 THEN 'guess' WHEN type = 'number' AND o_orderkey % 5 <> 0 THEN 'actual' ELSE 'text' END AS kind FROM orders JOIN words w ON w.i = o_orderkey * 7 % {len(_FIELDS)}),
    e AS (SELECT r.* REPLACE (CASE WHEN k % 23 = 0 THEN 'weather' ELSE r.dimension END AS dimension, CASE WHEN k % 29 = 0 THEN 'none_stated' WHEN k % 31 = 0 THEN 'depth' ELSE r.field END AS field), 'B' || r.doc AS source_cell,
        CASE WHEN k % 8 = 0 THEN '' WHEN k % 3 = 0 THEN 'no such words ' || k ELSE translate(substr(d.text, 1, 30), 'aeinrst', 'AEINRST') END AS quote FROM rows r LEFT JOIN documents d ON d.doc_id = r.doc)"""
_CHECKED = f"""{_EVIDENCE}, j AS (SELECT e.k, e.site_id, e.dimension, e.field, e.value, e.unit, e.kind, e.quote, n.site_id IS NOT NULL AS known, c.site_id IS NOT NULL AS cited, c.text, c.dimensions, w.type AS t, w.want AS u, w.allowed AS a
    FROM e LEFT JOIN known n ON n.site_id = e.site_id LEFT JOIN cells c ON c.site_id = e.site_id AND c.source_cell = e.source_cell LEFT JOIN words w ON w.dimension = e.dimension AND w.field = e.field),
    s AS (SELECT * FROM j WHERE known AND list_contains({_DIMENSIONS}, dimension) AND field <> 'none_stated')"""


def _evidence(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Evidence of orders read out of documents, some of it wrong, the documents as cells, and the known sites."""
    text = lambda xs, i: F.get(F.array(*map(F.lit, xs)), i.cast("int"))
    d, k = F.col("doc_id"), F.col("k")
    none = [F.lit(None).cast("string").alias(c) for c in ("tag_raw", "tag_norm", "dup_n", "dup_sites")]
    cells = t.documents.select((d % 97).alias("site_id"), F.concat(F.lit("B"), d).alias("source_cell"), d.alias("ordinal"), "text", F.concat_ws(";", text(_DIMENSIONS, d % 13), text(_DIMENSIONS, d * 5 % 13)).alias("dimensions"), F.col("source").alias("section"), F.col("lang").alias("column"), *none)
    words = t.spark.createDataFrame([(i, *f) for i, f in enumerate(_FIELDS)], "i long, dimension string, field string, type string, want string, allowed array<string>")
    rows = t.orders.select(F.col("o_orderkey").alias("k"), (F.col("o_custkey") % 400).alias("doc")).withColumn("i", k * 7 % len(_FIELDS)).join(F.broadcast(words), "i")
    value = F.when(k % 11 == 0, "maybe").when(F.col("type") == "list", F.get("allowed", F.lit(0))).when(F.col("type") == "number", "1,200").when(k % 7 == 0, "").otherwise("x")
    kind = F.when(k % 19 == 0, "guess").when((F.col("type") == "number") & (k % 5 != 0), "actual").otherwise("text")
    rows = rows.join(t.documents.select(d.alias("doc"), F.translate(F.substring("text", 1, 30), "aeinrst", "AEINRST").alias("head")), "doc", "left")
    rows = rows.select(
        "k", (F.col("doc") % 97 + (k % 17 == 0).cast("int")).alias("site_id"), F.concat(F.lit("B"), "doc").alias("source_cell"), F.when(k % 23 == 0, "weather").otherwise(F.col("dimension")).alias("dimension"),
        F.when(k % 29 == 0, ev.NONE_STATED).when(k % 31 == 0, "depth").otherwise(F.col("field")).alias("field"), value.alias("value"), F.when(k % 9 == 0, "kW").otherwise(F.col("want")).alias("unit"), kind.alias("kind"),
        F.when(k % 8 == 0, "").when(k % 3 == 0, F.concat(F.lit("no such words "), k)).otherwise(F.col("head")).alias("quote"),
    )
    return rows, cells, t.supplier.where("s_suppkey % 13 <> 0").select(F.col("s_suppkey").alias("site_id"))


@query(f"""WITH {_CHECKED}
    SELECT k, site_id, 'unknown site' AS violation FROM j WHERE NOT known UNION ALL SELECT k, site_id, 'unknown dimension' FROM j WHERE known AND NOT list_contains({_DIMENSIONS}, dimension)
    UNION ALL SELECT k, site_id, 'unknown field' FROM s WHERE t IS NULL UNION ALL SELECT k, site_id, 'unknown kind' FROM s WHERE t IS NOT NULL AND kind NOT IN ('actual', 'target', 'range_low', 'range_high', 'text')
    UNION ALL SELECT k, site_id, 'value not allowed' FROM s WHERE t = 'list' AND NOT list_contains(a, value) UNION ALL SELECT k, site_id, 'no value' FROM s WHERE t = 'text' AND value = ''
    UNION ALL SELECT k, site_id, 'not a number' FROM s WHERE t = 'number' AND TRY_CAST(replace(value, ',', '') AS DOUBLE) IS NULL UNION ALL SELECT k, site_id, 'wrong unit' FROM s WHERE t = 'number' AND unit IS DISTINCT FROM u
    UNION ALL SELECT k, site_id, 'number of kind text' FROM s WHERE t = 'number' AND kind = 'text' UNION ALL SELECT k, site_id, 'warning: column of another dimension' FROM s WHERE cited AND NOT list_contains(string_split(dimensions, ';'), dimension)
    UNION ALL SELECT k, site_id, 'unknown cell' FROM s WHERE NOT cited UNION ALL SELECT k, site_id, 'empty quote' FROM s WHERE cited AND coalesce(quote, '') = ''
    UNION ALL SELECT k, site_id, 'quote not in the cell' FROM s WHERE cited AND quote <> '' AND NOT contains({NORM.format("coalesce(text, '')")}, {NORM.format("quote")})""")
def evidence_checks(t: Tables) -> DataFrame:
    """Every rule that evidence breaks: words, values, units, kinds, cells, and quotes held against whole texts."""
    rows, cells, known = _evidence(t)
    return ev.evidence_violations(rows, cells, known, "k")


@query(f"""WITH {_EVIDENCE}, c AS (SELECT c_custkey AS k, c_custkey % 97 AS site_id, 'B' || c_custkey AS source_cell FROM customer WHERE c_custkey % 3 = 0),
    have AS (SELECT DISTINCT site_id, unnest(string_split(dimensions, ';')) AS dimension FROM cells WHERE text <> ''),
    read AS (SELECT e.site_id, dimension FROM e WHERE field = 'none_stated' OR EXISTS (FROM cells x WHERE x.site_id = e.site_id AND x.source_cell = e.source_cell))
    SELECT site_id, dimension FROM have WHERE site_id IN (SELECT site_id FROM known) AND NOT EXISTS (FROM read WHERE read.site_id = have.site_id AND read.dimension = have.dimension)""")
def evidence_uncovered(t: Tables) -> DataFrame:
    """Sites and dimensions that have text and no row read out of it."""
    rows, cells, known = _evidence(t)
    clues = t.customer.where("c_custkey % 3 = 0").select((F.col("c_custkey") % 97).alias("site_id"), F.lit("city").alias("clue_type"), F.concat(F.lit("B"), "c_custkey").alias("source_cell"))
    return ev.uncovered(rows, clues, cells, known)
