"""What was read out of cells, held against the cells and a vocabulary.

Evidence rows (dimension, field, value, unit, kind, quote, source cell) and location clues (type,
value, quote, source cell) are checked whole: known sites and words, values of the right type and
unit, quotes that stand verbatim in the cell they cite, and a row for every site and dimension
that has any text. Every violation is a row; so one bad row can have several, and none hides others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geosieve.functions import text as x

#: Dimensions and their fields, each with a unit, "text", or the values allowed.
VOCABULARY: dict[str, dict[str, str | tuple[str, ...]]] = {
    "power_capacity": {"mw": "MW", "mw_initial": "MW", "mw_full": "MW", "mw_expansion": "MW", "kva": "kVA", "detail": "text"},
    "power_timing": {"available": "text", "initial_available": "text", "full_available": "text", "detail": "text"},
    "power_connection": {
        "utility": "text", "service_level": ("distribution", "transmission", "unknown"), "substation": "text", "substation_status": ("existing", "new_or_planned", "unknown"), "voltage_kv": "kV", "circuits": "count",
        "study_stage": "text", "new_generation_required": ("yes", "no", "pending"), "detail": "text",
    },
    "grid_constraints": {"constraint": "text"},
    "power_cost": {"cents_per_kwh": "c/kWh", "basis": "text"},
    "fiber": {
        "status": ("quoted", "not_quoted", "feasibility_only"), "carrier": "text", "quote_level": "text", "quote_date": "text", "route1_ft": "ft", "route2_ft": "ft", "nrc_usd": "USD", "mrc_usd": "USD/month",
        "delivery_months": "months", "detail": "text",
    },
    "flood_wetlands": {"claim": "text"},
    "acreage": {"acres": "ac", "parent_acres": "ac", "detail": "text"},
    "zoning_neighbours": {"jurisdiction": "text", "zoning": "text", "use_permitted": ("yes", "no", "pending", "unknown"), "noise_rule": "text", "context": "text"},
    "site_control": {"stage": ("under_contract", "loi_or_negotiating", "owner_identified", "tract_identified", "no_site_yet", "no_site_control"), "owner_type": "text", "detail": "text"},
    "schedule": {"realism": "text", "next_step": "text"},
    "market": {"market": "text"},
    "other": {"detail": "text"},
}
#: Kinds of a value, types of a clue, the field of a dimension that was read and holds nothing.
KINDS = ("actual", "target", "range_low", "range_high", "text")
CLUES = (
    "coordinate", "coordinate_approx", "apn", "street_address", "intersection", "substation_name", "substation_planned", "landmark", "owner_name", "corridor", "area_name", "city", "zip", "county", "state", "utility", "acreage",
)
NONE_STATED = "none_stated"
#: What a cell tells about the rows read out of it.
DERIVED = ("section", "column", "tag_raw", "tag_norm", "dup_n", "dup_sites")
NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
_COORDINATE = r"^\s*([+-]?(?:\d+\.?\d*|\.\d+))\s*,\s*([+-]?(?:\d+\.?\d*|\.\d+))\s*$"


def fields(vocabulary: dict = VOCABULARY) -> list[tuple[str, str, str, str | None, list[str] | None]]:
    """(dimension, field, number, text or list, unit, allowed values) of a vocabulary, in its order."""
    out = []
    for d, named in vocabulary.items():
        for f, spec in named.items():
            out.append((d, f, "list", None, list(spec)) if not isinstance(spec, str) else (d, f, "text", None, None) if spec == "text" else (d, f, "number", spec, None))
    return out


def _with_cells(rows: DataFrame, cells: DataFrame, sites: DataFrame, site: str, cell: str) -> DataFrame:
    """rows with _known, whether their site is, and _cell, the cell they cite; of cells that share a name the last. Texts are normalised once a cell."""
    last = cells.groupBy(site, cell).agg(F.max_by(F.struct(x.normalised(F.coalesce("text", F.lit(""))).alias("norm"), F.split("dimensions", ";").alias("dimensions"), *DERIVED), "ordinal").alias("_cell"))
    known = sites.select(site).distinct().withColumn("_known", F.lit(True))
    return rows.join(known, site, "left").join(last, [site, cell], "left").withColumn("_known", F.coalesce("_known", F.lit(False)))


def _quoted() -> dict[str, Column]:
    """The rules of the cell and the quote."""
    cell, quote = F.col("_cell"), F.coalesce("quote", F.lit(""))
    return {"unknown cell": cell.isNull(), "empty quote": cell.isNotNull() & (quote == ""), "quote not in the cell": cell.isNotNull() & (quote != "") & ~F.contains(cell["norm"], x.normalised(quote))}


def _broken(rows: DataFrame, keys: list[str], rules: dict[str, Column]) -> DataFrame:
    named = F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in rules.items()]))
    return rows.select(*keys, F.explode(named).alias("violation"))


def evidence_violations(evidence: DataFrame, cells: DataFrame, sites: DataFrame, key: str, site: str = "site_id", cell: str = "source_cell", vocabulary: dict = VOCABULARY) -> DataFrame:
    """(key, site, violation) of evidence rows (site, dimension, field, value, unit, kind, quote, cell).

    cells: site, cell, ordinal, text, dimensions joined by ";", and the DERIVED columns. An unknown site or dimension hides the
    row's other rules, and a none_stated row has none but those. A null is an empty value. "warning: " marks what is odd but no error.
    """
    words = evidence.sparkSession.createDataFrame(fields(vocabulary), "dimension string, field string, _type string, _unit string, _allowed array<string>")
    rows = _with_cells(evidence, cells, sites, site, cell).join(F.broadcast(words), ["dimension", "field"], "left")  # the vocabulary, a fixed few rows
    dimension = F.coalesce("dimension", F.lit("")).isin(*vocabulary)
    stated = F.col("_known") & dimension & ~F.col("field").eqNullSafe(F.lit(NONE_STATED))
    value, of = F.coalesce("value", F.lit("")), lambda t: F.col("_type") == t
    rules = {
        "unknown field": F.col("_type").isNull(),
        "unknown kind": F.col("_type").isNotNull() & ~F.coalesce("kind", F.lit("")).isin(*KINDS),
        "value not allowed": of("list") & ~F.array_contains("_allowed", value),
        "no value": of("text") & (value == ""),
        "not a number": of("number") & ~F.replace(value, F.lit(","), F.lit("")).rlike(NUMBER),
        "wrong unit": of("number") & ~F.col("unit").eqNullSafe(F.col("_unit")),
        "number of kind text": of("number") & (F.col("kind") == "text"),
        "warning: column of another dimension": F.col("_cell").isNotNull() & ~F.array_contains(F.col("_cell.dimensions"), F.col("dimension")),
    } | _quoted()
    always = {"unknown site": ~F.col("_known"), "unknown dimension": F.col("_known") & ~dimension}
    return _broken(rows, [key, site], always | {n: stated & c for n, c in rules.items()})


def clue_violations(clues: DataFrame, cells: DataFrame, sites: DataFrame, key: str, site: str = "site_id", cell: str = "source_cell") -> DataFrame:
    """(key, site, violation) of location clues (site, clue_type, value, quote, cell); an unknown site or type hides the other rules."""
    rows = _with_cells(clues, cells, sites, site, cell)
    kind, value = F.coalesce("clue_type", F.lit("")), F.coalesce("value", F.lit(""))
    lat, lng = (F.regexp_extract(value, _COORDINATE, i).try_cast("double") for i in (1, 2))
    good = F.coalesce((F.abs(lat) <= 90) & (F.abs(lng) <= 180), F.lit(False))
    stated = F.col("_known") & kind.isin(*CLUES)
    rules = {
        "not lat,lng": kind.startswith("coordinate") & ~good,
        "not five digits": (kind == "zip") & ~value.rlike(r"^\d{5}$"),
        "not a number": (kind == "acreage") & ~value.rlike(NUMBER),
    } | _quoted()
    always = {"unknown site": ~F.col("_known"), "unknown clue type": F.col("_known") & ~kind.isin(*CLUES)}
    return _broken(rows, [key, site], always | {n: stated & c for n, c in rules.items()})


def uncovered(evidence: DataFrame, clues: DataFrame, cells: DataFrame, sites: DataFrame, site: str = "site_id") -> DataFrame:
    """(site, dimension) of known sites whose cells have text for a dimension that no row reads.

    A row counts unless its site or dimension is unknown, the cell it cites isn't the site's, or it is a clue of unknown
    type; a none_stated row counts whatever it cites. Clues count for the dimension location.
    """
    cited = cells.select(site, "source_cell").distinct()
    known = evidence.where(F.col("dimension").isin(*VOCABULARY))
    stated = known.where(~F.col("field").eqNullSafe(F.lit(NONE_STATED))).join(cited, [site, "source_cell"], "left_semi")
    read = stated.select(site, "dimension").union(known.where(F.col("field") == NONE_STATED).select(site, "dimension"))
    located = clues.where(F.col("clue_type").isin(*CLUES)).join(cited, [site, "source_cell"], "left_semi")
    read = read.union(located.select(site, F.lit("location").alias("dimension")))
    have = cells.where(F.coalesce("text", F.lit("")) != "").select(site, F.explode(F.split("dimensions", ";")).alias("dimension")).distinct()
    return have.join(read, [site, "dimension"], "left_anti").join(sites.select(site), site, "left_semi")


def checked(rows: DataFrame, cells: DataFrame, sites: DataFrame, site: str = "site_id", cell: str = "source_cell") -> DataFrame:
    """rows of known sites that cite one of their cells, or state that there is nothing, with what the cell tells about them."""
    out = _with_cells(rows, cells, sites, site, cell)
    empty = F.col("field").eqNullSafe(F.lit(NONE_STATED)) if "field" in rows.columns else F.lit(False)
    out = out.where(F.col("_known") & (F.col("_cell").isNotNull() | empty))
    return out.select(*rows.columns, *[F.col(f"_cell.{c}").alias(c) for c in DERIVED])
