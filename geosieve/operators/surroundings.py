"""Producers that are more than a Spec: flood zones, wetlands, power near a site, utility prices, the parcel.

Each takes sites and the pairs that a range join gave, with d_mm and a source
ordinal, and returns long value records. One pass groups the pairs of a site.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geosieve.functions import status
from geosieve.operators.producers import metres

#: Special flood hazard zones, and the least base flood elevation that is one.
SFHA_ZONES = ("A", "AE", "AH", "AO", "AR", "A99", "V", "VE")
NO_ELEVATION = -9999.0
#: Imagery before this year is stale.
STALE_BEFORE = 2000


def is_sfha(zone: Column, flag: Column) -> Column:
    """Whether a flood zone is a special hazard area, by its flag or its name."""
    return F.coalesce(flag == "T", F.lit(False)) | F.coalesce(zone.isin(*SFHA_ZONES), F.lit(False))


def _failed(sites: DataFrame, failed: Column | None) -> DataFrame:
    return sites.withColumn("_failed", F.coalesce(failed, F.lit(False)) if failed is not None else F.lit(False))


def flood(sites: DataFrame, key: str, zones: DataFrame, panels: DataFrame, coverage: DataFrame, failed: Column | None = None) -> DataFrame:
    """Flood zone at the pin, why there is none, panel, and the nearest hazard zone.

    zones: key, ordinal, d_mm, zone, subtype, flag, bfe, study; panels: key,
    ordinal, panel, effective; coverage: key, excluded, studied. The panel is
    the first whose number begins with the zone's study, else the first. An
    area left out or without a study is never called a minimal zone.
    """
    at = F.min(F.when(F.col("d_mm") == 0, F.struct("ordinal", "zone", "subtype", "flag", "bfe", "study")))
    near = F.min(F.when(is_sfha(F.col("zone"), F.col("flag")), F.struct("d_mm", "ordinal", "zone")))
    found = zones.groupBy(key).agg(at.alias("at"), near.alias("near"))
    wide = _failed(sites, failed).join(found, key, "left").join(coverage, key, "left")
    first = panels.join(found.select(key, F.col("at.study").alias("_study")), key, "left")
    other = ~F.coalesce(F.col("panel").startswith(F.col("_study")), F.lit(False))
    first = first.groupBy(key).agg(F.min(F.struct(other.alias("other"), "ordinal", "panel", "effective")).alias("panel"))
    wide = wide.join(first, key, "left")
    bad, here = F.col("_failed"), F.col("at").isNotNull()
    why = (
        F.when(here, "mapped")
        .when(F.coalesce(F.col("excluded"), F.lit(False)), "area_not_included")
        .when(~F.coalesce(F.col("studied"), F.lit(False)), "no_nfhl_data")
        .otherwise("no_zone_returned")
    )
    vintage = F.col("panel.effective")
    about = {"source": "flood", "vintage": vintage}
    one = lambda value, present: status.record(value, status.found(value, present, bad), note=F.when(~here & ~bad, why), **about)
    fields = {"fema_determination": status.record(why, status.found(why, F.lit(True), bad), **about)}
    values = {"fema_flood_zone": F.col("at.zone"), "fema_zone_subtype": F.col("at.subtype"), "fema_sfha": is_sfha(F.col("at.zone"), F.col("at.flag")), "fema_static_bfe_ft": F.when(F.col("at.bfe") > NO_ELEVATION, F.col("at.bfe")), "fema_dfirm_id": F.col("at.study")}
    fields |= {n: one(v, here) for n, v in values.items()}
    fields |= {n: one(F.col(f"panel.{c}"), F.col("panel").isNotNull()) for n, c in (("fema_firm_panel", "panel"), ("fema_panel_effective", "effective"))}
    fields |= {"fema_nearest_sfha_m": one(metres(F.col("near.d_mm"), 1), F.col("near").isNotNull()), "fema_nearest_sfha_zone": one(F.col("near.zone"), F.col("near").isNotNull())}
    return status.to_long(wide, key, fields)


def wetlands(sites: DataFrame, key: str, polygons: DataFrame, mapping: DataFrame, as_of: int, failed: Column | None = None, reach_m: int = 500) -> DataFrame:
    """Wetlands at the pin, the nearest, how many and how many acres within reach, and how old the mapping is.

    polygons: key, ordinal, d_mm, kind, code, acres; mapping: key, state,
    year, project. Nothing found where nothing was mapped is no evidence.
    """
    what = ("kind", "code", "acres")
    found = polygons.groupBy(key).agg(
        F.min(F.when(F.col("d_mm") == 0, F.struct("ordinal", *what))).alias("at"),
        F.min(F.struct("d_mm", "ordinal", *what)).alias("near"),
        F.count("*").alias("n"),
        F.sum("acres").alias("total"),
    )
    wide = _failed(sites, failed).join(found, key, "left").join(mapping, key, "left")
    bad, here, near, year = F.col("_failed"), F.col("at").isNotNull(), F.col("near").isNotNull(), F.col("year")
    stale = F.when(year < STALE_BEFORE, F.concat(F.lit("imagery of "), year.cast("string")))
    unmapped = F.when(F.col("state").isNull(), "not mapped: no polygons is no evidence")
    about = {"source": "wetlands", "vintage": year, "note": F.nullif(F.concat_ws("; ", stale, unmapped), F.lit(""))}
    one = lambda value, present: status.record(value, status.found(value, present, bad), **about)
    yes = F.lit(True)
    fields = {
        "nwi_mapping_status": one(F.col("state"), F.col("state").isNotNull()),
        "nwi_image_year": one(year, year.isNotNull()),
        "nwi_mapping_age_years": one(as_of - year, year.isNotNull()),
        "nwi_project": one(F.col("project"), F.col("project").isNotNull()),
        "nwi_at_point": one(here, yes),
        "nwi_type_at_point": one(F.col("at.kind"), here),
        "nwi_code_at_point": one(F.col("at.code"), here),
        "nwi_nearest_m": one(metres(F.col("near.d_mm"), 1), near),
        "nwi_nearest_type": one(F.col("near.kind"), near),
        "nwi_nearest_code": one(F.col("near.code"), near),
        "nwi_nearest_acres": one(F.bround(F.col("near.acres"), 3), near),
        f"nwi_count_within_{reach_m}m": one(F.coalesce("n", F.lit(0)), yes),
        f"nwi_polygon_acres_within_{reach_m}m": one(F.bround(F.coalesce("total", F.lit(0.0)), 3), yes),
    }
    return status.to_long(wide, key, fields)


def _tied(pairs: DataFrame, key: str, ok: dict[str, Column], columns: list[str], any_of: str | None = None) -> DataFrame:
    """For each name in ok, of a key's pairs within a metre of its nearest that are ok, the one of the highest voltage, then the first; and whether any_of holds for any of its pairs.

    Pairs are read and dealt by their key once, whatever they are asked for.
    """
    far = {n: F.col(f"_{n}") for n in ok}  # the distance where a pair is ok, else null
    held = [F.bool_or(any_of).alias(any_of)] if any_of else []
    wanted = reduce(or_, [d.isNotNull() for d in far.values()] + ([F.coalesce(any_of, F.lit(False))] if any_of else []))
    rows = pairs.withColumns({f"_{n}": F.when(c, F.col("d_mm")) for n, c in ok.items()}).where(F.col(key).isNotNull() & wanted)
    rows = rows.withColumns({f"_least_{n}": F.min(d).over(Window.partitionBy(key)) for n, d in far.items()})
    best = lambda d: F.struct((-F.coalesce("kv", F.lit(0.0))).alias("_minus"), "ordinal", d.alias("d_mm"), *columns)
    return rows.groupBy(key).agg(*[F.min(F.when(d <= F.col(f"_least_{n}") + 1000, best(d))).alias(n) for n, d in far.items()], *held)


def power_site(sites: DataFrame, key: str, lines: DataFrame, substations: DataFrame, line_kv: float = 69.0, sub_kv: float = 69.0, head_kv: float = 115.0, failed: Column | None = None) -> DataFrame:
    """The nearest line, substation and head substation that qualify, from the site's edge or from its pin, and whether a line crosses.

    sites: key, on_site (an outline or a parcel rather than a stand-in square)
    and basis; lines: key, ordinal, d_mm, kv, band_kv, crosses; substations:
    key, ordinal, d_mm, name, kv, state, kind.
    """
    from geosieve.functions.rules import line_qualifies, substation_qualifies
    from geosieve.functions.text import substation_label

    ok = lambda least: substation_qualifies(F.col("kv"), F.col("state"), F.col("kind"), least)
    near = _tied(lines, key, {"line": line_qualifies(F.col("kv"), F.col("band_kv"), line_kv)}, ["kv"], "crosses")
    wide = _failed(sites, failed).join(near, key, "left")
    wide = wide.join(_tied(substations, key, {"sub": ok(sub_kv), "head": ok(head_kv)}, ["kv", "name"]), key, "left")
    bad = F.col("_failed")
    one = lambda value, present, what="": status.record(value, status.found(value, present, bad), source="power_site", note=F.when(~present & ~bad, F.lit(what)))
    yes = F.lit(True)
    fields = {
        "pw_from": one(F.when(F.col("on_site"), F.col("basis")).otherwise("pin (no site outline)"), yes),
        "line_crosses_site": one(F.col("on_site") & F.coalesce("crosses", F.lit(False)), yes),
    }
    for tag, column, least in (("line_kv_site", "line", line_kv), ("sub_kv_site", "sub", sub_kv), ("sub_115kv_site", "head", head_kv)):
        there, none = F.col(column).isNotNull(), f"none of {least:g} kV or more"
        fields[f"{tag}_m"] = one(metres(F.col(f"{column}.d_mm"), 1), there, none)
        if column != "line":
            fields[f"{tag}_name"] = one(substation_label(F.col(f"{column}.name")), there, none)
        fields[f"{tag}_kv"] = one(F.col(f"{column}.kv"), there, none)
    return status.to_long(wide, key, fields)


def price(value: Column) -> Column:
    """A price to two decimals; what isn't over 0 is none."""
    number = value.try_cast("double")
    return F.when(number > 0, F.bround(number, 2))


def parcel_records(sites: DataFrame, key: str) -> DataFrame:
    """The parcel's records from sites that parcel_stages() went over: what a stage didn't reach has failed or is absent.

    Columns: parcel_status, county, geoid, scope, service, licensed (the
    county's data may not leave the house), apn, owner, address, acres_gis,
    acres_stated_by_county, vertices, hits, acres_stated, input_apn, pattern,
    has_owner.
    """
    from geosieve.functions.rules import owner_check
    from geosieve.functions.text import alphanumeric

    at = F.col("parcel_status")
    county_failed, parcel_failed = at == "county_failed", at == "parcel_failed"
    whole, some_county = at == "ok", ~at.isin("county_failed", "no_county")
    bad = lambda late: county_failed | (parcel_failed if late else F.lit(False))
    internal = F.when(F.col("licensed"), "internal use only (licensed county)")
    hits = F.when(F.col("hits") > 1, F.concat(F.col("hits").cast("string"), F.lit(" parcels returned for one point")))
    note = F.nullif(F.concat_ws("; ", hits, internal), F.lit(""))

    def one(value: Column, present: Column, late: bool = True, said: Column | None = None) -> Column:
        return status.record(value, status.found(value, present, bad(late)), source="parcel", note=F.when(whole, note) if said is None else said)

    told = owner_check(F.col("pattern"), F.col("owner"), F.col("has_owner"), F.col("apn"))
    same = F.coalesce(alphanumeric(F.col("apn")) == alphanumeric(F.col("input_apn")), F.lit(False))
    reached = F.when(whole, "ok").when(at.startswith("unresolved"), at)
    fields = {
        "parcel_county": one(F.col("county"), some_county, False),
        "parcel_county_geoid": one(F.col("geoid"), some_county, False),
        "parcel_source_scope": one(F.col("scope"), whole),
        "parcel_service_name": one(F.col("service"), whole),
        "parcel_apn": one(F.col("apn"), whole),
        "parcel_owner": one(F.col("owner"), whole),
        "parcel_address": one(F.col("address"), whole),
        "parcel_acres_gis": one(F.bround("acres_gis", 4), whole),
        "parcel_acres_stated_by_county": one(F.bround("acres_stated_by_county", 4), whole & F.col("acres_stated_by_county").isNotNull()),
        "parcel_acres_input": one(F.col("acres_stated"), whole & F.col("acres_stated").isNotNull()),
        "parcel_apn_matches_input": one(same, whole & F.col("input_apn").isNotNull()),
        "parcel_owner_check": one(told, whole & told.isNotNull()),
        "parcel_vertices": one(F.col("vertices"), whole),
        "parcel_use": one(F.coalesce(internal, F.lit("open")), whole),
        "parcel_status": one(reached, reached.isNotNull()),
    }
    return status.to_long(sites, key, fields)
