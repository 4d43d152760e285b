"""Evidence and clues held against their cells, each rule by a row that breaks it."""

from geosieve.operators import evidence as ev

CELLS = "site_id long, source_cell string, ordinal long, text string, dimensions string, section string, column string, tag_raw string, tag_norm string, dup_n int, dup_sites string"
ROWS = "k long, site_id long, dimension string, field string, value string, unit string, kind string, quote string, source_cell string, section string"


def cells(spark):
    rows = [
        (1, "B2", 1, "old words", "other", "S", "C", None, None, 1, None),
        (1, "B2", 2, "About 20  MW by ‘Q3’\n2027", "power_capacity;power_timing", "S", "C", "[wrtn]", "confirmed_written", 2, "1;2"),
        (1, "B3", 3, "", "fiber", "S", "D", None, None, 1, None),
        (2, "B9", 4, "Zoned I-2", "zoning_neighbours", "T", "D", None, None, 1, None),
    ]
    return spark.createDataFrame(rows, CELLS)


def sites(spark):
    return spark.createDataFrame([(1,), (2,), (2,)], "site_id long")


def test_each_rule(spark):
    good = (1, "power_capacity", "mw", "1,020.5", "MW", "actual", "20 mw BY 'q3' 2027", "B2")
    cases = [
        (good, []),
        ((9, *good[1:]), ["unknown site"]),
        ((None, *good[1:]), ["unknown site"]),
        ((1, "weather", *good[2:]), ["unknown dimension"]),
        ((1, None, *good[2:]), ["unknown dimension"]),
        ((1, "power_capacity", "depth", *good[3:]), ["unknown field"]),
        ((1, "power_capacity", None, *good[3:]), ["unknown field"]),
        ((*good[:3], "many", "kW", "text", *good[6:]), ["not a number", "wrong unit", "number of kind text"]),
        ((*good[:3], "20d", None, None, *good[6:]), ["unknown kind", "not a number", "wrong unit"]),
        ((1, "power_timing", "available", "", None, "text", "Q4", "B2"), ["no value", "quote not in the cell"]),
        ((1, "power_timing", "available", "2027", None, "text", None, "B2"), ["empty quote"]),
        ((1, "fiber", "status", "maybe", None, "text", "words", "B3"), ["value not allowed", "quote not in the cell"]),
        ((1, "fiber", "status", "quoted", None, "text", "20 MW", "B2"), ["warning: column of another dimension"]),
        ((1, "fiber", "status", "quoted", None, "text", "20 MW", "B9"), ["unknown cell"]),
        ((1, "grid_constraints", "none_stated", None, None, None, None, None), []),
        ((*good[:6], "‘q3’ 2027", "B2"), []),
    ]
    rows = spark.createDataFrame([(i, *c, "mine") for i, (c, _) in enumerate(cases)], ROWS)
    got = {}
    for r in ev.evidence_violations(rows, cells(spark), sites(spark), "k").collect():
        got.setdefault(r.k, []).append(r.violation)
    assert {k: sorted(v) for k, v in got.items()} == {i: sorted(w) for i, (_, w) in enumerate(cases) if w}
    assert ev.evidence_violations(rows.limit(0), cells(spark), sites(spark), "k").count() == 0
    no_cells = ev.evidence_violations(rows, cells(spark).limit(0), sites(spark), "k").where("violation = 'unknown cell'").count()
    assert no_cells == sum(bool(c[1] in ev.VOCABULARY and c[0] == 1 and c[2] != ev.NONE_STATED) for c, _ in cases)


def test_clues(spark):
    cases = [
        (("coordinate", "29.5, -95.1", "20 MW", "B2"), []), (("coordinate_approx", "95,-95", "20 MW", "B2"), ["not lat,lng"]), (("coordinate", "here", "20 MW", "B2"), ["not lat,lng"]), (("zip", "7700", "20 MW", "B2"), ["not five digits"]),
        (("acreage", "20 ac", "20 MW", "B2"), ["not a number"]), (("acreage", "1,000", "20 MW", "B2"), ["not a number"]), (("planet", "x", "20 MW", "B2"), ["unknown clue type"]), ((None, "x", "20 MW", "B2"), ["unknown clue type"]), (("city", None, "", "B7"), ["unknown cell"]), (("city", "x", "nothing", "B2"), ["quote not in the cell"]),
    ]
    rows = spark.createDataFrame([(i, 1, *c) for i, (c, _) in enumerate(cases)], "k long, site_id long, clue_type string, value string, quote string, source_cell string")
    got = [(r.k, r.violation) for r in ev.clue_violations(rows, cells(spark), sites(spark), "k").collect()]
    assert sorted(got) == [(i, v) for i, (_, w) in enumerate(cases) for v in w]


def test_coverage_and_what_cells_tell(spark):
    rows = spark.createDataFrame([(1, 1, "power_capacity", "mw", "1", "MW", "actual", "20 MW", "B2", "mine"), (2, 1, "power_timing", "available", "x", None, "text", "q", "B9", "mine"), (3, 2, "fiber", "none_stated", None, None, None, None, None, "mine")], ROWS)
    clues = spark.createDataFrame([], "site_id long, clue_type string, source_cell string")
    left = lambda rows: sorted(map(tuple, ev.uncovered(rows, clues, cells(spark), sites(spark)).collect()))
    assert left(rows) == [(1, "other"), (1, "power_timing"), (2, "zoning_neighbours")]
    assert left(rows.limit(0)) == [(1, "other"), (1, "power_capacity"), (1, "power_timing"), (2, "zoning_neighbours")]
    told = {r.k: r for r in ev.checked(rows.drop("section"), cells(spark), sites(spark)).collect()}
    assert set(told) == {1, 3} and (told[1].tag_norm, told[1].dup_n, told[3].section) == ("confirmed_written", 2, None)
