"""Map differences, moves, folder counts and grafts on small maps."""

from geosieve.operators import maps

MARK = "folder string, name string, parts array<array<array<struct<lng:double,lat:double>>>>, style string"


def frame(spark, rows):
    return spark.createDataFrame([(f, n, None if at is None else [[[at]]], s) for f, n, at, s in rows], MARK)


def test_changes_moves_and_folders(spark):
    a = frame(spark, [("M/A", "same", (1.0, 2.0), "s"), ("M/A", "bag", (1.0, 1.0), ""), ("M/A", "bag", (1.0, 1.0), ""), ("M/B", "gone", (3.0, 3.0), None), ("M/B", "moved", (-0.0, 5.0), None), ("M/B", "styled", (6.0, 6.0), "x"), (None, None, None, None)])
    b = frame(spark, [("M/A", "same", (1.0 + 1e-8, 2.0), "s"), ("M/A", "bag", (1.0, 1.0), ""), ("M/A", "bag", (1.0, 1.1), ""), ("M/C/D", "moved", (0.0, 5.0), ""), ("M/B", "styled", (6.0, 6.0), "y"), ("M/B", "new", (7.0, 7.0), None), ("", "", None, "")])
    got = {(r.folder, r.name): (r.in_a, r.in_b, r.outcome) for r in maps.map_difference(a, b).collect()}
    assert got == {
        ("M/A", "same"): (1, 1, maps.SAME), ("M/A", "bag"): (2, 2, maps.DIFFERS), ("M/B", "gone"): (1, 0, maps.ONLY_A), ("M/B", "moved"): (1, 0, maps.ONLY_A), ("M/C/D", "moved"): (0, 1, maps.ONLY_B),
        ("M/B", "styled"): (1, 1, maps.DIFFERS), ("M/B", "new"): (0, 1, maps.ONLY_B), ("", ""): (1, 1, maps.SAME),
    }
    assert [(r.name, r.from_folder, r.to_folder) for r in maps.moved(a, b).collect()] == [("moved", "M/B", "M/C/D")]
    counts = {r.folder: (r.in_a, r.in_b) for r in maps.folder_counts(a, b).collect()}
    assert counts == {"": (1, 1), "M": (0, 0), "M/A": (3, 3), "M/B": (3, 2), "M/C": (None, 0), "M/C/D": (None, 1)}
    assert {r.outcome for r in maps.map_difference(a, b.limit(0)).collect()} == {maps.ONLY_A} and maps.map_difference(a.limit(0), b.limit(0)).count() == 0


def test_graft(spark):
    target = frame(spark, [("M/Old", "x", (1.0, 1.0), None), ("M/Old/Sub", "y", (1.0, 1.0), None), ("M/Older", "z", (1.0, 1.0), None), (None, "w", None, None)])
    source = frame(spark, [("S/New", "a", (2.0, 2.0), None), ("S/New/Deep", "b", (2.0, 2.0), None), ("S/Newer", "c", (2.0, 2.0), None)])
    got = sorted((r.folder or "", r.name) for r in maps.graft(target, source, "S/New", "M/Old").collect())
    assert got == [("", "w"), ("M/Old", "a"), ("M/Old/Deep", "b"), ("M/Older", "z")]
