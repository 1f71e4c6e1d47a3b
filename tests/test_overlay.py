"""Validity, repair and exact areas of polygons with holes and parts, against plain versions."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from parcelflow.operators import overlay, polygons

RINGS = "array<array<struct<x:double,y:double>>>"

BOX = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0)]
HOLE = [(1.0, 1.0), (2.0, 1.0), (2.0, 3.0), (1.0, 3.0)]
SHAPES = {
    "box": ([BOX], True, [16.0]),
    "closed": ([[*BOX, BOX[0]]], True, [16.0]),
    "repeated point": ([[BOX[0], BOX[0], *BOX[1:]]], True, [16.0]),
    "clockwise": ([BOX[::-1]], True, [16.0]),
    "hole": ([BOX, HOLE], True, [14.0]),
    "two parts": ([BOX, [(x + 10, y) for x, y in BOX]], True, [16.0, 16.0]),
    "hole that touches": ([BOX, [(0.0, 2.0), (2.0, 1.0), (2.0, 3.0)]], True, [14.0]),
    "bow tie": ([[(0.0, 0.0), (4.0, 0.0), (0.0, 4.0), (4.0, 4.0)]], False, [4.0, 4.0]),
    "spike": ([[(0.0, 0.0), (4.0, 0.0), (4.0, 2.0), (9.0, 2.0), (4.0, 2.0), (4.0, 4.0), (0.0, 4.0)]], False, [16.0]),
    "spike inwards": ([[(0.0, 0.0), (4.0, 0.0), (4.0, 2.0), (1.0, 2.0), (4.0, 2.0), (4.0, 4.0), (0.0, 4.0)]], False, [16.0]),
    "touching": ([[(0.0, 0.0), (2.0, 0.0), (2.0, 2.0), (4.0, 2.0), (4.0, 4.0), (2.0, 4.0), (2.0, 2.0), (0.0, 2.0)]], False, [4.0, 4.0]),
    "pentagram": ([[(10 * math.cos(0.3 + 4 * math.pi * k / 5), 10 * math.sin(0.3 + 4 * math.pi * k / 5)) for k in range(5)]], False, None),
    "hole across": ([BOX, [(2.0, 1.0), (6.0, 1.0), (6.0, 3.0), (2.0, 3.0)]], False, [12.0, 4.0]),
    "hole at a side": ([BOX, [(0.0, 1.0), (1.0, 1.0), (1.0, 3.0), (0.0, 3.0)]], False, [14.0]),
    "line": ([[(0.0, 0.0), (4.0, 4.0)]], False, []),
    "flat": ([[(0.0, 0.0), (4.0, 0.0), (2.0, 0.0)]], False, []),
    "walked twice": ([BOX + BOX], False, []),
    "none": ([], None, []),
    "null": (None, None, []),
    "empty ring": ([[]], None, []),
    "point": ([[(1.0, 1.0)]], None, []),
}


@pytest.fixture(scope="module")
def shapes(spark):
    return spark.createDataFrame([(k, r) for k, (r, *_) in SHAPES.items()], f"k string, rings {RINGS}").repartition(3).cache()


def signed(ring):
    p, q = np.array(ring), np.roll(np.array(ring), -1, 0)
    return float((p[:, 0] * q[:, 1] - q[:, 0] * p[:, 1]).sum() / 2)


def test_validity(shapes):
    got = {r.k: r.valid for r in overlay.validity(shapes, ["k"]).collect()}
    assert got == {k: v for k, (_, v, _) in SHAPES.items() if v is not None}


def test_parts(shapes):
    """Areas of parts, their sum, and rings whose signed areas are those of the parts."""
    got = {}
    for r in overlay.parts(shapes, ["k"]).collect():
        got.setdefault(r.k, []).append(r)
    whole = {r.k: r.area for r in overlay.areas(shapes, ["k"]).collect()}
    for k, (_, _, want) in SHAPES.items():
        own = sorted(got.get(k, []), key=lambda r: r.part)
        assert [r.part for r in own] == list(range(len(own)))
        if want is None:  # a pentagram: five tips around a middle that is outside
            assert len(own) == 5 and np.ptp([r.area for r in own]) < 1e-9
        else:
            assert sorted((r.area for r in own), reverse=True) == pytest.approx(want), k
        assert sum(r.area for r in own) == pytest.approx(whole.get(k, 0.0))
        for r in own:
            turns = [signed([(p.x, p.y) for p in ring]) for ring in r.rings]
            assert sum(turns) == pytest.approx(r.area) and sum(t > 0 for t in turns) == 1
    assert [len(r) for r in got["hole"][0].rings] == [4, 4] and [len(r) for r in got["spike"][0].rings] == [4]
    assert [len(r.rings[0]) for r in got["bow tie"]] == [3, 3]


def test_repaired(shapes):
    by = {keep: {} for keep in ("all", "largest", "single")}
    for keep, rows in by.items():
        for r in overlay.repaired(shapes, ["k"], keep=keep).collect():
            rows.setdefault(r.k, []).append(r)
    assert len(by["all"]["bow tie"]) == 2 and len(by["largest"]["bow tie"]) == 1 and "bow tie" not in by["single"] and "spike" in by["single"]
    assert by["largest"]["hole across"][0].area == pytest.approx(12.0)
    assert [[tuple(p) for p in r] for r in by["all"]["clockwise"][0].rings] == [BOX[::-1]]  # valid shapes stay as they are
    assert "line" not in by["all"] and "null" not in by["all"]
    with pytest.raises(ValueError):
        overlay.repaired(shapes, ["k"], keep="some")
    # what is repaired is valid
    again = overlay.parts(shapes.where("k in ('bow tie', 'touching', 'spike', 'pentagram', 'hole at a side')"), ["k"])
    assert overlay.validity(again, ["k", "part"]).where("not valid").count() == 0


def test_cleaning(shapes):
    got = overlay.cleaning(shapes, ["k"]).first().asDict()
    bad = [k for k, (_, v, _) in SHAPES.items() if v is False]
    lost = [k for k in bad if SHAPES[k][2] == []]
    assert got == {"n": len(SHAPES), "empty": 4, "invalid": len(bad), "mended": len(bad) - len(lost), "lost": len(lost), "kept": len(SHAPES) - 4 - len(lost)}
    assert overlay.cleaning(shapes.where("false"), ["k"]).first().n == 0


def star(rng, n, x, y):
    turn, far = np.sort(rng.uniform(0, 2 * math.pi, n)), rng.uniform(5, 9, n)
    return [(float(x + f * math.cos(t)), float(y + f * math.sin(t))) for t, f in zip(turn, far, strict=True)]


def test_shared_areas(spark):
    """Concave rings against clipped fans; large rings; holes against their parts."""
    rng = np.random.default_rng(1)
    pairs = [(k, star(rng, int(rng.integers(3, 30)), 4e5, 4e6), star(rng, int(rng.integers(3, 30)), 4e5 + 3, 4e6 + 2)) for k in range(25)]
    rows = [(k, [a], [b]) for k, a, b in pairs] + [(100, [BOX, HOLE], [[(1.5, 0.0), (9.0, 0.0), (9.0, 9.0), (1.5, 9.0)]]), (101, [BOX], [[(4.0, 0.0), (8.0, 0.0), (8.0, 4.0)]]), (102, [BOX], None), (103, [BOX], [BOX])]
    big = [star(rng, 1000, 0, 0), star(rng, 1000, 1, 1)]
    rows.append((104, [big[0]], [big[1]]))
    df = spark.createDataFrame(rows, f"k long, a {RINGS}, b {RINGS}")
    got = {r.k: r for r in overlay.shared(df, ["k"]).collect()}
    for k, a, b in pairs:
        a, b = (np.array(r) - [4e5, 4e6] for r in (a, b))
        assert got[k].inter == pytest.approx(polygons.intersection_area(a, b), abs=1e-4), k
        assert got[k].area_a == pytest.approx(abs(signed(a)), abs=1e-4)
    assert got[100].inter == pytest.approx(2.5 * 4 - 0.5 * 2) and got[101].inter == 0 and got[102].inter == 0 and got[103].inter == 16
    assert got[104].inter == pytest.approx(polygons.intersection_area(*map(np.array, big)), rel=1e-9)
    assert {r.k: r.iou for r in overlay.iou(df.where("k in (101, 103)"), ["k"]).collect()} == {103: 1.0}


def test_worked_on_where_it_lies(spark, shapes, monkeypatch):
    """Shapes are neither shuffled nor stored, and blocks of any size give the same (whole coordinates, so to the last digit)."""
    wide = shapes.where("k <> 'pentagram'").crossJoin(spark.range(40).select((100.0 * F.col("id")).alias("d"))).select(
        F.concat("k", F.col("d").cast("int").cast("string")).alias("k"), F.transform("rings", lambda r: F.transform(r, lambda p: F.struct((p["x"] + F.col("d")).alias("x"), p["y"].alias("y")))).alias("rings")
    ).coalesce(1).cache()
    pairs = wide.withColumn("b", F.transform("rings", lambda r: F.transform(r, lambda p: F.struct((p["x"] + 0.5).alias("x"), p["y"].alias("y")))))
    whole = {}
    for points, items in ((overlay.POINTS, overlay.ITEMS), (7, 5)):
        monkeypatch.setattr(overlay, "POINTS", points)
        monkeypatch.setattr(overlay, "ITEMS", items)
        made = [overlay.validity(wide, ["k"]), overlay.areas(wide, ["k"]), overlay.parts(wide, ["k"]), overlay.repaired(wide, ["k"]), overlay.shared(pairs, ["k"], "rings", "b")]
        for n, df in enumerate(made):
            assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString().split("InMemoryTableScan")[0]
            rows = sorted(map(str, df.collect()))
            assert rows and whole.setdefault(n, rows) == rows
