"""Joins by place against all pairs, and crowds that share one box."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from parcelflow.operators import detect, polygons, spatial

BOX = "id long, kind string, xmin double, ymin double, xmax double, ymax double"


def area(a, b):
    w, h = min(a[4], b[4]) - max(a[2], b[2]), min(a[5], b[5]) - max(a[3], b[3])
    return max(w, 0.0) * max(h, 0.0) if w >= 0 and h >= 0 else -1.0


@pytest.mark.parametrize("listed", [spatial.LISTED, 3])
def test_pairs_by_place(spark, monkeypatch, listed):
    """Boxes on few places, with nulls; also where places fall into several."""
    monkeypatch.setattr(spatial, "LISTED", listed)
    rng = np.random.default_rng(3)
    rows = [(k, "abc"[int(rng.integers(3))] if k % 17 else None, *(float(v) for v in (x, y, x + 6, y + 6))) for k, (x, y) in enumerate(rng.integers(0, 5, (160, 2)) * 3)]
    rows.append((900, "a", None, 0.0, 1.0, 1.0))
    df = spark.createDataFrame(rows, BOX)
    sound = [r for r in rows if r[2] is not None]
    want = {(a[0], b[0], area(a, b)) for a in sound for b in sound if a[0] < b[0] and a[1] and b[1] and a[1] != b[1] and area(a, b) > 9}
    got = [tuple(r) for r in spatial.overlaps(df, "id", 6.0, "kind", 9.0).select("a_id", "b_id", "area").collect()]
    assert len(got) == len(set(got)) and set(got) == want
    assert spatial.count_overlaps(df, 6.0, "kind", 9.0).first().n == len(want)
    one, two = ([r for r in sound if r[1] == k] for k in "ab")
    first = {(a[0], b, i) for a in one for i, b in enumerate(sorted(b[0] for b in two if area(a, b) >= 0)[:4], 1)}
    got = spatial.first_met(df.where("kind = 'a'"), df.where("kind = 'b'"), "id", 6.0, 4).collect()
    assert {tuple(r) for r in got} == first and len(got) == len(first)


def test_crowd(spark):
    """Two crowds of 100,000 on one box: their 10^10 pairs are counted, and each row finds its first ones."""
    df = spark.range(200_000).select("id", F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("kind"), *(F.lit(v).alias(c) for c, v in zip(spatial.SIDES, (0.0, 0.0, 5.0, 5.0), strict=True)))
    assert spatial.count_overlaps(df, 6.0, "kind").first().n == 10**10
    got = spatial.first_met(df.where("kind = 'a'"), df.where("kind = 'b'"), "id", 6.0, 3).groupBy("rank").agg(F.count("*"), F.min("b_id"), F.max("b_id")).orderBy("rank").collect()
    assert [tuple(r) for r in got] == [(1, 100_000, 1, 1), (2, 100_000, 3, 3), (3, 100_000, 5, 5)]


def test_crowded_tiles(spark):
    """300 equal tiles and 3000 equal candidates: 900,000 pairs whose area is found once; one list of a place holds no more than its share."""
    at = lambda n, name, box: spark.range(n).select(F.col("id").alias(name), *(F.lit(v).alias(c) for c, v in zip(spatial.SIDES, box, strict=True)))
    tiles, cands = at(300, "tile_id", (0.0, 0.0, 10.0, 10.0)), at(3000, "cand_id", (8.0, 0.0, 14.0, 6.0))
    ring = F.array(*(F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in ((8.0, 0.0), (14.0, 0.0), (14.0, 6.0))))
    lists = spatial.gathered(cands, "cand_id").select(F.size("ids").alias("n")).collect()
    assert sum(r.n for r in lists) == 3000 and len(lists) == 3
    seen = []
    for got in (detect.tile_polygons(tiles, cands.withColumn("area", F.lit(18.0)).withColumn("ring", ring), ring="ring"), detect.tile_shapes(tiles, cands.select("cand_id", F.array(ring).alias("rings")))):
        assert "ArrowEvalPython" not in got._jdf.queryExecution().executedPlan().toString().split("SortMergeJoin")[0]  # not on pairs of rows
        seen.append(got.agg(F.count("*"), F.count_distinct("tile_id", "cand_id"), F.min("inter"), F.max("inter")).first())
    for n, pairs, least, most in seen:
        assert n == pairs == 900_000 and least == pytest.approx(2.0) and most == pytest.approx(2.0)


def test_few_pairs_are_cut(spark):
    """Rings whose boxes share too little are not cut by the kernel, and no pair that shares enough is lost."""
    rng = np.random.default_rng(5)
    rows = []
    for k in range(60):
        turn, far = np.sort(rng.uniform(0, 2 * np.pi, 7)), rng.uniform(40, 60, 7)
        xy = np.stack([far * np.cos(turn), far * np.sin(turn)], 1) + rng.uniform(0, 60, 2)
        rows.append((k, 0, float(k), 1.0, *map(float, (*xy.min(0), *xy.max(0))), [tuple(map(float, p)) for p in xy]))
    df = spark.createDataFrame(rows, "cand_id long, is_edge int, confidence double, area double, xmin double, ymin double, xmax double, ymax double, ring array<struct<x:double,y:double>>")
    near = detect._near(df, 0.5, 0.3, [], False, "ring")
    plan = near._jdf.queryExecution().optimizedPlan().toString()
    assert "__size" in plan[plan.index("ArrowEvalPython") :]
    rings = [np.array(r[-1]) for r in rows]
    size = [polygons.intersection_area(r, r) for r in rings]
    share = {(i, j): polygons.intersection_area(a, b) for i, a in enumerate(rings) for j, b in enumerate(rings)}
    want = {(i, j) for (i, j), s in share.items() if s / (size[i] + size[j] - s) >= 0.3}
    assert {(r.late, r.early) for r in near.collect()} == want and 60 < len(want) < 3600
