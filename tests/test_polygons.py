"""Polygon kernels against plain versions: clipping, cleaning, records of shapes, exact areas in tiles."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from parcelflow.operators import detect, labels, polygons

RING = "array<struct<x:double,y:double>>"


def inside(x, y, ring):
    odd = np.zeros(len(x), bool)
    for (ax, ay), (bx, by) in zip(ring, np.roll(ring, -1, 0), strict=True):
        hit = (ay > y) != (by > y)
        odd ^= hit & (x < ax + (y - ay) * (bx - ax) / (by - ay if by != ay else 1))
    return odd


def star(rng, n):
    """A simple ring around a point, seldom convex."""
    turn = np.sort(rng.uniform(0, 2 * math.pi, n))
    far = rng.uniform(2, 9, n)
    return np.stack([10 + far * np.cos(turn), 10 + far * np.sin(turn)], 1)


def test_areas_against_points():
    rng = np.random.default_rng(3)
    x, y = rng.uniform(0, 20, (2, 400_000))
    for n in (5, 6, 9):
        p, q = star(rng, n), star(rng, n + 2)[::-1] + rng.uniform(-3, 3, 2)
        want = (inside(x, y, p) & inside(x, y, q)).mean() * 400
        assert polygons.intersection_area(p, q) == pytest.approx(want, abs=1.2)
        assert polygons.intersection_area(p, q) == pytest.approx(polygons.intersection_area(q, p), abs=1e-9)


def test_convex_and_fans_agree():
    turn = np.arange(8) * math.pi / 4
    p = np.stack([np.cos(turn), np.sin(turn)], 1)[None]
    q, n = p + 0.3, np.array([8])
    assert polygons.shared_areas(p, n, q, n) == pytest.approx(polygons._fans(p, n, q, n), abs=1e-12)


def test_null_empty_and_padded_rings(spark):
    box = [(0.0, 0.0), (2.0, 0.0), (2.0, 2.0), (0.0, 2.0)]
    more = [(0.0, 0.0), (1.0, 0.0), (2.0, 0.0), (2.0, 0.0), (2.0, 2.0), (0.0, 2.0), (0.0, 0.0)]
    rows = spark.createDataFrame([(1, box, more), (2, None, box), (3, [], box), (4, box[:2], box), (5, [(5.0, 5.0)], box)], f"k int, a {RING}, b {RING}").coalesce(1)
    got = {r.k: r for r in rows.select("k", polygons.polygon_iou("a", "b").alias("iou"), polygons.polygon_overlap("a", "b").alias("area"), F.size(polygons.cleaned("b")).alias("n"), polygons.cleaned("a").alias("c"), polygons.aspect("a").alias("s")).collect()}
    assert got[1].iou == 1 and got[1].area == 4 and got[1].n == 4 and got[1].s == 1
    assert all(got[k].iou == 0 and got[k].area == 0 for k in (2, 3, 4, 5)) and got[2].c == [] and got[3].s is None
    assert rows.where("k > 9").select(polygons.polygon_iou("a", "b")).collect() == []


def test_shape_record(spark):
    square = "0.1 0.1 0.2 0.1 0.2 0.2 0.1 0.2"
    thin = "0.5 0.5 0.9 0.5 0.9 0.51 0.5 0.51"
    rows = [("a", 1, f"0 {square}"), ("a", 2, f"0 {square}"), ("a", 3, f"0 {thin}"), ("a", 4, "0 nan 0.1 0.2 0.1 0.2 0.2"), ("b", 1, "0 0 0 0.1 0 0.1 0.1 0 0.1"), ("c", 1, "")]
    got = {r.file: r for r in labels.shape_record(spark.createDataFrame(rows, "file string, line_no long, text string")).collect()}
    assert set(got) == {"a", "b"} and (got["a"].n_border, got["a"].n_dup, got["a"].n_low_circ) == (0, 1, 1)
    circ = lambda w, h: 4 * math.pi * w * h / (2 * w + 2 * h) ** 2
    assert got["a"].mean_circ == pytest.approx((2 * circ(1, 1) + circ(0.4, 0.01)) / 3) and got["a"].mean_aniso == pytest.approx((2 + 0.025) / 3)
    assert (got["b"].n_border, got["b"].n_dup) == (1, 0)


def test_shape_record_of_copies(spark):
    """Two hundred thousand equal lines, and a few that nearly equal them, make pairs that are counted and not stored."""
    near = F.when(F.col("id") < 3, "0 0.1 0.1 0.2 0.1 0.2 0.201 0.1 0.2").otherwise("0 0.1 0.1 0.2 0.1 0.2 0.2 0.1 0.2")
    got, = labels.shape_record(spark.range(200_000).select(F.lit("a").alias("file"), F.col("id").alias("line_no"), near.alias("text"))).collect()
    assert got.n_dup == 200_000 * 199_999 // 2 and got.n_border == 0 and got.mean_aniso == pytest.approx(1, abs=1e-3)


def test_polygons_in_tiles(spark):
    """Triangles across a tile's side; a box that meets the tile only with its empty corner is no pair."""
    tiles = spark.createDataFrame([(1, 0.0, 0.0, 10.0, 10.0)], "tile_id long, xmin double, ymin double, xmax double, ymax double")
    tri = [(8.0, 0.0), (14.0, 0.0), (14.0, 6.0)]
    corner = [(9.0, 14.0), (14.0, 9.0), (14.0, 14.0)]
    boxes = spark.createDataFrame([(1, tri, 18.0, 8.0, 0.0, 14.0, 6.0), (2, corner, 12.5, 9.0, 9.0, 14.0, 14.0)], f"cand_id long, ring {RING}, area double, xmin double, ymin double, xmax double, ymax double")
    got, = detect.tile_polygons(tiles, boxes, ring="ring").collect()
    assert (got.cand_id, got.inter) == (1, pytest.approx(2.0)) and got.visible == pytest.approx(1 / 9)
