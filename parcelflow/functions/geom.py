"""Boxes and rings as column expressions; a ring is array<struct<x:double,y:double>> without its closing point."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def overlap_area(a: str = "a_", b: str = "b_") -> Column:
    """Area that two boxes share, zero where they are apart."""
    w = F.least(f"{a}xmax", f"{b}xmax") - F.greatest(f"{a}xmin", f"{b}xmin")
    h = F.least(f"{a}ymax", f"{b}ymax") - F.greatest(f"{a}ymin", f"{b}ymin")
    return F.greatest(w, F.lit(0.0)) * F.greatest(h, F.lit(0.0))


def box_area(p: str = "") -> Column:
    return (F.col(f"{p}xmax") - F.col(f"{p}xmin")) * (F.col(f"{p}ymax") - F.col(f"{p}ymin"))


def box_iou(a: str = "a_", b: str = "b_") -> Column:
    """Intersection over union; zero for a union of nothing."""
    inter = overlap_area(a, b)
    union = box_area(a) + box_area(b) - inter
    return F.when(union <= 1e-12, 0.0).otherwise(inter / union)


def box_ring(p: str = "") -> Column:
    at = lambda x, y: F.struct(F.col(f"{p}{x}").alias("x"), F.col(f"{p}{y}").alias("y"))
    return F.array(at("xmin", "ymin"), at("xmax", "ymin"), at("xmax", "ymax"), at("xmin", "ymax"))



def ring_area(ring: Column) -> Column:
    """Shoelace formula."""
    rest = F.concat(F.slice(ring, 2, F.size(ring)), F.slice(ring, 1, 1))
    cross = F.zip_with(ring, rest, lambda p, q: p["x"] * q["y"] - q["x"] * p["y"])
    return F.abs(F.aggregate(cross, F.lit(0.0), lambda s, c: s + c)) / 2


def ring_perimeter(ring: Column) -> Column:
    rest = F.concat(F.slice(ring, 2, F.size(ring)), F.slice(ring, 1, 1))
    step = F.zip_with(ring, rest, lambda p, q: F.sqrt((q["x"] - p["x"]) * (q["x"] - p["x"]) + (q["y"] - p["y"]) * (q["y"] - p["y"])))
    return F.aggregate(step, F.lit(0.0), lambda s, c: s + c)


def exterior(rings: Column, tolerance: float = 1e-6) -> Column:
    """The outer ring of a polygon's rings, without holes and without the closing point."""
    ring = rings[0]
    last = F.element_at(ring, -1)
    closed = (F.size(ring) > 1) & (F.abs(ring[0]["x"] - last["x"]) <= tolerance) & (F.abs(ring[0]["y"] - last["y"]) <= tolerance)
    return F.when(closed, F.slice(ring, 1, F.size(ring) - 1)).otherwise(ring)


def ring_centroid(ring: Column) -> Column:
    """Centre of mass (x, y); null where the ring has no area."""
    rest = F.concat(F.slice(ring, 2, F.size(ring)), F.slice(ring, 1, 1))
    each = F.zip_with(ring, rest, lambda p, q: F.struct((p["x"] * q["y"] - q["x"] * p["y"]).alias("c"), (p["x"] + q["x"]).alias("x"), (p["y"] + q["y"]).alias("y")))
    total = lambda f: F.aggregate(each, F.lit(0.0), lambda s, e: s + f(e))
    area = total(lambda e: e["c"])
    at = lambda k: F.when(area != 0, total(lambda e: e["c"] * e[k]) / (3 * area))
    return F.struct(at("x").alias("x"), at("y").alias("y"))


def compactness(area: Column, perimeter: Column) -> Column:
    """1 for a circle; 0 without a perimeter."""
    return F.when(perimeter > 0, 4 * math.pi * area / (perimeter * perimeter)).otherwise(0.0)


def to_ground(ring: Column, x0: Column, y0: Column, res: float = 10.0) -> Column:
    """Pixels to map coordinates; rows run south."""
    return F.transform(ring, lambda p: F.struct((x0 + res * p["x"]).alias("x"), (y0 - res * p["y"]).alias("y")))


def to_pixels(ring: Column, x0: Column, y0: Column, res: float = 10.0) -> Column:
    return F.transform(ring, lambda p: F.struct(((p["x"] - x0) / res).alias("x"), ((y0 - p["y"]) / res).alias("y")))


def normalised(ring: Column, size: float = 640.0) -> Column:
    """Clipped to the image and scaled to [0, 1]."""
    clip = lambda v: F.least(F.greatest(v / size, F.lit(0.0)), F.lit(1.0))
    return F.transform(ring, lambda p: F.struct(clip(p["x"]).alias("x"), clip(p["y"]).alias("y")))


def label_text(ring: Column) -> Column:
    """Class 0 and the points with six decimals."""
    return F.concat(F.lit("0 "), F.array_join(F.transform(ring, lambda p: F.concat_ws(" ", F.format_string("%.6f", p["x"]), F.format_string("%.6f", p["y"]))), " "))


def near_edge(margin: float, inclusive: bool, size: float = 640.0) -> Column:
    """Whether a box (xmin, ymin, xmax, ymax in pixels) comes within a margin of its image's sides."""
    lo, hi = F.least("xmin", "ymin"), F.greatest("xmax", "ymax")
    return (lo <= margin) | (hi >= size - margin) if inclusive else (lo < margin) | (hi > size - margin)
