"""Outlines that a model returns for windows, as candidate rows in map coordinates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geom

#: Pixels from a window's side that make an edge instance, least area in square metres.
EDGE, LEAST = 10.0, 1.0


def mask_candidates(results: DataFrame, res: float = 10.0) -> DataFrame:
    """Candidates of (scene, row, col, k, ring, confidence, x0, y0): ring in pixels of the window, x0 and y0 the scene's upper left corner.

    Rings of fewer than three points, also once the closing point is gone, and of less than a square metre are left out;
    a missing confidence is 0.  Rings are taken as they are: those that cross themselves are not repaired.
    """
    x, y = F.col("x0") + F.col("col") * res, F.col("y0") - F.col("row") * res
    lo = lambda c: F.array_min(F.transform("ring", lambda p: p[c]))
    hi = lambda c: F.array_max(F.transform("ring", lambda p: p[c]))
    rows = results.where(F.size("ring") >= 3).withColumns({"xmin": lo("x"), "ymin": lo("y"), "xmax": hi("x"), "ymax": hi("y")})
    rows = rows.withColumn("is_edge", geom.near_edge(EDGE, False).cast("int"))
    # names bound by lambdas: a ring is made once, where a column that is filtered by would be made again for each use
    ground = F.transform(F.array(geom.to_ground(F.col("ring"), x, y, res)), lambda r: geom.exterior(F.array(r)))
    measured = F.transform(ground, lambda r: F.struct(r.alias("ring"), geom.ring_area(r).alias("area"), geom.ring_perimeter(r).alias("perimeter")))
    found = F.filter(measured, lambda m: (F.size(m["ring"]) >= 3) & (m["area"] >= LEAST))
    rows = rows.select("scene", "row", "col", "k", "confidence", "is_edge", F.inline_outer(found)).where("ring IS NOT NULL")
    shape = F.round(geom.compactness(F.col("area"), F.col("perimeter")), 4)
    return rows.select(
        "scene", F.col("row").alias("window_row"), F.col("col").alias("window_col"), "k", "ring", F.round(F.coalesce("confidence", F.lit(0.0)), 4).alias("confidence"),
        F.round("area", 2).alias("area_m2"), F.round("perimeter", 2).alias("perimeter"), shape.alias("compactness"), shape.alias("circularity"), F.size("ring").alias("vertex_count"), "is_edge",
    )


def window_outcomes(results: DataFrame, windows: DataFrame) -> DataFrame:
    """(scene, with_masks, no_mask, candidates): windows of (scene, row, col) with and without a candidate."""
    found = mask_candidates(results).groupBy("scene", F.col("window_row").alias("row"), F.col("window_col").alias("col")).agg(F.count("*").alias("n"))
    rows = windows.select("scene", "row", "col").join(found, ["scene", "row", "col"], "left")
    return rows.groupBy("scene").agg(F.count("n").alias("with_masks"), F.count_if(F.col("n").isNull()).alias("no_mask"), F.coalesce(F.sum("n"), F.lit(0)).alias("candidates"))
