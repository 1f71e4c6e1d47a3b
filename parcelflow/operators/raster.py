"""Tile grids, pixel statistics and contrast stretching."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TILE, STEP, BINS = 640, 512, 2048


def offsets_clamped(length: Column) -> Column:
    """Starts of windows that cover all of a side: the last ones move back to fit.  Null where the side is too short."""
    return F.when(length >= TILE, F.array_distinct(F.transform(F.sequence(F.lit(0), length - 1, F.lit(STEP)), lambda r: F.least(r, length - TILE))))


def offsets_truncated(length: Column) -> Column:
    """Starts of windows that fit without moving; what is left over is not covered."""
    return F.when(length >= TILE, F.sequence(F.lit(0), length - TILE, F.lit(STEP)))


def grid(scenes: DataFrame, clamped: bool) -> DataFrame:
    """(scene, row, col) of every window of (scene, height, width); scenes smaller than a window have none."""
    at = offsets_clamped if clamped else offsets_truncated
    return scenes.where((F.col("height") >= TILE) & (F.col("width") >= TILE)).withColumn("row", F.explode(at(F.col("height")))).withColumn("col", F.explode(at(F.col("width")))).select("scene", "row", "col")


def centre_out(grid_: DataFrame, most: int = 60) -> DataFrame:
    """(scene, axis, place, rank): row and column offsets of each scene, those nearest to the middle one first, at most `most` of each.

    The middle is the offset at position n // 2 of a scene's n offsets in order.
    """
    both = [grid_.select("scene", F.lit(axis).alias("axis"), F.col(axis).alias("place")).distinct() for axis in ("row", "col")]
    by = Window.partitionBy("scene", "axis")
    rows = both[0].unionByName(both[1]).withColumn("k", F.row_number().over(by.orderBy("place")) - 1).withColumn("n", F.count("*").over(by))
    rows = rows.withColumn("middle", F.max(F.when(F.col("k") == F.floor(F.col("n") / 2), F.col("place"))).over(by))
    rank = F.row_number().over(by.orderBy(F.abs(F.col("place") - F.col("middle")), "place"))
    return rows.withColumn("rank", rank).where(F.col("rank") <= most).select("scene", "axis", "place", "rank")


def band_range(pixels: DataFrame) -> DataFrame:
    return pixels.groupBy("scene", "band").agg(F.min("value").alias("lo"), F.max("value").alias("hi"), F.count("*").alias("n"))


def histogram(pixels: DataFrame, bins: int = BINS) -> DataFrame:
    """(scene, band, lo, hi, bin, count): equal bins from the smallest to the largest value, the last one closed."""
    edges = band_range(pixels).select("scene", "band", "lo", F.when(F.col("hi") - F.col("lo") < 1e-6, F.col("lo") + 1.0).otherwise(F.col("hi")).alias("hi"))
    at = F.least(F.floor((F.col("value") - F.col("lo")) * bins / (F.col("hi") - F.col("lo"))), F.lit(bins - 1)).cast("int")
    return pixels.join(edges, ["scene", "band"]).groupBy("scene", "band", "lo", "hi", at.alias("bin")).agg(F.count("*").alias("count"))


def stretch_params(hist: DataFrame, low: float = 0.02, high: float = 0.98, bins: int = BINS) -> DataFrame:
    """(scene, band, p_lo, p_hi): left edges of the first bins whose cumulative share reaches each quantile."""
    w = Window.partitionBy("scene", "band")
    share = hist.withColumn("cum", F.sum("count").over(w.orderBy("bin")) / F.sum("count").over(w))
    found = share.groupBy("scene", "band", "lo", "hi").agg(F.min(F.when(F.col("cum") >= low, F.col("bin"))).alias("a"), F.min(F.when(F.col("cum") >= high, F.col("bin"))).alias("b"))
    found = found.withColumn("b", F.when(F.col("b") <= F.col("a"), F.least(F.col("a") + 1, F.lit(bins - 1))).otherwise(F.col("b")))
    edge = lambda k: F.col("lo") + F.col(k) * (F.col("hi") - F.col("lo")) / bins
    return found.select("scene", "band", edge("a").alias("p_lo"), edge("b").alias("p_hi"))


def stretched(pixels: DataFrame, params: DataFrame) -> DataFrame:
    """`pixels` with v8 from 0 to 255, truncated; 0 where the range is nothing."""
    width = F.col("p_hi") - F.col("p_lo")
    scaled = F.least(F.greatest((F.col("value") - F.col("p_lo")) / width * 255.0, F.lit(0.0)), F.lit(255.0))
    return pixels.join(params, ["scene", "band"]).withColumn("v8", F.when(width < 1e-6, 0).otherwise(F.floor(scaled).cast("int")))
