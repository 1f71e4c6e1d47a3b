"""Loaders, and views that give general tables the shapes of tiles, detections, pixels and label lines.

All coordinates are whole numbers held as doubles, so areas are exact in any engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TILE = 6400.0


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(tile_id, source, xmin, ymin, xmax, ymax, is_negative) from orders: tiles of 640 pixels of 10 m, 512 apart."""
    k = F.col("o_orderkey")
    rows = load(spark, sf_dir, "orders").select(
        k.alias("tile_id"), (k % 6).alias("source"), (5120.0 * ((37 * k) % 61)).alias("xmin"), (5120.0 * ((k * k + 17 * k) % 2003)).alias("ymin"), F.when(k % 4 == 0, 0).otherwise(1).alias("is_negative")
    )
    return rows.withColumns({"xmax": F.col("xmin") + TILE, "ymax": F.col("ymin") + TILE})


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(cand_id, source, image, xmin, ymin, xmax, ymax, side, area, confidence, is_edge) from events."""
    k = F.col("event_id")
    rows = load(spark, sf_dir, "events").select(
        k.alias("cand_id"), (k % 6).alias("source"), (F.floor(k / 2) % 50).alias("image"), (200.0 * ((17 * F.col("user_id") + k % 13) % 150)).alias("xmin"),
        (40.0 * ((k * k + 7 * k) % 997)).alias("ymin"), (200.0 + 20 * (k % 5)).alias("side"), (((7919 * k) % 10000) / 10000.0).cast("double").alias("confidence"), (k % 2).alias("is_edge"),
    )
    return rows.withColumns({"xmax": F.col("xmin") + F.col("side"), "ymax": F.col("ymin") + F.col("side"), "area": F.col("side") * F.col("side")})


def pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(scene, band, value) of valid pixels from lineitem."""
    rows = load(spark, sf_dir, "lineitem")
    return rows.where("l_discount > 0").select(F.col("l_returnflag").alias("scene"), F.col("l_linenumber").alias("band"), F.col("l_extendedprice").alias("value"))


def window_pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(scene, window, pixel, band, value) from lineitem; a value is masked where there is no discount."""
    k = F.col("l_orderkey")
    rows = load(spark, sf_dir, "lineitem")
    return rows.select((k % 7).alias("scene"), (k % 211).alias("window"), F.floor(k / 211).alias("pixel"), F.col("l_linenumber").alias("band"), F.when(F.col("l_discount") > 0.01, F.col("l_extendedprice")).alias("value"))


def label_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(file, line_no, text) from events; event_id % 9 says which fault the line has."""
    digits = lambda n: F.concat(F.lit("0."), F.lpad((F.col("event_id") * n % 80).cast("string"), 2, "0"))
    a, b = digits(7), digits(11)
    good = F.concat_ws(" ", a, b, F.concat(a, F.lit("5")), b, F.concat(a, F.lit("5")), F.concat(b, F.lit("7")))
    kind = F.col("event_id") % 9
    text = (
        F.when(kind == 0, F.concat(F.lit("0 "), good))
        .when(kind == 1, F.lit("  "))
        .when(kind == 2, F.concat(F.lit("1 "), good))
        .when(kind == 3, F.concat_ws(" ", F.lit("0"), a, b, a, b, a))
        .when(kind == 4, F.concat(F.lit("0 "), good, F.lit(" 0.9")))
        .when(kind == 5, F.concat_ws(" ", F.lit("0"), a, b, F.lit("0.91"), b, F.lit("0.95"), F.lit("1.5")))
        .when(kind == 6, F.concat_ws(" ", F.lit("0 nan"), b, a, a, b, b))
        .when(kind == 7, F.concat_ws(" ", F.lit("0"), a, b, a, b, a, b))
        .otherwise(F.concat_ws(" ", F.lit("0 a"), b, a, a, b, b))
    )
    return load(spark, sf_dir, "events").select((F.col("event_id") % 200).alias("file"), F.col("event_id").alias("line_no"), text.alias("text"))
