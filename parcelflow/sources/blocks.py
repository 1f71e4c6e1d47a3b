"""Rasters as tables of blocks, and reads of masked windows from them.

A block holds the pixels of a square of a scene.  The table lies in a folder a scene, sorted by row of
blocks, so a read of some windows opens the folders of their scenes and skips row groups by the least and
largest row of blocks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Pixels along a side of a block.
SIDE = 256


def write_blocks(pixels: DataFrame, path: str, bands: list[str], side: int = SIDE) -> None:
    """Writes pixels (scene, r, c, one column a band; null where masked) as blocks (scene, br, bc, px), px sorted by place.

    A block takes side * side pixels at most; a pixel that repeats keeps one of its values.
    """
    place = ((F.col("r") % side) * side + F.col("c") % side).cast("int")
    each = pixels.select("scene", F.floor(F.col("r") / side).cast("int").alias("br"), F.floor(F.col("c") / side).cast("int").alias("bc"), place.alias("at"), *(F.col(b).cast("double").alias(b) for b in bands))
    each = each.dropDuplicates(["scene", "br", "bc", "at"])
    blocks = each.groupBy("scene", "br", "bc").agg(F.array_sort(F.collect_list(F.struct("at", *bands))).alias("px"))
    blocks.repartitionByRange("scene", "br", "bc").sortWithinPartitions("scene", "br", "bc").write.partitionBy("scene").parquet(path)


def read_windows(spark: SparkSession, path: str, windows: DataFrame, side: int = SIDE) -> DataFrame:
    """(scene, row, col, height, width, px): the pixels (at, bands) of each window (scene, row, col, height, width), in order.

    at counts along the rows of the window.  Windows may reach over any number of blocks and beyond the
    scene; pixels that no block holds are left out, and a window without any has an empty list.
    """
    asked = windows.select("scene", "row", "col", "height", "width").distinct().where("height > 0 and width > 0")
    span = asked.agg(F.min(F.floor(F.col("row") / side)), F.max(F.floor((F.col("row") + F.col("height") - 1) / side))).first()
    blocks = spark.read.parquet(path)
    if span[0] is not None:  # two numbers, for the row groups
        blocks = blocks.where(F.col("br").between(span[0], span[1]))
    steps = lambda a, n: F.explode(F.sequence(F.floor(F.col(a) / side).cast("int"), F.floor((F.col(a) + F.col(n) - 1) / side).cast("int")))
    cells = asked.withColumn("br", steps("row", "height")).withColumn("bc", steps("col", "width"))
    met = cells.join(blocks, ["scene", "br", "bc"])
    r, c = (lambda p: F.col("br") * side + F.floor(p["at"] / side) - F.col("row")), (lambda p: F.col("bc") * side + p["at"] % side - F.col("col"))
    inside = F.filter("px", lambda p: (r(p) >= 0) & (r(p) < F.col("height")) & (c(p) >= 0) & (c(p) < F.col("width")))
    bands = [f.name for f in blocks.schema["px"].dataType.elementType.fields if f.name != "at"]
    moved = F.transform(inside, lambda p: F.struct((r(p) * F.col("width") + c(p)).cast("int").alias("at"), *(p[b].alias(b) for b in bands)))
    key = ["scene", "row", "col", "height", "width"]
    found = met.select(*key, moved.alias("px")).groupBy(*key).agg(F.array_sort(F.flatten(F.collect_list("px"))).alias("px"))  # height * width pixels at most
    none = F.array().cast(found.schema["px"].dataType)
    return asked.join(found, key, "left").withColumn("px", F.coalesce("px", none))


def common_valid(px: str | Column, bands: list[str]) -> Column:
    """The pixels that no band masks and that are finite in all."""
    good = lambda p: [p[b].isNotNull() & ~F.isnan(p[b]) & (F.abs(p[b]) != float("inf")) for b in bands]

    def every(p: Column) -> Column:
        first, *rest = good(p)
        for x in rest:
            first = first & x
        return first

    return F.filter(px, every)


def valid_share(px: str | Column, bands: list[str]) -> Column:
    """Valid pixels of all pixels of a window; what lies beyond the scene is not valid."""
    return F.size(common_valid(px, bands)) / (F.col("height") * F.col("width"))
