"""Plain records of a tiled dataset: attributes, ids, samples, pixel masks, audits and report lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .split import hash_rank
from ..functions.geom import exterior, ring_area, ring_centroid
from ..plans.storage import cut

#: Least area of a polygon by version, share of valid pixels, samples of a split, yield of a scene.
LEAST_AREA = {"v1": 100.0, "v2": 1.0}
VALID, SAMPLE, YIELD = 0.20, {"train": 20, "val": 15}, 30


def attributes(cands: DataFrame) -> DataFrame:
    """The output columns of a detection, rounded half up as SQL does; circularity repeats compactness."""
    shape = F.round(F.col("compactness"), 4)
    return cands.select("cand_id", F.round("confidence", 4).alias("confidence"), F.round("area", 2).alias("area_m2"), F.round("perimeter", 2).alias("perimeter"), shape.alias("compactness"), shape.alias("circularity"), F.col("vertex_count").cast("int").alias("vertex_count"), F.col("is_edge").cast("int").alias("is_edge"))


def large_enough(version: str, area: str = "area") -> Column:
    return F.col(area) >= LEAST_AREA[version]


def with_ids(df: DataFrame, *order: str) -> DataFrame:
    """`df` with id from 0 on in an order.  Ranges are numbered apart, and one count a range is broadcast."""
    ranged = cut(df.repartitionByRange(*order).withColumn("__range", F.spark_partition_id()))
    counts = ranged.groupBy("__range").agg(F.count("*").alias("c"))
    base = counts.select("__range", (F.sum("c").over(Window.orderBy("__range")) - F.col("c")).alias("base"))
    row = F.row_number().over(Window.partitionBy("__range").orderBy(*order))
    return ranged.withColumn("k", row).join(F.broadcast(base), "__range").withColumn("id", F.col("base") + F.col("k") - 1).drop("__range", "k", "base")


def plausible_utm() -> Column:
    """Whether a box lies where metres of a UTM zone lie."""
    return (F.col("xmin") > 1e5) & (F.col("xmin") < 1.5e6) & (F.col("ymin") > 0) & (F.col("ymin") < 1e7)


def checked_utm(tiles: DataFrame) -> DataFrame:
    """`tiles`; a box outside of what UTM metres can be is an error when the rows are read."""
    ok = F.when(plausible_utm(), F.lit(True)).otherwise(F.raise_error(F.lit("coordinates are not metres of a UTM zone")).cast("boolean"))
    return tiles.where(ok)


def valid_pixels(values: DataFrame) -> DataFrame:
    """(scene, window, pixel, valid): pixels none of whose bands is masked (null), NaN or infinite."""
    good = F.col("value").isNotNull() & ~F.isnan("value") & (F.abs("value") != float("inf"))
    return values.groupBy("scene", "window", "pixel").agg(F.bool_and(good).alias("valid"))


def valid_share(values: DataFrame) -> DataFrame:
    """(scene, window, share, used): windows are used from a fifth of valid pixels on."""
    share = F.avg(F.col("valid").cast("int"))
    return valid_pixels(values).groupBy("scene", "window").agg(share.alias("share")).withColumn("used", F.col("share") >= VALID)


def scene_totals(values: DataFrame, masks: DataFrame) -> DataFrame:
    """(scene, windows, valid, with_masks, candidates): masks has (scene, window, n) with the raw candidates of a window."""
    rows = valid_share(values).join(masks, ["scene", "window"], "left")
    n = F.coalesce("n", F.lit(0))
    return rows.groupBy("scene").agg(F.count("*").alias("windows"), F.count_if("used").alias("valid"), F.count_if(F.col("used") & (n > 0)).alias("with_masks"), F.sum(F.when(F.col("used"), n).otherwise(0)).alias("candidates"))


def window_bounds(grid: DataFrame, scenes: DataFrame, size: int = 640, res: float = 10.0) -> DataFrame:
    """(scene, row, col, xmin, ymin, xmax, ymax) of windows in map coordinates; scenes has (scene, x0, y0), the upper left corner."""
    at = grid.join(scenes, "scene")
    x, y = F.col("x0") + F.col("col") * res, F.col("y0") - F.col("row") * res
    return at.select("scene", "row", "col", x.alias("xmin"), (y - size * res).alias("ymin"), (x + size * res).alias("xmax"), y.alias("ymax"))


def tile_name(number: Column, stem: Column, row: Column, col: Column) -> Column:
    return F.format_string("t%02d_%s_r%05d_c%05d", number.cast("int"), stem, row.cast("int"), col.cast("int"))


def conf_name(threshold: Column) -> Column:
    return F.format_string("conf_%03d", F.round(threshold * 100).cast("int"))


def first_of(df: DataFrame, by: str, most: int, *order: str) -> DataFrame:
    """The first rows of each group in an order."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(by).orderBy(*order))).where(F.col("rank") <= most)


def quality_sample(images: DataFrame) -> DataFrame:
    """Images to look at: of those with instances, so many of each split by a hash of their name.

    A split is ranked within bins of the first digits of the hash and each bin keeps its first rows, so what
    is ranked as a whole has a row limit times 256, whatever the table.
    """
    most = F.when(F.col("split") == "train", SAMPLE["train"]).when(F.col("split") == "val", SAMPLE["val"]).otherwise(0)
    rows = images.where("n_inst > 0").withColumn("h", hash_rank("image")).withColumn("bin", F.substring("h", 1, 2))
    rows = rows.withColumn("place", F.row_number().over(Window.partitionBy("split", "bin").orderBy("h", "image"))).where(F.col("place") <= most)
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy("split").orderBy("h", "image")))
    return ranked.where(F.col("rank") <= most).select("split", "image", "rank")


def until_yield(windows: DataFrame, most: int = YIELD) -> DataFrame:
    """Windows of each scene in scan order up to the one that completes the yield; `has_mask` says what counts."""
    seen = F.sum(F.col("has_mask").cast("long")).over(Window.partitionBy("scene").orderBy("row", "col").rowsBetween(Window.unboundedPreceding, -1))
    return windows.withColumn("before", F.coalesce(seen, F.lit(0))).where(F.col("before") < most).drop("before")


def thinned(ring: Column, most: int) -> Column:
    """At most so many points, evenly from the first to the last."""
    at = F.transform(F.sequence(F.lit(0), F.lit(most - 1)), lambda i: F.floor(i * (F.size(ring) - 1) / (most - 1)).cast("int"))
    return F.when(F.size(ring) > most, F.transform(at, lambda i: F.get(ring, i))).otherwise(ring)


def polygon_parts(shapes: DataFrame) -> DataFrame:
    """(shape_id, part, n_points, area, cx, cy) of (shape_id, parts): each part a row, its exterior ring without the
    closing point and without holes; parts of fewer than three points are left out."""
    rows = shapes.select("shape_id", F.posexplode("parts").alias("part", "rings")).withColumn("ring", exterior(F.col("rings")))
    rows = rows.where(F.size("ring") >= 3)
    centre = ring_centroid(F.col("ring"))
    return rows.select("shape_id", "part", F.size("ring").alias("n_points"), ring_area(F.col("ring")).alias("area"), centre["x"].alias("cx"), centre["y"].alias("cy"))


def conservation(assigned: DataFrame, total: DataFrame) -> DataFrame:
    """One row of counts, and whether every tile has one split."""
    got = assigned.agg(F.count_if(F.col("split") == "train").alias("n_train"), F.count_if(F.col("split") == "val").alias("n_val"), F.count("*").alias("n_rows"), F.count_distinct("tile_id").alias("n_tiles"))
    rows = got.join(total.agg(F.count("*").alias("n_total")))  # one row each
    return rows.withColumn("whole", (F.col("n_train") + F.col("n_val") == F.col("n_total")) & (F.col("n_tiles") == F.col("n_total")))


def paired_audit(images: DataFrame, labels: DataFrame) -> DataFrame:
    """(split, images, labels, paired, verdict) of (key, split) listings: PASS where each image has its label and each label its image."""
    both = images.select("key", "split", F.lit(1).alias("i")).join(labels.select("key", "split", F.lit(1).alias("l")), ["key", "split"], "full_outer")
    out = both.groupBy("split").agg(F.count("i").alias("images"), F.count("l").alias("labels"), F.count_if(F.col("i").isNotNull() & F.col("l").isNotNull()).alias("paired"))
    ok = (F.col("images") == F.col("paired")) & (F.col("labels") == F.col("paired"))
    return out.withColumn("verdict", F.when(ok, "PASS").otherwise("FAIL"))


def split_mode(scene_pairs: DataFrame, tile_pairs: DataFrame) -> DataFrame:
    """(scene_pairs, tile_pairs, mode): SPATIAL where scenes or tiles of different sources overlap, else BY_TIF; `tile_pairs` has their number n."""
    rows = scene_pairs.agg(F.count("*").alias("scene_pairs")).join(tile_pairs.select(F.col("n").alias("tile_pairs")))  # one row each
    return rows.withColumn("mode", F.when((F.col("scene_pairs") > 0) | (F.col("tile_pairs") > 0), "SPATIAL").otherwise("BY_TIF"))


def layers(parts: dict[str, DataFrame]) -> DataFrame:
    """All rows of several layers, with the name of each."""
    out = None
    for name, df in parts.items():
        rows = df.withColumn("layer", F.lit(name))
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    return out


def report_lines(summary: DataFrame) -> DataFrame:
    """(threshold, line_no, line) of the text report of each threshold, ready for write.text."""
    lines = F.array(
        F.concat(F.lit("threshold="), F.format_string("%.2f", "threshold")), F.concat(F.lit("instances="), F.col("n")),
        F.concat(F.lit("area min="), F.format_string("%.2f", "min_area"), F.lit(" max="), F.format_string("%.2f", "max_area")),
        F.concat(F.lit("median confidence="), F.format_string("%.5f", "median_confidence")),
    )
    return summary.select("threshold", F.posexplode(lines).alias("line_no", "line"))


def dataset_yaml(folder: str, names: list[str]) -> str:
    """The description that training reads; it is a few lines, whatever the data."""
    return "\n".join([f"path: {folder}", "train: images/train", "val: images/val", "test: images/test", "names:", *(f"  {i}: {n}" for i, n in enumerate(names))]) + "\n"
