"""Files of image and label pairs dealt to new split folders."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed value: the split of tiles that a buffer drops; they are neither copied nor missing.
DROPPED = "DROPPED_BUFFER"


def other(split: Column) -> Column:
    """Where a file is looked for when it isn't in the folder that the index names."""
    return F.when(split == "train", "val").otherwise("train")


def plan_pairs(assigned: DataFrame, images: DataFrame, labels: DataFrame) -> DataFrame:
    """(tile, split, image_from, label_from, status) for each row of `assigned` (tile, old_split, split).

    `images` and `labels` list files as (tile, split); repeated rows count once.  A file is taken from the old
    split's folder, else from the other one's; status is 'copied', or which of the two is missing.
    Rows without a split or dropped by a buffer are left out.  One shuffle on the tile: listings are sets of
    folders by the time they meet the index.
    """
    files = images.select("tile", F.lit("i").alias("kind"), "split").unionByName(labels.select("tile", F.lit("l").alias("kind"), "split"))
    folders = lambda kind: F.collect_set(F.when(F.col("kind") == kind, F.col("split")))
    have = files.where(F.col("tile").isNotNull()).groupBy("tile").agg(folders("i").alias("image_in"), folders("l").alias("label_in"))
    rows = assigned.where(F.col("split").isNotNull() & (F.col("split") != DROPPED)).join(have, "tile", "left")
    old = F.col("old_split")
    source = lambda c: F.when(F.array_contains(c, old), old).when(F.array_contains(c, other(old)), other(old))
    rows = rows.withColumns({"image_from": source(F.col("image_in")), "label_from": source(F.col("label_in"))})
    no_image, no_label = F.col("image_from").isNull(), F.col("label_from").isNull()
    status = F.when(no_image & no_label, "missing_both").when(no_image, "missing_image").when(no_label, "missing_label").otherwise("copied")
    return rows.select("tile", "split", "image_from", "label_from", status.alias("status"))


def publish(plan: DataFrame, images: DataFrame, labels: DataFrame, path: str) -> DataFrame:
    """Writes whole pairs (tile, image, label) by split under `path`; returns the rows of `plan` that have none.

    `images` and `labels` hold contents as (tile, split, content).  Pairs go to a staging folder beside `path`
    first, which takes its place only after its rows were found to be those of the plan; until then readers see
    the earlier data set.  A run that fails leaves `path` as it was.
    """
    spark = plan.sparkSession
    todo = plan.where("status = 'copied'")
    image, label = (df.select("tile", F.col("split").alias(f"{n}_from"), F.col("content").alias(n)) for df, n in ((images, "image"), (labels, "label")))
    pairs = todo.join(image, ["tile", "image_from"]).join(label, ["tile", "label_from"]).select("tile", "image", "label", "split")
    staging = f"{path.rstrip('/')}.staging-{uuid.uuid4().hex}"
    pairs.write.partitionBy("split").parquet(staging)
    wanted = _totals(todo)
    if wanted != (written := _totals(spark.read.schema(pairs.schema).parquet(staging))):
        _files(spark, staging).delete(_path(spark, staging), True)
        raise ValueError(f"pairs by split differ from the plan: {written}, not {wanted}")
    _swap(spark, staging, path)
    return plan.where("status <> 'copied'")


def _totals(rows: DataFrame) -> dict[str, tuple[int, int]]:
    """Rows of each split and a checksum of their tiles: as many values as there are splits."""
    found = rows.groupBy("split").agg(F.count("*").alias("n"), F.sum(F.pmod(F.xxhash64(F.col("tile").cast("string")), F.lit(1 << 30))).alias("sum"))
    return {r.split: (r.n, r["sum"]) for r in found.collect()}


def _path(spark: SparkSession, path: str):  # noqa: ANN202
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _files(spark: SparkSession, path: str):  # noqa: ANN202
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def _swap(spark: SparkSession, staging: str, path: str) -> None:
    fs, here = _files(spark, path), _path(spark, path)
    earlier = _path(spark, f"{path.rstrip('/')}.earlier-{uuid.uuid4().hex}")
    had = fs.exists(here)
    if had and not fs.rename(here, earlier):
        raise OSError(f"cannot move {path} aside")
    if not fs.rename(_path(spark, staging), here):
        if had:
            fs.rename(earlier, here)
        raise OSError(f"cannot publish {path}")
    if had:
        fs.delete(earlier, True)
