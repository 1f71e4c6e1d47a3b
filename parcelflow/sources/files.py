"""Readers and writers of the files of a tiled dataset."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The fields of a tile index.
INDEX = "tile_name string, source_tif string, source_crs string, target_crs string, utm_xmin double, utm_ymin double, utm_xmax double, utm_ymax double, pixel_size_m double, split string, instance_count int, is_negative int"

#: Names of rasters and of polygon layers.
RASTERS, LAYERS = "*.{tif,tiff,TIF,TIFF}", "*.{shp,SHP}"


def find(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """(path, stem) of files that match, each once."""
    rows = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder).select("path").distinct()
    return rows.withColumn("stem", F.regexp_extract("path", r"([^/]*?)(\.[^./]*)?$", 1))


def read_index(spark: SparkSession, path: str, required: list[str] | None = None) -> DataFrame:
    """A tile index, its columns found by the names in its header; missing required columns are an error.

    Order doesn't matter, a byte order mark and blanks around names are taken off, other columns are left
    out, and known ones that the file lacks are null.
    """
    rows = spark.read.option("header", True).option("encoding", "UTF-8").csv(path)
    rows = rows.toDF(*(c.lstrip("\ufeff").strip() for c in rows.columns))
    missing = [c for c in (required or ["tile_name", "source_tif", "split"]) if c not in rows.columns]
    if missing:
        raise ValueError(f"the tile index lacks {missing}")
    fields = [f.split() for f in INDEX.split(", ")]
    return rows.select(*((F.col(f"`{c}`") if c in rows.columns else F.lit(None)).cast(kind).alias(c) for c, kind in fields))


def write_index(df: DataFrame, path: str) -> None:
    df.select([f.split()[0] for f in INDEX.split(", ")]).write.mode("overwrite").option("header", True).csv(path)


def read_training_log(spark: SparkSession, path: str) -> DataFrame:
    """The table that training leaves, a row an epoch; names and values lose the blanks around them."""
    rows = spark.read.option("header", True).option("inferSchema", True).option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True).csv(path)
    return rows.toDF(*(c.strip() for c in rows.columns))


def reports_done(spark: SparkSession, paths: list[str]) -> bool:
    """Whether every report is there and names its threshold and its true positives."""
    from pyspark.errors import AnalysisException

    try:
        texts = spark.read.text(paths, wholetext=True)
    except AnalysisException:  # one of them is missing
        return False
    return texts.where(F.col("value").contains("threshold=") & F.col("value").contains("TP=")).count() == len(set(paths))


def read_labels(spark: SparkSession, folder: str) -> DataFrame:
    """(file, line_no, text): every line of every label file, also of empty files."""
    sc = spark.sparkContext  # file sources of DataFrames skip files of no length, which mark tiles without instances
    whole = sc.wholeTextFiles(folder, sc.defaultParallelism).toDF("path string, value string")
    rows = whole.select(F.element_at(F.split("path", "/"), -1).alias("file"), F.posexplode(F.split("value", "\n")).alias("k", "text"))
    return rows.select("file", (F.col("k") + 1).cast("long").alias("line_no"), "text")


def label_files(labels: DataFrame) -> DataFrame:
    """(tile, content) from (tile, line_no, text): one text a tile; tiles without lines have an empty one."""
    rows = labels.groupBy("tile").agg(F.sort_array(F.collect_list(F.struct("line_no", "text"))).alias("l"))
    return rows.select("tile", F.array_join(F.transform("l", lambda x: x["text"]), "\n").alias("content"))


def geojson(cands: DataFrame) -> DataFrame:
    """(feature): one GeoJSON feature a detection, ready for write.text."""
    at = lambda x, y: F.array(F.col(x), F.col(y))
    ring = F.array(at("xmin", "ymin"), at("xmax", "ymin"), at("xmax", "ymax"), at("xmin", "ymax"), at("xmin", "ymin"))
    shape = F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates"))
    return cands.select(F.to_json(F.struct(F.lit("Feature").alias("type"), F.struct("cand_id", "confidence", "area").alias("properties"), shape.alias("geometry"))).alias("feature"))


def write_splits(assigned: DataFrame, path: str) -> None:
    """Rows by split, the folders that training reads."""
    assigned.write.mode("overwrite").partitionBy("split").parquet(path)
