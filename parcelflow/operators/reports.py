"""Text reports of a data set: leakage, split and evaluation, as rows in an order of their own.

Each report is (section, item, line); in the order of section and item, then line, it reads as the text file.
Lists of scenes are as long as there are scenes and stay rows; only counts become one row.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .regroup import DROPPED
from .split import count_leaks, split_audit, split_sources, val_train_overlap

SETS = ("train", "val", "test")


def _lines(df: DataFrame, section: int, line: Column, item: Column | str = "") -> DataFrame:
    return df.select(F.lit(section).alias("section"), (item if isinstance(item, Column) else F.lit(item)).cast("string").alias("item"), line.alias("line"))


def _all(parts: Iterable[DataFrame]) -> DataFrame:
    first, *rest = parts
    for part in rest:
        first = first.unionByName(part)
    return first


def leakage(assigned: DataFrame, name: str = "tile_name") -> DataFrame:
    """The audit of a split into train and val: scenes of each, scenes and tile names of both, val tiles on train ground.

    There is a risk if any of the last three is not zero.  `assigned` needs tile_id, source, split, a box and `name`.
    """
    in_set = lambda s: F.max(F.col("split") == s)
    both = assigned.where(F.col("split").isin("train", "val"))
    scenes = both.groupBy("source").agg(in_set("train").alias("train"), in_set("val").alias("val"))
    shared = F.col("train") & F.col("val")
    names = both.groupBy(name).agg((in_set("train") & in_set("val")).alias("twice")).agg(F.count_if("twice").alias("n"))
    hit = val_train_overlap(both).agg(F.count("*").alias("n"))
    of = both.agg(F.count_if(F.col("split") == "val").alias("of"))
    listed = lambda test, k: _lines(scenes.where(test), k, F.concat(F.lit("  "), F.col("source").cast("string")), F.col("source"))
    total = lambda test, k, label: _lines(scenes.agg(F.count_if(test).alias("n")), k, F.concat(F.lit(f"{label}: "), F.col("n")))
    found = _all([scenes.agg(F.count_if(shared).alias("n")), names, hit]).agg(F.sum("n").alias("n"))
    # fixed values: the labels of the lines
    return _all([
        total(F.col("train"), 0, "train source_tif"), listed(F.col("train"), 1), total(F.col("val"), 2, "val source_tif"), listed(F.col("val"), 3),
        total(shared, 4, "shared source_tif"), listed(shared, 5), _lines(names, 6, F.concat(F.lit("dup tile_name count: "), F.col("n"))),
        _lines(hit.join(F.broadcast(of)), 7, F.concat(F.lit("val tiles overlapping train: "), F.col("n"), F.lit("/"), F.col("of"))),  # one row each
        _lines(found, 8, F.when(F.col("n") > 0, "DATA LEAKAGE RISK: YES").otherwise("DATA LEAKAGE RISK: NO")),
    ])


def splitting(assigned: DataFrame) -> DataFrame:
    """What a split gave: rows of each set and of the buffer, sets of each scene, scenes that two sets share, leaks."""
    sets = assigned.sparkSession.createDataFrame([(i, s) for i, s in enumerate(SETS)], "k int, split string")  # three rows
    counts = sets.join(split_audit(assigned), "split", "left").na.fill(0, ["rows", "positives", "negatives"])
    dropped = assigned.agg(F.count_if(F.col("split") == DROPPED).alias("n"))
    scenes = split_sources(assigned)
    of = lambda s: F.array_contains(F.split("splits", ","), s)
    pairs = [(a, b) for i, a in enumerate(SETS) for b in SETS[i + 1 :]]
    shared = scenes.agg(*(F.count_if(of(a) & of(b)).alias(f"n{i}") for i, (a, b) in enumerate(pairs)))
    leaks = count_leaks(assigned)
    return _all([
        _lines(counts, 0, F.format_string("  %-5s: rows %4d | positives %4d | negatives %4d", "split", "rows", "positives", "negatives"), F.col("k")),
        _lines(dropped, 1, F.concat(F.lit("  buffer: "), F.col("n"))),
        _lines(scenes, 2, F.concat(F.lit("  "), F.col("source").cast("string"), F.lit(": "), F.col("splits"), F.lit(" ("), F.col("n"), F.lit(")")), F.col("source")),
        *(_lines(shared, 3 + i, F.concat(F.lit(f"  {a} and {b} share: "), F.col(f"n{i}"))) for i, (a, b) in enumerate(pairs)),
        _lines(leaks, 6, F.concat(F.lit("  overlapping pairs across sets: "), F.col("n"))),
        _lines(leaks, 7, F.when(F.col("n") == 0, "  PASS").otherwise("  FAIL")),
    ])


def evaluation(scores: DataFrame) -> DataFrame:
    """(threshold, line_no, line) of what `evaluate.scores` found; without any ground truth one line says so."""
    none = F.col("tp") + F.col("fn") == 0
    share = lambda label, c: F.concat(F.lit(f"  {label:<10}: "), F.format_string("%.3f", c))
    lines = F.array(
        F.concat(F.lit("conf >= "), F.format_string("%.2f", "threshold")), F.concat(F.lit("TP / FP / FN: "), F.concat_ws(" / ", "tp", "fp", "fn")),
        share("Precision", "precision"), share("Recall", "recall"), share("F1", "f1"),
    )
    bare = F.array(F.concat(F.lit("conf >= "), F.format_string("%.2f", "threshold")), F.lit("no ground truth"))
    return scores.select("threshold", F.posexplode(F.when(none, bare).otherwise(lines)).alias("line_no", "line"))
