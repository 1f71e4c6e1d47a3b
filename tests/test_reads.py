"""Index by name, label files, GeoJSON, split folders; medians by selection; windows from blocks; splits by mode."""

import json
import math
import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from parcelflow.operators import selection, split
from parcelflow.sources import blocks, files

NAMES = [f.split()[0] for f in files.INDEX.split(", ")]


def test_index_by_name(spark, tmp_path):
    """Another order, extra columns, a byte order mark, blanks, missing columns."""
    path = tmp_path / "index.csv"
    path.write_text("﻿split,extra, tile_name ,source_tif,utm_xmax,instance_count\ntrain,x,t1,a.tif,7.5,3\nval,y,t2,b.tif,,\n", encoding="utf-8")
    one, two = sorted(files.read_index(spark, str(path)).collect(), key=lambda r: r.tile_name)
    assert files.read_index(spark, str(path)).columns == NAMES
    assert (one.tile_name, one.source_tif, one.split, one.utm_xmax, one.instance_count, one.utm_xmin) == ("t1", "a.tif", "train", 7.5, 3, None)
    assert (two.split, two.utm_xmax, two.instance_count) == ("val", None, None)
    with pytest.raises(ValueError, match="is_negative"):
        files.read_index(spark, str(path), ["tile_name", "is_negative"])
    full = files.read_index(spark, str(path)).withColumn("is_negative", F.lit(1))
    files.write_index(full.select(*reversed(NAMES), F.lit("z").alias("more")), str(tmp_path / "out"))
    assert sorted(map(str, files.read_index(spark, str(tmp_path / "out")).collect())) == sorted(map(str, full.collect()))


def test_label_files_geojson_splits(spark, tmp_path):
    rows = spark.createDataFrame([("b", 2, "0 2"), ("b", 1, "0 1"), ("a", 1, ""), ("b", 10, "0 10")], "tile string, line_no long, text string")
    assert {r.tile: r.content for r in files.label_files(rows).collect()} == {"a": "", "b": "0 1\n0 2\n0 10"}
    cands = spark.createDataFrame([(7, 0.5, 6.0, 1.0, 2.0, 3.0, 5.0)], "cand_id long, confidence double, area double, xmin double, ymin double, xmax double, ymax double")
    got = json.loads(files.geojson(cands).first().feature)
    assert got == {"type": "Feature", "properties": {"cand_id": 7, "confidence": 0.5, "area": 6.0}, "geometry": {"type": "Polygon", "coordinates": [[[1, 2], [3, 2], [3, 5], [1, 5], [1, 2]]]}}
    files.write_splits(spark.createDataFrame([(1, "train"), (2, "val")], "k long, split string"), str(tmp_path / "s"))
    assert spark.read.parquet(str(tmp_path / "s" / "split=val")).first().k == 2


@pytest.mark.parametrize(("bins", "few"), [(1024, 4096), (64, 3)])
def test_medians(spark, bins, few):
    rng = random.Random(6)
    groups = {"many": [rng.gauss(0, 1) for _ in range(3001)], "even": [rng.random() for _ in range(1000)], "same": [2.5] * 500, "ties": [float(rng.randint(0, 3)) for _ in range(999)], "one": [7.0], "two": [1.0, 2.0]}
    groups["wide"] = [rng.choice([-1, 1]) * 10.0 ** rng.randint(-300, 300) for _ in range(301)]
    groups["ends"] = [-1.7e308, 1.7e308, 0.0, 5.0, 6.0]
    rows = [(g, v) for g, vs in groups.items() for v in vs] + [("many", None), ("none", None), ("many", math.nan)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "g string, v double").repartition(4)
    got = {r.g: r.median for r in selection.medians(df, ["g"], "v", bins, few).collect()}
    assert got == {g: pytest.approx(statistics.median(vs), rel=1e-12) for g, vs in groups.items()}
    whole = [v for _, v in rows if v is not None and not math.isnan(v)]
    (all_,) = selection.medians(df, [], "v", bins, few).collect()
    assert all_.median == pytest.approx(statistics.median(whole)) and selection.medians(df.where("false"), [], "v").count() == 0
    assert selection.medians(df.where("false"), ["g"], "v").count() == 0


def test_windows_of_blocks(spark, tmp_path):
    """Windows over the borders of blocks, beyond the scene and outside it, against the array they come from."""
    rng = np.random.default_rng(4)
    scenes = {"a": rng.integers(0, 99, (70, 50)).astype(float), "b": rng.integers(0, 99, (10, 90)).astype(float)}
    mask = {k: rng.random(v.shape) < 0.2 for k, v in scenes.items()}
    rows = [(k, r, c, None if mask[k][r, c] else float(v[r, c]), float(r)) for k, v in scenes.items() for r in range(v.shape[0]) for c in range(v.shape[1])]
    path = str(tmp_path / "blocks")
    blocks.write_blocks(spark.createDataFrame(rows, "scene string, r int, c int, b2 double, b3 double"), path, ["b2", "b3"], 16)
    asked = [("a", 0, 0, 16, 16), ("a", 5, 7, 40, 30), ("a", 60, 40, 20, 20), ("a", 500, 0, 8, 8), ("b", 3, 14, 4, 70), ("a", 15, 15, 2, 2), ("a", 15, 15, 2, 2)]
    windows = spark.createDataFrame(asked, "scene string, row int, col int, height int, width int")
    read = blocks.read_windows(spark, path, windows, 16).withColumn("share", blocks.valid_share("px", ["b2", "b3"]))
    got = {(r.scene, r.row, r.col): r for r in read.collect()}
    assert len(got) == 6
    for scene, row, col, h, w in asked:
        v, m = scenes[scene][row : row + h, col : col + w], mask[scene][row : row + h, col : col + w]
        want = {r * w + c: (None if m[r, c] else v[r, c]) for r in range(v.shape[0]) for c in range(v.shape[1])}
        own = got[scene, row, col]
        assert {p.at: p.b2 for p in own.px} == want and [p.at for p in own.px] == sorted(want)
        assert own.share == pytest.approx((~m).sum() / (h * w))
    plan = blocks.read_windows(spark, path, windows, 16)._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(br,0)" in plan and "LessThanOrEqual(br,31)" in plan and "PartitionFilters" in plan
    assert blocks.read_windows(spark, path, windows.where("false"), 16).count() == 0


def test_splits_by_mode(spark):
    """Whole scenes in one split where they are apart; linked scenes together; bands where the mode says so."""
    rows = [(i, s, 1e6 * s + 100.0 * (i % 9), 0.0, 1e6 * s + 100.0 * (i % 9) + 50, 50.0, i % 2) for s in range(5) for i in range(s * 40, s * 40 + 40)]
    rows += [(1000, 9, 1e6 + 10, 0.0, 1e6 + 60, 50.0, 0)]  # scene 9 lies over scene 1
    tiles = spark.createDataFrame(rows, "tile_id long, source long, xmin double, ymin double, xmax double, ymax double, is_negative int")
    mode = lambda m: spark.createDataFrame([(m,)], "mode string")
    got = split.assigned_by_mode(tiles, mode("BY_TIF")).groupBy("source").agg(F.collect_set("split").alias("s")).collect()
    by = {r.source: r.s for r in got}
    assert all(len(s) == 1 for s in by.values()) and by[9] == by[1] and sorted(x for k, (x,) in by.items() if k != 9).count("train") == 3
    banded = split.band_assign(tiles, split.band_cuts(tiles)).select("tile_id", "split")
    assert sorted(map(tuple, split.assigned_by_mode(tiles, mode("SPATIAL")).select("tile_id", "split").collect())) == sorted(map(tuple, banded.collect()))
    with pytest.raises(Exception, match="fewer than two"):
        split.assigned_by_mode(tiles.where("source = 2"), mode("BY_TIF")).collect()
