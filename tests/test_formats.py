"""Shapefiles, PNG, logs and reports: what is written is read back, and what is no such file is an error."""

import os
import struct
import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from parcelflow.operators import infer, masks
from parcelflow.plans import queries
from parcelflow.sources import files, png, shapes

ELL = [(0.0, 0.0), (4.0, 0.0), (4.0, 2.0), (2.0, 2.0), (2.0, 4.0), (0.0, 4.0)]
UTM = 'PROJCS["WGS_1984_UTM_Zone_48N",GEOGCS["GCS_WGS_1984"]]'


def layer(rings):
    records = [shapes._record([np.array(r + r[:1], float) for r in poly])[0] for poly in rings]
    body = b"".join(struct.pack(">2i", k, len(r) // 2) + r for k, r in enumerate(records, 1))
    return shapes._header(100 + len(body), [0.0] * 4) + body


def test_layers_and_their_gate(spark, tmp_path):
    hole = [(0.5, 0.5), (1.0, 0.5), (1.0, 1.0), (0.5, 1.0)]  # counter-clockwise, so a hole
    far = [(9.0, 9.0), (9.0, 10.0), (10.0, 10.0), (10.0, 9.0)]
    (tmp_path / "a.shp").write_bytes(layer([[ELL[::-1], hole, far]]))
    (tmp_path / "a.prj").write_text(UTM.replace(",", ",\n", 1))
    got = shapes.read_layers(spark, str(tmp_path), "WGS_1984_UTM_Zone_48N").first()
    assert [[len(r) for r in p] for p in got.parts] == [[7, 5], [5]]
    with pytest.raises(ValueError, match="not in"):
        shapes.read_layers(spark, str(tmp_path), "WGS_1984_UTM_Zone_49N")
    (tmp_path / "b.shp").write_bytes(shapes.empty())
    with pytest.raises(ValueError, match="b.shp"):  # no system
        shapes.read_layers(spark, str(tmp_path), "WGS_1984_UTM_Zone_48N")


def test_layer_without_polygons(spark, tmp_path):
    (tmp_path / "b.shp").write_bytes(shapes.empty())
    (tmp_path / "b.prj").write_text(UTM)
    with pytest.raises(ValueError, match="no polygons"):
        shapes.read_layers(spark, str(tmp_path), "WGS_1984_UTM_Zone_48N")
    with pytest.raises(ValueError, match="shapefile"):
        list(shapes.polygons_of(b"x" * 200))


def test_written_layer(spark):
    df = spark.createDataFrame([("a", ELL, 1.5), ("a", ELL[:2], 2.0)], "layer string, ring array<struct<x:double,y:double>>, v double")
    f = shapes.encode(df, "layer", ["v"]).first()
    (number, parts), = shapes.polygons_of(bytes(f.shp))
    assert number == 1 and np.array_equal(parts[0][0][:-1][::-1], np.array(ELL))
    assert len(f.shx) == 108 and b"1.500000" in bytes(f.dbf) and struct.unpack_from("<I", bytes(f.dbf), 4)[0] == 1
    counts = shapes.cleaning_counts(spark.createDataFrame([(1, [1]), (2, []), (3, None), (4, [2])], "k int, parts array<int>"), F.col("k") < 4).first()
    assert tuple(counts) == (4, 2, 1, 1)


@pytest.mark.parametrize("channels", [1, 2, 3, 4])
def test_png_filters(channels):
    rng = np.random.default_rng(channels)
    image = rng.integers(0, 256, (10, 7, channels), dtype=np.uint8)
    assert np.array_equal(png.from_png(png.to_png(image)), image)
    kind = {1: 0, 2: 4, 3: 2, 4: 6}[channels]
    flat, lines = image.reshape(10, -1).astype(int), []
    for y in range(10):  # each line by another filter
        f, row = y % 5, []
        for i in range(flat.shape[1]):
            a, b = flat[y, i - channels] if i >= channels else 0, flat[y - 1, i] if y else 0
            c = flat[y - 1, i - channels] if y and i >= channels else 0
            row.append((flat[y, i] - [0, a, b, (a + b) // 2, png._paeth(a, b, c)][f]) % 256)
        lines.append(bytes([f, *map(int, row)]))
    head = struct.pack(">2I5B", 7, 10, 8, kind, 0, 0, 0)
    content = png.MAGIC + png._chunk(b"IHDR", head) + png._chunk(b"IDAT", zlib.compress(b"".join(lines))) + png._chunk(b"IEND", b"")
    assert np.array_equal(png.from_png(content), image)


def test_png_errors():
    with pytest.raises(ValueError, match="PNG"):
        png.from_png(b"GIF89a")


def test_logs_reports_models(spark, tmp_path):
    (tmp_path / "results.csv").write_text("  epoch,  time\n 1, 0.5\n 2, 0.75\n")
    rows = files.read_training_log(spark, str(tmp_path / "results.csv"))
    assert rows.columns == ["epoch", "time"] and [tuple(r) for r in rows.collect()] == [(1, 0.5), (2, 0.75)]
    one, two = tmp_path / "r1.txt", tmp_path / "r2.txt"
    one.write_text("threshold=0.35\nTP=4\n")
    assert not files.reports_done(spark, [str(one), str(two)])
    two.write_text("threshold=0.50\n")
    assert not files.reports_done(spark, [str(one), str(two)])
    two.write_text("threshold=0.50\nTP=1\n")
    assert files.reports_done(spark, [str(one), str(two)])
    for name in ("a.tif", "b.TIFF", "c.txt"):
        (tmp_path / name).write_text("x")
    assert sorted(r.stem for r in files.find(spark, str(tmp_path), files.RASTERS).collect()) == ["a", "b"]
    assert infer.checked_task({"task": "segment"})
    with pytest.raises(ValueError, match="segment"):
        infer.checked_task({"task": "detect"})


def test_png_read_in_batches(spark, monkeypatch):
    """Many small images are passed on together, not one by one."""
    files = spark.createDataFrame([(f"i{k}", png.to_png(np.full((2, 3, 1), k, np.uint8))) for k in range(50)], "name string, content binary").coalesce(1)
    seen = []
    monkeypatch.setattr(type(files), "mapInPandas", lambda self, f, schema: seen.append(list(f(iter([self.toPandas()])))) or self)
    png.decoded(files)
    assert [len(b) for b in seen[0]] == [50]
    assert [p[0] for p in seen[0][0]["pixels"]] == list(range(50))


def test_batches_leave_together(spark):
    """The model gets few windows at a time, what it finds leaves in large tables, and a one-task table is dealt out by the query."""
    sizes = spark.sparkContext.accumulator(0)
    calls = spark.sparkContext.accumulator(0)

    def load():
        def model(frame):
            calls.add(1)
            sizes.add(int(len(frame) > 8))
            return infer.stub_model()(frame)

        return model

    windows = spark.range(3000).coalesce(1).selectExpr("cast(id % 7 as string) scene", "cast(id * 512 as int) row", "cast(id * 1024 as int) col")
    found = infer.detect(windows, load)
    tables = found.mapInPandas(lambda frames: (pd.DataFrame({"n": [len(f)]}) for f in frames), "n long").collect()
    assert sum(r.n for r in tables) == 3000 and len(tables) <= 6
    assert calls.value == 375 and sizes.value == 0
    stub = queries.queries()["infer_stub"](spark, "/root/testdata/sf0.001") if os.path.isdir("/root/testdata/sf0.001") else None
    assert stub is None or stub.rdd.getNumPartitions() >= 4


def test_rings_of_masks_are_made_once(spark):
    """Of a ring the plan has one area and one perimeter, however often they are used."""
    ring = F.transform(F.sequence(F.lit(0), (F.col("id") % 5).cast("int")), lambda i: F.struct((10.0 * i + F.col("id")).alias("x"), (i * i * 10.0).alias("y")))
    zero, k = F.lit(0), F.col("id")
    rows = spark.range(50).select(zero.alias("scene"), zero.alias("row"), zero.alias("col"), k.alias("k"), ring.alias("ring"), F.lit(0.5).alias("confidence"), F.lit(0.0).alias("x0"), F.lit(0.0).alias("y0"))
    got = masks.mask_candidates(rows)
    assert got._jdf.queryExecution().optimizedPlan().toString().count("zip_with(") <= 2
    assert sorted(r.k for r in got.collect()) == [k for k in range(50) if k % 5 >= 2]
    assert masks.mask_candidates(rows.withColumn("ring", F.when(F.col("k") > 9, F.col("ring")))).count() == sum(k > 9 and k % 5 >= 2 for k in range(50))


def test_records_as_one_by_one(spark):
    """Rings of many lengths, turning both ways, give the bytes that one at a time give, and come back closed and clockwise."""
    rng = np.random.default_rng(2)
    rings = [rng.integers(0, 1000, (int(n), 2)).astype(float) for n in rng.integers(3, 9, 300)]
    signed = lambda r: float((r[:, 0] * np.roll(r[:, 1], -1) - np.roll(r[:, 0], -1) * r[:, 1]).sum())
    turned = [r[::-1] if signed(r) > 0 else r for r in rings]
    closed = [np.concatenate([r, r[:1]]) for r in turned]
    bodies = [shapes._record([r])[0] for r in closed]
    got, words, box = shapes._records(*np.concatenate(rings).T, np.array([len(r) for r in rings]))
    assert got == [struct.pack(">2i", k, len(b) // 2) + b for k, b in enumerate(bodies, 1)] and words.tolist() == [len(b) // 2 for b in bodies]
    assert box == [*np.concatenate(rings).min(0), *np.concatenate(rings).max(0)]
    df = spark.createDataFrame([("one", [tuple(p) for p in r.tolist()], float(k)) for k, r in enumerate(rings)], "layer string, ring array<struct<x:double,y:double>>, v double").coalesce(1)
    back = shapes.decode(shapes.encode(df, "layer", ["v"]).selectExpr("layer as path", "shp as content")).orderBy("record").collect()
    assert [[tuple(p) for p in r.parts[0][0]] for r in back] == [[tuple(p) for p in r.tolist()] for r in closed] and {len(r.parts) for r in back} == {1}
