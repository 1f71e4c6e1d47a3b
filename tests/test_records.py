"""Records that queries over the general tables don't reach: errors, report text, odd rings."""

import pytest
from pyspark.sql import functions as F

from parcelflow.functions import geom
from parcelflow.operators import raster, records


def test_utm_error(spark):
    rows = spark.createDataFrame([(2e5, 10.0), (9e4, 10.0)], "xmin double, ymin double")
    assert records.checked_utm(rows.where("xmin > 1e5")).count() == 1
    with pytest.raises(Exception, match="UTM"):
        records.checked_utm(rows).collect()


def test_yaml_and_names(spark):
    assert records.dataset_yaml("/d", ["field"]) == "path: /d\ntrain: images/train\nval: images/val\ntest: images/test\nnames:\n  0: field\n"
    assert [r[0] for r in spark.createDataFrame([(0.35,), (0.65,)], "t double").select(records.conf_name(F.col("t"))).collect()] == ["conf_035", "conf_065"]


def test_rings(spark):
    ell = [(0.0, 0.0), (4.0, 0.0), (4.0, 2.0), (2.0, 2.0), (2.0, 4.0), (0.0, 4.0), (0.0, 0.0)]
    rows = spark.createDataFrame([(1, [[ell]]), (2, [[ell[:2]]]), (3, [[[(1.0, 1.0), (2.0, 2.0), (3.0, 3.0)]]]), (4, [])], "shape_id long, parts array<array<array<struct<x:double,y:double>>>>")
    got = {r.shape_id: r for r in records.polygon_parts(rows).collect()}
    assert set(got) == {1, 3} and got[1].n_points == 6 and got[1].area == 12 and got[3].cx is None
    assert (got[1].cx, got[1].cy) == (pytest.approx(5 / 3), pytest.approx(5 / 3))
    open_ring = spark.createDataFrame([([ell[:-1]],)], "r array<array<struct<x:double,y:double>>>").select(F.size(geom.exterior(F.col("r")))).first()[0]
    assert open_ring == 6


def test_masks(spark):
    values = spark.createDataFrame([("s", 0, p, b, float("nan") if p == 0 else None if p == 1 and b else 1.0) for p in range(10) for b in (0, 1)], "scene string, window int, pixel int, band int, value double")
    assert records.valid_share(values).first().share == 0.8


def test_centre_out(spark):
    grid = spark.createDataFrame([("x", r, 0) for r in (0, 512, 1024, 1536)], "scene string, row int, col int")
    rows = {r.place: r["rank"] for r in raster.centre_out(grid).where("axis = 'row'").collect()}
    assert rows == {1024: 1, 512: 2, 1536: 3, 0: 4}
