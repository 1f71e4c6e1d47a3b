"""Boxes of very uneven sizes against brute force, and pairs of files dealt to new folders."""

import random

import pytest
from pyspark.sql import functions as F

from parcelflow.operators import regroup, uneven

BOX = "k long, g long, xmin double, ymin double, xmax double, ymax double"


def boxes(seed, n):
    rng, out = random.Random(seed), []
    for k in range(n):
        side = 2.0 ** rng.randint(-3, 12)
        x, y = (rng.uniform(-3000, 3000) for _ in "xy")
        out.append((k, k % 3, x, y, x + side, y + side * rng.random()))
    # a third lies in one small cell; points, touching boxes, faults, and one box over everything
    out += [(n + i, i % 3, 8 + rng.random() / 4, 8 + rng.random() / 4, 8.5, 8.5) for i in range(n // 2)]
    out += [(9000, 0, 1.0, 1.0, 1.0, 1.0), (9001, 0, 0.0, 0.0, 1.0, 1.0), (9002, 0, 1.0, 1.0, 2.0, 2.0), (9003, 0, -1e6, -1e6, 1e6, 1e6)]
    return out + [(9004, 0, None, 0.0, 1.0, 1.0), (9005, 0, 5.0, 5.0, 4.0, 6.0), (9006, 0, float("nan"), 0.0, 1.0, 1.0), (9007, 0, 0.0, 0.0, float("nan"), 1.0)]


@pytest.mark.parametrize(("closed", "equal"), [(False, []), (True, []), (False, ["g"])])
def test_uneven_join_is_brute_force(spark, closed, equal):
    a, b = boxes(1, 160), boxes(2, 130)
    ok = lambda r: None not in r and r[2] <= r[4] and r[3] <= r[5]
    meet = (lambda lo, hi: lo <= hi) if closed else (lambda lo, hi: lo < hi)
    want = sorted((x[0], y[0]) for x in a if ok(x) for y in b if ok(y) and (not equal or x[1] == y[1]) and meet(x[2], y[4]) and meet(y[2], x[4]) and meet(x[3], y[5]) and meet(y[3], x[5]))
    got = uneven.uneven_join(spark.createDataFrame(a, BOX), spark.createDataFrame(b, BOX), closed=closed, equal=equal)
    assert sorted((r.a_k, r.b_k) for r in got.collect()) == want
    assert [c for c in got.columns if not c.startswith(("a_", "b_"))] in ([], [f"k{i}" for i in range(len(equal))])


def test_uneven_join_places_few_rows_and_takes_empty_tables(spark):
    a = spark.createDataFrame(boxes(3, 200), BOX)
    named = uneven._named(a, "a_")
    per = uneven.placed(named, "a_", F.array(F.col("a_level"))).groupBy("a_k").count().agg(F.max("count")).first()[0]
    assert per <= 4
    assert uneven.uneven_join(a.where("false"), a).count() == 0 and uneven.uneven_join(a, a.where("false")).count() == 0


FILE = "tile string, split string, content string"


def files(kind, where):
    return [(t, s, f"{kind} {t} {s}") for t, s in where]


def test_pairs_are_planned_and_published(spark, tmp_path):
    images = spark.createDataFrame(files("i", [("a", "train"), ("a", "val"), ("b", "val"), ("c", "train"), ("e", "train"), ("x", "train")]), FILE)
    labels = spark.createDataFrame(files("l", [("a", "train"), ("b", "train"), ("d", "val"), ("e", "val"), ("x", "train")]), FILE)
    assigned = spark.createDataFrame([("a", "val", "test"), ("b", "train", "val"), ("c", "train", "val"), ("d", "val", "train"), ("e", "val", "train"), ("f", "train", "train"), ("x", "train", "DROPPED_BUFFER"), ("y", "train", None)], "tile string, old_split string, split string")
    plan = regroup.plan_pairs(assigned, images.select("tile", "split"), labels.select("tile", "split")).cache()
    assert {r.tile: tuple(r)[1:] for r in plan.collect()} == {
        "a": ("test", "val", "train", "copied"), "b": ("val", "val", "train", "copied"), "c": ("val", "train", None, "missing_label"),
        "d": ("train", None, "val", "missing_image"), "e": ("train", "train", "val", "copied"), "f": ("train", None, None, "missing_both"),
    }
    path = f"file://{tmp_path}/set"
    for _ in range(2):  # the second run takes the place of the first
        missing = regroup.publish(plan, images, labels, path)
        assert sorted(r.tile for r in missing.collect()) == ["c", "d", "f"]
        assert sorted(tuple(r) for r in spark.read.parquet(path).select("tile", "image", "label", "split").collect()) == [
            ("a", "i a val", "l a train", "test"), ("b", "i b val", "l b train", "val"), ("e", "i e train", "l e val", "train")]
        assert [p.name for p in tmp_path.iterdir()] == ["set"]
    with pytest.raises(ValueError, match="differ"):
        regroup.publish(plan, images.where("tile <> 'b'"), labels, path)
    assert spark.read.parquet(path).count() == 3 and [p.name for p in tmp_path.iterdir()] == ["set"]
