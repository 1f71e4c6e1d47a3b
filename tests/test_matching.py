"""Matching in cells against a scan of all pairs: chains, ties, members of one box, cells that fall into parts."""

import random

import pytest
from pyspark.sql import functions as F

from parcelflow.functions import geom
from parcelflow.operators import evaluate, reports

BOX = "cand_id long, image int, xmin double, ymin double, xmax double, ymax double, confidence double"


def scanned(rows, least, confident=0.0):
    def share(a, b):
        w, h = min(a[4], b[4]) - max(a[2], b[2]), min(a[5], b[5]) - max(a[3], b[3])
        inter = max(w, 0.0) * max(h, 0.0)
        return inter / ((a[4] - a[2]) * (a[5] - a[3]) + (b[4] - b[2]) * (b[5] - b[3]) - inter)

    sides = [[r for r in rows if r[0] % 2 == k and (k or r[6] >= confident)] for k in range(2)]
    used, out = set(), set()
    for _, p, g, m in sorted((-share(p, g), p[0], g[0], p[1]) for p in sides[0] for g in sides[1] if p[1] == g[1] and share(p, g) >= least):
        if p not in used and g not in used:
            used |= {p, g}
            out.add((m, p, g))
    return out


def split(spark, rows):
    df = spark.createDataFrame(rows, BOX)
    return df.where("cand_id % 2 = 0"), df.where("cand_id % 2 = 1")


def test_a_chain_takes_few_rounds(spark, monkeypatch):
    """Each pair hangs on the next one of a chain of 60 boxes; rounds, and what the driver keeps of them, don't follow its length."""
    x, rows = 0.0, []
    for k in range(60):
        rows.append((k, 0, x, 0.0, x + 100.0, 100.0, 0.9))
        x += 52.0 - k / 3
    cuts, cut = [], evaluate.cut
    monkeypatch.setattr(evaluate, "cut", lambda df: cuts.append(1) or cut(df))
    assert {(r.image, r.p, r.g) for r in evaluate.match(*split(spark, rows), 0.3).collect()} == scanned(rows, 0.3)
    assert len(cuts) < 12


@pytest.mark.parametrize(("sides", "most"), [(32, 2**18), (1, 2**18), (1, 3), (2, 1)])
def test_cells_and_parts(spark, monkeypatch, sides, most):
    """Boxes over many cells, with ties and up to four members, and cells that fall into parts."""
    monkeypatch.setattr(evaluate, "SIDES", sides)
    monkeypatch.setattr(evaluate, "CELL_PAIRS", most)
    rng, rows = random.Random(most + sides), []
    for k in range(160):
        x, y, w = 25.0 * rng.randint(-4, 9), 25.0 * rng.randint(-2, 2), rng.choice([60.0, 80.0])
        rows.append((k, rng.randint(0, 1), x, y, x + w, y + w, rng.randint(20, 99) / 100))
    sides_ = split(spark, rows)
    got = [tuple(r) for r in evaluate.match(*sides_, 0.2).collect()]
    assert len(got) == len(set(got)) and set(got) == scanned(rows, 0.2)
    by_level = {}
    for r in evaluate.match(*sides_, 0.2, levels=True).collect():
        by_level.setdefault(r.threshold, set()).add((r.image, r.p, r.g))
    assert by_level == {t: scanned(rows, 0.2, t) for t in evaluate.THRESHOLDS}


def test_report_of_a_chain(spark, monkeypatch):
    """The report of the scores, of pairs that hang on one another and of no pairs at all."""
    rows = [(k, 0, 45.0 * k - k * k / 8, 0.0, 45.0 * k - k * k / 8 + 100.0, 100.0, 0.9 - k % 4 / 5) for k in range(50)]
    cuts, cut = [], evaluate.cut
    monkeypatch.setattr(evaluate, "cut", lambda df: cuts.append(1) or cut(df))
    pred, gt = split(spark, rows)
    got = {r.threshold: r.tp for r in evaluate.scores(pred, gt, 0.3).collect()}
    assert got == {t: len(scanned(rows, 0.3, t)) for t in evaluate.THRESHOLDS}
    assert reports.evaluation(evaluate.scores(pred, gt, 0.3)).count() == 20 and len(cuts) < 24
    assert {r.threshold: (r.tp, r.fn) for r in evaluate.scores(pred.where("false"), gt, 0.3).collect()} == {t: (0, 25) for t in evaluate.THRESHOLDS}


def test_polygons_of_places(spark, monkeypatch):
    """60 equal predictions over 60 equal truths, and one of another place: 3660 pairs, of which the kernel sees two."""
    box = lambda k, x: (k, 0, x, 0.0, x + 200.0, 100.0, 0.9)
    rows = [box(k, 0.0 if k % 2 else 100.0) for k in range(120)] + [box(120, 0.0), (122, 1, 0.0, 0.0, 200.0, 100.0, 0.9)]
    made, join = [], evaluate.box_join
    monkeypatch.setattr(evaluate, "box_join", lambda *a, **k: made.append(join(*a, **k)) or made[-1])
    got = evaluate.polygon_ious(*split(spark, rows), geom.box_ring).collect()
    want = {(p, g, 1.0 if p == 120 else round(1 / 3, 6), 0.5) for p in range(0, 122, 2) for g in range(1, 120, 2)}
    assert len(got) == len(want) and {tuple(r) for r in got} == want
    assert made[0].count() == 2


def test_polygons_in_cells(spark, monkeypatch):
    """Diamonds over many cells, some of them equal: a scan of all pairs, in few rounds."""
    monkeypatch.setattr(evaluate, "SIDES", 1)
    rng, rows = random.Random(9), []
    for k in range(120):
        x, y, w = 20.0 * rng.randint(0, 12) if k < 60 else 20.0 * k - k * k / 16, 20.0 * rng.randint(0, 1), 100.0
        rows.append((k, 0, x, y, x + w, y + w, 0.9))
    at = lambda x, y: F.struct(F.expr(x).alias("x"), F.expr(y).alias("y"))
    ring = F.array(at("xmax", "ymin + 50"), at("xmin + 50", "ymax"), at("xmin", "ymin + 50"), at("xmin + 50", "ymin"))
    pred, gt = (side.withColumn("ring", ring) for side in split(spark, rows))
    used, want = set(), set()
    for r in sorted(evaluate.iou_pairs(pred, gt, 0.2, "ring").collect(), key=lambda r: (-r.iou, r.p, r.g)):
        if r.p not in used and r.g not in used:
            used |= {r.p, r.g}
            want.add((r.image, r.p, r.g))
    cuts, cut = [], evaluate.cut
    monkeypatch.setattr(evaluate, "cut", lambda df: cuts.append(1) or cut(df))
    assert {tuple(r) for r in evaluate.match(pred, gt, 0.2, "ring").collect()} == want and len(want) > 30
    assert len(cuts) < 14
