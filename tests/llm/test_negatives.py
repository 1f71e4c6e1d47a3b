"""Hard negatives against a plain version: ties, repeated ids, odd vectors, several blocks; bounds against true products."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from parcelflow.llm import negatives

SCHEMA = "vec_id long, embedding array<float>, label int, place string, q int"


def plain(rows, anchors, n_pos=5, n_neg=10, window=(30, 90), scale=256):
    use = []
    for i, v, label, *_ in rows:
        if i is None or label is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        use.append((i, label, [int(np.floor(np.float64(np.float32(x)) * scale)) for x in v]))
    out = []
    for k, (i, label, q) in enumerate(use):
        if not anchors(i) or not q:
            continue
        score = lambda x: sum(a * b for a, b in zip(q, x, strict=True))
        others = [(-score(x), j, m) for n, (j, m, x) in enumerate(use) if n != k and len(x) == len(q)]
        for s, p, _ in sorted(o for o in others if o[2] == label)[:n_pos]:
            inside = sorted((t, j) for t, j, m in others if m != label and window[0] * -s <= 100 * -t <= window[1] * -s)
            out += [(i, p, r + 1, j, -s, -t) for r, (t, j) in enumerate(inside[:n_neg])]
    return sorted(out)


def data(seed, n, width):
    rng = np.random.default_rng(seed)
    centre = rng.standard_normal((4, width))
    rows = []
    for i in range(n):
        label = int(rng.integers(0, 4))
        v = (centre[label] * rng.uniform(0, 1) + rng.standard_normal(width)) * rng.choice([0.05, 0.2, 1])
        rows.append((i, [float(np.float32(x)) for x in v], label, "p", 1))
    return rows


@pytest.mark.parametrize(("blocks", "directions"), [(8192, 12), (37, 4), (64, 0)])
def test_negatives(spark, monkeypatch, blocks, directions):
    for name, value in (("ROWS", blocks), ("ANCHORS", 5), ("STEP", 16), ("DIRECTIONS", directions)):
        monkeypatch.setattr(negatives, name, value)
    rows = data(1, 300, 8)
    rows += [(i, rows[i][1], rows[i][2], None, None) for i in (10, 20, 20, 40)]  # equal rows
    rows += [(10, rows[3][1], 1, None, None), (None, rows[1][1], 1, None, None), (400, None, 1, None, None), (410, rows[5][1], None, None, None), (420, [1.0, None] * 4, 1, None, None), (430, [float("nan")] * 8, 1, None, None)]
    rows += [(440, [0.0] * 8, 1, None, None), (450, [], 1, None, None), (460, [1.0, 2.0], 1, None, None), (470, [1.5, 2.0], 1, None, None), (480, [1.0, 0.5], 2, None, None), (490, [float("inf")] * 8, 1, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = sorted(tuple(r) for r in negatives.hard_negatives(docs, F.col("vec_id") % 10 == 0).collect())
    want = plain(rows, lambda i: i % 10 == 0)
    assert got == want and len({w[0] for w in want}) > 25
    assert negatives.hard_negatives(docs.where("false"), F.col("vec_id") % 10 == 0).count() == 0


def test_bounds():
    """No true product lies outside its bounds, not even of vectors along a direction or against it."""
    rng = np.random.default_rng(3)
    for scale in (1, 100, 10**6):
        v = rng.integers(-scale, scale + 1, (200, 6))
        v[:20] = v[20:40] * rng.integers(-3, 4, (20, 1))
        refs = negatives.directions([x.tobytes() for x in v.astype("<i8")], 5)[48]
        norm, angles = negatives._angles(v, refs)
        for k in range(len(v)):
            low, high = negatives.bounds(angles[:, k], norm[k], angles, norm)
            true = v @ v[k]
            assert (low <= true).all() and (true <= high).all()


def test_exact_scores():
    for scale in (1 << 10, 1 << 28, 1 << 30):
        q, rows = np.array([scale, -scale, 1]), np.array([[scale, scale - 1, 3], [0, 0, 0], [-scale, 1, 1]])
        assert negatives.exact_scores(q, rows).tolist() == [sum(int(a) * int(b) for a, b in zip(q, r, strict=True)) for r in rows]
