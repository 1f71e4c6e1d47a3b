"""Substring deduplication against the plain version, with anchors that split and blocks that don't."""

import random

import numpy as np
import pytest

from parcelflow.llm import repeats

from .brute_repeats import kept


def corpus():
    rng = random.Random(5)
    some = lambda n: " ".join(rng.choice("abcdefghij") + str(rng.randint(0, 50)) for _ in range(n))
    shared, line = some(60), some(36)
    out = [None, "", " \n\t", "one two three", some(34), some(34), shared, shared, some(20) + " " + shared + " " + some(20), some(400)]
    out += [" ".join(["echo"] * 80), " ".join(["x", "y"] * 30), " ".join(["x", "y"] * 17), some(10) + "\n" + line + "\t" + some(9), line, line.upper(), line + " A"]
    w = out[9].split()
    w[200] = "changed"
    out += [" ".join(w), " ".join(w[50:120]), " ".join(w[51:85]), " ".join(w[51:86]), "long " + some(30000), shared[:-1], "é中😀 " + shared]
    out += [some(rng.randint(5, 9)) + " " + line + " " + some(rng.randint(5, 9)) for _ in range(40)]
    return out + [" ".join(rng.choice("ab") for _ in range(rng.randint(1, 90))) for _ in range(60)]


@pytest.mark.parametrize(("length", "widest"), [(35, 1024), (35, 8), (5, 1024), (5, 2), (1, 1024), (90, 1024)])
def test_repeats(spark, monkeypatch, length, widest):
    monkeypatch.setattr(repeats, "WIDEST", widest)
    texts = corpus()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.n_words, sum(s.end - s.start for s in r.spans), r.kept) for r in repeats.without_repeats(docs, length).collect()}
    assert got == dict(enumerate(kept(texts, length)))


def test_odd_rows(spark):
    """Rows that repeat or lack an id, equal rows, clashing columns, an empty table."""
    t = " ".join(f"w{i}" for i in range(40))
    rows = [(1, t, 7, "k"), (1, t, 7, "k"), (None, t + " x", None, None), (None, None, 1, "z"), (2, "w0 w1", 2, None), (1, "other words", 3, "q")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, k long, parts string")
    got = sorted((r.doc_id or -1, r.n_words, r.kept) for r in repeats.without_repeats(docs, 35).collect())
    assert got == sorted((r[0] or -1, n, k) for r, (n, _, k) in zip(rows, kept([r[1] for r in rows], 35), strict=True))
    assert repeats.without_repeats(docs.where("false"), 35).count() == 0
    with pytest.raises(ValueError):
        repeats.without_repeats(docs, 91)


def test_longest():
    """The longest run of each place that stands elsewhere, against all pairs of places."""
    rng = np.random.default_rng(2)
    for _ in range(30):
        sizes = rng.integers(1, 12, rng.integers(1, 8))
        ends, values, times = np.cumsum(sizes), rng.integers(0, 3, sizes.sum()).astype(np.uint64), rng.integers(1, 3, len(sizes))
        owner = np.repeat(np.arange(len(sizes)), sizes)
        want = []
        for i in range(len(values)):
            best = 0 if times[owner[i]] == 1 else ends[owner[i]] - i
            for j in range(len(values)):
                k = 0
                while i != j and i + k < ends[owner[i]] and j + k < ends[owner[j]] and values[i + k] == values[j + k]:
                    k += 1
                best = max(best, k)
            want.append(best)
        assert repeats.longest(values, ends, times).tolist() == want
