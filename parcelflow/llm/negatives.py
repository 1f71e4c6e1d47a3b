"""Hard negatives by angular triangle filtering.

Every vector stores its norm and its angles to a few reference directions.  For an anchor at angles s
and a row at angles t, the angle between them lies between max |s - t| and min(s + t, 2 pi - s - t),
so their cosine lies in an interval, and times both norms so does their inner product, widened by
more than rounding can move it.  Only rows whose interval meets what an anchor still looks for are
scored in integers.

Anchors and rows meet in blocks: a task holds one block of each and hands on the best of each anchor
there, so nothing but those few rows is gathered by anchor.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, small, temporary

SCALE = 256
#: Positives of an anchor, negatives of a positive, and the window of negatives in hundredths of the positive's score.
POSITIVES, NEGATIVES, WINDOW = 5, 10, (30, 90)
#: Reference directions, and rows and bytes of the sample that they are fitted on.
DIRECTIONS, SAMPLE, SAMPLE_BYTES = 12, 8_000, 32 << 20
#: Rows and anchors that meet in one task, and rows whose bounds are computed at once.
ROWS, ANCHORS, STEP = 8192, 2048, 2048
#: Radians by which an angle may be off: the arc cosine of a cosine that is wrong by 1e-12.
SLACK = 4e-6


def quantised(rows: DataFrame, scale: int) -> DataFrame:
    """(vec_id, label, q): floor(scale * x) of each component, as 64-bit integers in bytes; rows that take part only.

    Rows with an empty vector, a null or non-finite component, or one beyond 2**53 when scaled, take no part.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches):
            q, use = [], []
            for i, v in enumerate(b.column(2).to_pylist()):
                if not v or any(x is None for x in v):
                    continue
                x = np.floor(np.array(v, np.float64) * scale)
                if np.isfinite(x).all() and (np.abs(x) < 2**53).all():
                    q.append(x.astype("<i8").tobytes())
                    use.append(i)
            pick = pa.array(use, pa.int32())
            yield pa.RecordBatch.from_arrays([b.column(0).take(pick), b.column(1).take(pick), pa.array(q, pa.binary())], ["vec_id", "label", "q"])

    kind = rows.schema
    return rows.mapInArrow(work, f"vec_id {kind['vec_id'].dataType.simpleString()}, label {kind['label'].dataType.simpleString()}, q binary")


def _vectors(packed: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(packed), "<i8").reshape(len(packed), -1)


def directions(sample: list[bytes], count: int) -> dict[int, np.ndarray]:
    """For each width of vectors, `count` unit vectors, each the one of the sample that lies farthest from those before."""
    out: dict[int, np.ndarray] = {}
    for width in {len(s) for s in sample}:
        v = _vectors([s for s in sample if len(s) == width]).astype(np.float64)
        norm = np.linalg.norm(v, axis=1)
        v = v[norm > 0] / norm[norm > 0, None]
        chosen: list[np.ndarray] = []
        near = np.full(len(v), -2.0)
        while len(v) and len(chosen) < count and near.min() < 1 - 1e-9:
            chosen.append(v[int(near.argmin())])
            near = np.maximum(near, v @ chosen[-1])
        out[width] = np.array(chosen).reshape(len(chosen), width // 8)
    return out


def _angles(q: np.ndarray, refs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Norms, and angles to each direction (a row each)."""
    v = q.astype(np.float64)
    norm = np.sqrt((v * v).sum(1))
    unit = v / np.where(norm > 0, norm, 1)[:, None]
    return norm, np.arccos(np.clip(refs @ unit.T, -1, 1))


def placed(rows: DataFrame, refs: dict[int, np.ndarray]) -> DataFrame:
    """`rows` with norm and angles, the latter packed."""
    sent = rows.sparkSession.sparkContext.broadcast(refs)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches):
            packed = b.column(2).to_pylist()
            norms, angles = np.zeros(len(packed)), [b""] * len(packed)
            for width in {len(p) for p in packed}:
                at = [i for i, p in enumerate(packed) if len(p) == width]
                norms[at], found = _angles(_vectors([packed[i] for i in at]), sent.value.get(width, np.zeros((0, width // 8))))
                for i, x in zip(at, found.T, strict=True):
                    angles[i] = x.tobytes()
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(norms), pa.array(angles, pa.binary())], [*b.schema.names, "norm", "angles"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(work, f"{kinds}, norm double, angles binary")


def bounds(s: np.ndarray, a: float, t: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lowest and highest inner product of a vector of norm `a` at angles `s` with vectors of norms `b` at angles `t`."""
    if not len(s):
        return -a * b * (1 + 1e-9) - 1, a * b * (1 + 1e-9) + 1
    apart = np.abs(t - s[:, None]).max(0)
    joint = t + s[:, None]
    widest = np.minimum(joint, 2 * np.pi - joint).min(0)
    reach = a * b
    room = reach * 1e-9 + 1
    return reach * np.cos(np.minimum(np.pi, widest + SLACK)) - room, reach * np.cos(np.maximum(0, apart - SLACK)) + room


def exact_scores(q: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products of integers, exactly; an error if one does not fit a long."""
    most = len(q) * int(np.abs(q).max(initial=0)) * int(np.abs(rows).max(initial=0))
    if most < 2**53:
        return (rows.astype(np.float64) @ q.astype(np.float64)).astype(np.int64)
    if most < 2**63:
        return rows @ q
    return np.array([sum(x * y for x, y in zip(q.tolist(), r, strict=True)) for r in rows.tolist()], np.int64)


def _first(ids: np.ndarray, scores: np.ndarray, most: int) -> np.ndarray:
    """The first `most` by score from high, then by id."""
    return np.lexsort((ids, -scores))[:most]


def _best_positives(anchor: dict, rows: dict, most: int) -> list[tuple]:
    """(score, id) of the best rows of the anchor's label among `rows`; itself left out."""
    scores, ids, floor = np.zeros(0, np.int64), np.zeros(0, np.int64), None
    same = np.flatnonzero((rows["label"] == anchor["label"]) & (rows["place"] != anchor["place"]))
    for lo in range(0, len(same), STEP):
        at = same[lo : lo + STEP]
        if floor is not None:
            at = at[bounds(anchor["angles"], anchor["norm"], rows["angles"][:, at], rows["norm"][at])[1] >= floor]
        scores, ids = np.append(scores, exact_scores(anchor["q"], rows["q"][at])), np.append(ids, rows["id"][at])
        keep = _first(ids, scores, most)
        scores, ids = scores[keep], ids[keep]
        if len(scores) == most:
            floor = scores[-1]
    return list(zip(scores.tolist(), ids.tolist(), strict=True))


def _best_negatives(anchor: dict, rows: dict, most: int, window: tuple[int, int]) -> list[tuple]:
    """(positive, its score, score, id) of the best rows of other labels inside each positive's window."""
    low, high = window
    wanted = [(p, s, -((-low * s) // 100), high * s // 100) for p, s in anchor["positives"]]
    wanted = [w for w in wanted if w[2] <= w[3]]
    held = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in wanted]
    other = np.flatnonzero(rows["label"] != anchor["label"])
    for lo in range(0, len(other), STEP):
        at = other[lo : lo + STEP]
        least, top = bounds(anchor["angles"], anchor["norm"], rows["angles"][:, at], rows["norm"][at])
        meets = np.zeros(len(at), bool)
        for (_, _, x, y), (scores, _) in zip(wanted, held, strict=True):
            meets |= (least <= y) & (top >= (scores[-1] if len(scores) == most else x))
        at = at[meets]
        got, ids = exact_scores(anchor["q"], rows["q"][at]), rows["id"][at]
        for k, (_, _, x, y) in enumerate(wanted):
            inside = (got >= x) & (got <= y)
            scores, own = np.append(held[k][0], got[inside]), np.append(held[k][1], ids[inside])
            keep = _first(own, scores, most)
            held[k] = scores[keep], own[keep]
    return [(p, s, a, b) for (p, s, *_), (scores, ids) in zip(wanted, held, strict=True) for a, b in zip(scores.tolist(), ids.tolist(), strict=True)]


def _meeting(rows: DataFrame, anchors: DataFrame, found: Callable[[dict, dict], list[tuple]], columns: str, n_rows: int, n_anchors: int) -> DataFrame:
    """(anchor, ...) what `found` gives for each anchor and each block of rows of its width."""
    blocks, parts = max(1, -(-n_rows // ROWS)), max(1, -(-n_anchors // ANCHORS))
    some = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = anchors.withColumn("part", F.pmod(F.xxhash64("place", F.lit(2)), F.lit(parts)).cast("int")).withColumn("block", some(blocks))
    right = rows.withColumn("block", F.pmod(F.xxhash64("place"), F.lit(blocks)).cast("int")).withColumn("part", some(parts))
    names = [c.split()[0] for c in columns.split(", ")]

    def work(a: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple] = []
        width = r["q"].map(len) if len(r) else None
        for w, own in a.groupby(a["q"].map(len)) if len(r) else ():
            near = r[width == w]
            if not len(near):
                continue
            labels, codes = np.unique(np.concatenate([near["label"].to_numpy(), own["label"].to_numpy()]), return_inverse=True)
            table = {"id": near["vec_id"].to_numpy(), "place": near["place"].to_numpy(), "label": codes[: len(near)], "q": _vectors(list(near["q"])), "norm": near["norm"].to_numpy(), "angles": np.frombuffer(b"".join(near["angles"]), np.float64).reshape(len(near), -1).T.copy()}
            for row, code in zip(own.to_dict("records"), codes[len(near) :], strict=True):
                anchor = {"label": code, "place": row["place"], "q": np.frombuffer(row["q"], "<i8"), "norm": row["norm"], "angles": np.frombuffer(row["angles"], np.float64), "positives": row.get("positives")}
                out += [(row["place"], *x) for x in found(anchor, table)]
        return pd.DataFrame(out, columns=names)

    return left.groupBy("block", "part").cogroup(right.groupBy("block", "part")).applyInPandas(work, columns)


def _first_of(df: DataFrame, by: list[str], score: str, tie: str, most: int) -> DataFrame:
    """The first `most` rows of each group by score from high, then id, with their rank; Spark limits each task's groups before it moves them."""
    order = Window.partitionBy(*by).orderBy(F.col(score).desc(), F.col(tie))
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def hard_negatives(rows: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, window: tuple[int, int] = WINDOW, scale: int = SCALE) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for rows (vec_id, label, embedding).

    A score is the inner product of floor(scale * x).  Of each row for which `is_anchor` holds, the positives
    are the first `positives` other rows of its label, and of each positive the negatives are the first
    `negatives` rows of other labels whose score lies in `window`, in hundredths of the positive's; higher
    scores come first, ties by smaller vec_id.  Rows without id, label or vector, or with an empty
    vector, a null or non-finite component or one beyond 2**53 when scaled, take no part; vectors of
    different lengths never meet.  Rows that repeat a vec_id are rows like others; ids and labels are whole numbers.  An empty
    table gives no rows; other columns are not read.
    """
    used = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), "embedding").where("vec_id is not null and label is not null and embedding is not null")
    with temporary() as keep:
        whole = materialize(quantised(used, scale).withColumn("place", F.monotonically_increasing_id()), "vectors")
        count, widest = whole.agg(F.count("*"), F.max(F.octet_length("q"))).first()
        fit = max(1, min(SAMPLE, SAMPLE_BYTES // max(widest or 1, 1)))
        sample = [r["q"] for r in whole.orderBy(F.xxhash64("place")).select("q").limit(fit).collect()]
        table = materialize(placed(whole, directions(sample, DIRECTIONS)), "placed")
        anchors = materialize(table.where(is_anchor), "anchors")
        n_anchors = anchors.count()
        best = _meeting(table, anchors, lambda a, r: _best_positives(a, r, positives), "anchor long, score long, positive long", count, n_anchors)
        best = _first_of(best, ["anchor"], "score", "positive", positives)
        with_best = best.groupBy("anchor").agg(F.collect_list(F.struct("positive", "score")).alias("positives"))  # `positives` at most
        ready = anchors.join(with_best, F.col("place") == F.col("anchor")).drop("anchor")
        ready = materialize(ready, "ready")
        # a positive stands for its place in the list: two may share id and score
        found = _meeting(table, ready, lambda a, r: _best_negatives({**a, "positives": [(k, p["score"]) for k, p in enumerate(a["positives"])]}, r, negatives, window), "anchor long, slot long, positive_score long, negative_score long, negative_id long", count, n_anchors)
        top = _first_of(found, ["anchor", "slot"], "negative_score", "negative_id", negatives)
        names = ready.select(F.col("place").alias("anchor"), F.col("vec_id").alias("anchor_id"), F.posexplode("positives").alias("slot", "p"))
        out = top.join(names, ["anchor", "slot"]).select("anchor_id", F.col("p.positive").alias("positive_id"), F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
        return keep(materialize(out, "negatives"))
