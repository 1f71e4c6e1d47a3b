"""Geometry that SQL cannot express, over Arrow batches: areas shared by polygons, rotated rectangles, cleaning.

Rings of a batch are padded matrices (rows, points, 2) with a count each, in blocks of ROWS rows or POINTS points at most,
and every step works on all rows of a block at once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructType

_RING = ArrayType(StructType().add("x", DoubleType()).add("y", DoubleType()))
#: Rows and points of a block, and pairs of triangles clipped at once.
ROWS, POINTS, PAIRS = 4096, 16384, 16384


def _next(count: np.ndarray, width: int) -> np.ndarray:
    at = np.arange(width)
    return np.where(at + 1 < count[:, None], at + 1, 0)


def _take(m: np.ndarray, at: np.ndarray) -> np.ndarray:
    return np.take_along_axis(m, at[:, :, None] if m.ndim == 3 else at, 1)


def _compact(points: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The kept points of each row, moved to its front."""
    count = keep.sum(1)
    order = np.argsort(~keep, axis=1, kind="stable")[:, : max(1, int(count.max(initial=0)))]
    return _take(points, order), count


def _signed(points: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Shoelace areas, positive for counter-clockwise rings; taken from the first point, so large coordinates lose nothing."""
    p = points - points[:, :1]
    q = _take(p, _next(count, p.shape[1]))
    cross = p[:, :, 0] * q[:, :, 1] - q[:, :, 0] * p[:, :, 1]
    return np.where(np.arange(p.shape[1]) < count[:, None], cross, 0.0).sum(1) / 2


def _turned(points: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Clockwise rings reversed."""
    at = np.arange(points.shape[1])
    back = np.where(at < count[:, None], count[:, None] - 1 - at, at)
    return np.where((_signed(points, count) < 0)[:, None, None], _take(points, back), points)


def _convex(points: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Which simple rings turn one way only."""
    q = _take(points, _next(count, points.shape[1]))
    e = q - points
    f = _take(e, _next(count, points.shape[1]))
    cross = np.where(np.arange(points.shape[1]) < count[:, None], e[:, :, 0] * f[:, :, 1] - e[:, :, 1] * f[:, :, 0], 0.0)
    return (cross >= 0).all(1) | (cross <= 0).all(1)


def _shared(p: np.ndarray, n: np.ndarray, q: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Areas that convex rings share, row by row: p is cut along each side of q, both counter-clockwise."""
    for j in range(q.shape[1]):
        a = q[:, j]
        b = np.where((j < m)[:, None], q[np.arange(len(q)), _next(m, q.shape[1])[:, j]], a)  # no side: nothing is cut
        d = b - a
        side = d[:, :1] * (p[:, :, 1] - a[:, 1:]) - d[:, 1:] * (p[:, :, 0] - a[:, :1])
        after = _next(n, p.shape[1])
        other = _take(side, after)
        real = np.arange(p.shape[1]) < n[:, None]
        cross = real & (side * other < 0)
        part = np.where(cross, side / np.where(cross, side - other, 1.0), 0.0)
        met = p + (_take(p, after) - p) * part[:, :, None]
        both = np.stack([p, met], 2).reshape(len(p), -1, 2)
        p, n = _compact(both, np.stack([real & (side >= 0), cross], 2).reshape(len(p), -1))
    return np.abs(_signed(p, n))


def _fans(p: np.ndarray, n: np.ndarray, q: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Areas that simple rings share: signed triangle fans, clipped pair by pair in blocks of PAIRS."""
    a, b = np.maximum(n - 2, 0), np.maximum(m - 2, 0)
    ends = np.cumsum(a * b)
    total = np.zeros(len(p))
    three = np.array([3])
    for start in range(0, int(ends[-1]) if len(ends) else 0, PAIRS):
        k = np.arange(start, min(start + PAIRS, int(ends[-1])))
        row = np.searchsorted(ends, k, "right")
        local = k - (ends[row] - (a * b)[row])
        i, j = local // b[row] + 1, local % b[row] + 1
        s = np.stack([p[row, 0], p[row, i], p[row, i + 1]], 1)
        t = np.stack([q[row, 0], q[row, j], q[row, j + 1]], 1)
        c = np.repeat(three, len(k))
        sign = np.sign(_signed(s, c)) * np.sign(_signed(t, c))
        ok = sign != 0
        area = _shared(_turned(s[ok], c[ok]), c[ok], _turned(t[ok], c[ok]), c[ok])
        np.add.at(total, row[ok], sign[ok] * area)
    return np.abs(total)


def shared_areas(p: np.ndarray, n: np.ndarray, q: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Areas that simple rings share, row by row; convex rings are clipped whole, others as fans."""
    out = np.zeros(len(p))
    whole = (n > 2) & (m > 2)
    plain = whole & _convex(p, n) & _convex(q, m)
    if plain.any():
        out[plain] = _shared(_turned(p[plain], n[plain]), n[plain], _turned(q[plain], m[plain]), m[plain])
    rest = whole & ~plain
    if rest.any():
        out[rest] = _fans(p[rest], n[rest], q[rest], m[rest])
    return out


def intersection_area(p: np.ndarray, q: np.ndarray) -> float:
    """Area shared by two simple polygons, convex or not."""
    return float(shared_areas(p[None], np.array([len(p)]), q[None], np.array([len(q)]))[0])


def _rows(*rings: pa.Array) -> int:
    """Rows of a block: the longer the longest ring, the fewer."""
    return max(1, min(ROWS, POINTS // max(1, *(pc.max(r.value_lengths()).as_py() or 0 for r in rings))))


def _blocks(rings: pa.Array, rows: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Padded points and counts of an Arrow array of rings, some rows at a time; a null ring has no points."""
    rows = rows or _rows(rings)
    for at in range(0, len(rings), rows):
        part = rings.slice(at, rows)
        flat = part.flatten()
        xy = np.stack([flat.field(k).to_numpy(zero_copy_only=False) for k in (0, 1)], 1).astype(float).reshape(-1, 2)
        count = part.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        inside = np.arange(max(1, int(count.max(initial=0)))) < count[:, None]
        points = np.zeros((*inside.shape, 2))
        points[inside] = xy
        yield points, count


def _rings(blocks: list[tuple[np.ndarray, np.ndarray]]) -> pa.Array:
    counts = np.concatenate([c for _, c in blocks]) if blocks else np.zeros(0, np.int64)
    xy = np.concatenate([p[np.arange(p.shape[1]) < c[:, None]] for p, c in blocks]) if blocks else np.zeros((0, 2))
    points = pa.StructArray.from_arrays([pa.array(xy[:, 0]), pa.array(xy[:, 1])], ["x", "y"])
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), points)


@F.arrow_udf(DoubleType())
def polygon_overlap(a: pa.Array, b: pa.Array) -> pa.Array:
    """Area that two rings share; zero where one is null or has fewer than three points."""
    return pa.array(np.concatenate([np.zeros(0), *(shared_areas(p, n, q, m) for (p, n), (q, m) in zip(_blocks(a, _rows(a, b)), _blocks(b, _rows(a, b)), strict=True))]))


@F.arrow_udf(DoubleType())
def polygon_iou(a: pa.Array, b: pa.Array) -> pa.Array:
    """Intersection over union of two rings; zero for a union of nothing."""
    out = [np.zeros(0)]
    for (p, n), (q, m) in zip(_blocks(a, _rows(a, b)), _blocks(b, _rows(a, b)), strict=True):
        inter = shared_areas(p, n, q, m)
        union = np.abs(_signed(p, n)) + np.abs(_signed(q, m)) - inter
        out.append(np.where(union > 1e-12, inter / np.where(union > 1e-12, union, 1.0), 0.0))
    return pa.array(np.concatenate(out))


@F.arrow_udf(_RING)
def cleaned(rings: pa.Array) -> pa.Array:
    """Rings without repeated and collinear points; a null ring becomes an empty one."""
    out = []
    for p, n in _blocks(rings):
        before = lambda p, n: _take(p, np.where(np.arange(p.shape[1]) > 0, np.arange(p.shape[1]) - 1, np.maximum(n - 1, 0)[:, None]))
        real = np.arange(p.shape[1]) < n[:, None]
        p, n = _compact(p, real & ((np.abs(p - before(p, n)).max(2) > 1e-9) | (n == 1)[:, None]))
        a, b = p - before(p, n), _take(p, _next(n, p.shape[1])) - p
        turn = np.abs(a[:, :, 0] * b[:, :, 1] - a[:, :, 1] * b[:, :, 0]) > 1e-9
        out.append(_compact(p, (np.arange(p.shape[1]) < n[:, None]) & turn))
    return _rings(out)


@F.arrow_udf(DoubleType())
def aspect(rings: pa.Array) -> pa.Array:
    """Short over long side of the smallest rotated rectangle around a ring; null where there is none."""
    out = [np.zeros(0)]
    for p, n in _blocks(rings):
        real = np.arange(p.shape[1]) < n[:, None]
        d = _take(p, _next(n, p.shape[1])) - p
        length = np.where(real, np.hypot(d[:, :, 0], d[:, :, 1]), 0.0)
        best, ratio = np.full(len(p), np.inf), np.full(len(p), np.nan)
        for j in range(p.shape[1]):
            ok = length[:, j] > 0
            u = d[:, j] / np.where(ok, length[:, j], 1.0)[:, None]
            span = lambda v: np.where(real, v, -np.inf).max(1) - np.where(real, v, np.inf).min(1)  # noqa: B023, E731
            w, h = span(p[:, :, 0] * u[:, :1] + p[:, :, 1] * u[:, 1:]), span(p[:, :, 1] * u[:, :1] - p[:, :, 0] * u[:, 1:])
            better = ok & (w * h < best)
            best[better], ratio[better] = (w * h)[better], (np.minimum(w, h) / np.maximum(w, h))[better]
        out.append(ratio)
    all_ = np.concatenate(out)
    return pa.array(all_, mask=np.isnan(all_))
