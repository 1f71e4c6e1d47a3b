"""Polygons with holes and parts: validity, repair, exact areas of any rings.

A shape is an array of rings, holes and further parts among them; a point is inside where a ray from it
crosses an odd number of edges.  Edges that meet are found by the cells of a grid that grows with the shape.
Between neighbouring x of vertices and crossings edges keep their order, so each such slab falls into
trapezoids between neighbouring edges, and areas, shared areas and parts are sums over trapezoids.  Work
follows edges and the slabs they span, not pairs of edges.

A shape is a row and is worked on where it lies: blocks of Arrow batches become flat columns of edges, whose
steps work on all shapes of a block at once, and nothing is shuffled or stored.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers need no copy of the package

#: Metres within which edges count as one and sides as not touching.
NEAR = 1e-6
#: Edges that a cell of the grid should hold.
CELL_EDGES = 8
#: Points of a block of shapes, and pairs and pieces worked on at once.
POINTS, ITEMS = 1 << 15, 1 << 20
RINGS = "array<array<struct<x:double,y:double>>>"


class Edges(NamedTuple):
    """Edges by row of the block, side, ring and place in the ring; `last` is the last place of the ring."""

    row: np.ndarray
    side: np.ndarray
    ring: np.ndarray
    at: np.ndarray
    last: np.ndarray
    x1: np.ndarray
    y1: np.ndarray
    x2: np.ndarray
    y2: np.ndarray


class Trapezoids(NamedTuple):
    """What lies between neighbouring pieces of a slab, y below and z above, and inside which sides."""

    row: np.ndarray
    slab: np.ndarray
    lo: np.ndarray
    hi: np.ndarray
    ylo: np.ndarray
    yhi: np.ndarray
    zlo: np.ndarray
    zhi: np.ndarray
    in1: np.ndarray
    in2: np.ndarray
    area: np.ndarray


def _spread(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each of so many items of an owner: the owner, and the place among its items."""
    owner = np.repeat(np.arange(len(counts)), counts)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)


def _first(*columns: np.ndarray) -> np.ndarray:
    """Which rows of sorted columns differ from the row before."""
    out = np.zeros(len(columns[0]), bool)
    out[:1] = True
    for c in columns:
        out[1:] |= c[1:] != c[:-1]
    return out


def _runs(counts: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of owners with about ITEMS items, one owner at least."""
    ends, start = np.cumsum(counts), 0
    while start < len(counts):
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + ITEMS, "right")))
        yield start, stop
        start = stop


def _places(group: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values by group in order, and the place of each value among them."""
    order = np.lexsort((value, group))
    new = _first(group[order], value[order])
    place = np.empty(len(order), np.int64)
    place[order] = np.cumsum(new) - 1
    return value[order][new], place


def _lengths(lists: pa.Array) -> np.ndarray:
    return lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)


def _edges(rings: pa.Array, side: int = 1) -> Edges:
    """Every edge of every ring that has a length; rings may be closed or not."""
    row, ring = _spread(_lengths(rings))
    flat = rings.flatten()
    of, at = _spread(_lengths(flat))
    x, y = (c.to_numpy(zero_copy_only=False).astype(float) for c in flat.flatten().flatten())
    moved = at == 0
    moved[1:] |= (x[1:] != x[:-1]) | (y[1:] != y[:-1])
    x, y, of = x[moved], y[moved], of[moved]
    count = np.bincount(of, minlength=len(ring))
    first = np.cumsum(count) - count
    some = np.flatnonzero(count > 1)
    end = first[some] + count[some] - 1
    closed = (x[end] == x[first[some]]) & (y[end] == y[first[some]])
    keep = count[of] > 1
    keep[end[closed]] = False
    count[some] -= closed
    keep &= count[of] > 1
    x, y, of = x[keep], y[keep], of[keep]
    count = np.bincount(of, minlength=len(ring))
    _, at = _spread(count)
    last = count[of] - 1
    after = np.arange(len(x)) + np.where(at < last, 1, -last)
    return Edges(row[of], np.full(len(x), side), ring[of], at, last, x, y, x[after], y[after])


def _both(a: Edges, b: Edges) -> Edges:
    order = np.argsort(np.concatenate([a.row, b.row]), kind="stable")
    return Edges(*(np.concatenate(c)[order] for c in zip(a, b, strict=True)))


def _meeting(e: Edges) -> Iterator[tuple[np.ndarray, np.ndarray, tuple[np.ndarray, ...]]]:
    """Pairs of edges of a shape that share a cell of its grid, with the turns of their ends; a pair may come once a cell."""
    if not len(e.row):
        return
    new = _first(e.row)
    shape, start = np.cumsum(new) - 1, np.flatnonzero(new)
    g = np.maximum(1, np.floor(np.sqrt(np.diff(np.append(start, len(e.row))) / CELL_EDGES))).astype(np.int64)
    spans = []
    for p, q in ((e.x1, e.x2), (e.y1, e.y2)):
        lo, hi = np.minimum(p, q), np.maximum(p, q)
        least = np.minimum.reduceat(lo, start)
        width = np.maximum(np.maximum.reduceat(hi, start) - least, 1e-300)
        spans.append([np.clip(np.nan_to_num((v - least[shape]) * g[shape] / width[shape]), 0, g[shape] - 1).astype(np.int64) for v in (lo, hi)])
    (cx, tx), (cy, ty) = spans
    high = ty - cy + 1
    owner, k = _spread((tx - cx + 1) * high)
    cell = (np.cumsum(g * g) - g * g)[shape[owner]] + (cx[owner] + k // high[owner]) * g[shape[owner]] + cy[owner] + k % high[owner]
    order = np.argsort(cell, kind="stable")
    owner, new = owner[order], _first(cell[order])
    size = np.diff(np.append(np.flatnonzero(new), len(owner)))
    later = np.repeat(size, size) - 1 - _spread(size)[1]
    for i, j in _runs(later):
        one, k = _spread(later[i:j])
        a, b = owner[i + one], owner[i + one + 1 + k]
        turn = lambda p, x, y: (e.x2[p] - e.x1[p]) * (y - e.y1[p]) - (e.y2[p] - e.y1[p]) * (x - e.x1[p])
        yield a, b, (turn(a, e.x1[b], e.y1[b]), turn(a, e.x2[b], e.y2[b]), turn(b, e.x1[a], e.y1[a]), turn(b, e.x2[a], e.y2[a]))


def _crossing(o: tuple[np.ndarray, ...]) -> np.ndarray:
    """Whether two edges cross inside both."""
    return (np.sign(o[0]) * np.sign(o[1]) < 0) & (np.sign(o[2]) * np.sign(o[3]) < 0)


def _overlapping(e: Edges, a: np.ndarray, b: np.ndarray, o: tuple[np.ndarray, ...]) -> np.ndarray:
    """Whether two edges lie on one line and share a stretch of it."""
    share = lambda p, q: np.minimum(np.maximum(p[a], q[a]), np.maximum(p[b], q[b])) - np.maximum(np.minimum(p[a], q[a]), np.minimum(p[b], q[b]))
    x, y = share(e.x1, e.x2), share(e.y1, e.y2)
    return (o[0] == 0) & (o[1] == 0) & (x >= 0) & (y >= 0) & (x + y > 0)


def _touching(e: Edges, a: np.ndarray, b: np.ndarray, o: tuple[np.ndarray, ...]) -> np.ndarray:
    """Whether an end of one edge lies on the other."""

    def on(turn: np.ndarray, x: np.ndarray, y: np.ndarray, p: np.ndarray) -> np.ndarray:
        within = lambda v, s, t: (v >= np.minimum(s, t)) & (v <= np.maximum(s, t))
        return (turn == 0) & within(x, e.x1[p], e.x2[p]) & within(y, e.y1[p], e.y2[p])

    return on(o[0], e.x1[b], e.y1[b], a) | on(o[1], e.x2[b], e.y2[b], a) | on(o[2], e.x1[a], e.y1[a], b) | on(o[3], e.x2[a], e.y2[a], b)


def _validity(e: Edges, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Rings with edges of each row, and whether it is valid."""
    bad = np.zeros(n, bool)
    for a, b, o in _meeting(e):
        own = e.ring[a] == e.ring[b]
        beside = own & ((e.at[b] - e.at[a] == 1) | ((e.at[a] == 0) & (e.at[b] == e.last[a])))
        bad[e.row[a[_crossing(o) | _overlapping(e, a, b, o) | (own & ~beside & _touching(e, a, b, o))]]] = True
    bad[e.row[e.last < 2]] = True
    return np.bincount(e.row[e.at == 0], minlength=n), ~bad


def _trapezoids(e: Edges) -> Iterator[Trapezoids]:
    """Trapezoids inside a side by slab and height; stretches that a side has an even number of times cancel."""
    rows, met = [e.row, e.row], [e.x1, e.x2]
    for a, b, o in _meeting(e):
        c = _crossing(o)
        a, t = a[c], o[2][c] / (o[2][c] - o[3][c])
        rows.append(e.row[a])
        met.append(e.x1[a] + t * (e.x2[a] - e.x1[a]))
    xs, place = _places(np.concatenate(rows), np.concatenate(met))
    one, two = place[: len(e.row)], place[len(e.row) : 2 * len(e.row)]
    first, last = np.minimum(one, two), np.maximum(one, two)
    pieces = np.cumsum(np.bincount(first, minlength=len(xs)) - np.bincount(last, minlength=len(xs)))
    for i, j in _runs(pieces):
        use = np.flatnonzero((first < j) & (last > i))
        lo, hi = np.maximum(first[use], i), np.minimum(last[use], j)
        own, k = _spread(np.maximum(hi - lo, 0))
        slab, p = lo[own] + k, use[own]

        def y(x: np.ndarray) -> np.ndarray:
            x1, x2, y1, y2 = e.x1[p], e.x2[p], e.y1[p], e.y2[p]  # noqa: B023
            return np.where(x == x1, y1, np.where(x == x2, y2, y1 + (x - x1) * (y2 - y1) / (x2 - x1)))

        yield _between(e.row[p], slab, e.side[p], xs[slab], xs[slab + 1], y(xs[slab]), y(xs[slab + 1]))


def _between(row: np.ndarray, slab: np.ndarray, side: np.ndarray, lo: np.ndarray, hi: np.ndarray, ylo: np.ndarray, yhi: np.ndarray) -> Trapezoids:
    a, b = np.floor(ylo / NEAR + 0.5), np.floor(yhi / NEAR + 0.5)
    order = np.lexsort((yhi, ylo, b, a, side, slab))
    new = np.flatnonzero(_first(*(c[order] for c in (slab, side, a, b))))
    odd = order[new[np.diff(np.append(new, len(order))) % 2 == 1]]
    odd = odd[np.lexsort((side[odd], ylo[odd], ylo[odd] + yhi[odd], slab[odd]))]
    row, slab, side, lo, hi, ylo, yhi = (c[odd] for c in (row, slab, side, lo, hi, ylo, yhi))
    start = np.maximum.accumulate(np.where(_first(slab), np.arange(len(slab)), 0)) if len(slab) else slab
    inside = []
    for s in (1, 2):
        upto = np.cumsum(np.append(0, side == s))
        inside.append((upto[1:] - upto[start]) % 2 == 1)
    t = np.flatnonzero(np.append(~_first(slab)[1:], np.zeros(min(1, len(slab)), bool)) & (inside[0] | inside[1]))
    zlo, zhi = ylo[t + 1], yhi[t + 1]
    area = ((zlo - ylo[t]) + (zhi - yhi[t])) / 2 * (hi[t] - lo[t])
    return Trapezoids(row[t], slab[t], lo[t], hi[t], ylo[t], yhi[t], zlo, zhi, inside[0][t], inside[1][t], area)


def _sums(e: Edges, n: int) -> tuple[np.ndarray, ...]:
    """Of each row: whether it has trapezoids, the areas of both sides, and what they share."""
    some, sums = np.zeros(n, bool), [np.zeros(n) for _ in range(3)]
    for t in _trapezoids(e):
        some[t.row] = True
        for total, test in zip(sums, (t.in1, t.in2, t.in1 & t.in2), strict=True):
            total += np.bincount(t.row, np.where(test, t.area, 0.0), n)
    return some, *sums


def _connected(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The smallest of the n nodes that links lead to, by hooking to the smaller label and halving paths."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        while (new[new] != new).any():
            new = new[new]
        label = new
        apart = label[a] != label[b]
        a, b = a[apart], b[apart]
    return label


def _parted(e: Edges) -> tuple[Trapezoids, np.ndarray]:
    """Trapezoids of the first side, and the first one that touching sides lead to from each."""
    each = [Trapezoids(*(c[t.in1 & (t.area > NEAR * NEAR)] for c in t)) for t in _trapezoids(e)]
    if not each:
        each = [_between(*(np.zeros(0, int),) * 3, *(np.zeros(0),) * 4)]
    t = Trapezoids(*(np.concatenate(c) for c in zip(*each, strict=True)))
    begin, end = np.searchsorted(t.slab, t.slab + 1), np.searchsorted(t.slab, t.slab + 2)
    links = []
    for i, j in _runs(end - begin):
        own, k = _spread(end[i:j] - begin[i:j])
        a, b = i + own, begin[i + own] + k
        touch = np.minimum(t.zhi[a], t.zlo[b]) - np.maximum(t.yhi[a], t.ylo[b]) > NEAR
        links.append((a[touch], b[touch]))
    a, b = (np.concatenate(c) for c in zip(*links, strict=True)) if links else (np.zeros(0, int),) * 2
    return t, _connected(a, b, len(t.row))


def _outline(t: Trapezoids, part: np.ndarray) -> tuple[np.ndarray, ...]:
    """(part, x1, y1, x2, y2): edges around the trapezoids of each part, the inside at their left."""
    stack = lambda *c: np.concatenate(c)
    ways = np.repeat([1, -1], len(part))
    of, at, x, y, z = stack(part, part), stack(t.slab + 1, t.slab), stack(t.hi, t.lo), stack(t.yhi, t.ylo), stack(t.zhi, t.zlo)
    high = z > y
    of, at, x, y, z, ways = (c[high] for c in (of, at, x, y, z, ways))
    # sides that two trapezoids share cancel, stretch by stretch
    _, group = _places(of, at)
    ys, place = _places(stack(group, group), stack(y, z))
    first, last = place[: len(y)], place[len(y) :]
    own, k = _spread(last - first)
    way = np.bincount(first[own] + k, ways[own], len(ys))
    step = np.flatnonzero(way)
    some = np.zeros(len(ys), np.int64)
    some[first[own] + k] = own
    of, x, up = of[some[step]], x[some[step]], way[step] > 0
    low, top = ys[step], ys[step + 1] if len(step) else ys[:0]
    return stack(part, part, of), stack(t.lo, t.hi, x), stack(t.ylo, t.zhi, np.where(up, low, top)), stack(t.hi, t.lo, x), stack(t.yhi, t.zlo, np.where(up, top, low))


def _walk(lines: list[tuple]) -> list[list[tuple]]:
    """Rings of directed edges; where a vertex is left more than once, the next edge is the first clockwise from where one came."""
    out: dict[tuple, list[tuple]] = {}
    for x1, y1, x2, y2 in lines:
        if (x1, y1) != (x2, y2):
            out.setdefault((x1, y1), []).append((x2, y2))
    rings = []
    while out:
        start = at = min(out)
        ring, came = [], None
        while at in out:
            ways = out[at]
            back = math.atan2(came[1] - at[1], came[0] - at[0]) if came else -math.pi / 2
            go = min(ways, key=lambda p: (back - math.atan2(p[1] - at[1], p[0] - at[0])) % (2 * math.pi) or 2 * math.pi) if len(ways) > 1 else ways[0]  # noqa: B023
            ways.remove(go)
            if not ways:
                del out[at]
            ring.append(at)
            came, at = at, go
            if at == start:
                break
        rings.append(_plain(ring))
    return [r for r in rings if len(r) > 2]


def _plain(ring: list[tuple]) -> list[tuple]:
    """A ring without points that repeat the one before or lie on the line between their neighbours."""
    near = lambda p, q: abs(p[0] - q[0]) <= NEAR and abs(p[1] - q[1]) <= NEAR
    apart = [p for k, p in enumerate(ring) if not near(p, ring[k - 1])]
    kept: list[tuple] = []
    for k, p in enumerate(apart):
        a, b = apart[k - 1], apart[(k + 1) % len(apart)]
        far = math.hypot(b[0] - a[0], b[1] - a[1])
        if abs((p[0] - a[0]) * (b[1] - a[1]) - (p[1] - a[1]) * (b[0] - a[0])) > NEAR * max(far, NEAR):
            kept.append(p)
    return kept


def _parts(e: Edges) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[list[list[tuple]]]]:
    """(row, number, area, rings) of each part, those of a row by size."""
    t, root = _parted(e)
    first, part = np.unique(root, return_inverse=True)
    area = np.bincount(part, t.area, len(first)).astype(float)  # whole numbers where there is no part
    of, *ends = _outline(t, part)
    order = np.argsort(of, kind="stable")
    lines = list(zip(*(c[order].tolist() for c in ends), strict=True))
    cuts = np.searchsorted(of[order], np.arange(len(first) + 1)).tolist()
    order = np.lexsort((first, -area, t.row[first]))
    row = t.row[first][order]
    number = _spread(np.bincount(row))[1] if len(row) else row
    return row, number, area[order], [_walk(lines[cuts[k] : cuts[k + 1]]) for k in order.tolist()]


def _rings(shapes: list[list[list[tuple]]]) -> pa.Array:
    """Arrow's form of shapes as lists of rings."""
    rings = [r for s in shapes for r in s]
    xy = np.array([p for r in rings for p in r], float).reshape(-1, 2)
    offsets = lambda lists: pa.array(np.cumsum([0, *map(len, lists)]).astype(np.int32))
    points = pa.StructArray.from_arrays([pa.array(xy[:, 0]), pa.array(xy[:, 1])], ["x", "y"])
    return pa.ListArray.from_arrays(offsets(shapes), pa.ListArray.from_arrays(offsets(rings), points))


def _mapped(df: DataFrame, key: list[str], inputs: list[str], fields: str, work: Callable[..., tuple]) -> DataFrame:
    """(key, fields): `work` gets the inputs of a block of rows and returns the rows that its results are of, and the results."""
    given = df.select(*key, *(F.col(c).cast(RINGS).alias(f"__in{i}") for i, c in enumerate(inputs)))
    schema = StructType([*given.schema.fields[: len(key)], *StructType.fromDDL(fields).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = sum(np.bincount(_spread(_lengths(c))[0], _lengths(c.flatten()), len(c)) for c in batch.columns[len(key) :])
            ends, start = np.cumsum(size + 1), 0
            while start < len(batch):
                stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + POINTS, "right")))
                block = batch.slice(start, stop - start)
                with np.errstate(all="ignore"):
                    at, *columns = work(*block.columns[len(key) :])
                yield pa.RecordBatch.from_arrays([*(c.take(pa.array(at)) for c in block.columns[: len(key)]), *columns], schema.names)
                start = stop

    return given.mapInArrow(run, schema)


def validity(shapes: DataFrame, key: list[str], rings: str = "rings") -> DataFrame:
    """(key, n_rings, valid): valid shapes have rings of three edges or more, each simple, that don't cross or overlap one another.

    A ring is simple if its edges meet in the vertices between neighbours only: no crossing, no vertex passed
    twice, no stretch walked twice.  Rings of one shape may touch in points.  Shapes without an edge have no row.
    """

    def work(rings: pa.Array) -> tuple:
        count, valid = _validity(_edges(rings), len(rings))
        at = np.flatnonzero(count)
        return at, pa.array(count[at]), pa.array(valid[at])

    return _mapped(shapes, key, [rings], "n_rings long, valid boolean", work)


def areas(shapes: DataFrame, key: list[str], rings: str = "rings") -> DataFrame:
    """(key, area): what an odd number of rings enclose, whether rings cross or not; shapes without area have no row."""

    def work(rings: pa.Array) -> tuple:
        some, area, *_ = _sums(_edges(rings), len(rings))
        at = np.flatnonzero(some)
        return at, pa.array(area[at])

    return _mapped(shapes, key, [rings], "area double", work)


def shared(pairs: DataFrame, key: list[str], a: str = "a", b: str = "b") -> DataFrame:
    """(key, area_a, area_b, inter) of pairs of shapes with any rings; pairs of shapes without area have no row."""

    def work(a: pa.Array, b: pa.Array) -> tuple:
        some, *sums = _sums(_both(_edges(a, 1), _edges(b, 2)), len(a))
        at = np.flatnonzero(some)
        return at, *(pa.array(s[at]) for s in sums)

    return _mapped(pairs, key, [a, b], "area_a double, area_b double, inter double", work)


def iou(pairs: DataFrame, key: list[str], a: str = "a", b: str = "b") -> DataFrame:
    """(key, inter, iou) of pairs of shapes that share area."""
    union = F.col("area_a") + F.col("area_b") - F.col("inter")
    return shared(pairs, key, a, b).where("inter > 0").select(*key, "inter", F.when(union > 1e-12, F.col("inter") / union).otherwise(0.0).alias("iou"))


def parts(shapes: DataFrame, key: list[str], rings: str = "rings") -> DataFrame:
    """(key, part, area, rings): each connected stretch of the inside of a shape, its outer ring and its holes, numbered from 0 by size.

    What lines alone join, or points, are parts of their own, so crossing rings fall apart where they cross
    and stretches without width go.  Areas add up to that of the shape.
    """

    def work(rings: pa.Array) -> tuple:
        row, number, area, out = _parts(_edges(rings))
        return row, pa.array(number.astype(np.int32)), pa.array(area), _rings(out)

    return _mapped(shapes, key, [rings], f"part int, area double, rings {RINGS}", work)


def repaired(shapes: DataFrame, key: list[str], rings: str = "rings", keep: str = "all") -> DataFrame:
    """(key, part, area, rings) with valid shapes as they are and others by their parts.

    `keep`: "all" parts, the "largest", or "single": shapes that fall into several parts are left out.
    Null and empty shapes, and those without area, have no row.
    """
    if keep not in ("all", "largest", "single"):
        raise ValueError(f"unknown rule {keep}")

    def work(rings: pa.Array) -> tuple:
        e, n = _edges(rings), len(rings)
        count, valid = _validity(e, n)
        good = valid & (count > 0)
        own = lambda test: Edges(*(c[test[e.row]] for c in e))
        some, whole, *_ = _sums(own(good), n)
        fine = np.flatnonzero(some)
        row, number, area, out = _parts(own(~good))
        if keep != "all":
            use = number == 0 if keep == "largest" else np.bincount(row, minlength=n)[row] == 1
            row, number, area, out = row[use], number[use], area[use], [r for r, u in zip(out, use.tolist(), strict=True) if u]
        joined = pa.concat_arrays([rings.take(pa.array(fine)), _rings(out).cast(rings.type)])
        return np.append(fine, row), pa.array(np.append(np.zeros(len(fine)), number).astype(np.int32)), pa.array(np.append(whole[fine], area)), joined

    return _mapped(shapes, key, [rings], f"part int, area double, rings {RINGS}", work)


def cleaning(shapes: DataFrame, key: list[str], rings: str = "rings") -> DataFrame:
    """(n, empty, invalid, mended, lost, kept): one row that tells what each step of cleaning a layer leaves.

    empty shapes are null or have no edge, mended ones were invalid and have area once repaired, lost ones
    were invalid and have none.
    """

    def work(rings: pa.Array) -> tuple:
        e, n = _edges(rings), len(rings)
        count, valid = _validity(e, n)
        some, area, *_ = _sums(Edges(*(c[~valid[e.row]] for c in e)), n)
        return np.arange(n), pa.array(valid, mask=count == 0), pa.array(area, mask=~some)

    rows, bad = _mapped(shapes, key, [rings], "valid boolean, area double", work), ~F.col("valid")
    return rows.agg(
        F.count("*").alias("n"), F.count_if(F.col("valid").isNull()).alias("empty"), F.count_if(bad).alias("invalid"), F.count_if(bad & (F.col("area") > 0)).alias("mended"),
        F.count_if(bad & F.col("area").isNull()).alias("lost"), F.count_if(F.col("valid") | (F.col("area") > 0)).alias("kept"),
    )
