"""Predictions against ground truth at several thresholds."""

from __future__ import annotations

from collections.abc import Callable
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .polygons import aspect, cleaned, polygon_iou
from .spatial import box_join, gathered
from ..functions.geom import box_iou
from ..plans.storage import cut

#: Fixed values of the reports.
THRESHOLDS = [0.35, 0.50, 0.65, 0.75]
#: Sides of boxes that a cell of the first round of matching has, and pairs that one task of a cell takes.
SIDES, CELL_PAIRS = 32, 2**18


def thresholds(df: DataFrame) -> DataFrame:
    """A row for each threshold that a detection reaches."""
    return df.withColumn("threshold", F.explode(F.array(*map(F.lit, THRESHOLDS)))).where("confidence >= threshold")


def threshold_counts(cands: DataFrame) -> DataFrame:
    """(threshold, n, b35, b50, b65, b75): instances from each threshold on, and how many are in each bin."""
    c = F.col("confidence")
    edges = [*THRESHOLDS, 1.01]
    bins = [F.count_if((c >= a) & (c < b)).alias(f"b{round(a * 100)}") for a, b in zip(edges, edges[1:], strict=False)]
    return thresholds(cands).groupBy("threshold").agg(F.count("*").alias("n"), *bins)


def per_image(images: DataFrame, cands: DataFrame) -> DataFrame:
    """Predictions an image at each threshold, images without any included."""
    grid = images.select("image", F.explode(F.array(*map(F.lit, THRESHOLDS))).alias("threshold"))
    counts = thresholds(cands).groupBy("image", "threshold").agg(F.count("*").alias("c"))
    rows = grid.join(counts, ["image", "threshold"], "left").select("threshold", F.coalesce("c", F.lit(0)).alias("c"))
    return rows.groupBy("threshold").agg(F.avg("c").alias("mean"), F.median("c").alias("median"), F.max("c").alias("most"))


def iou_pairs(pred: DataFrame, gt: DataFrame, least: float = 0.5, ring: str | None = None, of: list[str] = []) -> DataFrame:  # noqa: B006
    """(image, p, g, iou, of) of an image's boxes, or of the polygons that `ring` names, that overlap enough; `of` names columns of pred."""
    cols = ["cand_id", "image", "xmin", "ymin", "xmax", "ymax", *filter(None, [ring])]
    pairs = box_join(pred.select(cols), gt.select(cols), 400.0, equal=["image"]).withColumn("iou", F.round(polygon_iou(F.col(f"a_{ring}"), F.col(f"b_{ring}")), 9) if ring else box_iou())
    return pairs.where(F.col("iou") >= least).select(F.col("a_image").alias("image"), F.col("a_cand_id").alias("p"), F.col("b_cand_id").alias("g"), "iou", *(F.col(f"a_{c}").alias(c) for c in of))


def polygon_ious(pred: DataFrame, gt: DataFrame, ring: Callable[[str], Column], cell: float = 400.0) -> DataFrame:
    """(p, g, iou, aspect) of all boxes of an image that share area, by the polygons that `ring` makes of them.

    The kernels see each two places and each place of pred once; pairs of rows are made of their lists, which go along with the places.
    """
    a, b = (gathered(rows, "cand_id", ["image"]) for rows in (pred, gt))
    a = a.withColumns({"ring": cleaned(ring("")), "aspect": F.round(aspect(ring("")), 6)})
    met = box_join(a.drop("place"), b.drop("place"), cell, equal=["image"])
    met = met.select("a_ids", "b_ids", F.round(polygon_iou("a_ring", ring("b_")), 6).alias("iou"), F.col("a_aspect").alias("aspect"))
    return met.select("b_ids", "iou", "aspect", F.explode("a_ids").alias("p")).select("p", F.explode("b_ids").alias("g"), "iou", "aspect")


def _matched(pairs: DataFrame, left: DataFrame, right: DataFrame, by: list[str], side: float = 1.0, levels: int = 1) -> DataFrame:
    """(by, level, p, g): members that a scan by IoU down, then p, then g takes, for each level apart.

    `pairs` has (by, p, g, iou, x, y) of classes, `left` (by, p, x, y, ids, lv) and `right` (by, g, ids): members of a class by id,
    in level 0 up to lv - 1; x and y say where p is.  Members of a class have the same pairs and are used up by id.

    Each round deals classes p with all their pairs to cells of some SIDES sides, each scanned by a task.  Only a class g can have pairs
    in other cells; it is told the first of those, and what hangs on them stays open for the next round, whose cells
    are larger and lie elsewhere.  The first open pair of all hangs on no other, so every round ends some, and mostly all
    but what lies at the sides of cells.  A cell with over CELL_PAIRS pairs falls into parts by p.
    """
    zeros = F.array(*(F.lit(0) for _ in range(levels)))
    pairs = cut(pairs.select(*by, "p", "g", "iou", F.col("x").cast("double"), F.col("y").cast("double"))).withColumns({"head": F.col("p"), "mask": F.lit((1 << levels) - 1)})
    left, right = left.withColumn("ptr", zeros), right.withColumn("ptr", zeros)
    one = {f.name: f.dataType.simpleString() for f in pairs.schema}
    types = {c: one[c] for c in by} | {"kind": "int", "level": "int", "p": one["p"], "g": one["g"], "iou": "double", "x": "double", "y": "double"}
    types |= {"head": one["p"], "mask": "int", "ids": f"array<{one['p']}>", "lv": "array<int>", "ptr": "array<int>"}
    whole = types | {"first_iou": "double", "first_head": one["p"]}
    round_, out = 0, None
    while True:
        size, cell = side * SIDES * 2**round_, [*by, "cx", "cy"]
        at = {f"c{v}": F.floor(F.col(v) / size + round_ % 2 / 2) for v in "xy"}
        many = F.broadcast(pairs.withColumns(at).groupBy(*cell).agg(F.ceil(F.count("*") / CELL_PAIRS).alias("parts")).where("parts > 1"))
        dealt = lambda rows: rows.withColumns(at).join(many, cell, "left").withColumn("part", F.coalesce(F.pmod(F.xxhash64("p"), F.col("parts")), F.lit(0)))  # noqa: B023, E731
        spots, task = dealt(pairs), [*cell, "part"]
        order = Window.partitionBy(*by, "g").orderBy("low")
        reach = spots.groupBy(*by, "g", *task[len(by) :]).agg(F.min(F.struct((-F.col("iou")).alias("v"), "head")).alias("low"))
        reach = reach.withColumn("low", F.when(F.row_number().over(order) == 1, F.lead("low").over(order)).otherwise(F.first("low").over(order)))
        reach = reach.join(right, [*by, "g"]).withColumns({"first_iou": -F.col("low.v"), "first_head": F.col("low.head")})
        rows = None
        for kind, df in enumerate((spots, dealt(left), reach)):
            df = df.select(*task[len(by) :], *((F.lit(kind) if c == "kind" else F.col(c) if c in df.columns else F.lit(None)).cast(t).alias(c) for c, t in whole.items()))
            rows = df if rows is None else rows.unionByName(df)
        done = cut(rows.groupBy(*task).applyInArrow(_scanned(by, levels), ", ".join(f"`{c}` {t}" for c, t in types.items())))
        took = done.where(F.col("kind") == 3).select(*by, "level", "p", "g")
        out = took if out is None else out.unionByName(took)
        pairs = done.where(F.col("kind") == 0).select(*by, "p", "g", "iou", "x", "y", "head", "mask")
        if pairs.isEmpty():
            return out
        left = done.where(F.col("kind") == 1).select(*by, "p", "x", "y", "ids", "lv", "ptr")
        right = done.where(F.col("kind") == 2).groupBy(*by, "g").agg(F.first("ids").alias("ids"), F.array(*(F.max(F.col("ptr")[i]) for i in range(levels))).alias("ptr"))
        round_ += 1


def _flat(lists: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The values of lists one after the other, and where each list begins and the last one ends."""
    lists = lists.combine_chunks()
    ends = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False), dtype=np.int64)
    return lists.flatten().to_numpy(zero_copy_only=False), np.append(0, ends)


def _scanned(by: list[str], levels: int) -> Callable[[pa.Table], pa.Table]:
    def scan(table: pa.Table) -> pa.Table:
        names = [c for c in table.column_names if c not in ("cx", "cy", "part", "first_iou", "first_head")]
        kind = table["kind"].to_numpy()
        pairs, left, right = (table.filter(pa.array(kind == k)) for k in range(3))
        pairs = pairs.take(pa.array(np.argsort(-pairs["iou"].to_numpy(), kind="stable")))
        iou, mask = pairs["iou"].to_numpy(), pairs["mask"].to_numpy().tolist()
        ends = (np.append(np.flatnonzero(np.diff(iou)) + 1, len(iou)) if len(iou) else iou).tolist()
        ps, gs = (pc.index_in(pairs[n], value_set=side[n].combine_chunks()).to_numpy().tolist() for side, n in ((left, "p"), (right, "g")))
        (ids, starts), lv, (g_ids, g_at) = _flat(left["ids"]), _flat(left["lv"])[0], _flat(right["ids"])
        next_p, next_g = (_flat(side["ptr"])[0].reshape(-1, levels).copy() for side in (left, right))
        was_g = next_g.copy()
        first_v, first_h = right["first_iou"].fill_null(-1.0).to_numpy().tolist(), pc.coalesce(right["first_head"], right["g"]).to_numpy().tolist()
        g_ids, g_end = g_ids.tolist(), g_at[1:].tolist()
        values, open_, heads, took = iou.tolist(), [0] * len(iou), [None] * len(iou), []
        for level in range(levels):
            inside = lv > level
            at = np.append(0, np.cumsum(inside))[starts]
            p_ids, p_end = ids[inside].tolist(), at[1:].tolist()
            # where the first free member of each class is
            pn, gn = (at[:-1] + next_p[:, level]).tolist(), (g_at[:-1] + next_g[:, level]).tolist()
            unsure_p, unsure_g = bytearray(len(pn)), bytearray(len(gn))
            start = 0
            for end in ends:  # pairs as good as each other
                v, near, late = values[start], {}, []
                for k in range(start, end):
                    i, g = ps[k], gs[k]
                    if pn[i] < p_end[i] and gn[g] < g_end[g] and mask[k] >> level & 1:
                        if i in near:
                            near[i].append(k)
                        else:
                            near[i] = [k]
                start = end
                heap = [(p_ids[pn[i]], i) for i in near]
                heapify(heap)
                while heap:
                    head, i = heappop(heap)
                    best, unsure, free = None, unsure_p[i], []
                    for k in near[i]:
                        g = gs[k]
                        if gn[g] < g_end[g]:
                            free.append(k)
                            # p hangs on pairs that are open, or on pairs of other cells that come before
                            unsure = unsure or unsure_g[g] or first_v[g] > v or (first_v[g] == v and first_h[g] < head)
                            if best is None or g_ids[gn[g]] < g_ids[gn[best]]:
                                best = g
                    if best is None:
                        continue
                    near[i] = free
                    if unsure:
                        unsure_p[i] = 1
                        late.append(i)
                        for k in free:
                            unsure_g[gs[k]] = 1
                        continue
                    took.append((level, head, g_ids[gn[best]]))
                    pn[i] += 1
                    gn[best] += 1
                    if pn[i] < p_end[i]:
                        heappush(heap, (p_ids[pn[i]], i))
                for i in late:
                    head = p_ids[pn[i]]
                    for k in near[i]:
                        if gn[gs[k]] < g_end[gs[k]]:
                            open_[k] |= 1 << level
                            heads[k] = head if heads[k] is None else min(heads[k], head)
            next_p[:, level], next_g[:, level] = pn - at[:-1], gn - g_at[:-1]
        still = np.flatnonzero(open_)
        put = lambda rows, **new: pa.table({c: pa.array(new[c], table.schema.field(c).type) if c in new else rows[c] for c in names})
        some = lambda rows, at, ptr: put(rows.take(pa.array(at)), ptr=pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1, dtype=np.int32) * levels), pa.array(ptr[at].ravel())))
        out = [put(pairs.take(pa.array(still)), mask=[open_[k] for k in still], head=[heads[k] for k in still])]
        out.append(some(left, np.unique(np.array(ps, np.int64)[still]), next_p))
        out.append(some(right, np.union1d(np.array(gs, np.int64)[still], np.flatnonzero((next_g != was_g).any(1))).astype(np.int64), next_g))
        blank = {c: pa.nulls(len(took), table.schema.field(c).type) for c in ("iou", "x", "y", "head", "mask", "ids", "lv", "ptr")}
        level, p, g = zip(*took, strict=True) if took else ((), (), ())
        out.append(put(table.take(pa.array([0] * len(took), pa.int64())), **blank, kind=[3] * len(took), level=level, p=p, g=g))
        return pa.concat_tables(out)

    return scan


def greedy_matches(pairs: DataFrame, by: list[str] = []) -> DataFrame:  # noqa: B006
    """Pairs taken by IoU down, then prediction, then truth, where both sides are free; `by` names columns that part separate matchings."""
    pairs, of = cut(pairs.select(*by, "image", "p", "g", "iou")), [*by, "image"]
    spot = {"x": F.lit(0.0), "y": F.lit(0.0)}
    left, right = (pairs.select(*of, side).distinct().withColumns({"ids": F.array(side), "lv": F.array(F.lit(1)), **spot}) for side in "pg")
    return pairs.join(_matched(pairs.withColumns(spot), left, right, of).drop("level"), [*of, "p", "g"]).select(*by, "image", "p", "g", "iou")


def _classes(rows: DataFrame, ring: str | None, levels: bool) -> DataFrame:
    """(image, box, cand_id, ids, lv): boxes of an image that differ, each by its smallest cand_id, with their members by id and how many thresholds each reaches."""
    shape = ["image", "xmin", "ymin", "xmax", "ymax", *filter(None, [ring])]
    reached = sum(((F.col("confidence") >= t).cast("int") for t in THRESHOLDS), F.lit(0)) if levels else F.lit(1)
    of = rows.withColumn("lv", reached).where("lv > 0").groupBy(*shape).agg(F.array_sort(F.collect_list(F.struct("cand_id", "lv"))).alias("m"))
    return cut(of.select(*shape, F.col("m")[0]["cand_id"].alias("cand_id"), F.col("m.cand_id").alias("ids"), F.col("m.lv").alias("lv")))


def match(pred: DataFrame, gt: DataFrame, least: float = 0.5, ring: str | None = None, levels: bool = False) -> DataFrame:
    """(image, p, g): what `greedy_matches` takes of all `iou_pairs`, with `levels` at each threshold apart.

    Only boxes that differ are paired, so pairs follow places and not the square of the candidates; the members of one box of an image must fit a task.
    """
    a, b = _classes(pred, ring, levels), _classes(gt, ring, False)
    side = a.agg(F.avg(F.greatest(F.col("xmax") - F.col("xmin"), F.col("ymax") - F.col("ymin")))).first()[0]
    spot = {"xmin": "x", "ymin": "y"}
    pairs = iou_pairs(a, b, least, ring, list(spot)).withColumnsRenamed(spot)
    left, right = a.select("image", F.col("cand_id").alias("p"), F.col("xmin").alias("x"), F.col("ymin").alias("y"), "ids", "lv"), b.select("image", F.col("cand_id").alias("g"), "ids")
    took = _matched(pairs, left, right, ["image"], side or 1.0, len(THRESHOLDS) if levels else 1)
    return took.select(*([F.array(*map(F.lit, THRESHOLDS))[F.col("level")].alias("threshold")] if levels else []), "image", "p", "g")


def scores(pred: DataFrame, gt: DataFrame, least: float = 0.5) -> DataFrame:
    """(threshold, tp, fp, fn, precision, recall, f1) over all images."""
    tp = match(pred, gt, least, levels=True).groupBy("threshold").agg(F.count("*").alias("tp"))
    n = thresholds(pred).groupBy("threshold").agg(F.count("*").alias("n_pred"))
    rows = pred.sparkSession.createDataFrame([(t,) for t in THRESHOLDS], "threshold double")
    rows = rows.join(tp, "threshold", "left").join(n, "threshold", "left").join(gt.agg(F.count("*").alias("n_gt"))).na.fill(0)
    out = rows.select("threshold", "tp", (F.col("n_pred") - F.col("tp")).alias("fp"), (F.col("n_gt") - F.col("tp")).alias("fn"))
    p, r = F.col("tp") / F.greatest(F.lit(1), F.col("tp") + F.col("fp")), F.col("tp") / F.greatest(F.lit(1), F.col("tp") + F.col("fn"))
    out = out.withColumns({"precision": p, "recall": r})
    return out.withColumn("f1", F.when(F.col("precision") + F.col("recall") == 0, 0.0).otherwise(2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))))
