"""Detections: tile labels, quality filters, duplicate suppression and their reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import overlay
from .greedy import greedy_dropped
from .polygons import polygon_iou, polygon_overlap
from .selection import medians
from .spatial import box_join, gathered, places, spread
from ..functions.geom import box_iou, box_ring, overlap_area, ring_area
from ..plans.storage import cut

#: Fixed values of the filters: areas in square metres, compactness, share of a polygon that must be visible.
MIN_AREA, MAX_AREA, MIN_COMPACT, VISIBLE = 10000.0, 600000.0, 0.35, 0.70
CELL = 400.0


def tile_polygons(tiles: DataFrame, boxes: DataFrame, cell: float = 6400.0, ring: str | None = None) -> DataFrame:
    """Pairs of tiles and boxes that share area, with the share of the box that is inside; `ring` names the polygons in the boxes."""
    of = ["area", *filter(None, [ring])]
    spots, found = gathered(tiles, "tile_id"), gathered(boxes, "cand_id", of)
    met = box_join(places(spots), places(found, of), cell).withColumn("inter", polygon_overlap(box_ring("a_"), F.col(f"b_{ring}")) if ring else overlap_area()).where(F.col("inter") > 0)
    met = met.select("a_place", "b_place", "inter", (F.col("inter") / F.col("b_area")).alias("visible"))
    return _of_tiles(met, spots, found)


def _of_tiles(met: DataFrame, spots: DataFrame, found: DataFrame) -> DataFrame:
    """What places share, for each of their tiles and candidates."""
    pairs = spread(met, spots, found, "tile_id", to="cand_id")
    return pairs.select(F.col("a_tile_id").alias("tile_id"), F.col("b_cand_id").alias("cand_id"), "inter", "visible")


def tile_shapes(tiles: DataFrame, shapes: DataFrame, cell: float = 6400.0) -> DataFrame:
    """(tile_id, cand_id, inter, visible) of tiles and shapes (cand_id, rings) with holes and parts that share area.

    Shapes whose box lies in a tile are whole there; only the others are cut at its sides.
    """
    ends = lambda f, v: f(F.transform(F.flatten("rings"), lambda p: p[v]))
    boxed = shapes.select("cand_id", "rings", *(ends(f, v).alias(f"{v}{n}") for v in "xy" for n, f in (("min", F.array_min), ("max", F.array_max)))).where("xmin IS NOT NULL")
    spots, found = gathered(tiles, "tile_id"), gathered(boxed, "cand_id", ["rings"])
    shaped = places(found, ["rings"])
    pairs = box_join(places(spots), shaped, cell)
    within = F.expr("b_xmin >= a_xmin AND b_xmax <= a_xmax AND b_ymin >= a_ymin AND b_ymax <= a_ymax")
    size = overlay.areas(shaped.select(F.col("place").alias("b_place"), "rings"), ["b_place"])
    whole = pairs.where(within).select("a_place", "b_place").join(size, "b_place").select("a_place", "b_place", F.col("area").alias("inter"), F.lit(1.0).alias("visible"))
    across = pairs.where(~within).select("a_place", "b_place", F.array(box_ring("a_")).alias("a"), F.col("b_rings").alias("b"))
    part = overlay.shared(across, ["a_place", "b_place"]).where("inter > 0")
    return _of_tiles(whole.unionByName(part.select("a_place", "b_place", "inter", (F.col("inter") / F.col("area_b")).alias("visible"))), spots, found)


def tile_decisions(tiles: DataFrame, joined: DataFrame, min_pixels: float = 4.0, keep: float = 0.10, res: float = 10.0) -> DataFrame:
    """(tile_id, n_labels, decision): a partly visible polygon skips the tile, then labels make it positive,
    polygons below the least size alone skip it, and of empty tiles a tenth is kept by hash."""
    small = F.col("inter") / (res * res) < min_pixels
    per = joined.groupBy("tile_id").agg(F.bool_or(F.col("visible") < VISIBLE).alias("partial"), F.count_if(~small).alias("n_labels"), F.bool_or(small).alias("small"))
    rows = tiles.select("tile_id").join(per, "tile_id", "left")
    lucky = F.md5(F.concat(F.col("tile_id").cast("string"), F.lit(":neg"))) < f"{int(keep * 16**4):04x}"
    decision = F.when(F.col("partial"), "skip_partial").when(F.col("n_labels") > 0, "positive").when(F.col("small"), "skip_small").when(lucky, "negative").otherwise("skip_negative")
    return rows.select("tile_id", F.coalesce("n_labels", F.lit(0)).cast("long").alias("n_labels"), decision.alias("decision"))


def quota(tiles: DataFrame, most: int = 40) -> DataFrame:
    """At most `most` tiles of each source, positives first, in scan order."""
    rank = F.row_number().over(Window.partitionBy("source").orderBy("is_negative", "ymin", "xmin", "tile_id"))
    return tiles.withColumn("rank", rank).where(F.col("rank") <= most)


def quality_reason(least: float, area: str = "area", compact: str = "compact") -> Column:
    """The first rule that a detection fails, null for none."""
    return F.when(F.col("confidence") < least, "low_conf").when(F.col(area) < MIN_AREA, "too_small").when(F.col(area) > MAX_AREA, "too_large").when(F.col(compact) < MIN_COMPACT, "low_compactness")


def _rank(edge_iou: float | None) -> list[str]:
    return ["is_edge", "-confidence", "-area", "cand_id"] if edge_iou is not None else ["-confidence", "cand_id"]


def _part(p: str, c: str) -> Column:
    return -F.col(p + c[1:]) if c[0] == "-" else F.col(p + c)


def _kind(share: Column, late_edge: Column, early_edge: Column, iou: float, edge_iou: float | None, strict: bool) -> Column:
    kind = F.when(share > iou if strict else share >= iou, "nms_dropped")
    return kind if edge_iou is None else kind.when((late_edge == 1) & (early_edge == 0) & (share >= edge_iou), "edge_dropped")


def _near(cands: DataFrame, iou: float, edge_iou: float | None, scope: list[str], strict: bool, ring: str | None) -> DataFrame:
    """(late, early, earlier, kind, kind0, kind1, rank): pairs whose boxes share enough, themselves included; `kind0` and
    `kind1` are what `early` makes of anything in the place of `late` that is off or at an edge."""
    use = cands.select("cand_id", "is_edge", "confidence", "area", "xmin", "ymin", "xmax", "ymax", *scope, *filter(None, [ring]))
    parts = _rank(edge_iou)
    # the order of the ranks of b and a column by column, which compiles where that of structs does not
    earlier = F.lit(False)
    for c in reversed(parts):
        earlier = (_part("b_", c) < _part("a_", c)) | ((_part("b_", c) == _part("a_", c)) & earlier)
    share = F.round(polygon_iou(F.col(f"a_{ring}"), F.col(f"b_{ring}")), 9) if ring else box_iou()
    least = min(iou, iou if edge_iou is None else edge_iou)
    use = use.withColumn("__size", ring_area(F.col(ring))) if ring else use
    pairs = box_join(use, use, CELL, equal=scope)
    if ring:  # simple polygons share no more than their boxes do, which leaves few pairs to be cut
        rest = F.col("a___size") + F.col("b___size") - overlap_area()
        pairs = pairs.where(F.coalesce((rest <= 0) | (overlap_area() >= (least - 1e-6) * rest), F.lit(True)))
    # one plain test of all pairs, which compiles where the kinds do not
    pairs = pairs.withColumn("iou", share).where(F.col("iou") >= least)
    kinds = {n: _kind(F.col("iou"), e, F.col("b_is_edge"), iou, edge_iou, strict) for n, e in (("kind", F.col("a_is_edge")), ("kind0", F.lit(0)), ("kind1", F.lit(1)))}
    rank = F.struct(*(_part("b_", c) for c in parts))
    return pairs.select(F.col("a_cand_id").alias("late"), F.col("b_cand_id").alias("early"), F.coalesce(earlier, F.lit(False)).alias("earlier"), *(k.alias(n) for n, k in kinds.items()), rank.alias("rank"))


def suppressed(cands: DataFrame, iou: float = 0.70, edge_iou: float | None = 0.50, scope: list[str] = [], strict: bool = False, ring: str | None = None) -> DataFrame:  # noqa: B006
    """`cands` with status: kept, or why its best-ranked kept neighbour drops it.

    Rank: off-edge before edge, then confidence and area down, then cand_id; with edge_iou None by
    confidence alone.  `scope` names columns within which conflicts arise, none for the whole table.
    `ring` names the polygons in the boxes; their IoU is rounded to nine places, so that ties don't hang on arithmetic.

    Candidates in one place have the same neighbours, and what drops the best of them drops the others, as does the
    best itself if it stays.  So only the best of each place meets its neighbours, and work follows places.
    """
    rules = (iou, edge_iou, scope, strict, ring)
    place = ["xmin", "ymin", "xmax", "ymax", *scope, *filter(None, [ring])]
    names = [c.lstrip("-") for c in _rank(edge_iou)]
    own = F.round(polygon_iou(F.col(ring), F.col(ring)), 9) if ring else box_iou("", "")
    known = lambda columns: F.expr(" AND ".join(f"`{c}` IS NOT NULL" for c in columns))
    alike = known([*scope, *names]) & _kind(own, F.lit(0), F.lit(0), iou, edge_iou, strict).isNotNull()
    if edge_iou is not None:
        alike = alike & F.col("is_edge").isin(0, 1)
    best = F.min_by(F.struct("is_edge", "confidence", "area", "cand_id"), F.struct(*(_part("", c) for c in _rank(edge_iou))))

    def placed(test: Column) -> tuple[DataFrame, DataFrame]:
        rows = cands.withColumn("__own", F.struct(F.when(~F.coalesce(test, F.lit(False)), F.col("cand_id")).alias("id")))
        return rows, cut(rows.groupBy(*place, "__own").agg(best.alias("r")).select(*place, "__own", "r.*"))

    rows, first = placed(alike)
    if not first.where(~known(names)).isEmpty():  # what has no full rank is not before or after all of a place
        rows, first = placed(F.lit(False))
    near = cut(_near(first, *rules))
    dropped = greedy_dropped(near.where("earlier AND kind IS NOT NULL")).select(F.col("late").alias("d"))
    kept = near.join(dropped, near["early"] == dropped["d"], "left_anti")
    lowest = lambda kind, test: F.min(F.when(F.col(kind).isNotNull() & test, F.struct("rank", kind)))[kind]
    why = kept.groupBy(F.col("late").alias("cand_id")).agg(lowest("kind", F.col("earlier")).alias("why"), *(lowest(k, F.lit(True)).alias(k) for k in ("kind0", "kind1")))
    of = first.select(*place, "__own", "cand_id").join(why, "cand_id").withColumnRenamed("cand_id", "__best")
    # merged: places are too many to be sent to every task
    out = rows.join(of.hint("merge"), [*place, "__own"], "left")
    status = F.when(F.col("cand_id") == F.col("__best"), F.col("why")).otherwise(F.when(F.col("is_edge") == 1, F.col("kind1")).otherwise(F.col("kind0")))
    return out.withColumn("status", F.coalesce(status, F.lit("kept"))).select(*cands.columns, "status")


def distribution(cands: DataFrame, *by: str) -> DataFrame:
    """Least, largest, mean and exact median of area, confidence and, where there is one, compactness, and the share at an edge."""
    cols = [c for c in ("area", "confidence", "compactness") if c in cands.columns]
    stats = [f(c).alias(f"{n}_{c}") for c in cols for n, f in (("min", F.min), ("max", F.max), ("mean", F.avg))]
    out = cands.groupBy(*by).agg(F.count("*").alias("n"), *stats, F.avg(F.col("is_edge").cast("double")).alias("edge_share")).withColumn("__one", F.lit(1))
    for c in cols:
        middle = medians(cands, list(by), c).withColumnRenamed("median", f"median_{c}")
        out = out.join(middle.withColumn("__one", F.lit(1)), [*by, "__one"], "left")
    return out.drop("__one")
