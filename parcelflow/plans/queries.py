"""The queries of the engine over the general tables, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import storage
from . import tables as t
from ..functions import geom, projection
from ..operators import detect, evaluate, greedy, infer, labels, masks, overlay, polygons, raster, records, regroup, reports, spatial, split
from ..sources import blocks, png, shapes
from ..streaming import bins

Query = Callable[[SparkSession, str], DataFrame]
_ALL: dict[str, Query] = {}


def _query(f: Query) -> Query:
    _ALL[f.__name__] = f
    return f


def _assigned(s: SparkSession, d: str) -> DataFrame:
    tiles = t.tiles(s, d)
    return split.band_assign(tiles, split.band_cuts(tiles))


def _scenes(s: SparkSession, d: str) -> DataFrame:
    k = F.col("s_suppkey")
    return t.load(s, d, "supplier").select(k.alias("scene"), (400 + 97 * (k % 40)).alias("height"), (500 + 61 * (k % 50)).alias("width"))


def _sides(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    c = t.candidates(s, d)
    return c.where("cand_id % 2 = 0"), c.where("cand_id % 2 = 1")


@_query
def source_stats(s: SparkSession, d: str) -> DataFrame:
    return split.source_stats(t.tiles(s, d))


@_query
def scene_overlap_pairs(s: SparkSession, d: str) -> DataFrame:
    return split.scene_overlaps(t.tiles(s, d))


@_query
def scene_components(s: SparkSession, d: str) -> DataFrame:
    """Suppliers are joined where their numbers differ by 7 within a nation: chains of known shape."""
    n = t.load(s, d, "supplier").select(F.col("s_suppkey").alias("node"), F.col("s_nationkey").alias("nation"))
    a, b = (n.select(F.col("node").alias(x), F.col("nation").alias(f"n{x}")) for x in "ab")
    return greedy.components(n, a.join(b, (F.col("na") == F.col("nb")) & (F.col("b") > F.col("a")) & (F.col("b") - F.col("a") <= 7)))


@_query
def cross_source_overlap(s: SparkSession, d: str) -> DataFrame:
    pairs = spatial.overlaps(t.tiles(s, d).select("tile_id", "source", "xmin", "ymin", "xmax", "ymax"), "tile_id", t.TILE, "source")
    return pairs.select(F.col("a_tile_id").alias("a"), F.col("b_tile_id").alias("b"), "area")


@_query
def uneven_overlap_pairs(s: SparkSession, d: str) -> DataFrame:
    """Tiles whose side depends on their scene, from 1280 m to 41 km, where those of two scenes share ground."""
    side = 1280.0 * F.pow(F.lit(2.0), F.col("source"))
    rows = t.tiles(s, d).select("tile_id", "source", "xmin", "ymin", (F.col("xmin") + side).alias("xmax"), (F.col("ymin") + side).alias("ymax"))
    return spatial.overlaps(rows, "tile_id", None, "source", 0.0).select(F.col("a_tile_id").alias("a"), F.col("b_tile_id").alias("b"), "area")


def _regrouped(s: SparkSession, d: str) -> DataFrame:
    """Orders are tiles, with the images of their lines and the labels of events of their number."""
    side = lambda test: F.when(test, "train").otherwise("val").alias("split")
    tiles = t.tiles(s, d)
    assigned = tiles.select("tile_id", F.when(F.col("is_negative") == 0, "train").otherwise("val").alias("old_split")).join(split.random_split(tiles), "tile_id").withColumnRenamed("tile_id", "tile")
    images = t.load(s, d, "lineitem").select(F.col("l_orderkey").alias("tile"), side(F.col("l_quantity") < 25))
    labels = t.load(s, d, "events").select(F.col("event_id").alias("tile"), side(F.col("event_id") % 3 == 0))
    return regroup.plan_pairs(assigned, images, labels)


@_query
def pair_regroup(s: SparkSession, d: str) -> DataFrame:
    return _regrouped(s, d)


@_query
def pair_regroup_report(s: SparkSession, d: str) -> DataFrame:
    """What was copied to each split and what is missing there, with totals."""
    return _regrouped(s, d).rollup("split").agg(F.count("*").alias("n"), *(F.count_if(F.col("status") == k).alias(k) for k in ("copied", "missing_image", "missing_label", "missing_both")), F.count_if((F.col("status") == "copied") & (F.col("image_from") != F.col("label_from"))).alias("mixed"))


@_query
def random_split(s: SparkSession, d: str) -> DataFrame:
    return split.random_split(t.tiles(s, d))


@_query
def source_split(s: SparkSession, d: str) -> DataFrame:
    return split.source_split(t.tiles(s, d))


@_query
def band_cut_search(s: SparkSession, d: str) -> DataFrame:
    return split.band_cuts(t.tiles(s, d)).select("k1", "k2", "c1", "c2", "n0", "n1", "n2", "dropped", F.round("score", 9).alias("score"))


@_query
def band_assign(s: SparkSession, d: str) -> DataFrame:
    return _assigned(s, d).select("tile_id", "split")


@_query
def split_audit(s: SparkSession, d: str) -> DataFrame:
    return split.split_audit(_assigned(s, d))


@_query
def split_sources(s: SparkSession, d: str) -> DataFrame:
    return split.split_sources(_assigned(s, d))


@_query
def split_report(s: SparkSession, d: str) -> DataFrame:
    return reports.splitting(_assigned(s, d))


@_query
def leakage_report(s: SparkSession, d: str) -> DataFrame:
    """The audit of a random split: tile names repeat every 60 tiles."""
    tiles = t.tiles(s, d)
    rows = tiles.join(split.random_split(tiles), "tile_id")
    return reports.leakage(rows.withColumn("tile_name", F.format_string("tile_%02d", F.col("tile_id") % 60)))


@_query
def evaluation_report(s: SparkSession, d: str) -> DataFrame:
    return reports.evaluation(evaluate.scores(*_sides(s, d), 0.1))


@_query
def leak_pairs(s: SparkSession, d: str) -> DataFrame:
    """Leaks of a random split, which the bands avoid."""
    tiles = t.tiles(s, d)
    return split.leak_pairs(tiles.join(split.random_split(tiles), "tile_id")).select(F.col("a_tile_id").alias("a"), F.col("b_tile_id").alias("b"), "area")


@_query
def leak_gate(s: SparkSession, d: str) -> DataFrame:
    return split.count_leaks(_assigned(s, d)).select(F.col("n").alias("leaks"))


@_query
def leak_val_train(s: SparkSession, d: str) -> DataFrame:
    tiles = t.tiles(s, d)
    return split.val_train_overlap(tiles.join(split.random_split(tiles), "tile_id"))


@_query
def pair_missing_label(s: SparkSession, d: str) -> DataFrame:
    return t.load(s, d, "documents").select("doc_id").join(t.load(s, d, "labels").select("doc_id"), "doc_id", "left_anti")


@_query
def pair_missing_image(s: SparkSession, d: str) -> DataFrame:
    """Scenes stand for images; there are fewer of them than labels."""
    return t.load(s, d, "labels").select("doc_id").join(_scenes(s, d).select(F.col("scene").alias("doc_id")), "doc_id", "left_anti")


@_query
def pair_status(s: SparkSession, d: str) -> DataFrame:
    a, b = t.load(s, d, "documents").select(F.col("doc_id").alias("a")), t.load(s, d, "labels").select(F.col("doc_id").alias("b"))
    state = F.when(F.col("a").isNull(), "no_image").when(F.col("b").isNull(), "no_label").otherwise("paired")
    return a.join(b, F.col("a") == F.col("b"), "full_outer").groupBy(state.alias("state")).agg(F.count("*").alias("n"))


@_query
def shared_keys(s: SparkSession, d: str) -> DataFrame:
    a = _assigned(s, d)
    one, two = (a.where(F.col("split") == x).select("source") for x in ("train", "val"))
    return one.intersect(two)


@_query
def tile_grid_clamped(s: SparkSession, d: str) -> DataFrame:
    return raster.grid(_scenes(s, d), clamped=True)


@_query
def tile_grid_truncated(s: SparkSession, d: str) -> DataFrame:
    return raster.grid(_scenes(s, d), clamped=False)


@_query
def grid_centre_out(s: SparkSession, d: str) -> DataFrame:
    return raster.centre_out(raster.grid(_scenes(s, d), clamped=False))


@_query
def tile_polygon_join(s: SparkSession, d: str) -> DataFrame:
    return detect.tile_polygons(t.tiles(s, d), t.candidates(s, d))


@_query
def tile_decision(s: SparkSession, d: str) -> DataFrame:
    tiles = t.tiles(s, d)
    return detect.tile_decisions(tiles, detect.tile_polygons(tiles, t.candidates(s, d)))


@_query
def tile_quota(s: SparkSession, d: str) -> DataFrame:
    return detect.quota(t.tiles(s, d)).select("tile_id", "source", "rank")


@_query
def band_minmax(s: SparkSession, d: str) -> DataFrame:
    return raster.band_range(t.pixels(s, d))


@_query
def band_histogram(s: SparkSession, d: str) -> DataFrame:
    return raster.histogram(t.pixels(s, d)).select("scene", "band", "bin", "count")


@_query
def stretch_params(s: SparkSession, d: str) -> DataFrame:
    return raster.stretch_params(raster.histogram(t.pixels(s, d))).select("scene", "band", *((F.round(F.col(c) * 1e6) / 1e6).alias(c) for c in ("p_lo", "p_hi")))


@_query
def stretch_apply(s: SparkSession, d: str) -> DataFrame:
    px = t.pixels(s, d)
    return raster.stretched(px, raster.stretch_params(raster.histogram(px))).groupBy("scene", "band").agg(F.count("*").alias("n"), F.sum("v8").alias("total"), F.count_if(F.col("v8") == 255).alias("top"))


def _label_query(rules: str) -> Query:
    def f(s: SparkSession, d: str) -> DataFrame:
        return labels.validated(t.label_lines(s, d), rules)

    return f


for _rules in ("strict", "train", "lenient", "range4", "qc"):
    _ALL[f"labels_{_rules}"] = _label_query(_rules)


@_query
def label_vertex_stats(s: SparkSession, d: str) -> DataFrame:
    return labels.vertex_stats(t.label_lines(s, d))


@_query
def label_empty_ratio(s: SparkSession, d: str) -> DataFrame:
    lines = t.label_lines(s, d)
    return labels.empty_share(lines.withColumn("file", F.col("line_no") % 1000))


@_query
def label_qc_record(s: SparkSession, d: str) -> DataFrame:
    return labels.qc_record(t.label_lines(s, d))


@_query
def duplicate_instances(s: SparkSession, d: str) -> DataFrame:
    c = t.candidates(s, d).select("cand_id", "image", "xmin", "ymin", "xmax", "ymax")
    pairs = spatial.box_join(c, c, detect.CELL, F.col("a_cand_id") < F.col("b_cand_id"), equal=["image"]).where(geom.box_iou() > 0.9)
    return pairs.groupBy(F.col("a_image").alias("image")).agg(F.count("*").alias("n_dup"))


@_query
def border_flags(s: SparkSession, d: str) -> DataFrame:
    c = t.candidates(s, d)
    px = c.select("cand_id", *((F.col(a) % 641).alias(a) for a in ("xmin", "ymin")), "side").withColumns({"xmax": F.col("xmin") + F.col("side") / 10, "ymax": F.col("ymin") + F.col("side") / 10})
    return px.select("cand_id", geom.near_edge(10, False).alias("is_edge"), geom.near_edge(3, True).alias("touches"))


@_query
def shape_metrics(s: SparkSession, d: str) -> DataFrame:
    c = t.candidates(s, d).withColumn("ring", geom.box_ring())
    a, p = geom.ring_area(F.col("ring")), geom.ring_perimeter(F.col("ring"))
    return c.select("cand_id", a.alias("area"), p.alias("perimeter"), F.round(geom.compactness(a, p), 9).alias("compactness"))


@_query
def affine_roundtrip(s: SparkSession, d: str) -> DataFrame:
    c = t.candidates(s, d).withColumn("ring", geom.box_ring())
    x0, y0 = F.lit(500000.0), F.lit(4400000.0)
    ground = c.select("cand_id", "ring", geom.to_ground(F.col("ring"), x0, y0).alias("g")).withColumn("back", geom.to_pixels(F.col("g"), x0, y0))
    return ground.select("cand_id", F.col("g")[0]["x"].alias("gx"), F.col("g")[0]["y"].alias("gy"), (F.col("back") == F.col("ring")).alias("same"))


@_query
def label_format(s: SparkSession, d: str) -> DataFrame:
    return t.candidates(s, d).select("cand_id", geom.label_text(geom.normalised(geom.box_ring())).alias("text"))


def _quality(s: SparkSession, d: str) -> DataFrame:
    return t.candidates(s, d).withColumns({"area": F.col("area") * (F.col("cand_id") % 17), "compact": (F.col("cand_id") % 10) / 10.0})


@_query
def quality_filter_reasons(s: SparkSession, d: str) -> DataFrame:
    return _quality(s, d).groupBy(F.coalesce(detect.quality_reason(0.65), F.lit("kept")).alias("reason")).agg(F.count("*").alias("n"))


@_query
def quality_filter_v2(s: SparkSession, d: str) -> DataFrame:
    return _quality(s, d).where(detect.quality_reason(0.35).isNull()).select("cand_id")


@_query
def quality_filter_v3(s: SparkSession, d: str) -> DataFrame:
    return _quality(s, d).where(detect.quality_reason(0.65).isNull()).select("cand_id")


@_query
def dedup_v1(s: SparkSession, d: str) -> DataFrame:
    return detect.suppressed(t.candidates(s, d), iou=0.5, edge_iou=None, strict=True).select("cand_id", "status")


@_query
def nms_per_source(s: SparkSession, d: str) -> DataFrame:
    return detect.suppressed(t.candidates(s, d), scope=["source"]).select("cand_id", "status")


@_query
def nms_global(s: SparkSession, d: str) -> DataFrame:
    return detect.suppressed(t.candidates(s, d)).select("cand_id", "status")


@_query
def nms_drop_reasons(s: SparkSession, d: str) -> DataFrame:
    return detect.suppressed(t.candidates(s, d)).groupBy("status").agg(F.count("*").alias("n"))


@_query
def survivors_by_source(s: SparkSession, d: str) -> DataFrame:
    kept = detect.suppressed(t.candidates(s, d)).where("status = 'kept'")
    return kept.groupBy("source").agg(F.count("*").alias("kept"), F.count_if(F.col("confidence") >= 0.65).alias("filtered"))


@_query
def skip_totals(s: SparkSession, d: str) -> DataFrame:
    tiles = t.tiles(s, d)
    got = detect.tile_decisions(tiles, detect.tile_polygons(tiles, t.candidates(s, d))).join(tiles.select("tile_id", "source"), "tile_id")
    return got.rollup("source").agg(F.count("*").alias("n"), *(F.count_if(F.col("decision") == k).alias(k) for k in ("skip_partial", "skip_small", "skip_negative")))


@_query
def threshold_counts(s: SparkSession, d: str) -> DataFrame:
    return evaluate.threshold_counts(t.candidates(s, d))


@_query
def threshold_summary(s: SparkSession, d: str) -> DataFrame:
    return detect.distribution(evaluate.thresholds(t.candidates(s, d)), "threshold").select("threshold", "n", "min_area", "max_area", "median_area", "median_confidence", F.round("mean_area", 6).alias("mean_area"))


@_query
def summary_distribution(s: SparkSession, d: str) -> DataFrame:
    return detect.distribution(t.candidates(s, d)).select("n", "min_area", "max_area", "median_area", "min_confidence", "max_confidence", "median_confidence", "edge_share")


@_query
def per_image_counts(s: SparkSession, d: str) -> DataFrame:
    c = t.candidates(s, d)
    return evaluate.per_image(s.range(60).select(F.col("id").alias("image")), c)


@_query
def iou_pairs(s: SparkSession, d: str) -> DataFrame:
    return evaluate.iou_pairs(*_sides(s, d)).withColumn("iou", F.round("iou", 9))


@_query
def greedy_match(s: SparkSession, d: str) -> DataFrame:
    return evaluate.match(*_sides(s, d), 0.1)


@_query
def eval_prf(s: SparkSession, d: str) -> DataFrame:
    return evaluate.scores(*_sides(s, d), 0.1)


@_query
def polygon_iou(s: SparkSession, d: str) -> DataFrame:
    """The Arrow kernel on boxes, so that SQL can say what it must give."""
    return evaluate.polygon_ious(*_sides(s, d), geom.box_ring)


@_query
def infer_stub(s: SparkSession, d: str) -> DataFrame:
    windows = raster.grid(_scenes(s, d), clamped=False).select(F.col("scene").cast("string").alias("scene"), F.col("row").cast("int").alias("row"), F.col("col").cast("int").alias("col"))
    # one small table is one split, and a task of its own would find everything
    tasks = max(4 * s.sparkContext.defaultParallelism, int(s.conf.get("spark.sql.shuffle.partitions")))
    return infer.detect(windows.repartition(tasks, "scene", "row", "col"), infer.stub_model)


@_query
def confidence_windows(s: SparkSession, d: str) -> DataFrame:
    e = t.load(s, d, "events").select(F.col("ts"), (((7919 * F.col("event_id")) % 10000) / 10000.0).cast("double").alias("confidence"))
    return bins.binned(e, width="1 day")


def _shaped(s: SparkSession, d: str) -> DataFrame:
    c = t.candidates(s, d).withColumn("perimeter", 4 * F.col("side"))
    return c.withColumns({"compactness": geom.compactness(F.col("area"), F.col("perimeter")), "vertex_count": F.lit(4)})


@_query
def attribute_projection(s: SparkSession, d: str) -> DataFrame:
    return records.attributes(_shaped(s, d)).withColumns({c: F.format_string("%.4f", c) for c in ("compactness", "circularity")})


@_query
def least_area(s: SparkSession, d: str) -> DataFrame:
    small = t.candidates(s, d).withColumn("area", F.col("area") / 1000)
    return small.agg(F.count_if(records.large_enough("v1")).alias("v1"), F.count_if(records.large_enough("v2")).alias("v2"))


@_query
def surrogate_ids(s: SparkSession, d: str) -> DataFrame:
    return records.with_ids(t.candidates(s, d).select("cand_id", "confidence"), "confidence", "cand_id").select("id", "cand_id")


@_query
def utm_check(s: SparkSession, d: str) -> DataFrame:
    return t.tiles(s, d).groupBy(records.plausible_utm().alias("plausible")).agg(F.count("*").alias("n"))


@_query
def valid_pixel_share(s: SparkSession, d: str) -> DataFrame:
    return records.valid_share(t.window_pixels(s, d))


@_query
def scene_pixel_totals(s: SparkSession, d: str) -> DataFrame:
    masks = t.load(s, d, "orders").groupBy((F.col("o_orderkey") % 7).alias("scene"), (F.col("o_orderkey") % 211).alias("window")).agg(F.count_if(F.col("o_orderkey") % 3 == 0).alias("n"))
    return records.scene_totals(t.window_pixels(s, d), masks)


@_query
def window_bounds(s: SparkSession, d: str) -> DataFrame:
    scenes = _scenes(s, d)
    corners = scenes.select("scene", (500000.0 + 5120 * F.col("scene")).alias("x0"), (4400000.0 - 5120 * F.col("scene")).alias("y0"))
    return records.window_bounds(raster.grid(scenes, clamped=True), corners)


@_query
def tile_names(s: SparkSession, d: str) -> DataFrame:
    g = raster.grid(_scenes(s, d), clamped=True)
    return g.select("scene", "row", "col", records.tile_name(F.col("scene") % 100, F.concat(F.lit("scene-"), "scene"), F.col("row"), F.col("col")).alias("name"))


@_query
def first_per_source(s: SparkSession, d: str) -> DataFrame:
    return records.first_of(t.tiles(s, d).select("tile_id", "source"), "source", 5, "tile_id")


@_query
def qc_sample(s: SparkSession, d: str) -> DataFrame:
    images = t.tiles(s, d).join(split.random_split(t.tiles(s, d)), "tile_id").select(F.col("tile_id").alias("image"), "split", (1 - F.col("is_negative")).alias("n_inst"))
    return records.quality_sample(images)


@_query
def yield_stop(s: SparkSession, d: str) -> DataFrame:
    windows = raster.grid(_scenes(s, d), clamped=False).withColumn("has_mask", (F.col("row") + F.col("col")) % 1024 == 0)
    return records.until_yield(windows, 5)


@_query
def vertex_thinning(s: SparkSession, d: str) -> DataFrame:
    ring = F.transform(F.sequence(F.lit(0), (F.col("cand_id") % 40).cast("int") + 2), lambda i: F.struct(i.cast("double").alias("x"), (i * i).cast("double").alias("y")))
    thin = records.thinned(ring, 12)
    return t.candidates(s, d).select("cand_id", F.size(thin).alias("n"), F.array_join(F.transform(thin, lambda p: p["x"].cast("int").cast("string")), " ").alias("points"))


@_query
def shape_parts(s: SparkSession, d: str) -> DataFrame:
    """Shapes of one or two parts, closed, with a hole; every seventh part has too few points."""
    c = t.candidates(s, d)
    ring = lambda shift: F.transform(geom.box_ring(), lambda p: F.struct((p["x"] + shift).alias("x"), p["y"].alias("y")))
    closed = lambda r: F.concat(r, F.slice(r, 1, 1))
    one = F.array(F.when(F.col("cand_id") % 7 == 0, F.slice(ring(0), 1, 2)).otherwise(closed(ring(0))), F.slice(ring(1), 1, 3))
    parts = F.when(F.col("cand_id") % 3 == 0, F.array(one, F.array(closed(ring(1000))))).otherwise(F.array(one))
    return records.polygon_parts(c.select(F.col("cand_id").alias("shape_id"), parts.alias("parts")))


@_query
def conservation(s: SparkSession, d: str) -> DataFrame:
    return records.conservation(split.random_split(t.tiles(s, d)), t.tiles(s, d))


@_query
def paired_audit(s: SparkSession, d: str) -> DataFrame:
    listing = lambda name: t.load(s, d, name).select(F.col("doc_id").alias("key"), F.when(F.col("doc_id") % 5 == 0, "val").otherwise("train").alias("split"))
    return records.paired_audit(listing("documents"), listing("labels"))


@_query
def split_mode(s: SparkSession, d: str) -> DataFrame:
    tiles = t.tiles(s, d)
    return records.split_mode(split.scene_overlaps(tiles), spatial.count_overlaps(tiles, t.TILE, "source"))


@_query
def set_bounds(s: SparkSession, d: str) -> DataFrame:
    return t.tiles(s, d).agg(*(f(c).alias(c) for c, f in (("xmin", F.min), ("ymin", F.min), ("xmax", F.max), ("ymax", F.max))))


@_query
def layer_union(s: SparkSession, d: str) -> DataFrame:
    a, b = _sides(s, d)
    return records.layers({"first": a.select("cand_id", "area"), "second": b.select("cand_id", "area", "confidence")}).select("layer", "cand_id", "area", "confidence")


@_query
def threshold_report(s: SparkSession, d: str) -> DataFrame:
    return records.report_lines(detect.distribution(evaluate.thresholds(t.candidates(s, d)), "threshold"))


@_query
def shared_tile_names(s: SparkSession, d: str) -> DataFrame:
    """Names that two splits hold: tiles number 0 to 59 of each source, so names repeat between sources."""
    a = _assigned(s, d).select("split", F.format_string("tile_%02d", (F.col("tile_id") % 60).cast("int")).alias("name"))
    one, two = (a.where(F.col("split") == x).select("name") for x in ("train", "val"))
    return one.intersect(two)


@_query
def leak_examples(s: SparkSession, d: str) -> DataFrame:
    """The first five train tiles that each val tile meets."""
    tiles = t.tiles(s, d)
    assigned = tiles.join(split.random_split(tiles), "tile_id")
    cols = ["tile_id", "xmin", "ymin", "xmax", "ymax"]
    val, train = (assigned.where(F.col("split") == x).select(cols) for x in ("val", "train"))
    return spatial.first_met(val, train, "tile_id", t.TILE, 5).select(F.col("a_tile_id").alias("val"), F.col("b_tile_id").alias("train"), "rank")


def _diamonds(s: SparkSession, d: str) -> DataFrame:
    """Candidates as the diamonds in their boxes, whose shared areas are boxes once turned by 45 degrees."""
    c, r = t.candidates(s, d), F.col("side") / 2
    x, y = F.col("xmin") + r, F.col("ymin") + r
    at = lambda a, b: F.struct(a.alias("x"), b.alias("y"))
    return c.withColumns({"ring": F.array(at(x + r, y), at(x, y + r), at(x - r, y), at(x, y - r)), "area": F.col("area") / 2})


@_query
def nms_polygons(s: SparkSession, d: str) -> DataFrame:
    return detect.suppressed(_diamonds(s, d), ring="ring").select("cand_id", "status")


@_query
def greedy_match_polygons(s: SparkSession, d: str) -> DataFrame:
    c = _diamonds(s, d)
    return evaluate.match(c.where("cand_id % 2 = 0"), c.where("cand_id % 2 = 1"), 0.1, ring="ring")


@_query
def tile_polygon_exact(s: SparkSession, d: str) -> DataFrame:
    return detect.tile_polygons(t.tiles(s, d), _diamonds(s, d), ring="ring").withColumns({c: F.round(c, 6) for c in ("inter", "visible")})


@_query
def label_shape_record(s: SparkSession, d: str) -> DataFrame:
    return labels.shape_record(t.label_lines(s, d)).withColumns({c: F.round(c, 9) for c in ("mean_circ", "mean_aniso")})


def _outlines(s: SparkSession, d: str) -> DataFrame:
    """Outlines of windows: every fifth has two points, every fifth is closed, every fourth has no confidence."""
    k, at = F.col("cand_id"), lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    x, y, w = F.col("xmin") % 600, F.col("ymin") % 600, F.col("side") / 10
    ring = F.array(at(x, y), at(x + w, y), at(x + w, y + w), at(x, y + w))
    ring = F.when(k % 5 == 0, F.slice(ring, 1, 2)).when(k % 5 == 1, F.concat(ring, F.slice(ring, 1, 1))).otherwise(ring)
    scene = k % 7
    return t.candidates(s, d).select(
        scene.alias("scene"), (512 * (k % 5)).alias("row"), (512 * (k % 3)).alias("col"), k.alias("k"), ring.alias("ring"), F.when(k % 4 != 0, F.col("confidence")).alias("confidence"),
        (500000.0 + 5120 * scene).alias("x0"), (4400000.0 - 5120 * scene).alias("y0"),
    )


@_query
def mask_candidates(s: SparkSession, d: str) -> DataFrame:
    return masks.mask_candidates(_outlines(s, d)).drop("ring")


@_query
def window_outcomes(s: SparkSession, d: str) -> DataFrame:
    o = _outlines(s, d)
    return masks.window_outcomes(o, o.select("scene", "row", "col").distinct())


@_query
def scene_bounds_utm(s: SparkSession, d: str) -> DataFrame:
    k = F.col("s_suppkey")
    west, south = 104.0 + (k % 100) / 50.0, 36.0 + (k % 70) / 35.0
    box = projection.bounds_to_utm(west, south, west + 0.5, south + 0.25, 105.0)
    rows = t.load(s, d, "supplier").select(k.alias("scene"), box.alias("b"))
    return rows.select("scene", *(F.round(f"b.{c}", 3).alias(c) for c in ("xmin", "ymin", "xmax", "ymax")))


@_query
def shapefile_roundtrip(s: SparkSession, d: str) -> DataFrame:
    """Layers by source, written as shapefiles and read back."""
    files = shapes.encode(_diamonds(s, d), "source", ["cand_id", "confidence"])
    back = shapes.decode(files.select(F.col("layer").alias("path"), F.col("shp").alias("content")))
    parts = records.polygon_parts(back.select(F.col("path").alias("shape_id"), "parts"))
    return parts.groupBy(F.col("shape_id").alias("layer")).agg(F.count("*").alias("n"), F.sum("n_points").alias("points"), F.sum("area").alias("area"))


@_query
def png_roundtrip(s: SparkSession, d: str) -> DataFrame:
    """A small image a tile, written as PNG and read back."""
    pixel = F.transform(F.sequence(F.lit(0), F.lit(47)), lambda i: ((F.col("tile_id") * 7 + i * 13) % 256).cast("int"))
    images = t.tiles(s, d).select(F.col("tile_id").cast("string").alias("name"), F.lit(4).alias("height"), F.lit(4).alias("width"), F.lit(3).alias("channels"), pixel.alias("pixels"))
    return png.decoded(png.encoded(images)).select("name", "height", "width", "channels", F.md5(F.hex("pixels").cast("binary")).alias("digest"))


def _at(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def _faulty(s: SparkSession, d: str) -> DataFrame:
    """Candidates by kind: box, bow tie, box with a spike, two squares that touch, box with a hole; some null or without a ring."""
    x, y, w, h, k = F.col("xmin"), F.col("ymin"), F.col("side"), F.col("side") / 2, F.col("cand_id")
    box = F.array(_at(x, y), _at(x + w, y), _at(x + w, y + w), _at(x, y + w))
    tie = F.array(_at(x, y), _at(x + w, y), _at(x, y + w), _at(x + w, y + w))
    spike = F.array(_at(x, y), _at(x + w, y), _at(x + w, y + h), _at(x + 2 * w, y + h), _at(x + w, y + h), _at(x + w, y + w), _at(x, y + w))
    touch = F.array(_at(x, y), _at(x + h, y), _at(x + h, y + h), _at(x + w, y + h), _at(x + w, y + w), _at(x + h, y + w), _at(x + h, y + h), _at(x, y + h))
    hole = F.array(_at(x + w / 4, y + w / 4), _at(x + w / 4, y + 3 * w / 4), _at(x + 3 * w / 4, y + 3 * w / 4), _at(x + 3 * w / 4, y + w / 4))
    rings = F.when(k % 5 == 0, F.array(box)).when(k % 5 == 1, F.array(tie)).when(k % 5 == 2, F.array(spike)).when(k % 5 == 3, F.array(touch)).otherwise(F.array(box, hole))
    rings = F.when(k % 101 == 0, F.lit(None)).when(k % 103 == 0, F.slice(rings, 1, 0)).otherwise(rings)
    return t.candidates(s, d).select("cand_id", "side", rings.alias("rings"))


@_query
def shape_repair(s: SparkSession, d: str) -> DataFrame:
    """What repair leaves of each shape: parts, area in all, area of the largest."""
    rows = overlay.repaired(_faulty(s, d), ["cand_id"])
    return rows.groupBy("cand_id").agg(F.count("*").alias("n_parts"), F.sum("area").alias("area"), F.max("area").alias("largest"))


@_query
def shape_parts_rings(s: SparkSession, d: str) -> DataFrame:
    """Parts of faulty shapes with the points of their rings."""
    rows = overlay.parts(_faulty(s, d), ["cand_id"])
    return rows.select("cand_id", "part", "area", F.size("rings").alias("n_rings"), F.size(F.flatten("rings")).alias("n_points"))


@_query
def layer_cleaning(s: SparkSession, d: str) -> DataFrame:
    return overlay.cleaning(_faulty(s, d), ["cand_id"])


def _holed(s: SparkSession, d: str) -> DataFrame:
    """Candidates as boxes with a hole, each with a second part 1000 to the east."""
    x, y, w = F.col("xmin"), F.col("ymin"), F.col("side")
    box = lambda x, y, w: F.array(_at(x, y), _at(x + w, y), _at(x + w, y + w), _at(x, y + w))
    return t.candidates(s, d).select("cand_id", F.array(box(x, y, w), box(x + w / 4, y + w / 4, w / 2), box(x + 1000, y, w)).alias("rings"))


@_query
def tile_shapes_exact(s: SparkSession, d: str) -> DataFrame:
    return detect.tile_shapes(t.tiles(s, d), _holed(s, d)).withColumns({c: F.round(c, 6) for c in ("inter", "visible")})


@_query
def iou_concave(s: SparkSession, d: str) -> DataFrame:
    """Shapes like an L: boxes without their upper right quarter against boxes without their lower left one."""
    x, y, w, h = F.col("xmin"), F.col("ymin"), F.col("side"), F.col("side") / 2
    one = F.array(_at(x, y), _at(x + w, y), _at(x + w, y + h), _at(x + h, y + h), _at(x + h, y + w), _at(x, y + w))
    two = F.array(_at(x + h, y), _at(x + w, y), _at(x + w, y + w), _at(x, y + w), _at(x, y + h), _at(x + h, y + h))
    cols = ["cand_id", "image", "xmin", "ymin", "xmax", "ymax"]
    a, b = (side.select(*cols, F.array(ring).alias("rings")) for side, ring in zip(_sides(s, d), (one, two), strict=True))
    pairs = spatial.box_join(a, b, 400.0, equal=["image"]).select(F.col("a_cand_id").alias("p"), F.col("b_cand_id").alias("g"), F.col("a_rings").alias("a"), F.col("b_rings").alias("b"))
    return overlay.iou(pairs, ["p", "g"]).withColumn("iou", F.round("iou", 9))


@_query
def window_read(s: SparkSession, d: str) -> DataFrame:
    """Windows of 24 pixels, read over the borders of blocks of 16, with their common valid pixels."""
    k = F.col("o_orderkey")
    pixels = t.load(s, d, "orders").select((k % 3).alias("scene"), F.floor(k / 192).alias("r"), (F.floor(k / 3) % 64).alias("c"), F.when(k % 11 != 0, F.col("o_totalprice").cast("double")).alias("b2"), F.col("o_custkey").cast("double").alias("b3"))
    path = storage.folder(s, "blocks")
    blocks.write_blocks(pixels, path, ["b2", "b3"], 16)
    n = F.col("s_suppkey")
    windows = t.load(s, d, "supplier").select((n % 3).alias("scene"), (20 * (n % 97)).alias("row"), (20 * (n % 4)).alias("col"), F.lit(24).alias("height"), F.lit(24).alias("width"))
    read = blocks.read_windows(s, path, windows, 16)
    cents = F.aggregate(blocks.common_valid("px", ["b2", "b3"]), F.lit(0).cast("long"), lambda a, p: a + F.round(p["b2"] * 100).cast("long"))
    return read.select("scene", "row", "col", F.size("px").alias("n"), F.size(blocks.common_valid("px", ["b2", "b3"])).alias("n_valid"), (blocks.valid_share("px", ["b2", "b3"]) >= 0.2).alias("used"), cents.alias("cents"))


@_query
def assigned_by_mode(s: SparkSession, d: str) -> DataFrame:
    """Scenes that overlap are split by bands."""
    return split.assigned_by_mode(t.tiles(s, d), split_mode(s, d)).select("tile_id", "split")


@_query
def assigned_by_mode_apart(s: SparkSession, d: str) -> DataFrame:
    """The same tiles with each scene moved away from the others: whole scenes are split."""
    far = F.col("source") * 1e6
    tiles = t.tiles(s, d).withColumns({c: F.col(c) + far for c in ("xmin", "xmax")})
    cross = spatial.count_overlaps(tiles, t.TILE, "source")
    return split.assigned_by_mode(tiles, records.split_mode(split.scene_overlaps(tiles), cross)).select("tile_id", "split")


@_query
def shape_distribution(s: SparkSession, d: str) -> DataFrame:
    """Summary of each source with compactness, of rings that are longer than those of squares."""
    longer = 4 * F.col("side") + 10 * (F.col("cand_id") % 9)
    c = t.candidates(s, d).withColumn("compactness", F.round(16 * F.col("area") / (longer * longer), 9))
    return detect.distribution(c, "source").select("source", "n", "median_area", "median_confidence", "min_compactness", "max_compactness", "median_compactness")


def queries() -> dict[str, Query]:
    return dict(_ALL)
