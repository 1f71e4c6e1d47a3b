"""Train, validation and test splits of tiles, and their audits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .greedy import components
from .spatial import box_join, count_overlaps, overlaps
from .uneven import uneven_join
from ..functions.geom import overlap_area
from ..plans.storage import cut
from ..plans.tables import TILE

#: Shares aimed at, and the weight of dropped tiles.
SHARES, DROP_WEIGHT = (0.6, 0.2, 0.2), 0.002
NAMES = ["train", "val", "test"]


def hash_rank(key: str, seed: int = 42) -> Column:
    """A reproducible order that stands for random sampling."""
    return F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")))


def source_stats(tiles: DataFrame) -> DataFrame:
    return tiles.groupBy("source").agg(
        F.count("*").alias("n"), F.count_if(F.col("is_negative") == 0).alias("positives"), F.count_if(F.col("is_negative") == 1).alias("negatives"),
        F.min("xmin").alias("xmin"), F.min("ymin").alias("ymin"), F.max("xmax").alias("xmax"), F.max("ymax").alias("ymax"),
    )


def scene_overlaps(tiles: DataFrame) -> DataFrame:
    """Pairs of scenes whose bounds share area, in square kilometres.  Bounds of any size meet by a pyramid of cells."""
    stats = source_stats(tiles).select("source", "xmin", "ymin", "xmax", "ymax")
    pairs = uneven_join(stats, stats, F.col("a_source") < F.col("b_source")).withColumn("area", overlap_area()).where("area > 1.0")
    return pairs.select(F.col("a_source").alias("a"), F.col("b_source").alias("b"), (F.col("area") / 1e6).alias("km2"))


def random_split(tiles: DataFrame, share: float = 0.2) -> DataFrame:
    """max(1, round half even of share * n) tiles go to val, by hash order over the whole table.

    Ranks come from counts of the first three hex digits, so no single task sorts the table.
    """
    rows = tiles.select("tile_id", hash_rank("tile_id").alias("h")).withColumn("bin", F.substring("h", 1, 3))
    bins = rows.groupBy("bin").agg(F.count("*").alias("c"))  # 4096 rows at most
    before = bins.select("bin", (F.sum("c").over(Window.orderBy("bin")) - F.col("c")).alias("before"), F.sum("c").over(Window.partitionBy()).alias("n"))
    rank = F.row_number().over(Window.partitionBy("bin").orderBy("h", "tile_id")) + F.col("before")
    ranked = rows.join(F.broadcast(before), "bin").withColumn("rank", rank)
    return ranked.select("tile_id", F.when(F.col("rank") <= F.greatest(F.lit(1), F.bround(F.col("n") * share, 0)), "val").otherwise("train").alias("split"))


def source_split(tiles: DataFrame) -> DataFrame:
    """Whole sources by hash order: the first with positives is val, the second test, the rest train.  Fewer than two is an error."""
    stats = source_stats(tiles).select("source", "positives", hash_rank("source").alias("h"))
    rank = F.row_number().over(Window.partitionBy(F.col("positives") > 0).orderBy("h"))
    ranked = stats.withColumn("rank", F.when(F.col("positives") > 0, rank)).withColumn("eligible", F.count_if(F.col("positives") > 0).over(Window.partitionBy()))
    chosen = F.when(F.col("eligible") < 2, F.raise_error(F.lit("fewer than two sources have positives")).cast("string")).when(F.col("rank") == 1, "val").when(F.col("rank") == 2, "test").otherwise("train")
    return ranked.select("source", "positives", chosen.alias("split"))


def _running(rows: DataFrame, x: str, columns: list[str]) -> DataFrame:
    """`rows` (one for each x) with their columns summed up to and with each x.

    Ranges of x are summed apart and carry what the ranges before them hold, so no task sees all rows.
    """
    rows = cut(rows.repartitionByRange(x).withColumn("part", F.spark_partition_id()))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row a partition
    sums = rows.groupBy("part").agg(*(F.sum(c).alias(f"part_{c}") for c in columns))
    carried = sums.select("part", *(F.coalesce(F.sum(f"part_{c}").over(before), F.lit(0)).alias(f"before_{c}") for c in columns))
    upto = Window.partitionBy("part").orderBy(x).rowsBetween(Window.unboundedPreceding, 0)
    out = rows.join(F.broadcast(carried), "part")
    return out.select(*(c for c in rows.columns if c not in columns and c != "part"), *(F.col(c).alias(f"own_{c}") for c in columns), *((F.sum(c).over(upto) + F.col(f"before_{c}")).alias(c) for c in columns))


def _cut_points(centres: DataFrame) -> DataFrame:
    """(c, k, many, and for n and pos: begun, ended): each distinct centre as a cut, with the tiles that begin before it and end by it.

    A tile without width ends after the cut at its own centre, since it lies in the band that begins there.
    """
    kinds, half = ("begun", "ended", "flat"), F.col("hw")
    at = {"begun": F.col("c") - half, "ended": F.col("c") + half, "flat": F.col("c")}
    none = F.lit(0).cast("long")
    marks = None
    for kind in kinds:
        holds = F.when(half <= 0, F.lit(1)).otherwise(0) if kind == "flat" else F.lit(1)
        values = [(F.col(v) * holds if k == kind else none).alias(f"{k}_{v}") for k in kinds for v in ("n", "pos")]
        rows = centres.select(at[kind].alias("x"), *values, F.lit(int(kind == "flat")).alias("centre"))
        marks = rows if marks is None else marks.unionByName(rows)
    columns = [f"{k}_{v}" for k in kinds for v in ("n", "pos")]
    marks = marks.groupBy("x").agg(*(F.sum(c).alias(c) for c in columns), F.max("centre").cast("long").alias("centre"))
    rows = _running(marks, "x", [*columns, "centre"]).where("own_centre = 1")
    # strictly before the cut: tiles that begin; at or before it: tiles that end
    begun, ended = ([(F.col(f"{k}_{v}") - F.col(f"own_{o}_{v}")).alias(f"{k}_{v}") for v in ("n", "pos")] for k, o in (("begun", "begun"), ("ended", "flat")))
    rows = cut(rows.select(F.col("x").alias("c"), (F.col("centre") - 1).alias("k"), *begun, *ended))
    return rows.join(F.broadcast(rows.agg(F.count("*").alias("many"))))  # one row


def _crossing_both(one: DataFrame, two: DataFrame, centres: DataFrame, width: float) -> DataFrame:
    """(k1, k2, b_n, b_pos): tiles that cross both cuts; tiles and cuts meet by cells of twice the widest half."""
    near = lambda x: F.explode(F.sequence(F.floor((F.col(x) - width / 2) / width), F.floor((F.col(x) + width / 2) / width)))
    crosses = lambda x: (F.col("c") - F.col("hw") < F.col(x)) & (F.col("c") + F.col("hw") > F.col(x))
    tiles = centres.withColumn("cell", F.floor(F.col("c") / width))
    first = one.select("k1", "c1", near("c1").alias("cell")).join(tiles, "cell").where(crosses("c1"))
    both = first.join(two.select("k2", "c2", near("c2").alias("cell")), "cell").where(crosses("c2") & (F.col("k2") > F.col("k1")))
    return both.groupBy("k1", "k2").agg(*(F.sum(v).alias(f"b_{v}") for v in ("n", "pos")))


def _scored_cuts(one: DataFrame, two: DataFrame, centres: DataFrame, width: float, total: DataFrame) -> DataFrame:
    """Pairs of cuts that leave no band empty, nor val and test without positives, with counts and score."""
    pairs = one.join(two, F.col("k2") >= F.col("k1") + 2)
    rows = pairs.join(_crossing_both(one, two, centres, width), ["k1", "k2"], "left").na.fill(0).join(F.broadcast(total))  # one row
    for v in ("n", "pos"):
        crosses1, crosses2 = (F.col(f"begun_{v}{i}") - F.col(f"ended_{v}{i}") for i in (1, 2))
        dropped = crosses1 + crosses2 - F.col(f"b_{v}")
        # a band's tiles: before the first cut those that end by it, after the second those that begin there
        rows = rows.withColumns({f"{v}0": F.col(f"ended_{v}1"), f"{v}2": F.col(f"all_{v}") - F.col(f"begun_{v}2"), f"dropped_{v}": dropped})
        rows = rows.withColumn(f"{v}1", F.col(f"all_{v}") - F.col(f"{v}0") - F.col(f"{v}2") - F.col(f"dropped_{v}"))
    rows = rows.withColumnRenamed("dropped_n", "dropped")
    kept = F.col("n0") + F.col("n1") + F.col("n2")
    score = sum((F.abs(F.col(f"n{b}") / kept - SHARES[b]) for b in range(3)), F.lit(0.0)) + DROP_WEIGHT * F.col("dropped") / F.col("all_n")
    return rows.where("pos1 > 0 and pos2 > 0 and n0 > 0 and n1 > 0 and n2 > 0").withColumn("score", score)


def band_cuts(tiles: DataFrame, probes: int = 32) -> DataFrame:
    """One row: the best pair of cuts (k1, k2, c1, c2), counts of each band, and the score.

    Tiles are counted by centre; from running totals each cut knows what ends by it and what begins at or after it,
    so a pair is scored from its two ends.  A first cut alone says what share train gets, up to the tiles that a
    second one drops, and a second what test gets.  The deviations of the three shares add up to nothing, so a score
    is at least twice the largest of them, which bounds it for each cut.  First the `probes` cuts of the lowest
    bounds are paired, as many more as it takes to find a pair that may be; then all cuts whose bound does not
    exceed its score.  No pair as good is lost, and ties go to the smallest k1, then k2.
    """
    half = (F.col("xmax") - F.col("xmin")) / 2
    centres = tiles.groupBy(((F.col("xmin") + F.col("xmax")) / 2).alias("c"), half.alias("hw")).agg(F.count("*").alias("n"), F.count_if(F.col("is_negative") == 0).alias("pos"))
    centres = cut(centres)
    total = centres.agg(F.sum("n").alias("all_n"), F.sum("pos").alias("all_pos"))
    width = 2 * max(centres.agg(F.max("hw")).first()[0] or 0.0, 1e-6)
    at = _cut_points(centres)
    crosses, all_n = F.col("begun_n") - F.col("ended_n"), F.col("all_n")
    worst = at.agg(F.max(crosses).alias("worst"))
    at = at.join(F.broadcast(worst)).join(F.broadcast(total.select("all_n")))  # one row each

    def bounded(got: Column, share: float) -> Column:
        least, most = got / F.greatest(all_n - crosses, F.lit(1)), got / F.greatest(all_n - crosses - F.col("worst"), F.lit(1))
        return 2 * F.greatest(F.lit(0.0), least - share, share - most) + DROP_WEIGHT * crosses / all_n

    at = cut(at.withColumns({"bound1": bounded(F.col("ended_n"), SHARES[0]), "bound2": bounded(all_n - F.col("begun_n"), SHARES[2])}))
    stats = ["begun_n", "begun_pos", "ended_n", "ended_pos"]
    # a bound counts as met within rounding, so no pair is lost to the last digit
    side = lambda i, allowed: at.where(allowed).select(F.col("k").alias(f"k{i}"), F.col("c").alias(f"c{i}"), F.col(f"bound{i}").alias(f"bound{i}"), *(F.col(c).alias(f"{c}{i}") for c in stats))
    one, two = side(1, (F.col("k") >= 1) & (F.col("k") < F.col("many") - 3)), side(2, F.col("k") < F.col("many") - 1)
    many = at.count()
    while True:
        near1, near2 = (cut(d.orderBy(f"bound{i}", f"k{i}").limit(probes)) for i, d in ((1, one), (2, two)))
        best = _scored_cuts(near1, near2, centres, width, total).agg(F.min("score")).first()[0]
        if best is not None or probes >= many:
            break
        probes *= 4
    if best is None:  # no pair may be: an empty table of the same columns
        return _scored_cuts(near1, near2, centres, width, total).limit(0)
    one, two = (d.where(F.col(f"bound{i}") <= best + 1e-9) for i, d in ((1, one), (2, two)))
    return _scored_cuts(one, two, centres, width, total).orderBy("score", "k1", "k2").limit(1)


def band_assign(tiles: DataFrame, cuts: DataFrame) -> DataFrame:
    """`tiles` with split: the band of the centre, or DROPPED_BUFFER where a tile crosses a cut."""
    rows = tiles.join(F.broadcast(cuts.select("c1", "c2")))  # one row
    c, hw = (F.col("xmin") + F.col("xmax")) / 2, (F.col("xmax") - F.col("xmin")) / 2
    crosses = lambda cut: (c - hw < F.col(cut)) & (c + hw > F.col(cut))
    split = F.when(crosses("c1") | crosses("c2"), "DROPPED_BUFFER").when(c < F.col("c1"), "train").when(c < F.col("c2"), "val").otherwise("test")
    return rows.withColumn("split", split).drop("c1", "c2")


def assigned_by_mode(tiles: DataFrame, mode: DataFrame) -> DataFrame:
    """`tiles` with split: by bands where the one row of `mode` says SPATIAL, else by whole components of scenes.

    Both ways are in the plan and the row lets one of them have the tiles, so nothing is decided on the driver.
    Scenes whose bounds share area stay together, under the smallest of them.
    """
    rows = tiles.join(F.broadcast(cut(mode.select("mode"))))  # one row, found once
    spatial, apart = (rows.where(F.col("mode") == m).drop("mode") for m in ("SPATIAL", "BY_TIF"))
    linked = components(apart.select(F.col("source").alias("node")).distinct(), scene_overlaps(apart).select("a", "b"))
    whole = apart.join(linked.select(F.col("node").alias("source"), "component"), "source")
    chosen = source_split(whole.withColumn("source", F.col("component"))).select(F.col("source").alias("component"), "split")
    by_source = whole.join(chosen, "component").drop("component")
    return band_assign(spatial, band_cuts(spatial)).unionByName(by_source)


def split_audit(assigned: DataFrame) -> DataFrame:
    return assigned.groupBy("split").agg(F.count("*").alias("rows"), F.count_if(F.col("is_negative") == 0).alias("positives"), F.count_if(F.col("is_negative") == 1).alias("negatives"), F.count_distinct("source").alias("sources"))


def split_sources(assigned: DataFrame) -> DataFrame:
    """Splits that each source touches, the dropped left out."""
    kept = assigned.where("split <> 'DROPPED_BUFFER'")
    return kept.groupBy("source").agg(F.array_join(F.array_sort(F.collect_set("split")), ",").alias("splits"), F.count("*").alias("n"))


def leak_pairs(assigned: DataFrame, cell: float = TILE) -> DataFrame:
    """Pairs of tiles in different splits that share more than 1 square metre."""
    kept = assigned.where("split <> 'DROPPED_BUFFER'").select("tile_id", "split", "xmin", "ymin", "xmax", "ymax")
    return overlaps(kept, "tile_id", cell, "split")


def count_leaks(assigned: DataFrame, cell: float = TILE) -> DataFrame:
    """One row, n: how many pairs `leak_pairs` has."""
    return count_overlaps(assigned.where("split <> 'DROPPED_BUFFER'"), cell, "split")


def val_train_overlap(assigned: DataFrame, cell: float = TILE) -> DataFrame:
    """For each val tile that a train tile meets, touching included: how many, shared area, the smallest of them."""
    cols = ["tile_id", "xmin", "ymin", "xmax", "ymax"]
    val, train = (assigned.where(F.col("split") == s).select(cols) for s in ("val", "train"))
    pairs = box_join(val, train, cell, closed=True).withColumn("area", overlap_area())
    return pairs.groupBy(F.col("a_tile_id").alias("tile_id")).agg(F.count("*").alias("n_train"), F.sum("area").alias("area"), F.min("b_tile_id").alias("first_train"))
