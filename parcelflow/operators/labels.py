"""Label text `class x1 y1 ... xn yn`: five rule sets over the same lines, and statistics of instances."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import polygons
from .spatial import box_join
from ..functions import geom
from ..plans.storage import cut

NUMBER = r"^[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?|nan|NaN|inf|infinity)$"


def parsed(lines: DataFrame) -> DataFrame:
    """Lines that are not blank, with tokens, values (null where not a number) and what the rules ask for."""
    rows = lines.withColumn("tokens", F.filter(F.split("text", r"\s+"), lambda t: t != "")).where(F.size("tokens") > 0)
    rows = rows.withColumn("coords", F.slice("tokens", 2, F.size("tokens")))
    rows = rows.withColumn("values", F.transform("coords", lambda t: F.when(t.rlike(NUMBER), t.try_cast("double"))))
    v = F.col("values")
    rows = rows.withColumns({
        "cls": F.element_at("tokens", 1), "n": F.size("coords"), "numeric": F.forall(v, lambda x: x.isNotNull()),
        "finite": F.forall(v, lambda x: ~F.isnan(x) & (F.abs(x) != float("inf"))), "inside": F.forall(v, lambda x: (x >= 0) & (x <= 1)),
    })
    points = F.transform(F.sequence(F.lit(0), F.greatest(F.floor(F.col("n") / 2) - 1, F.lit(0)).cast("int")), lambda i: F.struct(F.get("values", i * 2).alias("x"), F.get("values", i * 2 + 1).alias("y")))
    return rows.withColumn("points", F.when((F.col("n") >= 2) & F.col("numeric"), points))


def _code(*rules: tuple[Column, str]) -> Column:
    out = F.when(rules[0][0], rules[0][1])
    for test, name in rules[1:]:
        out = out.when(test, name)
    return out.otherwise("ok")


def _rules() -> dict[str, Column]:
    n, odd, numeric = F.col("n"), F.col("n") % 2 != 0, F.col("numeric")
    return {
        # preparing a dataset: tokens, class, even count, numbers, finite, range
        "strict": _code((n < 6, "too_few"), (F.col("cls") != "0", "class"), (odd, "odd"), (~numeric, "non_numeric"), (~F.col("finite"), "nan"), (~F.col("inside"), "range")),
        # before training: the class comes first, and three distinct vertices are asked for
        "train": _code((F.col("cls").try_cast("int").isNull(), "bad_class"), (F.col("cls").try_cast("int") != 0, "class"), (n < 6, "too_few"), (odd, "odd"), (~numeric, "non_numeric"), (~F.col("finite"), "nan"), (~F.col("inside"), "range"), (F.size(F.array_distinct("points")) < 3, "few_vertices")),
        # quality control: only lines that cannot be read are bad
        "qc": _code(((n < 6) | odd | ~numeric, "bad_line")),
        # lenient reading: lines that make no polygon are skipped
        "lenient": _code((n < 6, "skipped"), (~numeric, "skipped"), (odd, "skipped"), (~F.col("finite"), "skipped")),
        # the range of the first four values only; NaN passes
        "range4": _code((n < 4, "ignored"), (F.exists(F.slice("values", 1, 4), lambda x: x.isNull()), "raises"), (F.exists(F.slice("values", 1, 4), lambda x: ~F.isnan(x) & ((x < 0) | (x > 1))), "range")),
    }


def validated(lines: DataFrame, rules: str) -> DataFrame:
    """(file, line_no, code): the first rule each line fails, blank lines left out."""
    return parsed(lines).select("file", "line_no", _rules()[rules].alias("code"))


def instances(lines: DataFrame) -> DataFrame:
    """Lines that quality control reads, with n_points and whether a value is out of range (NaN is not)."""
    rows = parsed(lines).where(_rules()["qc"] == "ok")
    return rows.select("file", "line_no", "points", (F.col("n") / 2).cast("int").alias("n_points"), F.exists("values", lambda x: ~F.isnan(x) & ((x < 0) | (x > 1))).alias("outside"))


def qc_record(lines: DataFrame) -> DataFrame:
    """One row a file: instances, rectangles, many-sided ones, points of instances out of bounds, bad lines."""
    files = lines.select("file").distinct()
    got = instances(lines).groupBy("file").agg(F.count("*").alias("n_inst"), F.count_if(F.col("n_points") == 4).alias("n_rect4"), F.count_if(F.col("n_points") >= 8).alias("n_8p"), F.sum(F.when(F.col("outside"), F.col("n_points")).otherwise(0)).alias("oob"))
    bad = validated(lines, "qc").groupBy("file").agg(F.count_if(F.col("code") == "bad_line").alias("bad_lines"))
    out = files.join(got, "file", "left").join(bad, "file", "left")
    return out.select("file", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_inst", "n_rect4", "n_8p", "oob", "bad_lines")))


def shape_record(lines: DataFrame, size: float = 640.0) -> DataFrame:
    """One row a file with instances: how many touch the border, pairs of equal ones, mean circularity, how many are far
    from a circle, mean short over long side.  Instances with a value that is no finite number have no shape and don't count.
    A number names one line of its file; lines without one make no pairs."""
    rows = instances(lines).where(F.forall("points", lambda p: ~F.isnan(p["x"]) & ~F.isnan(p["y"]) & (F.abs(p["x"]) != float("inf")) & (F.abs(p["y"]) != float("inf"))))
    rows = rows.select("file", F.col("line_no").isNotNull().cast("long").alias("numbered"), F.transform("points", lambda p: F.struct((p["x"] * size).alias("x"), (p["y"] * size).alias("y"))).alias("ring"))
    # equal rings of a file are measured once and weigh as many as they are
    rows = cut(rows.groupBy("file", "ring").agg(F.count("*").alias("n"), F.sum("numbered").alias("numbered")))
    axis = lambda c: F.transform("ring", lambda p: p[c])
    rows = rows.withColumns({c + k: f(axis(c)) for c in "xy" for k, f in (("min", F.array_min), ("max", F.array_max))})
    a, p = geom.ring_area(F.col("ring")), geom.ring_perimeter(F.col("ring"))
    each = rows.withColumns({"border": geom.near_edge(3, True, size), "circ": geom.compactness(a, p), "aniso": polygons.aspect(F.col("ring"))})
    mean = lambda c: F.sum(F.col(c) * F.col("n")) / F.sum(F.when(F.col(c).isNotNull(), F.col("n")))
    number = lambda test: F.coalesce(F.sum(F.when(test, F.col("n"))), F.lit(0)).cast("long")
    per = each.groupBy("file").agg(number(F.col("border")).alias("n_border"), mean("circ").alias("mean_circ"), number(F.col("circ") < 0.60).alias("n_low_circ"), mean("aniso").alias("mean_aniso"))
    # a ring and itself make pairs of their lines, two rings a pair of each line of one and each of the other
    met = box_join(rows, rows, 64.0, F.col("a_ring") <= F.col("b_ring"), equal=["file"]).where(polygons.polygon_iou(F.col("a_ring"), F.col("b_ring")) > 0.9)
    n, m = F.col("a_numbered"), F.col("b_numbered")
    same = met.groupBy(F.col("a_file").alias("file")).agg(F.sum(F.when(F.col("a_ring") == F.col("b_ring"), F.expr("a_numbered * (a_numbered - 1) div 2")).otherwise(n * m)).alias("n_dup"))
    return per.join(same, "file", "left").select("file", "n_border", F.coalesce("n_dup", F.lit(0)).alias("n_dup"), "mean_circ", "n_low_circ", "mean_aniso")


def vertex_stats(lines: DataFrame) -> DataFrame:
    n = F.col("n_points")
    return instances(lines).agg(F.count("*").alias("n"), F.min(n).alias("least"), F.max(n).alias("most"), F.avg(n).alias("mean"), F.median(n).alias("median"), F.avg((n == 4).cast("double")).alias("share4"), F.avg((n >= 8).cast("double")).alias("share8"))


def empty_share(lines: DataFrame) -> DataFrame:
    """(files, empty, share): files without any token."""
    per = lines.groupBy("file").agg(F.bool_and(F.trim("text") == "").alias("empty"))
    return per.agg(F.count("*").alias("files"), F.count_if("empty").alias("empty"), (F.count_if("empty") / F.count("*")).alias("share"))
