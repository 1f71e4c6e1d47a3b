"""Exact medians by selection: histograms that narrow down to the bin that holds the middle."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.storage import cut

#: Bins of a round, and values of a group that are few enough to be sorted.
BINS, FEW = 1024, 4096


def medians(df: DataFrame, by: list[str], value: str, bins: int = BINS, few: int = FEW) -> DataFrame:
    """(by, median): the middle value of each group, or the mean of the two middle ones; nulls and NaN are left out.

    Each round counts the values between the ends that are left by bin and narrows the ends to the least and
    the largest value of the bins that hold the middle, so a group needs a counter per bin and not its values.
    It ends where few values are left, which are ranked, or one value.
    """
    rows = df.select(*by, F.col(value).cast("double").alias("__v")).where("__v IS NOT NULL AND NOT isnan(__v)")
    state = rows.groupBy(*by).agg(F.min("__v").alias("__lo"), F.max("__v").alias("__hi"), F.count("*").alias("__n"))
    state = cut(state.withColumns({"__held": F.col("__n"), "__before": F.lit(0).cast("long")}))
    same = [F.col(f"s.{c}").eqNullSafe(F.col(f"r.{c}")) for c in by]

    def inside(at: DataFrame) -> DataFrame:
        meet = F.col("r.__v").between(F.col("s.__lo"), F.col("s.__hi"))
        for c in same:
            meet = meet & c
        return rows.alias("r").join(F.broadcast(at.alias("s")) if not by else at.alias("s"), meet).select("s.*", "r.__v")

    done, found, even = state.where(_settled(few)), None, True
    open_ = cut(state.where(~_settled(few)))
    while not open_.isEmpty():
        # equal widths, and every other round equal ratios, so that neither outliers nor wide ranges last
        most = F.greatest(F.abs("__lo"), F.abs("__hi"))
        t = (lambda v: F.col(v) / 2) if even else (lambda v: F.signum(v) * F.log1p(F.abs(v) / most * 1e300))
        even = not even
        width = t("__hi") - t("__lo")
        place = F.when(width > 0, F.least(F.lit(bins - 1), F.floor((t("__v") - t("__lo")) / width * bins))).otherwise(F.when(F.col("__v") > F.col("__lo"), 1).otherwise(0))
        keys = [*by, "__lo", "__hi", "__n", "__before"]
        binned = inside(open_).groupBy(*keys, place.alias("__bin")).agg(F.count("*").alias("__c"), F.min("__v").alias("__a"), F.max("__v").alias("__z"))
        upto = F.sum("__c").over(Window.partitionBy(*by).orderBy("__bin").rowsBetween(Window.unboundedPreceding, 0)) + F.col("__before")
        binned = binned.withColumn("__upto", upto)
        holds = (F.col("__upto") > F.floor((F.col("__n") - 1) / 2)) & (F.col("__upto") - F.col("__c") <= F.floor(F.col("__n") / 2))
        narrow = binned.where(holds).groupBy(*by, "__n").agg(
            F.count("*").alias("__bins"), F.min("__a").alias("__lo"), F.max("__z").alias("__hi"), F.min("__z").alias("__left"), F.max("__a").alias("__right"), F.sum("__c").alias("__held"), F.min(F.col("__upto") - F.col("__c")).alias("__before")
        )
        narrow = cut(narrow)
        # two bins hold the middle: it lies between the last value of one and the first of the other
        parted = narrow.where("__bins = 2").select(*by, (F.col("__left") / 2 + F.col("__right") / 2).alias("median"))
        found = parted if found is None else found.unionByName(parted)
        state = narrow.where("__bins = 1").select(*by, "__lo", "__hi", "__n", "__held", "__before")
        done = done.unionByName(state.where(_settled(few)))
        open_ = state.where(~_settled(few))
    one = done.where("__lo = __hi").select(*by, F.col("__lo").alias("median"))
    rank = F.row_number().over(Window.partitionBy(*by).orderBy("__v")) - 1 + F.col("__before")
    ranked = inside(done.where("__lo < __hi")).withColumn("__rank", rank)
    middle = ranked.where((F.col("__rank") == F.floor((F.col("__n") - 1) / 2)) | (F.col("__rank") == F.floor(F.col("__n") / 2)))
    ranked = one.unionByName(middle.groupBy(*by).agg((F.min("__v") / 2 + F.max("__v") / 2).alias("median")))
    return (ranked if found is None else ranked.unionByName(found)).where("median IS NOT NULL")


def _settled(few: int):
    return (F.col("__held") <= few) | (F.col("__lo") == F.col("__hi"))
