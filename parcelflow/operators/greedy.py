"""Choices that depend on order, as fixpoints: greedy suppression, one-to-one matching, components."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.storage import cut


def greedy_dropped(edges: DataFrame) -> DataFrame:
    """(late): items that a scan in rank order drops because an earlier kept item conflicts with them.

    `edges` has a row (late, early) for each conflict.  Each round keeps what has no earlier item left
    and drops what conflicts with it, so rounds follow the longest chain of decisions, not the rows
    (Blelloch, Fineman and Shun, SPAA 2012).
    """
    left = cut(edges.select("late", "early").distinct())
    dropped = None
    while not left.isEmpty():
        first = left.select(F.col("early").alias("k")).distinct().join(left.select(F.col("late").alias("k")).distinct(), "k", "left_anti")
        now = cut(left.join(first, left["early"] == first["k"], "left_semi").select("late").distinct())
        dropped = now if dropped is None else dropped.unionByName(now)
        gone = now.select(F.col("late").alias("k"))
        kept = first
        left = left.join(gone, left["late"] == F.col("k"), "left_anti")
        left = left.join(gone.unionByName(kept), left["early"] == F.col("k"), "left_anti")
        left = cut(left)
    return edges.select("late").limit(0) if dropped is None else dropped


def components(nodes: DataFrame, pairs: DataFrame) -> DataFrame:
    """(node, component): smallest node reachable, by hooking each component to its smallest neighbour and halving paths."""
    both = cut(pairs.select("a", "b").unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    label = cut(nodes.select("node", F.col("node").alias("component")))
    while True:
        near = both.join(label.select(F.col("node").alias("b"), "component"), "b").groupBy(F.col("a").alias("node")).agg(F.min("component").alias("low"))
        hooked = label.join(near, "node", "left").select("node", "component", F.least("component", F.coalesce("low", "component")).alias("low"))
        jump = hooked.select(F.col("node").alias("low"), F.col("low").alias("to"))
        new = cut(hooked.join(jump, "low", "left").select("node", F.least("low", F.coalesce("to", "low")).alias("component"), (F.least("low", F.coalesce("to", "low")) < F.col("component")).alias("moved")))
        label = new.select("node", "component")
        if new.where("moved").isEmpty():
            return label
