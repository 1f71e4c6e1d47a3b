"""Confidence bins of detections as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.evaluate import THRESHOLDS


def binned(events: DataFrame, late: str = "10 minutes", width: str = "1 hour") -> DataFrame:
    """(start, n, and a count of each bin) per tumbling window of a stream or table (ts timestamp, confidence)."""
    c, edges = F.col("confidence"), [*THRESHOLDS, 1.01]
    bins = [F.count_if((c >= a) & (c < b)).alias(f"b{round(a * 100)}") for a, b in zip(edges, edges[1:], strict=False)]
    rows = events.withWatermark("ts", late) if events.isStreaming else events
    return rows.groupBy(F.window("ts", width).alias("w")).agg(F.count("*").alias("n"), *bins).select(F.col("w.start").alias("start"), "n", *(f"b{round(a * 100)}" for a in THRESHOLDS))
