"""Mergeable figures of windows: distinct users and processing times of any range of windows.

A window's sketch has a bounded size and can be stored; those of a range are merged without reading
the edits again, which exact distinct counts and exact percentiles do not allow.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch import fixed
from tidewatch.operators.windows import window_columns, windowed

# 2**15 slots of half a byte at most, fewer for few users: the usual error of a count is 0.6 %.
LOG_SIZE = 15
# Items of a level of a quantile sketch: up to so many values are kept as they are, and beyond that a
# percentile is off by about 0.2 % of the rows.
ITEMS = 2000
PERCENTILES = {"p50": 0.5, "p95": 0.95, "p99": 0.99}


def user_sketches(
    edits: DataFrame,
    granularities: Mapping[str, int] = fixed.GRANULARITIES,
    by: Sequence[str] = (),
) -> DataFrame:
    """One row per non-empty window: ``total_edits`` and the sketch of its users; a null user counts
    in the former only."""
    return _sketched(
        edits,
        granularities,
        by,
        F.count("*").alias("total_edits"),
        F.hll_sketch_agg("user", LOG_SIZE).alias("users_sketch"),
    )


def _sketched(edits, granularities, by, *measures: Column) -> DataFrame:
    keys = windowed(edits, granularities)
    figures = keys.groupBy("window_seconds", "window_epoch", *by).agg(*measures)
    names = [n for n in figures.columns if n not in ("window_seconds", "window_epoch")]
    return figures.select(*names, *window_columns(granularities))


def merged_users(sketches: DataFrame, *by: str | Column) -> DataFrame:
    """Distinct users of all windows of each value of ``by``, from their sketches."""
    union = F.hll_union_agg("users_sketch")
    return sketches.groupBy(*by).agg(F.hll_sketch_estimate(union).alias("approx_users"))


def latency(silver: DataFrame) -> Column:
    """Milliseconds from the arrival of an edit to its features; null if either time is unknown."""
    return F.unix_millis("silver_processed_at") - F.unix_millis("ingested_at")


def latency_sketches(
    silver: DataFrame,
    granularities: Mapping[str, int] = fixed.GRANULARITIES,
    by: Sequence[str] = (),
) -> DataFrame:
    """One row per non-empty window: edits with a known processing time, and the sketch of the times.

    Windows are those of the edits, so a late edit shows its time in the window it belongs to.
    """
    timed = silver.withColumn("latency_ms", latency(silver)).where("latency_ms IS NOT NULL")
    return _sketched(
        timed,
        granularities,
        by,
        F.count("*").alias("timed_edits"),
        F.max("latency_ms").alias("max_latency_ms"),
        F.kll_sketch_agg_bigint("latency_ms", F.lit(ITEMS)).alias("latency_sketch"),
    )


def merged_latency(
    sketches: DataFrame, *by: str | Column, percentiles: Mapping[str, float] = PERCENTILES
) -> DataFrame:
    """Percentiles of the processing time (``p50_ms`` ...) of all windows of each value of ``by``."""
    merged = sketches.groupBy(*by).agg(
        F.sum("timed_edits").alias("timed_edits"),
        F.max("max_latency_ms").alias("max_latency_ms"),
        F.kll_merge_agg_bigint("latency_sketch", F.lit(ITEMS)).alias("latency_sketch"),
    )
    quantiles = [
        F.kll_sketch_get_quantile_bigint("latency_sketch", F.lit(float(share))).alias(f"{name}_ms")
        for name, share in percentiles.items()
    ]
    return merged.select("*", *quantiles).drop("latency_sketch")
