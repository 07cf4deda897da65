"""Window figures of a stream of edits, and the edits that came too late for them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch import fixed
from tidewatch.operators.sketches import LOG_SIZE
from tidewatch.operators.windows import bot_ratio, edit_volume, volume_measures

# How long a window is kept open for edits that come late.
DELAY = "10 minutes"


def volume_stream(
    silver: DataFrame,
    delay: str = DELAY,
    granularities: Mapping[str, int] = fixed.GRANULARITIES,
    by: Sequence[str] = (),
) -> DataFrame:
    """One row per window, once it is closed: ``delay`` after the latest edit seen.

    The columns are those of the volume table, but users are a mergeable sketch (``users_sketch``) with
    its estimate (``approx_users``), as a stream has no exact distinct count.  A later edit does not
    reopen its window: :func:`~tidewatch.streaming.volume.late_counts` tells what was missed, and the
    late-edits job repairs the gold tables.  The state is one row per open window and value of ``by``;
    edits are combined on the map side before they reach it.
    """
    timed = silver.withWatermark("edit_timestamp", delay)
    parts = []
    for label, seconds in granularities.items():
        figures = timed.groupBy(
            F.window("edit_timestamp", f"{seconds} seconds").alias("time_window"), *by
        ).agg(*volume_measures(F.hll_sketch_agg("user", LOG_SIZE).alias("users_sketch")))
        start = F.col("time_window.start")
        measures = [name for name in figures.columns if name != "time_window"]
        parts.append(
            figures.select(
                *measures,
                F.hll_sketch_estimate("users_sketch").alias("approx_users"),
                start.alias("window_start"),
                F.col("time_window.end").alias("window_end"),
                F.lit(label).alias("window_duration"),
                bot_ratio(),
                F.to_date(start).alias("date"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


def late_counts(
    silver: DataFrame,
    closed: DataFrame,
    granularities: Mapping[str, int] = fixed.GRANULARITIES,
    by: Sequence[str] = (),
) -> DataFrame:
    """Windows that were closed too early: ``counted_edits`` in the stream's table ``closed``, and
    ``late_edits`` that ``silver`` holds besides.

    A window counts as closed if one that ends then or later is in ``closed``; one whose edits were all
    late is not there itself and has 0 counted.
    """
    keys = ["window_duration", *by, "window_start"]
    ends = closed.groupBy("window_duration").agg(F.max("window_end").alias("closed_to"))
    there = edit_volume(silver, granularities, by).select(*keys, "window_end", "total_edits")
    # one row per window length
    there = there.join(F.broadcast(ends), "window_duration").where("window_end <= closed_to")
    pairs = reduce(
        lambda a, b: a & b, [F.col(f"a.{key}").eqNullSafe(F.col(f"b.{key}")) for key in keys]
    )
    counted = F.coalesce("b.total_edits", F.lit(0))
    return (
        there.alias("a")
        .join(closed.alias("b"), pairs, "left")
        .select(
            *[f"a.{key}" for key in keys],
            counted.alias("counted_edits"),
            (F.col("a.total_edits") - counted).alias("late_edits"),
        )
        .where("late_edits > 0")
    )
