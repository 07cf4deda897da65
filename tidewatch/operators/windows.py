"""Tumbling-window aggregates of edits, for all window lengths in one pass.

Each edit is expanded to one row per window length before the aggregation, so the table is scanned
once.  Grouping is map-side combined, and the distinct counts run in Spark's two-step form: rows of
one hot window, user or page are spread by the distinct column before they meet.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch import fixed
from tidewatch.functions import lit_moment, window_epoch

_KEYS = ("window_seconds", "window_epoch")


def windowed(edits: DataFrame, granularities: Mapping[str, int]) -> DataFrame:
    """Each edit once for every window length, with ``window_seconds`` and ``window_epoch``."""
    lengths = F.array(*[F.lit(seconds) for seconds in granularities.values()])
    return (
        edits.filter(F.col("edit_timestamp").isNotNull())
        .withColumn("window_seconds", F.explode(lengths))
        .withColumn("window_epoch", window_epoch(F.col("edit_timestamp"), F.col("window_seconds")))
    )


def window_columns(granularities: Mapping[str, int]) -> list[Column]:
    """Bounds, label and date of a window, from the columns :func:`windowed` adds."""
    # casts, as timestamp_seconds raises on the end of a window at the far end of time
    epoch, seconds = F.col("window_epoch"), F.col("window_seconds")
    start = epoch.cast("timestamp")
    labels = [F.lit(part) for label, length in granularities.items() for part in (length, label)]
    return [
        start.alias("window_start"),
        (epoch + seconds).cast("timestamp").alias("window_end"),
        F.try_element_at(F.create_map(*labels), seconds).alias("window_duration"),
        F.to_date(start).alias("date"),
    ]


def _ones(condition: Column) -> Column:
    """Rows where ``condition`` holds; rows where it is null count for neither side."""
    return F.sum(condition.cast("int"))


def volume_measures(users: Column) -> list[Column]:
    """The figures of a window; ``users`` is how its users are counted."""
    return [
        F.count("*").alias("total_edits"),
        _ones(F.col("bot")).alias("bot_edits"),
        _ones(~F.col("bot")).alias("human_edits"),
        users,
        F.sum("abs_bytes_delta").alias("total_bytes_changed"),
        F.avg("abs_bytes_delta").alias("avg_bytes_per_edit"),
        _ones(F.col("is_revert")).alias("revert_count"),
    ]


def bot_ratio() -> Column:
    return F.round(F.col("bot_edits") / F.col("total_edits"), fixed.BOT_RATIO_DIGITS).alias("bot_ratio")


def edit_volume(
    edits: DataFrame,
    granularities: Mapping[str, int] = fixed.GRANULARITIES,
    by: Sequence[str] = (),
) -> DataFrame:
    """One row per non-empty window: edit, bot, human, user, byte and revert figures.

    With ``by``, one row per window and value of those columns.
    """
    figures = (
        windowed(edits, granularities)
        .groupBy(*_KEYS, *by)
        .agg(*volume_measures(F.count_distinct("user").alias("unique_users")))
    )
    start, end, label, day = window_columns(granularities)
    measures = [name for name in figures.columns if name not in _KEYS]
    return figures.select(*measures, start, end, label, bot_ratio(), day)


def user_activity(
    edits: DataFrame,
    granularities: Mapping[str, int] = fixed.GRANULARITIES,
    by: Sequence[str] = (),
) -> DataFrame:
    """One row per window, user and bot flag; a null user or flag is a group of its own.

    With ``by``, one row per value of those columns, too.
    """
    figures = (
        windowed(edits, granularities)
        .groupBy(*_KEYS, "user", "bot", *by)
        .agg(
            F.count("*").alias("edit_count"),
            F.sum("abs_bytes_delta").alias("bytes_changed"),
            _ones(F.col("is_revert")).alias("revert_count"),
            F.count_distinct("title").alias("unique_pages_edited"),
        )
    )
    measures = [name for name in figures.columns if name not in _KEYS]
    return figures.select(*measures, *window_columns(granularities))


def fill_quiet(
    volume: DataFrame,
    granularities: Mapping[str, int] = fixed.GRANULARITIES,
    by: Sequence[str] = (),
    start: datetime | None = None,
    end: datetime | None = None,
) -> DataFrame:
    """``volume`` with a row for every window of each series between its first and its last one.

    A window without edits has counts and sums of 0, and no mean and ratio.  With ``start`` or ``end``
    (exclusive), every series has all windows from or to there, and its own beyond it are left out;
    give both where some timestamps are absurd.  A series without any window has no row.  The calendar
    is made day by day, so no task holds more than a day of a series.
    """
    seconds = F.try_element_at(
        F.create_map(*[F.lit(x) for entry in granularities.items() for x in entry]),
        F.col("window_duration"),
    )
    if start is not None:
        volume = volume.where(F.col("window_start") >= lit_moment(start))
    if end is not None:
        volume = volume.where(F.col("window_start") < lit_moment(end))
    epoch = F.unix_seconds("window_start")
    first = F.unix_seconds(lit_moment(start)) if start else F.min(epoch)
    last = F.unix_seconds(lit_moment(end)) - 1 if end else F.max(epoch)
    series = (
        volume.groupBy("window_duration", *by)
        .agg(first.alias("first"), last.alias("last"))
        .withColumn("length", seconds)
        # the first whole window at or after the first moment
        .withColumn("first", F.col("first") + F.pmod(-F.col("first"), F.col("length")))
        .where("first <= last")
    )
    day = 86_400
    midnight = F.col("first") - F.pmod("first", F.lit(day))
    days = series.withColumn("day", F.explode(F.sequence(midnight, F.col("last"), F.lit(day))))
    begin = F.col("day") + F.pmod(-F.col("day"), F.col("length"))
    stop = F.least(F.col("last"), F.col("day") + (day - 1))
    starts = F.when(begin <= stop, F.sequence(begin, stop, F.col("length")))
    calendar = (
        days.withColumn("epoch", F.explode(starts))
        .where("epoch >= first")
        .select(
            "window_duration",
            *by,
            F.timestamp_seconds("epoch").alias("window_start"),
            F.timestamp_seconds(F.col("epoch") + F.col("length")).alias("window_end"),
        )
    )
    known = [name for name in volume.columns if name not in ("window_duration", *by, "window_start")]
    keys = ["window_duration", *by, "window_start"]
    same = reduce(and_, [F.col(f"c.{key}").eqNullSafe(F.col(f"v.{key}")) for key in keys])
    joined = calendar.alias("c").join(volume.alias("v"), same, "left")
    zero = {
        "total_edits", "bot_edits", "human_edits", "unique_users", "total_bytes_changed", "revert_count"
    }
    quiet = F.col("v.window_start").isNull()
    filled = {
        "window_end": F.col("c.window_end"),
        "date": F.to_date("c.window_start"),
        **{name: F.when(quiet, 0).otherwise(F.col(f"v.{name}")) for name in zero & set(known)},
    }
    kinds = {field.name: field.dataType for field in volume.schema}
    columns = {key: F.col(f"c.{key}") for key in keys}
    columns |= {name: filled.get(name, F.col(f"v.{name}")).cast(kinds[name]) for name in known}
    return joined.select(*[columns[name].alias(name) for name in volume.columns])
