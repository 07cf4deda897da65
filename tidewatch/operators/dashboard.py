"""Dashboard queries over the two gold tables, down to the rows that are shown."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch import fixed
from tidewatch.functions import editor_label, lit_date, lit_moment, percent

# Column lists are fixed values: the order in which the tables show them.
VOLUME_COLUMNS = (
    "window_start", "window_end", "total_edits", "bot_edits", "human_edits", "bot_ratio",
    "unique_users", "total_bytes_changed", "avg_bytes_per_edit", "revert_count", "is_anomaly",
    "z_score", "rolling_mean_edits", "anomaly_threshold",
)
USER_COLUMNS = (
    "window_start", "user", "bot", "edit_count", "bytes_changed", "revert_count",
    "unique_pages_edited",
)
ANOMALY_COLUMNS = (
    "window_start", "window_end", "total_edits", "bot_edits", "human_edits", "bot_ratio",
    "z_score", "revert_count",
)


def since(table: DataFrame, start: datetime) -> DataFrame:
    """Rows whose window starts at or after ``start``; the date bound prunes partitions."""
    return table.filter(
        (F.col("date") >= lit_date(start)) & (F.col("window_start") >= lit_moment(start))
    )


def _slice(table, columns, granularity, start, granularities):
    if granularity not in granularities:
        raise ValueError(f"granularity must be one of {[*granularities]}, not {granularity}")
    rows = table if start is None else since(table, start)
    return rows.filter(F.col("window_duration") == granularity).select(*columns)


def volume_slice(
    volume: DataFrame,
    start: datetime | None = None,
    granularity: str = fixed.DEFAULT_GRANULARITY,
    granularities: Iterable[str] = fixed.GRANULARITIES,
) -> DataFrame:
    """Volume rows of one granularity from ``start`` on; the whole table if there is no start.

    ``granularities`` are the labels the table has.
    """
    return _slice(volume, VOLUME_COLUMNS, granularity, start, granularities)


def user_slice(
    activity: DataFrame,
    start: datetime | None = None,
    granularity: str = fixed.DEFAULT_GRANULARITY,
    granularities: Iterable[str] = fixed.GRANULARITIES,
) -> DataFrame:
    return _slice(activity, USER_COLUMNS, granularity, start, granularities)


def key_figures(volume: DataFrame) -> DataFrame:
    """The figures above the charts; the mean bot ratio weighs every window alike."""
    return volume.agg(
        F.count("*").alias("windows"),
        F.sum("total_edits").alias("total_edits"),
        F.count_if("is_anomaly").alias("anomalous_windows"),
        F.avg("bot_ratio").alias("avg_bot_ratio"),
        F.max("total_edits").alias("peak_edits"),
    ).withColumn("anomalous_pct", percent(F.col("anomalous_windows"), F.col("windows")))


def distinct_users(activity: DataFrame) -> DataFrame:
    """Distinct users of a slice, nulls not counted; one row."""
    return activity.agg(F.count_distinct("user").alias("unique_users"))


def anomalies(volume: DataFrame) -> DataFrame:
    return volume.filter("is_anomaly")


def volume_series(volume: DataFrame) -> DataFrame:
    """Edits, rolling mean and threshold over time; ``anomaly_edits`` holds the marker points."""
    return volume.select(
        "window_start",
        "total_edits",
        "rolling_mean_edits",
        "anomaly_threshold",
        F.when(F.col("is_anomaly"), F.col("total_edits")).alias("anomaly_edits"),
    ).orderBy("window_start")


def bot_series(volume: DataFrame) -> DataFrame:
    return volume.select("window_start", "human_edits", "bot_edits", "bot_ratio").orderBy(
        "window_start"
    )


def z_score_series(volume: DataFrame) -> DataFrame:
    """Z-scores over time; the anomaly zone of the chart starts at ``fixed.SIGMA``."""
    return volume.select("window_start", "z_score").orderBy("window_start")


def users_in_anomalies(activity: DataFrame, volume: DataFrame) -> DataFrame:
    """User rows whose window is an anomalous one.

    Spark chooses the join from the sizes it sees at run time, and splits a hot window.
    """
    minute = F.date_trunc("minute", F.col("window_start"))
    unusual = anomalies(volume).select(minute.alias("minute"))
    return activity.withColumn("minute", minute).join(unusual, "minute", "left_semi").drop("minute")


def top_editors(activity: DataFrame, rows: int = fixed.TOP_EDITORS) -> DataFrame:
    """Most active editors.  ``unique_pages`` adds up the distinct pages of each window, so a page
    edited in two windows counts twice.  Rows without user or flag belong to no editor."""
    return (
        activity.filter(F.col("user").isNotNull() & F.col("bot").isNotNull())
        .groupBy("user", "bot")
        .agg(
            F.sum("edit_count").alias("edit_count"),
            F.count_distinct("window_start").alias("windows"),
            F.sum("unique_pages_edited").alias("unique_pages"),
        )
        .orderBy(F.desc("edit_count"), "user", "bot")
        .limit(rows)
        .withColumn("label", editor_label(F.col("user"), F.col("bot")))
    )


def anomaly_table(volume: DataFrame) -> DataFrame:
    """The anomalous windows, newest first."""
    return anomalies(volume).select(*ANOMALY_COLUMNS).orderBy(F.desc("window_start"))
