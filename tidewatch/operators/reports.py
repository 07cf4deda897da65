"""Figures about the silver slice and the gold tables.  Each returns a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch import fixed


def time_range(edits: DataFrame) -> DataFrame:
    return edits.agg(
        F.min("edit_timestamp").alias("earliest"), F.max("edit_timestamp").alias("latest")
    )


def rows_per_granularity(table: DataFrame) -> DataFrame:
    return table.groupBy("window_duration").count()


def volume_totals(volume: DataFrame) -> DataFrame:
    return volume.agg(
        F.count("*").alias("total_rows"), F.count_if("is_anomaly").alias("anomalous_rows")
    )


def user_totals(activity: DataFrame) -> DataFrame:
    """Rows and distinct users, where a null user counts as one value (hence the struct)."""
    return activity.agg(
        F.count("*").alias("total_rows"),
        F.count_distinct(F.struct("user")).alias("distinct_users"),
    )


def by_window(volume: DataFrame) -> DataFrame:
    """Presentation order of the volume table."""
    return volume.orderBy("window_start")


def by_window_and_edits(activity: DataFrame) -> DataFrame:
    """Presentation order of the user table.

    Ties are settled by user and flag: most rows of a busy window have an edit count of one, and
    without a further key a range-partitioned sort would put all of them into one task.
    """
    return activity.orderBy("window_start", F.desc("edit_count"), "user", "bot")


def latest_windows(volume: DataFrame, rows: int = fixed.LATEST_WINDOWS) -> DataFrame:
    return volume.orderBy(F.desc("window_start"), "window_duration").limit(rows)


def editor_preview(
    activity: DataFrame,
    granularity: str = fixed.DEFAULT_GRANULARITY,
    rows: int = fixed.PREVIEW_EDITORS,
) -> DataFrame:
    """The first editors in presentation order."""
    chosen = activity.filter(F.col("window_duration") == granularity).select(
        "window_start", "user", "bot", "edit_count", "unique_pages_edited"
    )
    return by_window_and_edits(chosen).limit(rows)
