"""All frames of one dashboard page, from the written gold tables."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import DataFrame

from tidewatch import fixed
from tidewatch.functions import slice_start
from tidewatch.operators import dashboard
from tidewatch.operators.reports import by_window, by_window_and_edits


def dashboard_page(
    volume: DataFrame,
    activity: DataFrame,
    as_of: datetime | None = None,
    hours: int = fixed.DEFAULT_HOURS,
    granularity: str = fixed.DEFAULT_GRANULARITY,
    granularities: Iterable[str] = fixed.GRANULARITIES,
) -> dict[str, DataFrame]:
    """The slices of the last ``hours`` and everything shown about them, by name.

    Building the page runs no job; only the rows that are shown leave the cluster, and only when a
    frame is collected.
    """
    start = slice_start(as_of, hours)
    windows = dashboard.volume_slice(volume, start, granularity, granularities)
    users = dashboard.user_slice(activity, start, granularity, granularities)
    unusual = dashboard.users_in_anomalies(users, windows)
    return {
        "volume": by_window(windows),
        "users": by_window_and_edits(users),
        "key_figures": dashboard.key_figures(windows),
        "distinct_users": dashboard.distinct_users(users),
        "volume_series": dashboard.volume_series(windows),
        "bot_series": dashboard.bot_series(windows),
        "z_score_series": dashboard.z_score_series(windows),
        "top_editors": dashboard.top_editors(unusual),
        "anomalies": dashboard.anomaly_table(windows),
    }
