"""Slices, key figures, series and editor lists."""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tests.helpers import moment, silver_rows
from tidewatch.functions import floor_minutes, slice_start, utc_date
from tidewatch.operators import dashboard, reports
from tidewatch.operators.windows import user_activity
from tidewatch.plans.gold import gold_edit_volume
from tidewatch.sources.tables import SILVER_PARTITION, edits_since


def spiky(spark, **spike):
    """Twenty quiet minutes and one busy one, in which ``busy`` edits most."""
    quiet = [{"t": 60 * n, "user": f"q{n % 3}"} for n in range(20)]
    busy = [{"t": 1200 + n, "user": "busy", "bot": True, "title": f"p{n % 4}"} for n in range(30)]
    return silver_rows(spark, [*quiet, *busy, {"t": 1201, "user": "q0", **spike}])


def test_slice_start():
    now = datetime(2024, 1, 2, 3, 59, 59, 5)
    assert floor_minutes(now) == datetime(2024, 1, 2, 3, 55)
    assert slice_start(now) == datetime(2024, 1, 1, 21, 55)
    assert slice_start(now, 1) == datetime(2024, 1, 2, 2, 55)
    assert slice_start(now.replace(tzinfo=timezone(timedelta(hours=2))), 1) == datetime(
        2024, 1, 2, 0, 55
    )
    for hours in (0, 49):
        with pytest.raises(ValueError, match="hours"):
            slice_start(now, hours)


def test_slices(spark):
    gold, users = gold_edit_volume(spiky(spark)), user_activity(spiky(spark))
    volume = dashboard.volume_slice(gold, datetime(1970, 1, 1, 0, 20), "1min")
    assert volume.columns == list(dashboard.VOLUME_COLUMNS) and len(volume.columns) == 14
    assert [row.window_start for row in volume.collect()] == [moment(1200)]
    sliced = dashboard.user_slice(users, datetime(1970, 1, 1, 0, 20), "1min")
    assert len(sliced.columns) == 7
    assert {row.user for row in sliced.collect()} == {"busy", "q0"}
    assert dashboard.volume_slice(gold).count() == 5
    with pytest.raises(ValueError, match="granularity"):
        dashboard.volume_slice(gold, granularity="2min")


def test_slice_prunes_partitions(spark, folder):
    gold_edit_volume(spiky(spark)).write.partitionBy("date").parquet(f"{folder}/gold")
    stored = spark.read.parquet(f"{folder}/gold")
    sliced = dashboard.volume_slice(stored, datetime(1970, 1, 1, 0, 20), "1min")
    plan = sliced._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan
    assert "PushedFilters: [IsNotNull(window_start), IsNotNull(window_duration)" in plan
    assert sliced.count() == 1


def test_key_figures(spark):
    volume = dashboard.volume_slice(gold_edit_volume(spiky(spark)), granularity="1min")
    figures = dashboard.key_figures(volume).first()
    assert (figures.windows, figures.total_edits, figures.anomalous_windows) == (21, 51, 1)
    assert figures.peak_edits == 31
    assert figures.anomalous_pct == pytest.approx(100 / 21)
    assert figures.avg_bot_ratio == pytest.approx(0.9677 / 21)
    empty = dashboard.key_figures(volume.filter("false")).first()
    assert (empty.windows, empty.anomalous_pct) == (0, None)


def test_mean_bot_ratio_skips_windows_without_one(spark):
    rows = [{"t": 0, "bot": True}, {"t": 60, "bot": None}, {"t": 120, "bot": False}]
    gold = gold_edit_volume(silver_rows(spark, rows))
    volume = dashboard.volume_slice(gold, granularity="1min")
    assert dashboard.key_figures(volume).first().avg_bot_ratio == 0.5


def test_series(spark):
    volume = dashboard.volume_slice(gold_edit_volume(spiky(spark)), granularity="1min")
    rows = dashboard.volume_series(volume).collect()
    assert [row.window_start for row in rows] == [moment(60 * n) for n in range(21)]
    assert [row.anomaly_edits for row in rows] == [None] * 20 + [31]
    last = dashboard.bot_series(volume).collect()[-1]
    assert (last.human_edits, last.bot_edits, last.bot_ratio) == (1, 30, 0.9677)
    scores = [row.z_score for row in dashboard.z_score_series(volume).collect()]
    assert scores[0] == 0.0 and scores[-1] > 2
    table = dashboard.anomaly_table(volume)
    assert table.columns == list(dashboard.ANOMALY_COLUMNS)
    assert [row.window_start for row in table.collect()] == [moment(1200)]


def test_bounds_with_a_zone(spark):
    """01:00 at +05:00 is 20:00 UTC of the day before."""
    rows = silver_rows(spark, [{"t": 19 * 3600}, {"t": 20 * 3600}, {"t": 25 * 3600}])
    east = datetime(1970, 1, 2, 1, 0, tzinfo=timezone(timedelta(hours=5)))
    assert utc_date(east) == date(1970, 1, 1) and utc_date(date(1970, 1, 2)) == date(1970, 1, 2)
    activity = dashboard.user_slice(user_activity(rows), east, "1min")
    assert activity.count() == 2
    by_day = rows.withColumn(SILVER_PARTITION, F.to_date("edit_timestamp"))
    assert edits_since(by_day, east).count() == 2


def test_other_labels(spark):
    rows = user_activity(silver_rows(spark, [{"t": 0}]), {"hour": 3600})
    assert dashboard.user_slice(rows, None, "hour", ["hour"]).count() == 1
    with pytest.raises(ValueError, match="granularity"):
        dashboard.user_slice(rows, None, "1min", ["hour"])


@pytest.mark.parametrize("threshold", ["-1", "10m"])
def test_users_in_anomalies(spark, threshold):
    source = spiky(spark)
    volume = dashboard.volume_slice(gold_edit_volume(source), granularity="1min")
    users = dashboard.user_slice(user_activity(source), granularity="1min")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        found = dashboard.users_in_anomalies(users, volume)
        assert found.columns == users.columns
        assert sorted(row.user for row in found.collect()) == ["busy", "q0"]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_top_editors(spark):
    rows = [
        {"t": 0, "user": "a", "title": "x"},
        {"t": 1, "user": "a", "title": "x"},
        {"t": 400, "user": "a", "title": "x"},
        {"t": 0, "user": "b", "bot": True},
        {"t": 0, "user": "b", "bot": False},
        {"t": 0, "user": None},
        {"t": 0, "user": "c", "bot": None},
    ]
    users = dashboard.user_slice(user_activity(silver_rows(spark, rows)))
    top = [tuple(row) for row in dashboard.top_editors(users).collect()]
    # user a edited one page in two windows: it counts twice; ties go by user, then flag
    assert top == [
        ("a", False, 3, 2, 2, "a"),
        ("b", False, 1, 1, 1, "b"),
        ("b", True, 1, 1, 1, "b 🤖"),
    ]
    assert dashboard.distinct_users(users).first().unique_users == 3


def test_top_is_cut_at_twenty(spark):
    rows = [{"t": 0, "user": f"u{n:02}"} for n in range(25)]
    users = dashboard.user_slice(user_activity(silver_rows(spark, rows)))
    assert [row.user for row in dashboard.top_editors(users).collect()] == [
        f"u{n:02}" for n in range(20)
    ]


def test_null_user_in_the_two_distinct_counts(spark):
    users = user_activity(silver_rows(spark, [{"t": 0, "user": None}, {"t": 400, "user": None}]))
    sliced = dashboard.user_slice(users)
    assert dashboard.distinct_users(sliced).first().unique_users == 0
    assert reports.user_totals(sliced).first().distinct_users == 1
    assert dashboard.top_editors(sliced).isEmpty()


def test_latest_windows(spark):
    gold = gold_edit_volume(silver_rows(spark, [{"t": 60 * n} for n in range(30)]))
    latest = reports.latest_windows(gold).collect()
    assert len(latest) == 20 and latest[0].window_start == moment(1740)
    shared = [row.window_duration for row in latest if row.window_start == moment(1500)]
    assert shared == ["1min", "5min"]


def test_reports(spark):
    gold = gold_edit_volume(spiky(spark))
    assert tuple(reports.volume_totals(gold).first()) == (26, gold.filter("is_anomaly").count())
    rows = reports.rows_per_granularity(gold).collect()
    counts = {row.window_duration: row["count"] for row in rows}
    assert counts == {"1min": 21, "5min": 5}
    span = reports.time_range(spiky(spark)).first()
    assert (span.earliest, span.latest) == (moment(0), moment(1229))


def test_summary_on_nothing(spark):
    gold = gold_edit_volume(spiky(spark).filter(F.lit(False)))
    assert gold.isEmpty() and dashboard.anomaly_table(dashboard.volume_slice(gold)).isEmpty()
