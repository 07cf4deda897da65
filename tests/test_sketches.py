"""Mergeable figures, quiet windows and looked-up labels."""

from __future__ import annotations

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.helpers import expected_baseline, moment, silver_rows, volume_rows
from tidewatch.operators import sketches
from tidewatch.operators.anomaly import flag_anomalies
from tidewatch.operators.silver import edit_features, labelled
from tidewatch.operators.windows import edit_volume, fill_quiet
from tidewatch.schemas import BRONZE_EDITS

DAY = 86_400


def test_users_of_a_range_from_stored_windows(spark, folder):
    rng = random.Random(1)
    rows = [{"t": rng.randrange(3 * DAY), "user": rng.choice([None, f"u{rng.randrange(3000)}"])} for _ in range(20_000)]
    edits = silver_rows(spark, rows)
    sketches.user_sketches(edits).write.parquet(f"{folder}/s")
    stored = spark.read.parquet(f"{folder}/s")
    exact = {0: set(), 1: set(), 2: set()}
    for row in rows:
        exact[row["t"] // DAY].add(row["user"])
    found = sketches.merged_users(stored.where("window_duration = '5min'"), "date").collect()
    for row in found:
        right = len(exact[row.date.day - 1] - {None})
        assert abs(row.approx_users - right) <= 0.03 * right
    whole = sketches.merged_users(stored.where("window_duration = '1min'")).first().approx_users
    right = len(set().union(*exact.values()) - {None})
    assert abs(whole - right) <= 0.03 * right
    assert stored.where("window_duration = '1min'").agg(F.sum("total_edits")).first()[0] == 20_000


def stamped(spark, lags):
    """Edits a minute apart with these milliseconds from arrival to features, or None."""
    frame = spark.createDataFrame(list(enumerate(lags)), "n int, lag long")
    arrived = F.timestamp_seconds(F.col("n") * 60 + 5)
    return frame.select(
        F.timestamp_seconds(F.col("n") * 60).alias("edit_timestamp"),
        arrived.alias("ingested_at"),
        F.timestamp_millis(F.unix_millis(arrived) + F.col("lag")).alias("silver_processed_at"),
    )


def test_latency(spark):
    fixed = sketches.latency_sketches(stamped(spark, [1500] * 300), {"5min": 300})
    row = sketches.merged_latency(fixed).first()
    assert (row.timed_edits, row.p50_ms, row.p95_ms, row.p99_ms, row.max_latency_ms) == (300,) + (1500,) * 4
    lags = [*range(1, 1001), None, None]
    random.Random(3).shuffle(lags)
    stored = sketches.latency_sketches(stamped(spark, lags), {"1min": 60, "5min": 300})
    for row in sketches.merged_latency(stored, "window_duration").collect():
        assert (row.timed_edits, row.p50_ms, row.p95_ms, row.p99_ms) == (1000, 500, 950, 990)
    other = sketches.merged_latency(stored, "window_duration", percentiles={"p10": 0.1})
    assert {row.p10_ms for row in other.collect()} == {100}
    one = stored.where("window_duration = '1min'")
    assert one.count() == 1000 and sketches.merged_latency(one.limit(0), "date").isEmpty()


def test_quiet_windows_count_as_nothing(spark):
    counts = {0: 5, 300: 7, 3900: 2}
    dense = flag_anomalies(fill_quiet(volume_rows(spark, counts)))
    full = {60 * n: counts.get(60 * n, 0) for n in range(66)}
    right = expected_baseline(full)
    found = {row.window_start: row for row in dense.collect()}
    assert found.keys() == {moment(epoch) for epoch in full}
    for epoch, total in full.items():
        row = found[moment(epoch)]
        assert row.total_edits == total
        assert (row.rolling_mean_edits, row.rolling_stddev_edits) == pytest.approx(right[epoch])


def test_quiet_windows_have_all_columns(spark):
    edits = silver_rows(spark, [{"t": 0}, {"t": 2 * DAY + 59, "bot": True, "size": 4}])
    volume = edit_volume(edits)
    dense = fill_quiet(volume)
    assert dense.schema.names == volume.schema.names and dense.dtypes == volume.dtypes
    labels = {row[0]: row[1] for row in dense.groupBy("window_duration").count().collect()}
    assert labels == {"1min": 2 * 1440 + 1, "5min": 2 * 288 + 1}
    assert dense.where("total_edits > 0").exceptAll(volume).isEmpty()
    quiet = dense.where("total_edits = 0 AND window_start = '1970-01-02 10:05:00'")
    for row in quiet.collect():
        minutes = int(row.window_duration[0])
        assert (row.bot_edits, row.human_edits, row.unique_users, row.revert_count) == (0, 0, 0, 0)
        assert (row.total_bytes_changed, row.avg_bytes_per_edit, row.bot_ratio) == (0, None, None)
        assert row.window_end == datetime(1970, 1, 2, 10, 5 + minutes) and str(row.date) == "1970-01-02"


def test_quiet_windows_of_series_and_bounds(spark):
    edits = silver_rows(spark, [{"t": 600, "user": "a"}, {"t": 1200, "user": "a"}, {"t": 900, "user": None}])
    volume = edit_volume(edits, {"5min": 300}, ["user"])
    starts = lambda frame: sorted(((r.user, r.window_start.minute, r.total_edits) for r in frame.collect()), key=repr)
    assert starts(fill_quiet(volume, by=["user"])) == [("a", 10, 1), ("a", 15, 0), ("a", 20, 1), (None, 15, 1)]
    bounded = fill_quiet(volume, by=["user"], start=datetime(1970, 1, 1, 0, 11), end=datetime(1970, 1, 1, 0, 26))
    assert starts(bounded) == [("a", 15, 0), ("a", 20, 1), ("a", 25, 0), (None, 15, 1), (None, 20, 0), (None, 25, 0)]
    assert fill_quiet(volume.limit(0), by=["user"]).isEmpty()
    seven = fill_quiet(edit_volume(silver_rows(spark, [{"t": 0}, {"t": 3 * DAY}]), {"7min": 420}), {"7min": 420})
    assert seven.count() == 3 * DAY // 420 + 1


def edits_of(spark, namespaces):
    rows = spark.createDataFrame([(n,) for n in namespaces], "namespace int")
    return rows.select(
        *[
            F.col("namespace") if f.name == "namespace"
            else F.lit(1 if f.name in ("id", "timestamp") else None).cast(f.dataType).alias(f.name)
            for f in BRONZE_EDITS
        ]
    )


@pytest.mark.parametrize("at_most", [0, 2**30])
def test_looked_up_labels(spark, folder, at_most, monkeypatch):
    monkeypatch.setattr(labelled, "__defaults__", (at_most,))
    path = f"{folder}/labels-{at_most}"
    known = [(0, "Main"), (1, None), (None, "nowhere"), (None, "twice"), (99, "Far")]
    spark.createDataFrame(known, "namespace int, label string").coalesce(1).write.parquet(path)
    labels = spark.read.parquet(path)
    frame = edit_features(edits_of(spark, [0, 0, 1, 2, None, 99]), labels=labels, other_label="?")
    assert sorted(r.namespace_label for r in frame.collect()) == ["?", "?", "?", "Far", "Main", "Main"]
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert ("BroadcastHashJoin" in plan) == (at_most > 0 or "BroadcastHashJoin" in plan)
    usual = edit_features(edits_of(spark, [0]))
    assert frame.columns == usual.columns
    twice = labels.union(spark.createDataFrame([(0, "Other")], labels.schema))
    with pytest.raises(Exception, match="two labels for namespace 0"):
        edit_features(edits_of(spark, [0]), labels=twice).collect()
