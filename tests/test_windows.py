"""Window aggregates against brute force, against the built-in window function, and under skew."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tests.helpers import LENGTHS, expected_users, expected_volume, moment, silver_rows
from tidewatch.functions import window_epoch
from tidewatch.operators import reports
from tidewatch.operators.windows import edit_volume, user_activity
from tidewatch.plans.registry import _silver

VOLUME = (
    "total_edits", "bot_edits", "human_edits", "unique_users", "total_bytes_changed",
    "avg_bytes_per_edit", "revert_count",
)
USERS = ("edit_count", "bytes_changed", "revert_count", "unique_pages_edited")


def volume_result(frame):
    return {
        (row.window_duration, row.window_start): tuple(row[name] for name in VOLUME)
        for row in frame.collect()
    }


def user_result(frame):
    return {
        (row.window_duration, row.window_start, row.user, row.bot): tuple(
            row[name] for name in USERS
        )
        for row in frame.collect()
    }


def at_moments(expected):
    return {(key[0], moment(key[1]), *key[2:]): value for key, value in expected.items()}


def check(spark, rows):
    frame = silver_rows(spark, rows)
    rows = [row for row in rows if row["t"] is not None]
    assert volume_result(edit_volume(frame)) == at_moments(expected_volume(rows))
    assert user_result(user_activity(frame)) == at_moments(expected_users(rows))


def test_nulls(spark):
    check(
        spark,
        [
            {"t": 0, "bot": True},
            {"t": 1, "bot": None, "user": None},
            {"t": 2, "bot": False, "size": None, "title": None},
            {"t": 70, "bot": None, "size": None, "user": None},
            {"t": 71, "bot": None, "size": None, "user": None},
            {"t": None},
        ],
    )


def test_null_flag_counts_for_neither_side(spark):
    frame = silver_rows(spark, [{"t": 0, "bot": b} for b in (True, None, False)])
    row = edit_volume(frame, {"5min": 300}).first()
    assert (row.total_edits, row.bot_edits, row.human_edits) == (3, 1, 1)
    assert row.bot_ratio == 0.3333
    frame = silver_rows(spark, [{"t": 0, "bot": None}])
    row = edit_volume(frame, {"5min": 300}).first()
    assert (row.bot_edits, row.human_edits, row.bot_ratio) == (None, None, None)


def test_bounds_label_and_date(spark):
    frame = silver_rows(spark, [{"t": 86399.999999}, {"t": 86400}])
    rows = edit_volume(frame, {"1min": 60}).orderBy("window_start").collect()
    assert [(row.window_start, row.window_end) for row in rows] == [
        (moment(86340), moment(86400)),
        (moment(86400), moment(86460)),
    ]
    assert [str(row.date) for row in rows] == ["1970-01-01", "1970-01-02"]
    assert {row.window_duration for row in rows} == {"1min"}


@pytest.mark.parametrize("seed", range(3))
def test_random_rows(spark, seed):
    dice = random.Random(seed)
    check(
        spark,
        [
            {
                "t": dice.randrange(-2000, 4000) + dice.choice([0, 0.25, 0.999999]),
                "user": dice.choice(["a", "b", "c", None]),
                "title": dice.choice(["p", "q", "r", None]),
                "bot": dice.choice([True, False, None]),
                "size": dice.choice([None, 0, 1, 7, 2**31 - 1]),
                "revert": dice.choice([True, False]),
            }
            for _ in range(400)
        ],
    )


@pytest.mark.parametrize("hot", ["user", "title", "window", "all"])
def test_a_third_of_the_rows_share_a_key(spark, hot):
    dice = random.Random(7)
    rows = []
    for n in range(900):
        row = {"t": dice.randrange(40_000), "user": f"u{n}", "title": f"p{n}"}
        if n % 3 == 0:
            row |= {"user": "hot"} if hot in ("user", "all") else {}
            row |= {"title": "hot"} if hot in ("title", "all") else {}
            row |= {"t": 1200 + n % 60} if hot in ("window", "all") else {}
        rows.append(row)
    check(spark, rows)


@pytest.mark.parametrize("label", LENGTHS)
def test_same_windows_as_the_built_in_function(spark, label):
    frame = _silver(spark, "/root/testdata/sf0.01")
    length = LENGTHS[label]
    built_in = frame.groupBy(F.window("edit_timestamp", f"{length} seconds").alias("w")).agg(
        F.count("*").alias("n")
    )
    ours = edit_volume(frame, {label: length})
    assert (
        built_in.select("w.start", "w.end", "n")
        .exceptAll(ours.select("window_start", "window_end", "total_edits"))
        .isEmpty()
    )
    assert built_in.count() == ours.count()


def test_window_epoch_before_1970(spark):
    frame = spark.sql("SELECT timestamp_seconds(-1) AS t")
    assert frame.select(window_epoch(F.col("t"), F.lit(300))).first()[0] == -300


def test_invariants(spark):
    frame = _silver(spark, "/root/testdata/sf0.01")
    volume, users = edit_volume(frame), user_activity(frame)
    assert volume.filter("bot_edits + human_edits > total_edits").isEmpty()
    per_window = users.groupBy("window_start", "window_duration").agg(
        F.sum("edit_count").alias("n")
    )
    keys = ["window_start", "window_duration"]
    joined = volume.join(per_window, keys)
    assert joined.count() == volume.count()
    assert joined.filter("n <> total_edits").isEmpty()
    minutes = volume.filter("window_duration = '1min'").withColumn(
        "window_start", F.timestamp_seconds(window_epoch(F.col("window_start"), F.lit(300)))
    )
    summed = minutes.groupBy("window_start").agg(F.sum("total_edits").alias("n"))
    fives = volume.filter("window_duration = '5min'")
    assert fives.join(summed, "window_start").filter("n = total_edits").count() == fives.count()


def test_presentation_order(spark):
    rows = [{"t": t, "user": u} for t, u in [(700, "a"), (10, "a"), (20, "b"), (30, "b")]]
    frame = silver_rows(spark, rows)
    starts = [row.window_start for row in reports.by_window(edit_volume(frame)).collect()]
    assert starts == sorted(starts)
    users = user_activity(frame, {"5min": 300})
    shown = [(row.user, row.edit_count) for row in reports.by_window_and_edits(users).collect()]
    assert shown == [("b", 2), ("a", 1), ("a", 1)]
    preview = reports.editor_preview(user_activity(frame), rows=2).collect()
    assert [(row.user, row.edit_count) for row in preview] == [("b", 2), ("a", 1)]


def test_null_user_counts_once_in_the_table_report(spark):
    frame = silver_rows(spark, [{"t": 0, "user": None}, {"t": 400, "user": None}, {"t": 0}])
    report = reports.user_totals(user_activity(frame, {"5min": 300})).first()
    assert (report.total_rows, report.distinct_users) == (3, 2)
