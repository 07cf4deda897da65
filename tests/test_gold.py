"""Lookback, baseline modes, and the refresh of the gold tables."""

from __future__ import annotations

import uuid
from datetime import UTC, date, datetime, timedelta, timezone
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tests.helpers import moment, silver_rows
from tidewatch import fixed
from tidewatch.functions import lookback_start
from tidewatch.operators.windows import edit_volume, user_activity
from tidewatch.plans.gold import Settings, gold_edit_volume_since, refresh_gold
from tidewatch.sinks import (
    create_table,
    replace_dates,
    require_schema,
    table_exists,
    write_by_date,
)
from tidewatch.sources.tables import edits_since

DAY = 86_400
AS_OF = datetime(1970, 1, 10, 15, 30)
START = date(1970, 1, 8)


@pytest.fixture
def names():
    tag = uuid.uuid4().hex
    return {"volume_table": f"v_{tag}", "user_table": f"u_{tag}"}


def rows_of(spark, table):
    return sorted(map(tuple, spark.table(table).collect()), key=repr)


def days(spark, table):
    rows = spark.table(table).groupBy("date").count().collect()
    return {str(row.date): row["count"] for row in rows}


def on_days(spark, *numbers, **fields):
    """One edit at noon of each of these days of January 1970."""
    return silver_rows(spark, [{"t": (n - 1) * DAY + DAY // 2, **fields} for n in numbers])


def test_lookback_start():
    assert lookback_start(AS_OF) == START
    assert lookback_start(AS_OF, 0) == date(1970, 1, 10)
    east = datetime(1970, 1, 10, 1, 0, tzinfo=timezone(timedelta(hours=5)))
    assert lookback_start(east) == date(1970, 1, 7)
    today = datetime.now(UTC).date()
    assert lookback_start() in (today - timedelta(days=2), today - timedelta(days=3))


def test_lookback_is_from_midnight(spark):
    frame = silver_rows(spark, [{"t": 7 * DAY - 0.000001}, {"t": 7 * DAY}, {"t": 9 * DAY}])
    kept = [row.t for row in edits_since(frame, START).collect()]
    assert kept == [7 * DAY, 9 * DAY]


def test_warm_and_cold_baseline(spark):
    before = [{"t": 7 * DAY - 3600 + 60 * n} for n in range(60) for _ in range(4)]
    frame = silver_rows(spark, [*before, {"t": 7 * DAY}, {"t": 7 * DAY + 3600}])
    first, later = moment(7 * DAY), moment(7 * DAY + 3600)

    def means(warm):
        gold = gold_edit_volume_since(frame, START, warm).filter("window_duration = '1min'")
        return {row.window_start: row.rolling_mean_edits for row in gold.collect()}

    assert means(False) == {first: 1.0, later: 1.0}
    warm = means(True)
    assert set(warm) == {first, later} and warm[later] == 1.0
    assert warm[first] == pytest.approx((60 * 4 + 1) / 61)


def test_first_run_creates_partitioned_tables(spark, names):
    assert not table_exists(spark, names["volume_table"])
    result = refresh_gold(spark, silver=on_days(spark, 8, 9, 10), as_of=AS_OF, **names)
    assert result.written and result.start == START
    volume, users = spark.table(names["volume_table"]), spark.table(names["user_table"])
    assert len(volume.columns) == 17 and len(users.columns) == 10
    for table in names.values():
        assert table_exists(spark, table)
        assert days(spark, table) == {f"1970-01-{n:02}": 2 for n in (8, 9, 10)}
        assert spark.sql(f"SHOW PARTITIONS {table}").count() == 3


def test_rerun_gives_the_same_tables(spark, names):
    silver = on_days(spark, 7, 8, 9)
    refresh_gold(spark, silver=silver, as_of=AS_OF, **names)
    before = {table: rows_of(spark, table) for table in names.values()}
    refresh_gold(spark, silver=silver, as_of=AS_OF, **names)
    assert before == {table: rows_of(spark, table) for table in names.values()}


@pytest.mark.parametrize("external", [False, True])
def test_later_run_replaces_the_lookback_only(spark, names, folder, external):
    where = {"location": folder} if external else {}
    refresh_gold(
        spark, silver=on_days(spark, 6, 7, 8, 9), as_of=AS_OF - timedelta(days=2), **names, **where
    )
    assert set(days(spark, names["user_table"])) == {f"1970-01-{n:02}" for n in (6, 7, 8, 9)}
    # day 7 and 9 are gone from silver, day 6 and 8 have a late edit, day 10 is new
    silver = on_days(spark, 6, 8, 10).union(on_days(spark, 6, 8, user="late"))
    refresh_gold(spark, silver=silver, as_of=AS_OF, **names, **where)
    assert days(spark, names["user_table"]) == {
        "1970-01-06": 2,
        "1970-01-07": 2,
        "1970-01-08": 4,
        "1970-01-10": 2,
    }
    assert days(spark, names["volume_table"]) == {
        f"1970-01-{n:02}": 2 for n in (6, 7, 8, 10)
    }
    if external:
        on_disk = spark.read.parquet(f"{folder}/{names['user_table']}")
        assert on_disk.filter("date = '1970-01-09'").isEmpty()
    mode = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    assert mode.lower() == "static"


def test_nothing_to_write(spark, names):
    result = refresh_gold(spark, silver=on_days(spark, 5), as_of=AS_OF, **names)
    assert not result.written
    assert not any(table_exists(spark, table) for table in names.values())
    refresh_gold(spark, silver=on_days(spark, 8), as_of=AS_OF, **names)
    refresh_gold(spark, silver=on_days(spark, 5), as_of=AS_OF, **names)
    assert days(spark, names["user_table"]) == {"1970-01-08": 2}


def test_row_before_the_start_fails_the_write(spark, names):
    table = names["user_table"]
    create_table(user_activity(on_days(spark, 5, 6)), table)
    before = rows_of(spark, table)
    with pytest.raises(PySparkException, match="row before 1970-01-06"):
        replace_dates(user_activity(on_days(spark, 5, 6)), table, date(1970, 1, 6))
    assert rows_of(spark, table) == before
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_other_schema_is_refused(spark, names):
    table = names["user_table"]
    write_by_date(user_activity(on_days(spark, 5)), table, START)
    with pytest.raises(ValueError, match="edit_count"):
        other = user_activity(on_days(spark, 8)).withColumn("edit_count", F.lit("x"))
        write_by_date(other, table, START)
    with pytest.raises(ValueError, match="extra"):
        require_schema(spark.table(table).withColumn("extra", F.lit(1)), spark.table(table).schema)


def test_all_dates_vanish(spark, names):
    table = names["user_table"]
    create_table(user_activity(on_days(spark, 7, 8, 9)), table)
    replace_dates(user_activity(on_days(spark)), table, START)
    assert days(spark, table) == {"1970-01-07": 2}


def test_hot_date_is_written_whole(spark, names):
    table = names["volume_table"]
    rows = [{"t": 8 * DAY + 60 * n} for n in range(1400)] + [{"t": 7 * DAY}]
    frame = edit_volume(silver_rows(spark, rows), {"1min": 60})
    create_table(frame, table)
    assert days(spark, table) == {"1970-01-08": 1, "1970-01-09": 1400}
    replace_dates(frame, table, START)
    assert days(spark, table) == {"1970-01-08": 1, "1970-01-09": 1400}


def test_one_file_per_small_date(spark, names, folder):
    table, where = names["user_table"], f"{folder}/t"
    rows = [{"t": (7 + n % 3) * DAY + n, "user": f"u{n}"} for n in range(600)]
    frame = user_activity(silver_rows(spark, rows).repartition(8))
    create_table(frame, table, path=where)
    assert [len([*day.glob("*.parquet")]) for day in Path(where).glob("date=*")] == [1, 1, 1]
    replace_dates(frame, table, START)
    assert [len([*day.glob("*.parquet")]) for day in Path(where).glob("date=*")] == [1, 1, 1]


def test_files_are_sorted_within(spark, names, folder):
    rows = [{"t": 8 * DAY + 60 * (n * 37 % 500), "user": f"u{n}"} for n in range(500)]
    frame = user_activity(silver_rows(spark, rows).repartition(8))
    create_table(frame, names["user_table"], path=f"{folder}/t")
    stored = spark.read.parquet(f"{folder}/t").coalesce(1)
    keys = [(row.window_duration, row.window_start) for row in stored.collect()]
    assert len(keys) == 1000 and keys == sorted(keys)


@pytest.mark.parametrize("external", [False, True])
def test_far_dates_vanish_like_others(spark, names, folder, external):
    """Dates 32,768 days apart and beyond the year 9999 are told apart and removed."""
    table = names["user_table"]
    where = {"path": f"{folder}/t"} if external else {}
    far = [{"t": 1.7e12}, {"t": (8 + 32_768) * DAY}]
    old = user_activity(on_days(spark, 7, 8, 9).union(silver_rows(spark, far[:1])))
    create_table(old, table, **where)
    assert any(day.startswith("+") for day in days_as_text(spark, table))
    replace_dates(user_activity(on_days(spark, 8).union(silver_rows(spark, far[1:]))), table, START)
    assert days_as_text(spark, table) == ["1970-01-07", "1970-01-08", "2059-09-27"]
    listed = {row.partition for row in spark.sql(f"SHOW PARTITIONS {table}").collect()}
    assert listed == {f"date={day}" for day in days_as_text(spark, table)}
    if external:
        assert spark.read.parquet(f"{folder}/t").select("date").distinct().count() == 3


def days_as_text(spark, table):
    found = spark.table(table).select(F.col("date").cast("string")).distinct().collect()
    return sorted(row.date for row in found)


def test_vanished_dates_of_a_managed_table_run_no_job(spark, names):
    table = names["user_table"]
    create_table(user_activity(on_days(spark, *range(8, 20))), table)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("vanish", "")
    try:
        replace_dates(user_activity(on_days(spark, 8)), table, START)
        many = len(tracker.getJobIdsForGroup("vanish"))
        spark.sparkContext.setJobGroup("nothing", "")
        replace_dates(user_activity(on_days(spark, 8)), table, START)
        none = len(tracker.getJobIdsForGroup("nothing"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    # what is left over is removed without a job for each date
    assert many < none + 11
    assert days(spark, table) == {"1970-01-08": 2}


def test_silver_by_path(spark, names, folder):
    """The path asked for is read, also if there is a table of the usual name."""
    on_days(spark, 8).write.saveAsTable(fixed.SILVER_TABLE)
    try:
        on_days(spark, 10).write.parquet(f"{folder}/silver")
        refresh_gold(spark, silver_path=f"{folder}/silver", as_of=AS_OF, **names)
        assert days(spark, names["user_table"]) == {"1970-01-10": 2}
        refresh_gold(spark, as_of=AS_OF, **names)
        assert days(spark, names["user_table"]) == {"1970-01-08": 2}
        with pytest.raises(ValueError, match="one of"):
            refresh_gold(spark, silver_table="x", silver_path="y", as_of=AS_OF, **names)
    finally:
        spark.sql(f"DROP TABLE {fixed.SILVER_TABLE}")


def test_other_settings(spark, names):
    """Window lengths, baseline, sigma and group columns reach the tables."""
    settings = Settings({"hour": 3600}, 7200, 0.5, by=["title"])
    rows = [{"t": 8 * DAY + 3600 * h, "title": t} for h in range(3) for t in "ab" for _ in range(h + 1)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    refresh_gold(spark, silver=silver_rows(spark, rows), as_of=AS_OF, settings=settings, **names)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    volume = spark.table(names["volume_table"])
    found = {(r.title, r.total_edits): (r.rolling_mean_edits, r.is_anomaly) for r in volume.collect()}
    assert found == {(t, n): ((n + 1) / 2, n > 1) for t in "ab" for n in (1, 2, 3)}
    assert set(volume.select("window_duration").distinct().first()) == {"hour"}
    assert "title" in spark.table(names["user_table"]).columns


def test_absurd_future_date_is_carried_along(spark, names):
    far = silver_rows(spark, [{"t": 1.7e12}, {"t": 9.2e12}])
    for silver in (on_days(spark, 8).union(far), on_days(spark, 8, 9).union(far)):
        refresh_gold(spark, silver=silver, as_of=AS_OF, **names)
    counts = spark.table(names["user_table"]).groupBy(F.col("date").cast("string")).count()
    found = {day: n for day, n in counts.collect()}
    assert len(found) == 4 and set(found.values()) == {2}
    assert {"1970-01-08", "1970-01-09"} < found.keys()
