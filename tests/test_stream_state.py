"""Streams with state: windows, flags, distinct edits; restarts, late and repeated rows."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.helpers import silver_rows, volume_rows
from tidewatch.operators.anomaly import flag_anomalies
from tidewatch.operators.windows import edit_volume
from tidewatch.schemas import BRONZE_EDITS
from tidewatch.sources.tables import stream_table
from tidewatch.streaming import anomaly_job, late_counts, silver_job, volume_job
from tidewatch.streaming.anomaly import spread

DELAY = "10 minutes"


def stream_of(spark, path):
    return stream_table(spark, path=path, schema=spark.read.parquet(path).schema)


def feed(spark, folder, job, *batches):
    """Store each batch and run the job on it: a restart between any two."""
    for batch in batches:
        batch.write.mode("append").parquet(f"{folder}/in")
        job(stream_of(spark, f"{folder}/in"), f"{folder}/checkpoint", {"path": f"{folder}/out"}, DELAY)
    return spark.read.parquet(f"{folder}/out")


def rows_of(frame, *columns):
    return sorted(map(tuple, frame.select(*columns).collect()), key=repr)


VOLUME = ("window_duration", "window_start", "window_end", "total_edits", "bot_edits", "human_edits",
          "total_bytes_changed", "avg_bytes_per_edit", "revert_count", "bot_ratio", "date")


def some_edits(seed, begin, end, n):
    rng = random.Random(seed)
    return [
        {
            "t": rng.uniform(begin, end),
            "user": rng.choice(["a", "b", "c", None]),
            "bot": rng.choice([True, False, None]),
            "size": rng.choice([None, 1, 7]),
            "revert": rng.random() < 0.3,
        }
        for _ in range(n)
    ]


def test_windows_equal_the_batch_ones_and_late_edits_are_counted(spark, folder):
    first, second = some_edits(1, 0, 4000, 300), some_edits(2, 3700, 9000, 300)
    late = some_edits(3, 0, 3000, 20)
    last = [{"t": 20_000.0}]
    on_time = silver_rows(spark, [*first, *second, *last])
    closed = feed(
        spark, folder, volume_job, silver_rows(spark, first), silver_rows(spark, second),
        silver_rows(spark, [*late, *last]),
    )
    ends = F.col("window_end") <= F.timestamp_seconds(F.lit(20_000 - 600))
    assert rows_of(closed, *VOLUME) == rows_of(edit_volume(on_time).where(ends), *VOLUME)
    users = edit_volume(on_time).where(ends).select(*VOLUME[:2], "unique_users")
    assert rows_of(closed, *VOLUME[:2], "approx_users") == rows_of(users, *users.columns)

    everything = silver_rows(spark, [*first, *second, *late, *last])
    found = late_counts(everything, closed)
    assert found.agg(F.sum("late_edits")).first()[0] == 2 * len(late)
    both = found.select("window_duration", "window_start", (F.col("counted_edits") + F.col("late_edits")))
    right = edit_volume(everything).join(found, ["window_duration", "window_start"], "left_semi")
    assert rows_of(both, *both.columns) == rows_of(right, "window_duration", "window_start", "total_edits")
    assert late_counts(on_time, closed).isEmpty()


def test_an_edit_within_the_delay_is_counted(spark, folder):
    batches = [silver_rows(spark, [{"t": t}]) for t in (1000, 500, 399, 5000)]
    closed = feed(spark, folder, volume_job, *batches).where("window_duration = '1min'")
    starts = {row[0].minute * 60 for row in closed.select("window_start").collect()}
    # the watermark was 400 when the edit at 399 came, and its window ends at 420
    assert starts == {960, 480, 360}


def test_windows_by_column(spark, folder):
    batch = silver_rows(spark, [*some_edits(4, 0, 3000, 200), {"t": 9000, "user": "z"}])
    job = lambda *args: volume_job(*args, granularities={"10min": 600}, by=["user"])
    closed = feed(spark, folder, job, batch)
    right = edit_volume(batch, {"10min": 600}, ["user"]).where("window_start < '1970-01-01 01:00:00'")
    assert rows_of(closed, "user", *VOLUME) == rows_of(right, "user", *VOLUME)
    assert late_counts(batch, closed, {"10min": 600}, ["user"]).isEmpty()


FLAGS = ("window_duration", "window_start", "total_edits", "rolling_mean_edits", "rolling_stddev_edits",
         "anomaly_threshold", "is_anomaly", "z_score")


def test_flags_equal_the_batch_ones_in_any_order(spark, folder):
    rng = random.Random(5)
    counts = {60_000 + 60 * n: rng.choice([1, 2, 3, 3, 4, 40]) for n in range(400) if rng.random() < 0.8}
    fives = {60_000 + 300 * n: rng.randint(1, 60) for n in range(80)}
    volume = volume_rows(spark, counts).union(volume_rows(spark, fives, "5min"))
    # out of order by up to the delay, and dealt over four runs
    volume = volume.withColumn("at", F.unix_seconds("window_start") + F.pmod(F.xxhash64("window_start"), F.lit(600)))
    pieces = [volume.where(f"at >= {a} AND at < {a + 6500}").drop("at") for a in range(60_000, 86_000, 6500)]
    end = volume_rows(spark, {120_000: 1})
    found = feed(spark, folder, anomaly_job, *pieces, end)
    assert rows_of(found, *FLAGS) == rows_of(flag_anomalies(volume.drop("at")), *FLAGS)
    assert not found.where("is_anomaly").isEmpty()


def test_flags_by_column_and_other_settings(spark, folder):
    rng = random.Random(6)
    parts = [
        volume_rows(spark, {60_000 + 600 * n: rng.randint(1, 9) for n in range(40)}, "10min").withColumn("wiki", F.lit(w))
        for w in ("a", "b", None)
    ]
    volume = parts[0].union(parts[1]).union(parts[2])
    settings = {"baseline_seconds": 7200, "sigma": 1.0, "by": ["wiki"]}
    job = lambda *args: anomaly_job(*args, **settings)
    end = volume_rows(spark, {600_000: 1}, "10min").withColumn("wiki", F.lit("a"))
    found = feed(spark, folder, job, volume, end)
    assert rows_of(found, "wiki", *FLAGS) == rows_of(flag_anomalies(volume, **settings), "wiki", *FLAGS)


def test_spread():
    assert spread([5]) == (5.0, 0.0)
    mean, deviation = spread([1, 2, 3, 4])
    assert mean == 2.5 and deviation == pytest.approx(1.2909944487358056)


def bronze(spark, rows):
    start = datetime(2024, 1, 1)
    table = [(i, start + timedelta(minutes=m)) for i, m in rows]
    frame = spark.createDataFrame(table, "id long, ingested_at timestamp")
    known = {"id", "ingested_at"}
    columns = [
        F.col(f.name) if f.name in known else F.lit(5 if f.name == "timestamp" else None).cast(f.dataType).alias(f.name)
        for f in BRONZE_EDITS
    ]
    return frame.select(*columns)


def test_distinct_edits(spark, folder):
    def run(*rows):
        bronze(spark, rows).write.mode("append").parquet(f"{folder}/bronze")
        stream = stream_table(spark, path=f"{folder}/bronze", schema=BRONZE_EDITS)
        target = {"path": f"{folder}/silver"}
        silver_job(stream, f"{folder}/ck", target, distinct_within="1 hour")
        return sorted(row.id for row in spark.read.parquet(f"{folder}/silver").collect())

    # an id twice in a batch, a null id (no edit), and again after a restart
    assert run((1, 0), (1, 1), (2, 1), (None, 1)) == [1, 2]
    assert run((2, 10), (3, 10), (1, 20)) == [1, 2, 3]
    # an hour later ids are forgotten, so what comes again then is a new edit
    run((4, 180))
    assert run((1, 200)) == [1, 1, 2, 3, 4]


def test_settings_reach_the_stream(spark, folder):
    rows = bronze(spark, [(1, 0)]).withColumn("namespace", F.lit(3)).withColumn("comment", F.lit("undo it"))
    rows.write.parquet(f"{folder}/bronze")
    for name, labels in (("map", {3: "three"}), ("table", spark.createDataFrame([(3, "three")], "namespace int, label string"))):
        stream = stream_table(spark, path=f"{folder}/bronze", schema=BRONZE_EDITS)
        silver_job(stream, f"{folder}/ck-{name}", {"path": f"{folder}/{name}"}, labels=labels, revert_pattern="undo")
        row = spark.read.parquet(f"{folder}/{name}").first()
        assert (row.namespace_label, row.is_revert) == ("three", True)
