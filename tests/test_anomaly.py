"""The rolling baseline and what is derived from it."""

from __future__ import annotations

import math
import random
from datetime import UTC
from fractions import Fraction

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.helpers import expected_baseline, moment, volume_rows
from tidewatch.operators.anomaly import anomaly_summary, flag_anomalies, rolling_baseline
from tidewatch.operators.windows import edit_volume
from tidewatch.plans.registry import _silver


def flagged(spark, counts, **options):
    rows = flag_anomalies(volume_rows(spark, counts), **options).collect()
    return {row.window_start: row for row in rows}


def minutes(*counts):
    return {60 * n: count for n, count in enumerate(counts)}


def test_single_window(spark):
    row = flagged(spark, {0: 50})[moment(0)]
    assert (row.rolling_mean_edits, row.rolling_stddev_edits, row.z_score) == (50.0, 0.0, 0.0)
    assert row.anomaly_threshold == 50.0 and row.is_anomaly is False


def test_frame_holds_both_ends(spark):
    assert flagged(spark, {0: 1, 3600: 3})[moment(3600)].rolling_mean_edits == 2.0
    assert flagged(spark, {0: 1, 3660: 3})[moment(3660)].rolling_mean_edits == 3.0


def test_spikes(spark):
    five = flagged(spark, minutes(1, 1, 1, 1, 100))[moment(240)]
    assert five.is_anomaly is False and five.z_score == pytest.approx(1.789, abs=1e-3)
    six = flagged(spark, minutes(1, 1, 1, 1, 1, 100))[moment(300)]
    assert six.is_anomaly is True and six.z_score == pytest.approx(2.041, abs=1e-3)
    assert flagged(spark, minutes(1, 1, 1, 1, 1, 100), sigma=2.1)[moment(300)].is_anomaly is False


def test_flat_series_is_never_flagged(spark):
    rows = flagged(spark, minutes(*[4] * 20)).values()
    assert not any(row.is_anomaly for row in rows) and {row.z_score for row in rows} == {0.0}


@pytest.mark.parametrize("chunk", [60, 1800, 3600, 5000, 86_400, 10**9])
def test_chunks_do_not_change_the_result(spark, chunk):
    dice = random.Random(3)
    counts = {60 * n: dice.randrange(1, 60) for n in range(-200, 1700) if dice.random() < 0.6}
    rows = rolling_baseline(volume_rows(spark, counts), chunk_seconds=chunk).collect()
    assert len(rows) == len(counts)
    expected = expected_baseline(counts)
    for row in rows:
        mean, spread = expected[(row.window_start - moment(0)).total_seconds()]
        assert row.rolling_mean_edits == pytest.approx(mean, rel=1e-12)
        assert row.rolling_stddev_edits == pytest.approx(spread, rel=1e-9, abs=1e-12)


def test_same_bits_as_one_ordered_pass(spark):
    volume = edit_volume(_silver(spark, "/root/testdata/sf0.01"))
    frame = (
        Window.partitionBy("window_duration")
        .orderBy(F.unix_seconds("window_start"))
        .rangeBetween(-3600, 0)
    )
    single = volume.select(
        "window_start",
        "window_duration",
        F.avg("total_edits").over(frame).alias("rolling_mean_edits"),
        F.coalesce(F.stddev("total_edits").over(frame), F.lit(0.0)).alias("rolling_stddev_edits"),
    )
    chunked = rolling_baseline(volume).select(single.columns)
    assert single.exceptAll(chunked).isEmpty() and chunked.exceptAll(single).isEmpty()


def test_granularities_are_apart(spark):
    both = volume_rows(spark, {0: 1}).union(volume_rows(spark, {0: 9}, "5min"))
    means = {row.window_duration: row.rolling_mean_edits for row in flag_anomalies(both).collect()}
    assert means == {"1min": 1.0, "5min": 9.0}


@pytest.mark.parametrize(
    ("sf", "windows", "anomalies"),
    [
        ("0.001", {"1min": 977, "5min": 925}, {"1min": 0, "5min": 0}),
        ("0.01", {"1min": 8876, "5min": 5912}, {"1min": 558, "5min": 228}),
        ("0.1", {"1min": 38758, "5min": 8640}, {"1min": 1644, "5min": 179}),
    ],
)
def test_known_counts_and_bounds(spark, sf, windows, anomalies):
    gold = flag_anomalies(edit_volume(_silver(spark, f"/root/testdata/sf{sf}")))
    rows = gold.groupBy("window_duration").agg(
        F.count("*").alias("n"),
        F.count_if("is_anomaly").alias("a"),
        F.max("z_score").alias("z"),
        F.count_if(F.col("is_anomaly") & (F.col("z_score") < 2 - 1e-9)).alias("low"),
    )
    for row in rows.collect():
        label = row.window_duration
        assert (row.n, row.a, row.low) == (windows[label], anomalies[label], 0)
        most = {"1min": 61, "5min": 13}[label]
        assert row.z <= (most - 1) / math.sqrt(most) + 1e-9


def test_summary(spark):
    gold = flag_anomalies(volume_rows(spark, minutes(1, 1, 1, 1, 1, 100, 1, 1)))
    assert tuple(anomaly_summary(gold).first()) == (8, 1, 12.5)
    assert anomaly_summary(gold.filter("false")).first().anomalous_pct is None


def test_exact_flags_leave_windows_on_the_threshold_alone(spark):
    """With few different counts many windows lie on the threshold or just off it."""
    rng = random.Random(8)
    for sigma in (2.0, 1.5, 0.1):
        counts = {60 * n: rng.choice([0, 0, 0, 1, 2, 3]) for n in range(400)}
        found = flag_anomalies(volume_rows(spark, counts), sigma=sigma, exact=True)
        ratio = Fraction(str(sigma))
        for row in found.collect():
            epoch = int(row.window_start.replace(tzinfo=UTC).timestamp())
            frame = [n for other, n in counts.items() if epoch - 3600 <= other <= epoch]
            n, s, q = len(frame), sum(frame), sum(x * x for x in frame)
            gap = n * row.total_edits - s
            assert row.is_anomaly == (
                n > 1 and gap > 0 and Fraction(gap) ** 2 * (n - 1) > ratio**2 * n * (n * q - s * s)
            )
    assert found.columns == flag_anomalies(volume_rows(spark, {0: 1})).columns
