"""Hand-made silver rows, and brute-force versions of the aggregates to compare with."""

from __future__ import annotations

import statistics
from collections import defaultdict
from datetime import UTC, datetime

from pyspark.sql import functions as F

LENGTHS = {"1min": 60, "5min": 300}


def silver_rows(spark, rows):
    """Rows as dicts with ``t`` in epoch seconds (may be fractional); the rest has defaults."""
    table = [
        (
            None if row["t"] is None else float(row["t"]),
            row.get("user", "u"),
            row.get("title", "p"),
            row.get("bot", False),
            row.get("size", 1),
            row.get("revert", False),
        )
        for row in rows
    ]
    frame = spark.createDataFrame(
        table,
        "t double, user string, title string, bot boolean, abs_bytes_delta int, is_revert boolean",
    )
    return frame.withColumn("edit_timestamp", F.timestamp_micros((F.col("t") * 1e6).cast("long")))


def moment(epoch):
    return datetime.fromtimestamp(epoch, UTC).replace(tzinfo=None)


def volume_rows(spark, counts, label="1min"):
    """Window rows from ``{epoch: total_edits}``."""
    table = [(moment(epoch), label, total) for epoch, total in counts.items()]
    return spark.createDataFrame(
        table, "window_start timestamp, window_duration string, total_edits long"
    )


def total(values):
    known = [value for value in values if value is not None]
    return sum(known) if known else None


def expected_volume(rows):
    groups = defaultdict(list)
    for row in rows:
        for label, length in LENGTHS.items():
            groups[label, int(row["t"] // length * length)].append(row)
    result = {}
    for key, members in groups.items():
        bots = [row.get("bot", False) for row in members]
        sizes = [row.get("size", 1) for row in members]
        known = [size for size in sizes if size is not None]
        bot_edits = total([None if bot is None else int(bot) for bot in bots])
        result[key] = (
            len(members),
            bot_edits,
            total([None if bot is None else int(not bot) for bot in bots]),
            len({row.get("user", "u") for row in members} - {None}),
            total(sizes),
            sum(known) / len(known) if known else None,
            sum(row.get("revert", False) for row in members),
        )
    return result


def expected_users(rows):
    groups = defaultdict(list)
    for row in rows:
        for label, length in LENGTHS.items():
            start = int(row["t"] // length * length)
            groups[label, start, row.get("user", "u"), row.get("bot", False)].append(row)
    return {
        key: (
            len(members),
            total([row.get("size", 1) for row in members]),
            sum(row.get("revert", False) for row in members),
            len({row.get("title", "p") for row in members} - {None}),
        )
        for key, members in groups.items()
    }


def expected_baseline(counts, seconds=3600):
    result = {}
    for epoch, edits in counts.items():
        frame = [n for other, n in counts.items() if epoch - seconds <= other <= epoch]
        mean = statistics.fmean(frame)
        spread = statistics.stdev(frame) if len(frame) > 1 else 0.0
        result[epoch] = (mean, spread)
    return result
