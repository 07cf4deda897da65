"""Bronze parsing and silver features, row by row."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidewatch.operators import bronze, silver
from tidewatch.operators.windows import user_activity
from tidewatch.plans.gold import gold_edit_volume
from tidewatch.schemas import BRONZE_EDITS, BRONZE_PAGE_EVENTS, EDIT_MESSAGE, RECORD

ARRIVED = datetime(2024, 1, 2, 3, 4, 5)


def records(spark, *values):
    rows = [(value.encode(), ARRIVED, n, 7) for n, value in enumerate(values)]
    return spark.createDataFrame(rows, RECORD)


def edits(spark, *rows):
    """Edit rows given as dicts; what is left out is null."""
    names = EDIT_MESSAGE.names
    defaults = {"id": 1, "timestamp": 0}
    table = [tuple({**defaults, **row}.get(name) for name in names) for row in rows]
    return spark.createDataFrame(table, EDIT_MESSAGE)


def test_bronze_keeps_every_record(spark):
    rows = bronze.bronze_edits(
        records(spark, "not json", '{"id":"x","bot":false,"timestamp":1}', '{"id":3,"title":"t"}')
    )
    assert rows.columns == EDIT_MESSAGE.names + [
        "kafka_timestamp",
        "offset",
        "partition",
        "ingested_at",
    ]
    for frame, schema in (
        (rows, BRONZE_EDITS),
        (bronze.bronze_page_events(records(spark)), BRONZE_PAGE_EVENTS),
    ):
        assert [(f.name, f.dataType) for f in frame.schema] == [
            (f.name, f.dataType) for f in schema
        ]
    broken, mistyped, good = rows.orderBy("offset").collect()
    assert [broken[name] for name in EDIT_MESSAGE.names] == [None] * 14
    assert (mistyped.id, mistyped.bot, mistyped.timestamp) == (None, False, 1)
    assert (good.id, good.title) == (3, "t")
    assert {row.kafka_timestamp for row in (broken, mistyped, good)} == {ARRIVED}
    assert good.partition == 7 and good.ingested_at is not None


def test_page_events(spark):
    rows = bronze.bronze_page_events(records(spark, '{"id":1,"log_type":"delete","minor":true}'))
    assert len(rows.columns) == 15 and "minor" not in rows.columns
    assert rows.first().log_type == "delete"


def test_only_identified_edits_pass(spark):
    rows = silver.has_identity(
        edits(spark, {"id": 1}, {"id": None}, {"timestamp": None}, {"id": 2})
    )
    assert [row.id for row in rows.collect()] == [1, 2]


def test_silver_columns(spark):
    parsed = bronze.bronze_edits(records(spark, '{"id":1,"timestamp":1}'))
    features = silver.edit_features(parsed)
    assert len(features.columns) == 23
    assert not {"offset", "partition", "kafka_timestamp"} & set(features.columns)
    row = features.first()
    assert row.ingested_at is not None and row.silver_processed_at is not None


def test_time_features(spark):
    sunday = 1704585599  # 2024-01-06 23:59:59 UTC, a Saturday, then one second later
    rows = silver.edit_features(edits(spark, {"timestamp": sunday}, {"timestamp": sunday + 1}))
    first, second = rows.orderBy("edit_timestamp").collect()
    assert (first.edit_hour, first.edit_day_of_week) == (23, 7)
    assert (second.edit_hour, second.edit_day_of_week) == (0, 1)
    assert first.edit_timestamp == datetime(2024, 1, 6, 23, 59, 59)


def test_absurd_times_do_not_stop_the_job(spark):
    far = [{"timestamp": t} for t in (2**62, -(2**62), 1_704_067_200_000, 1_704_067_200_000_000)]
    features = silver.edit_features(edits(spark, *far, {"timestamp": 1}))
    assert features.filter("edit_timestamp IS NOT NULL").count() == 5
    for table, rows in ((gold_edit_volume(features), 8), (user_activity(features), 8)):
        # every column is worked out, none is brought to Python, which has no such dates
        texts = [F.col(name).cast("string") for name in table.columns]
        assert len(table.select(F.concat_ws("|", *texts)).collect()) == rows


@pytest.mark.parametrize(
    ("old", "new", "delta", "size"),
    [
        (10, 4, -6, 6),
        (4, 10, 6, 6),
        (5, 5, 0, 0),
        (None, 5, None, None),
        (5, None, None, None),
        (2**31 - 1, -5, None, None),
        (2**31 - 1, -1, -(2**31), None),
    ],
)
def test_byte_features(spark, old, new, delta, size):
    row = silver.edit_features(edits(spark, {"length_old": old, "length_new": new})).first()
    assert (row.bytes_delta, row.abs_bytes_delta) == (delta, size)


def test_namespace_labels(spark):
    numbers = [*range(17), -1, 99, None]
    rows = silver.edit_features(edits(spark, *[{"namespace": n} for n in numbers])).collect()
    labels = {row.namespace: row.namespace_label for row in rows}
    assert labels[0] == "Article" and labels[15] == "Category_Talk"
    others = {n for n, label in labels.items() if label == "Other"}
    assert others == {8, 9, 12, 13, 16, -1, 99, None}


@pytest.mark.parametrize(
    ("comment", "expected"),
    [
        ("rv x", True),
        ("RVV", True),
        ("Undid 1", True),
        ("please revert", True),
        ("(revert)", True),
        ("Reverted edits", False),
        ("rvx", False),
        ("_rv_", False),
        ("", False),
        (None, False),
    ],
)
def test_revert_flag(spark, comment, expected):
    assert silver.edit_features(edits(spark, {"comment": comment})).first().is_revert is expected


def test_reports(spark):
    features = silver.edit_features(
        edits(
            spark,
            {"bot": True, "comment": "rv", "namespace": 0},
            {"bot": None, "namespace": 0},
            {"bot": False, "namespace": 1},
            {"bot": False},
        )
    )
    report = silver.feature_report(features).first()
    assert report.asDict() == {
        "total_rows": 4,
        "revert_rows": 1,
        "bot_rows": 1,
        "revert_pct": 25.0,
        "bot_pct": 25.0,
    }
    counts = [tuple(row) for row in silver.namespace_breakdown(features).collect()]
    assert counts == [("Article", 2), ("Other", 1), ("Talk", 1)]
    empty = silver.feature_report(features.filter("id < 0")).first()
    assert empty.total_rows == 0 and empty.revert_pct is None
