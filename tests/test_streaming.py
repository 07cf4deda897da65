"""Streams over files: same rows as the batch functions, and nothing twice."""

from __future__ import annotations

import json
import uuid
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests.helpers import silver_rows
from tidewatch.operators import bronze, ingest, silver
from tidewatch.schemas import BRONZE_EDITS
from tidewatch.sinks import append_stream, await_all
from tidewatch.sources import (
    kafka_options,
    kafka_records,
    raw_text,
    read_silver,
    read_table,
    run_sql,
    sse_blocks,
    sse_payloads,
    stream_table,
    topic_file_records,
)
from tidewatch.sources.tables import SILVER_PARTITION, edits_since
from tidewatch.streaming import bronze_job, ingest_job, silver_job

DAY = 86_400


def raw_line(number, kind="edit", day=0):
    return json.dumps(
        {
            "type": kind,
            "id": number,
            "server_name": "en.wikipedia.org",
            "timestamp": day * DAY + number,
            "user": f"u{number}",
            "length": {"old": 1, "new": number},
        }
    )


def add_file(folder, name, *lines):
    Path(folder, "raw").mkdir(exist_ok=True)
    Path(folder, "raw", name).write_text("\n".join(lines))


def run_all(spark, folder):
    """Ingest, bronze and silver once over what there is."""
    raw = raw_text(spark, f"{folder}/raw", stream=True, maxFilesPerTrigger=1)
    ingest_job(raw, f"{folder}/ck/ingest", fmt="parquet", path=f"{folder}/topics")

    def records(topic):
        return topic_file_records(spark, f"{folder}/topics", topic, stream=True)

    bronze_job(
        records("wiki_edits"),
        records("wiki_page_events"),
        f"{folder}/ck/bronze",
        {"path": f"{folder}/edits"},
        {"path": f"{folder}/pages"},
    )
    appended = stream_table(spark, path=f"{folder}/edits", schema=BRONZE_EDITS)
    silver_job(appended, f"{folder}/ck/silver", {"path": f"{folder}/silver"})


def ids(frame):
    return sorted(row.id for row in frame.select("id").collect())


def test_end_to_end_and_rerun(spark, folder):
    add_file(folder, "a.json", raw_line(1), raw_line(2, "log"), "broken", raw_line(3, day=1))
    add_file(folder, "b.json", raw_line(4, "new"), raw_line(5, "other"), "")
    run_all(spark, folder)
    silver_path = f"{folder}/silver"
    assert ids(read_silver(spark, path=silver_path)) == [1, 3, 4]
    assert ids(read_table(spark, path=f"{folder}/pages")) == [2]
    run_all(spark, folder)
    assert ids(read_silver(spark, path=silver_path)) == [1, 3, 4]
    add_file(folder, "c.json", raw_line(6), raw_line(7, "categorize"))
    run_all(spark, folder)
    assert ids(read_silver(spark, path=silver_path)) == [1, 3, 4, 6]
    assert ids(read_table(spark, path=f"{folder}/pages")) == [2, 7]

    lines = raw_text(spark, f"{folder}/raw")
    sent = ingest.messages(lines).filter("topic = 'wiki_edits'")
    envelope = sent.select(
        F.col("value").cast("binary").alias("value"),
        F.lit(None).cast("timestamp").alias("timestamp"),
        F.lit(None).cast("bigint").alias("offset"),
        F.lit(None).cast("int").alias("partition"),
    )
    batch = silver.edit_features(bronze.bronze_edits(envelope))
    stamps = ("ingested_at", "silver_processed_at")
    streamed = read_silver(spark, path=silver_path)
    assert streamed.columns == batch.columns and len(batch.columns) == 23
    assert streamed.drop(*stamps).exceptAll(batch.drop(*stamps)).isEmpty()
    assert batch.drop(*stamps).exceptAll(streamed.drop(*stamps)).isEmpty()
    assert streamed.filter("ingested_at IS NULL OR silver_processed_at IS NULL").isEmpty()


def test_replay_is_cut_into_batches(spark, folder):
    for name in ("a.json", "b.json", "c.json"):
        add_file(folder, name, raw_line(1))
    for limit, batches in (({"maxBytesPerTrigger": 1}, 3), ({}, 1)):
        raw = raw_text(spark, f"{folder}/raw", stream=True, **limit)
        checkpoint = f"{folder}/ck{batches}"
        ingest_job(raw, checkpoint, fmt="parquet", path=f"{folder}/topics{batches}")
        assert len([*Path(checkpoint, "commits").glob("[0-9]*")]) == batches
        assert spark.read.parquet(f"{folder}/topics{batches}").count() == 3


def test_bronze_keeps_source_metadata(spark, folder):
    add_file(folder, "a.json", raw_line(1))
    run_all(spark, folder)
    edits = read_table(spark, path=f"{folder}/edits")
    assert len(edits.columns) == 18
    assert edits.first().kafka_timestamp is not None
    assert len(read_table(spark, path=f"{folder}/pages").columns) == 15


def test_lookback_reads_its_days_only(spark, folder):
    add_file(folder, "a.json", *[raw_line(n, day=n) for n in range(1, 9)])
    run_all(spark, folder)
    stored = read_table(spark, path=f"{folder}/silver")
    assert SILVER_PARTITION in stored.columns
    recent = read_silver(spark, path=f"{folder}/silver", start="1970-01-07")
    assert ids(recent) == [6, 7, 8]
    plan = recent.select("id")._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [", 1)[1]
    assert filters.startswith("isnotnull(edit_date") and "1970-01-07" in filters
    assert SILVER_PARTITION not in recent.columns


def test_lookback_without_day_column(spark):
    frame = silver_rows(spark, [{"t": 0}, {"t": DAY}])
    assert edits_since(frame, "1970-01-02").count() == 1


def test_named_tables(spark, folder):
    tag = uuid.uuid4().hex
    edit_table, page_table, silver_table = (f"{name}_{tag}" for name in ("be", "bp", "s"))
    add_file(folder, "a.json", raw_line(1), raw_line(2, "log"), raw_line(3, day=2))
    raw = raw_text(spark, f"{folder}/raw", stream=True)
    ingest_job(raw, f"{folder}/ck/ingest", fmt="parquet", path=f"{folder}/topics")
    bronze_job(
        topic_file_records(spark, f"{folder}/topics", "wiki_edits", stream=True),
        topic_file_records(spark, f"{folder}/topics", "wiki_page_events", stream=True),
        f"{folder}/ck/bronze",
        {"table": edit_table},
        {"table": page_table},
    )
    for _ in range(2):
        silver_job(
            stream_table(spark, edit_table), f"{folder}/ck/silver", {"table": silver_table}
        )
    assert ids(read_silver(spark, silver_table)) == [1, 3]
    assert ids(read_table(spark, page_table)) == [2]


def test_silver_schema_may_not_change(spark, folder):
    add_file(folder, "a.json", raw_line(1))
    run_all(spark, folder)
    edits = stream_table(spark, path=f"{folder}/edits", schema=BRONZE_EDITS)
    with pytest.raises(ValueError, match="extra"):
        silver_job(
            edits.withColumn("extra", F.lit(1)), f"{folder}/ck/other", {"path": f"{folder}/silver"}
        )
    assert ids(read_silver(spark, path=f"{folder}/silver")) == [1]


def test_failed_stream_stops_its_companions(spark, folder):
    add_file(folder, "a.json", raw_line(1))
    lines = raw_text(spark, f"{folder}/raw", stream=True)
    bad = lines.select(F.raise_error(F.lit("broken on purpose")).cast("string").alias("value"))
    queries = [
        append_stream(bad, f"{folder}/ck/bad", path=f"{folder}/bad"),
        append_stream(lines, f"{folder}/ck/good", path=f"{folder}/good"),
    ]
    with pytest.raises(Exception, match="broken on purpose"):
        await_all(queries)
    assert not any(query.isActive for query in queries)


def test_only_a_missing_folder_counts_as_unwritten(spark, folder):
    add_file(folder, "a.json", raw_line(1))
    lines = raw_text(spark, f"{folder}/raw", stream=True)
    with pytest.raises(Exception, match="nosuchformat"):
        append_stream(lines, f"{folder}/ck", path=f"{folder}/raw", fmt="nosuchformat")


def test_files_of_a_long_history(spark, folder):
    """A batch that meets many days in every task writes few files for each."""
    rows = [raw_line(n, day=n % 20) for n in range(400)]
    for part in range(8):
        add_file(folder, f"{part}.json", *rows[part::8])
    raw = raw_text(spark, f"{folder}/raw", stream=True)
    ingest_job(raw, f"{folder}/ck/ingest", fmt="parquet", path=f"{folder}/topics")
    records = [
        topic_file_records(spark, f"{folder}/topics", topic, stream=True)
        for topic in ("wiki_edits", "wiki_page_events")
    ]
    targets = {"path": f"{folder}/edits"}, {"path": f"{folder}/pages"}
    bronze_job(*records, f"{folder}/ck/bronze", *targets)
    appended = stream_table(spark, path=f"{folder}/edits", schema=BRONZE_EDITS)
    for name, limit in (("plain", None), ("few", 2)):
        silver_job(appended, f"{folder}/ck/{name}", {"path": f"{folder}/{name}"}, files_per_day=limit)
        assert ids(read_silver(spark, path=f"{folder}/{name}")) == list(range(400))
    files = [len([*day.glob("*.parquet")]) for day in Path(folder, "few").glob("edit_date=*")]
    assert len(files) == 20 and max(files) <= 2


def test_events_of_several_lines(spark, folder):
    """Data lines of an event are joined; what has none is dropped."""
    text = "\n\n".join(
        [
            ":ok",
            'event: message\nid: 1\ndata: {"a": 1,\ndata: "b": 2}',
            "data:x\r\ndata:\r\ndata:  y",
            "id: 3",
            "\ndata: z",
        ]
    )
    Path(folder, "raw").mkdir()
    Path(folder, "raw", "a.txt").write_bytes(text.encode())
    found = sse_payloads(sse_blocks(spark, f"{folder}/raw"))
    assert sorted(row.value for row in found.collect()) == ["x\n\n y", "z", '{"a": 1,\n"b": 2}']


def test_two_objects_in_one_text_are_the_first(spark):
    """A decision: garbage that ends in a brace is not looked for."""
    texts = [(f"{raw_line(1)} {raw_line(2)}",), (f"{raw_line(3)} x",)]
    sent = ingest.messages(spark.createDataFrame(texts, "value string"))
    assert [row.key for row in sent.collect()] == ["1"]


def test_kafka_options(spark):
    options = kafka_options("broker:1", maxOffsetsPerTrigger="5", startingOffsets="latest")
    assert options["kafka.bootstrap.servers"] == "broker:1"
    assert options["kafka.security.protocol"] == "SASL_SSL"
    assert options["kafka.sasl.mechanism"] == "PLAIN"
    assert options["failOnDataLoss"] == "false"
    assert options["startingOffsets"] == "latest" and options["maxOffsetsPerTrigger"] == "5"
    assert kafka_options("b")["startingOffsets"] == "earliest"
    assert int(kafka_options("b")["maxOffsetsPerTrigger"]) > 0
    # no connector here: the source is asked for by its name, and that is as far as it goes
    with pytest.raises(Exception, match="(?i)kafka"):
        kafka_records(spark, "wiki_edits", options)


def test_sql_text_over_frames(spark):
    frame = spark.range(5)
    rows = run_sql(spark, "SELECT id FROM {t} WHERE id > :low", {"low": 2}, t=frame)
    assert [row.id for row in rows.collect()] == [3, 4]


def test_bronze_says_which_file_a_record_is_from(spark, folder):
    add_file(folder, "a.json", raw_line(1), raw_line(2, "log"))
    raw = raw_text(spark, f"{folder}/raw", stream=True)
    ingest_job(raw, f"{folder}/ck/ingest", fmt="parquet", path=f"{folder}/topics")
    records = [
        topic_file_records(spark, f"{folder}/topics", topic, stream=True, source_file=True)
        for topic in ("wiki_edits", "wiki_page_events")
    ]
    bronze_job(*records, f"{folder}/ck/bronze", {"path": f"{folder}/edits"}, {"path": f"{folder}/pages"})
    edits = read_table(spark, path=f"{folder}/edits")
    assert len(edits.columns) == 19 and "topic=wiki_edits" in edits.first().source_file
    assert len(silver.edit_features(edits).columns) == 23
