"""The registered queries: every operator run on the ``events`` table of a data folder.

Timestamps are given without zone and derived doubles rounded, so that the results can be compared
with those of another SQL engine.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime, timedelta
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from tidewatch import fixed
from tidewatch.functions import lit_moment, lookback_start, slice_start
from tidewatch.operators import bronze, dashboard, ingest, reports, silver, sketches, windows
from tidewatch.operators.anomaly import anomaly_summary, flag_anomalies
from tidewatch.plans import fixture
from tidewatch.plans.gold import (
    Settings,
    gold_edit_volume,
    gold_edit_volume_since,
    refresh_gold,
)
from tidewatch.schemas import BRONZE_EDITS, BRONZE_PAGE_EVENTS, EDIT_MESSAGE, RECORD
from tidewatch.session import configure, scan_bytes, scratch_folder, size_shuffles
from tidewatch.sources import (
    raw_text,
    read_silver,
    run_sql,
    sse_blocks,
    sse_payloads,
    stream_table,
    topic_file_records,
)
from tidewatch.sources.tables import SILVER_PARTITION, edits_since
from tidewatch.streaming import (
    anomaly_job,
    bronze_job,
    ingest_job,
    late_counts,
    late_edits_job,
    silver_job,
    volume_job,
)
from tidewatch.versions import read_version

Query = Callable[[SparkSession, str], DataFrame]

# "Now" of the queries that look back from it.
AS_OF = datetime(2024, 1, 30, 18, 3, 27)
LOOKBACK = lookback_start(AS_OF)
SLICE = slice_start(AS_OF)
# An earlier refresh, whose dates the one at AS_OF partly replaces.
EARLIER = AS_OF - timedelta(days=1)
EARLIER_LOOKBACK = lookback_start(EARLIER)
# A date of both lookbacks whose edits are gone at the second refresh, and come back far later.
VANISHED = (AS_OF - timedelta(days=1)).date()
FAR_DAYS = 32_768

ROUNDED = {
    "avg_bytes_per_edit": 6,
    "rolling_mean_edits": 6,
    "rolling_stddev_edits": 6,
    "anomaly_threshold": 6,
    "z_score": 6,
    "avg_bot_ratio": 6,
}
CLOCKS = ("ingested_at", "silver_processed_at")
ARRIVAL = ("ingested_at", "kafka_timestamp", "offset", "partition")
STAMPS = ("ingested_at", "silver_processed_at", "kafka_timestamp", "offset", "partition")


def comparable(frame: DataFrame, *, stamps: Sequence[str] = ()) -> DataFrame:
    """Timestamps without zone, last digits of derived doubles left out.

    Of the wall-clock stamps and source columns only those in ``stamps`` are shown: wall-clock ones
    as whether they are set.
    """
    clocks = [F.col(n).isNotNull().alias(f"{n}_set") for n in stamps if n in CLOCKS]
    hidden = {*STAMPS} - ({*stamps} - {*CLOCKS})

    def shown(name, kind):
        column = F.col(f"`{name}`")
        if isinstance(kind, TimestampType):
            return column.cast("timestamp_ntz").alias(name)
        return F.round(column, ROUNDED[name]).alias(name) if name in ROUNDED else column

    return frame.select(
        *[shown(field.name, field.dataType) for field in frame.schema if field.name not in hidden],
        *clocks,
    )


# Inputs of the queries.


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture.raw_events(fixture.load_events(spark, sf_dir))


def _messages(spark: SparkSession, sf_dir: str, topic: str | None = None) -> DataFrame:
    wanted = {kind: name for kind, name in ingest.routes().items() if topic in (None, name)}
    return ingest.messages(_raw(spark, sf_dir), topics=wanted)


def _records(spark: SparkSession, sf_dir: str, topic: str) -> DataFrame:
    """Messages of one topic as the records a source would deliver, numbered by their time."""
    sent = _messages(spark, sf_dir, topic)
    number = F.get_json_object("value", "$.timestamp").cast("long")
    source = {"timestamp": number.cast("timestamp"), "offset": number, "partition": number % 8}
    return sent.select(
        F.col("value").cast("binary").alias("value"),
        *[source[f.name].cast(f.dataType).alias(f.name) for f in RECORD.fields[1:]],
    )


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.edit_features(fixture.edits(fixture.load_events(spark, sf_dir)))


def _volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold_edit_volume(_silver(spark, sf_dir))


def _users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.user_activity(_silver(spark, sf_dir))


def _volume_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.volume_slice(_volume(spark, sf_dir))


def _user_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.user_slice(_users(spark, sf_dir))


def _window_length(label: str) -> dict[str, int]:
    return {label: fixed.GRANULARITIES[label]}


# Queries that need more than one line.


def ingest_route_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _messages(spark, sf_dir).groupBy("topic").agg(F.count("*").alias("messages"))


def volume_slice_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The volume slice as SQL text over the gold table."""
    text = f"""
        SELECT {", ".join(dashboard.VOLUME_COLUMNS)}
        FROM {{volume}}
        WHERE window_duration = :granularity
          AND date >= CAST(:since AS DATE) AND window_start >= CAST(:since AS TIMESTAMP)
        ORDER BY window_start
    """
    args = {"granularity": "1min", "since": str(SLICE)}
    return run_sql(spark, text, args, volume=_volume(spark, sf_dir))


def user_slice_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The user slice as SQL text over the gold table."""
    text = f"""
        SELECT {", ".join(dashboard.USER_COLUMNS)}
        FROM {{activity}}
        WHERE window_duration = :granularity
          AND date >= CAST(:since AS DATE) AND window_start >= CAST(:since AS TIMESTAMP)
        ORDER BY window_start, edit_count DESC, user, bot
    """
    args = {"granularity": "1min", "since": str(SLICE)}
    return run_sql(spark, text, args, activity=_users(spark, sf_dir))


def anomaly_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.users_in_anomalies(_user_rows(spark, sf_dir), _volume_rows(spark, sf_dir))


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw text files -> ingest stream -> one folder per topic; the messages that arrived."""
    folder = scratch_folder(spark, "stream-ingest")
    _raw(spark, sf_dir).write.text(f"{folder}/raw")
    raw = raw_text(spark, f"{folder}/raw", stream=True)
    ingest_job(raw, f"{folder}/checkpoint", fmt="parquet", path=f"{folder}/topics")
    return spark.read.parquet(f"{folder}/topics").select("topic", "key", "value")


def stream_bronze_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edit messages in files -> bronze stream -> silver stream; the silver table."""
    folder = scratch_folder(spark, "stream-silver")
    edits = fixture.edits(fixture.load_events(spark, sf_dir))
    value = F.to_json(F.struct(*EDIT_MESSAGE.names), {"ignoreNullFields": "false"})
    edits.select(
        F.lit(fixed.EDIT_TOPIC).alias("topic"),
        F.col("id").cast("string").alias("key"),
        value.alias("value"),
    ).write.partitionBy("topic").parquet(f"{folder}/topics")

    def records(topic: str) -> DataFrame:
        return topic_file_records(spark, f"{folder}/topics", topic, stream=True)

    bronze_job(
        records(fixed.EDIT_TOPIC),
        records(fixed.PAGE_TOPIC),
        f"{folder}/checkpoints",
        {"path": f"{folder}/edits"},
        {"path": f"{folder}/pages"},
    )
    appended = stream_table(spark, path=f"{folder}/edits", schema=BRONZE_EDITS)
    silver_job(appended, f"{folder}/checkpoints/silver", {"path": f"{folder}/silver"})
    return comparable(read_silver(spark, path=f"{folder}/silver"), stamps=CLOCKS)


def stream_ingest_sse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A recorded event stream -> ingest stream; the data of every third event is on two lines."""
    folder = scratch_folder(spark, "stream-sse")
    raw = _raw(spark, sf_dir)
    broken = F.regexp_replace("value", r',"id":', ',\ndata: "id":')
    text = F.when(F.pmod(F.hash("value"), F.lit(3)) == 0, broken).otherwise(F.col("value"))
    blocks = raw.select(F.concat(F.lit("event: message\ndata: "), text).alias("value"))
    blocks.write.option("lineSep", "\n\n").text(f"{folder}/raw")
    payloads = sse_payloads(sse_blocks(spark, f"{folder}/raw", stream=True))
    ingest_job(payloads, f"{folder}/checkpoint", fmt="parquet", path=f"{folder}/topics")
    return spark.read.parquet(f"{folder}/topics").select("topic", "key", "value")


def stream_bronze_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw text -> ingest stream -> both topics -> bronze stream; the table of page events."""
    folder = scratch_folder(spark, "stream-pages")
    _raw(spark, sf_dir).write.text(f"{folder}/raw")
    raw = raw_text(spark, f"{folder}/raw", stream=True)
    ingest_job(raw, f"{folder}/checkpoint", fmt="parquet", path=f"{folder}/topics")
    edits, pages = (
        topic_file_records(spark, f"{folder}/topics", topic, stream=True)
        for topic in (fixed.EDIT_TOPIC, fixed.PAGE_TOPIC)
    )
    targets = {"path": f"{folder}/edits"}, {"path": f"{folder}/pages"}
    bronze_job(edits, pages, f"{folder}/checkpoints", *targets)
    written = spark.read.schema(BRONZE_PAGE_EVENTS).parquet(f"{folder}/pages")
    return comparable(written, stamps=["ingested_at"])


def _refreshed(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One gold table after a refresh at EARLIER, which saw only what had come in by then, and
    another at AS_OF."""
    edits = _silver(spark, sf_dir)
    seen = edits.filter(F.col("edit_timestamp") < lit_moment(EARLIER))
    return _after(spark, table, (seen, EARLIER), (edits, AS_OF))


def _after(spark: SparkSession, table: str, *runs: tuple[DataFrame, datetime]) -> DataFrame:
    """One gold table after refreshes with these silver rows at these times."""
    folder = scratch_folder(spark, "refresh")
    suffix = folder.rsplit("-", 1)[1]
    names = {"volume_table": f"volume_{suffix}", "user_table": f"users_{suffix}"}
    for silver_rows, as_of in runs:
        refresh_gold(spark, silver=silver_rows, as_of=as_of, location=folder, **names)
    result = comparable(spark.read.parquet(f"{folder}/{names[table]}"))
    for name in names.values():
        spark.sql(f"DROP TABLE {name}")  # external: the files stay
    return result


def refresh_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _refreshed(spark, sf_dir, "user_table")


def refresh_nothing_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second refresh finds no edit in its lookback."""
    edits = _silver(spark, sf_dir)
    return _after(spark, "user_table", (edits, AS_OF), (edits, AS_OF + timedelta(days=3650)))


def refresh_vanished_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """At the second refresh one date has no edits any more, and a far one has."""
    edits = _silver(spark, sf_dir)
    gone = F.to_date("edit_timestamp") == F.lit(str(VANISHED)).cast("date")
    later = F.col("edit_timestamp") + F.make_dt_interval(days=F.lit(FAR_DAYS))
    moved = edits.filter(gone).withColumn("edit_timestamp", later)
    now = edits.filter(~gone).unionByName(moved)
    return _after(spark, "user_table", (edits, EARLIER), (now, AS_OF))


def refresh_volume_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _refreshed(spark, sf_dir, "volume_table")


# Windows of a stream stay open for as long; one in so many edits comes days too late.
OPEN = "10 minutes"
LATE_MODULO = 11


def _is_late() -> Column:
    old = F.col("edit_timestamp") < lit_moment(EARLIER_LOOKBACK)
    return (F.col("revision_old") % LATE_MODULO == 0) & old


def _store_silver(rows: DataFrame, folder: str) -> None:
    """Add rows to a silver table in a folder, by day as the silver job does."""
    stored = rows.withColumn(SILVER_PARTITION, F.to_date("edit_timestamp"))
    stored = stored.hint("rebalance", SILVER_PARTITION)
    stored.write.partitionBy(SILVER_PARTITION).mode("append").parquet(folder)


def _silver_stream(spark: SparkSession, folder: str) -> DataFrame:
    return stream_table(spark, path=folder, schema=spark.read.parquet(folder).schema)


def refresh_late_edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold of a whole history, and then late edits far beyond the lookback, whose dates alone are
    computed again; the volume table."""
    folder = scratch_folder(spark, "late")
    edits = _silver(spark, sf_dir)
    names = {"volume_table": "volume", "user_table": "users", "versions": f"{folder}/gold"}

    def job() -> None:
        late_edits_job(
            _silver_stream(spark, f"{folder}/silver"),
            lambda: spark.read.parquet(f"{folder}/silver"),
            f"{folder}/checkpoint",
            **names,
        )

    _store_silver(edits.where(~_is_late()), f"{folder}/silver")
    job()
    _store_silver(edits.where(_is_late()), f"{folder}/silver")
    job()
    return comparable(read_version(spark, f"{folder}/gold", "volume"))


def refresh_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``refresh_volume_partitions``, with both tables kept in versions; the latest one."""
    folder = scratch_folder(spark, "versions")
    edits = _silver(spark, sf_dir)
    seen = edits.filter(F.col("edit_timestamp") < lit_moment(EARLIER))
    names = {"volume_table": "volume", "user_table": "users", "versions": folder}
    for silver_rows, as_of in ((seen, EARLIER), (edits, AS_OF)):
        refresh_gold(spark, silver=silver_rows, as_of=as_of, **names)
    return comparable(read_version(spark, folder, "volume"))


def _closed_windows(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, str]:
    """All edits as silver, and the folder of the windows that a stream closed: late edits reach it
    after edits of ten days later have."""
    folder = scratch_folder(spark, "closed")
    edits = _silver(spark, sf_dir)
    early = F.col("edit_timestamp") < lit_moment(EARLIER)
    for rows in (edits.where(early & ~_is_late()), edits.where(~early | _is_late())):
        _store_silver(rows, f"{folder}/silver")
        stream = _silver_stream(spark, f"{folder}/silver")
        volume_job(stream, f"{folder}/checkpoint", {"path": f"{folder}/volume"}, OPEN)
    return edits, f"{folder}/volume"


def stream_edit_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    closed = spark.read.parquet(_closed_windows(spark, sf_dir)[1])
    return comparable(closed.drop("users_sketch", "approx_users"))


def stream_late_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    edits, closed = _closed_windows(spark, sf_dir)
    return comparable(late_counts(edits, spark.read.parquet(closed)))


def stream_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows in files -> stream of baselines and flags, in two runs."""
    folder = scratch_folder(spark, "flags")
    volume = windows.edit_volume(_silver(spark, sf_dir))
    columns = ("window_duration", "window_start", "total_edits")
    early = F.col("window_start") < lit_moment(EARLIER)
    for rows in (volume.where(early), volume.where(~early)):
        rows.select(*columns).write.mode("append").parquet(f"{folder}/volume")
        stream = _silver_stream(spark, f"{folder}/volume")
        anomaly_job(stream, f"{folder}/checkpoint", {"path": f"{folder}/flags"}, OPEN)
    return comparable(spark.read.parquet(f"{folder}/flags"))


def stream_silver_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``stream_bronze_silver``; a third of the messages comes again after a reconnect."""
    folder = scratch_folder(spark, "distinct")
    edits = fixture.edits(fixture.load_events(spark, sf_dir))
    value = F.to_json(F.struct(*EDIT_MESSAGE.names), {"ignoreNullFields": "false"})
    sent = edits.withColumn("key", F.col("id").cast("string")).withColumn("value", value)
    sent = sent.withColumn("topic", F.lit(fixed.EDIT_TOPIC))
    for rows in (sent, sent.where(F.col("revision_old") % 3 == 0)):
        rows.select("topic", "key", "value").write.mode("append").partitionBy("topic").parquet(
            f"{folder}/topics"
        )
        records = [
            topic_file_records(spark, f"{folder}/topics", topic, stream=True)
            for topic in (fixed.EDIT_TOPIC, fixed.PAGE_TOPIC)
        ]
        targets = {"path": f"{folder}/edits"}, {"path": f"{folder}/pages"}
        bronze_job(*records, f"{folder}/checkpoints", *targets)
        appended = stream_table(spark, path=f"{folder}/edits", schema=BRONZE_EDITS)
        silver_job(
            appended,
            f"{folder}/checkpoints/silver",
            {"path": f"{folder}/silver"},
            distinct_within="2 hours",
        )
    return comparable(read_silver(spark, path=f"{folder}/silver"))


def sketched_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct users of each day from the stored sketches of its windows, against the exact number."""
    edits = _silver(spark, sf_dir)
    merged = sketches.merged_users(sketches.user_sketches(edits), "window_duration", "date")
    exact = edits.groupBy(F.to_date("edit_timestamp").alias("date")).agg(
        F.count_distinct("user").alias("exact_users")
    )
    close = F.abs(F.col("approx_users") - F.col("exact_users")) <= 0.03 * F.col("exact_users")
    return merged.join(exact, "date").select(
        "window_duration", "date", "exact_users", close.alias("within_3_pct")
    )


def processing_latency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Percentiles of the processing time of each day from the sketches of its windows."""
    edits = fixture.with_stamps(_silver(spark, sf_dir))
    stored = sketches.latency_sketches(edits, _window_length("5min"))
    return sketches.merged_latency(stored, "date")


def gold_edit_volume_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The volume table with a row for every window, so that quiet ones count in the baseline; many of
    its windows lie on their threshold, so flags are exact."""
    volume = windows.edit_volume(_silver(spark, sf_dir))
    return comparable(flag_anomalies(windows.fill_quiet(volume), exact=True))


QUERIES: dict[str, Query] = {
    "ingest_route_counts": ingest_route_counts,
    "ingest_edit_messages": lambda s, d: _messages(s, d, fixed.EDIT_TOPIC),
    "ingest_page_messages": lambda s, d: _messages(s, d, fixed.PAGE_TOPIC),
    "bronze_edits": lambda s, d: comparable(
        bronze.bronze_edits(_records(s, d, fixed.EDIT_TOPIC)), stamps=ARRIVAL
    ),
    "bronze_page_events": lambda s, d: comparable(
        bronze.bronze_page_events(_records(s, d, fixed.PAGE_TOPIC)), stamps=ARRIVAL
    ),
    "silver_edits": lambda s, d: comparable(_silver(s, d), stamps=["silver_processed_at"]),
    "silver_report": lambda s, d: silver.feature_report(_silver(s, d)),
    "namespace_breakdown": lambda s, d: silver.namespace_breakdown(_silver(s, d)),
    "lookback_slice": lambda s, d: comparable(edits_since(_silver(s, d), LOOKBACK)),
    "time_range": lambda s, d: comparable(reports.time_range(edits_since(_silver(s, d), LOOKBACK))),
    "edit_volume_1min": lambda s, d: comparable(
        windows.edit_volume(_silver(s, d), _window_length("1min"))
    ),
    "edit_volume_5min": lambda s, d: comparable(
        windows.edit_volume(_silver(s, d), _window_length("5min"))
    ),
    "gold_edit_volume": lambda s, d: comparable(_volume(s, d)),
    "gold_edit_volume_lookback": lambda s, d: comparable(
        gold_edit_volume_since(_silver(s, d), LOOKBACK, warm_baseline=True)
    ),
    "gold_edit_volume_lookback_cold": lambda s, d: comparable(
        gold_edit_volume_since(_silver(s, d), LOOKBACK)
    ),
    "gold_edit_volume_10min": lambda s, d: comparable(
        gold_edit_volume(_silver(s, d), Settings({"10min": 600}, 7200, 1.5))
    ),
    "gold_edit_volume_by_bot": lambda s, d: comparable(
        gold_edit_volume(_silver(s, d), Settings({"5min": 300}, by=["bot"]))
    ),
    "anomaly_summary": lambda s, d: anomaly_summary(_volume(s, d)),
    "volume_table_report": lambda s, d: reports.volume_totals(_volume(s, d)),
    "rows_per_granularity": lambda s, d: reports.rows_per_granularity(_volume(s, d)),
    "gold_user_activity": lambda s, d: comparable(_users(s, d)),
    "user_table_report": lambda s, d: reports.user_totals(_users(s, d)),
    "editor_preview": lambda s, d: comparable(reports.editor_preview(_users(s, d))),
    "latest_windows": lambda s, d: comparable(reports.latest_windows(_volume(s, d))),
    "first_windows": lambda s, d: comparable(reports.by_window(_volume_rows(s, d)).limit(20)),
    "volume_slice": lambda s, d: comparable(
        reports.by_window(dashboard.volume_slice(_volume(s, d), SLICE))
    ),
    "volume_slice_sql": lambda s, d: comparable(volume_slice_sql(s, d)),
    "user_slice": lambda s, d: comparable(
        reports.by_window_and_edits(dashboard.user_slice(_users(s, d), SLICE))
    ),
    "user_slice_sql": lambda s, d: comparable(user_slice_sql(s, d)),
    "kpis": lambda s, d: comparable(dashboard.key_figures(_volume_rows(s, d))),
    "slice_users": lambda s, d: dashboard.distinct_users(_user_rows(s, d)),
    "volume_series": lambda s, d: comparable(dashboard.volume_series(_volume_rows(s, d))),
    "bot_series": lambda s, d: comparable(dashboard.bot_series(_volume_rows(s, d))),
    "zscore_series": lambda s, d: comparable(dashboard.z_score_series(_volume_rows(s, d))),
    "anomaly_users": lambda s, d: comparable(anomaly_users(s, d)),
    "top_editors": lambda s, d: dashboard.top_editors(anomaly_users(s, d)),
    "anomaly_table": lambda s, d: comparable(dashboard.anomaly_table(_volume_rows(s, d))),
    "stream_ingest": stream_ingest,
    "stream_ingest_sse": stream_ingest_sse,
    "stream_bronze_silver": stream_bronze_silver,
    "stream_bronze_pages": stream_bronze_pages,
    "refresh_partitions": refresh_partitions,
    "refresh_nothing_new": refresh_nothing_new,
    "refresh_vanished_dates": refresh_vanished_dates,
    "refresh_volume_partitions": refresh_volume_partitions,
    "refresh_late_edits": refresh_late_edits,
    "refresh_versions": refresh_versions,
    "stream_edit_volume": stream_edit_volume,
    "stream_late_counts": stream_late_counts,
    "stream_anomalies": stream_anomalies,
    "stream_silver_distinct": stream_silver_distinct,
    "sketched_users": sketched_users,
    "processing_latency": processing_latency,
    "gold_edit_volume_dense": gold_edit_volume_dense,
    "silver_edits_lookup": lambda s, d: comparable(
        silver.edit_features(
            fixture.edits(fixture.load_events(s, d)), labels=fixture.own_labels(s), other_label="None"
        )
    ),
}


@cache
def _events_bytes(spark: SparkSession, sf_dir: str) -> int:
    return scan_bytes(fixture.load_events(spark, sf_dir))


def _configured(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        # twice the input: every edit goes into one window of each length
        size_shuffles(configure(spark), len(fixed.GRANULARITIES) * _events_bytes(spark, sf_dir))
        return query(spark, sf_dir)

    run.__doc__ = query.__doc__
    return run


def registered() -> dict[str, Query]:
    return {name: _configured(query) for name, query in QUERIES.items()}
