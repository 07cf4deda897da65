"""Command line of the jobs, for ``spark-submit`` or ``python -m tidewatch``.

    ingest  (--feed DIR [--sse] | --feed-topic NAME) [--feed-option KEY=VALUE]
            (--servers HOST:PORT | --topics DIR) --checkpoint DIR
    bronze  (--servers HOST:PORT | --topics DIR) --checkpoint DIR
    silver  --checkpoint DIR [--files-per-day N] [--distinct-within TIME]
    gold    [--as-of TIME] [--warm] [--versions DIR]
    late    --checkpoint DIR [--before DATE] [--versions DIR]
    windows --checkpoint DIR --out DIR [--delay TIME]
    flags   --checkpoint DIR --windows DIR --out DIR [--delay TIME]
    report  [--as-of TIME]
    page    [--as-of TIME] [--hours N] [--granularity 1min|5min] [--out DIR]

Topics are those of a message bus (``--servers``, with ``--option key=value`` for the connector) or
folders of files (``--topics``).  ``gold`` and ``late`` take ``--window LABEL=SECONDS`` (repeatable),
``--baseline SECONDS``, ``--sigma NUMBER`` and ``--by COLUMN`` (repeatable).  A topic of raw events is read from the same servers.  Tables go by
their usual names; ``--format`` chooses their format.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession

from tidewatch import fixed
from tidewatch.functions import lookback_start
from tidewatch.operators import reports, silver
from tidewatch.operators.anomaly import anomaly_summary
from tidewatch.plans.gold import Settings, refresh_gold
from tidewatch.plans.page import dashboard_page
from tidewatch.session import configure
from tidewatch.sources import (
    kafka_options,
    kafka_records,
    raw_records,
    raw_text,
    read_silver,
    read_table,
    sse_blocks,
    sse_payloads,
    stream_table,
    topic_file_records,
)
from tidewatch.streaming import (
    anomaly_job,
    bronze_job,
    ingest_job,
    late_edits_job,
    silver_job,
    volume_job,
)
from tidewatch.streaming.volume import DELAY


# What a page shows: all but its two slices of the tables themselves.
SHOWN = (
    "key_figures", "distinct_users", "volume_series", "bot_series", "z_score_series",
    "top_editors", "anomalies",
)
MOST_ROWS = 2**31 - 1


def _arguments(words: Sequence[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tidewatch", description="Edit-stream analytics jobs")
    parser.add_argument("--format", default="parquet")
    commands = parser.add_subparsers(dest="command", required=True)

    ingest = commands.add_parser("ingest", help="raw event files -> topics")
    feed = ingest.add_mutually_exclusive_group(required=True)
    feed.add_argument("--feed", help="folder of text files")
    feed.add_argument("--feed-topic", help="topic of raw events")
    ingest.add_argument("--feed-option", action="append", default=[], metavar="KEY=VALUE")
    ingest.add_argument("--sse", action="store_true", help="files are a recorded event stream")
    bronze = commands.add_parser("bronze", help="topics -> bronze tables")
    for command in (ingest, bronze):
        topics = command.add_mutually_exclusive_group(required=True)
        topics.add_argument("--servers")
        topics.add_argument("--topics")
        command.add_argument("--option", action="append", default=[], metavar="KEY=VALUE")
        command.add_argument("--checkpoint", required=True)

    features = commands.add_parser("silver", help="bronze edits -> silver table")
    features.add_argument("--checkpoint", required=True)
    features.add_argument("--files-per-day", type=int, help="shuffle by day before writing")

    features.add_argument("--distinct-within", help="leave out edits that come again so soon")

    gold = commands.add_parser("gold", help="silver -> gold tables, last days only")
    gold.add_argument("--warm", action="store_true", help="baseline reads the hour before")
    late = commands.add_parser("late", help="silver stream -> gold dates of new edits, however old")
    late.add_argument("--before", type=date.fromisoformat, help="only dates before this one")
    for command in (gold, late):
        command.add_argument("--versions", help="keep both tables here, replaced at once")
        command.add_argument("--window", action="append", metavar="LABEL=SECONDS")
        command.add_argument("--baseline", type=int, default=fixed.BASELINE_SECONDS)
        command.add_argument("--sigma", type=float, default=fixed.SIGMA)
        command.add_argument("--by", action="append", default=[])
    closed = commands.add_parser("windows", help="silver stream -> windows once they are closed")
    flags = commands.add_parser("flags", help="stream of closed windows -> baselines and flags")
    flags.add_argument("--windows", required=True, help="folder that `windows` writes")
    for command in (closed, flags):
        command.add_argument("--out", required=True)
        command.add_argument("--delay", default=DELAY, help="how late an edit or window may be")
    for command in (late, closed, flags):
        command.add_argument("--checkpoint", required=True)
    report = commands.add_parser("report", help="figures about silver and gold")
    page = commands.add_parser("page", help="key figures, editors and anomalies of a slice")
    page.add_argument("--hours", type=int, default=fixed.DEFAULT_HOURS)
    page.add_argument("--granularity", default=fixed.DEFAULT_GRANULARITY)
    page.add_argument("--out", help="also write every frame to a folder of its name here")
    for command in (gold, report, page):
        command.add_argument("--as-of", type=datetime.fromisoformat)
    return parser.parse_args(words)


def _topic_sink(given: argparse.Namespace) -> dict[str, str]:
    if given.topics:
        return {"fmt": "parquet", "path": given.topics, **given.option}
    # of the defaults, those that also concern a writer; of the given options, all
    settings = {k: v for k, v in kafka_options(given.servers).items() if k.startswith("kafka.")}
    return {"fmt": "kafka", **settings, **given.option}


def _raw(spark: SparkSession, given: argparse.Namespace) -> DataFrame:
    if given.feed_topic:
        if not given.servers:
            raise SystemExit("--feed-topic needs --servers")
        return raw_records(spark, given.feed_topic, kafka_options(given.servers, **given.feed_option))
    if given.sse:
        return sse_payloads(sse_blocks(spark, given.feed, stream=True, **given.feed_option))
    return raw_text(spark, given.feed, stream=True, **given.feed_option)


def _records(spark: SparkSession, given: argparse.Namespace, topic: str) -> DataFrame:
    if given.topics:
        return topic_file_records(spark, given.topics, topic, stream=True, **given.option)
    return kafka_records(spark, topic, kafka_options(given.servers, **given.option))


def _settings(given: argparse.Namespace) -> Settings:
    pairs = (window.rsplit("=", 1) for window in given.window or ())
    lengths = {label: int(seconds) for label, seconds in pairs} or fixed.GRANULARITIES
    return Settings(lengths, given.baseline, given.sigma, given.by)


def _windows(spark: SparkSession, given: argparse.Namespace) -> None:
    target = {"path": given.out}
    if given.command == "windows":
        stream = stream_table(spark, fixed.SILVER_TABLE)
        volume_job(stream, given.checkpoint, target, given.delay, fmt=given.format)
    else:
        schema = read_table(spark, path=given.windows, fmt=given.format).schema
        stream = stream_table(spark, path=given.windows, schema=schema, fmt=given.format)
        anomaly_job(stream, given.checkpoint, target, given.delay, fmt=given.format)


def _report(spark: SparkSession, as_of: datetime | None) -> None:
    recent = read_silver(spark, fixed.SILVER_TABLE, start=lookback_start(as_of))
    edits = read_silver(spark, fixed.SILVER_TABLE)
    volume = read_table(spark, fixed.VOLUME_TABLE)
    users = read_table(spark, fixed.USER_TABLE)
    for frame in (
        silver.feature_report(edits),
        silver.namespace_breakdown(edits),
        reports.time_range(recent),
        anomaly_summary(volume),
        reports.volume_totals(volume),
        reports.rows_per_granularity(volume),
        reports.user_totals(users),
        reports.editor_preview(users),
        reports.latest_windows(volume),
    ):
        _show(frame)


def _show(frame: DataFrame) -> None:
    """All rows of a frame that is small by its nature: totals, lists, windows of a slice."""
    frame.show(MOST_ROWS, truncate=False)


def main(words: Sequence[str] | None = None) -> None:
    given = _arguments(words)
    spark = configure(SparkSession.builder.appName(f"tidewatch {given.command}").getOrCreate())
    if given.command in ("ingest", "bronze"):
        given.option = dict(option.split("=", 1) for option in given.option)
    if given.command == "ingest":
        given.feed_option = dict(option.split("=", 1) for option in given.feed_option)
    if given.command == "ingest":
        ingest_job(_raw(spark, given), given.checkpoint, **_topic_sink(given))
    elif given.command == "bronze":
        bronze_job(
            _records(spark, given, fixed.EDIT_TOPIC),
            _records(spark, given, fixed.PAGE_TOPIC),
            given.checkpoint,
            fmt=given.format,
        )
    elif given.command == "silver":
        bronze = stream_table(spark, fixed.BRONZE_EDITS_TABLE)
        silver_job(
            bronze,
            given.checkpoint,
            fmt=given.format,
            files_per_day=given.files_per_day,
            distinct_within=given.distinct_within,
        )
    elif given.command == "gold":
        done = refresh_gold(
            spark,
            as_of=given.as_of,
            warm_baseline=given.warm,
            fmt=given.format,
            settings=_settings(given),
            versions=given.versions,
        )
        print(f"{'replaced' if done.written else 'nothing found'} from {done.start} on")
    elif given.command == "late":
        options = {"fmt": given.format, "settings": _settings(given), "versions": given.versions}
        days = late_edits_job(
            stream_table(spark, fixed.SILVER_TABLE),
            lambda: spark.table(fixed.SILVER_TABLE),
            given.checkpoint,
            given.before,
            **options,
        )
        print(f"replaced: {', '.join(days) or 'nothing'}")
    elif given.command in ("windows", "flags"):
        _windows(spark, given)
    elif given.command == "report":
        _report(spark, given.as_of)
    else:
        volume = read_table(spark, fixed.VOLUME_TABLE)
        users = read_table(spark, fixed.USER_TABLE)
        frames = dashboard_page(volume, users, given.as_of, given.hours, given.granularity)
        for name in SHOWN:
            print(name)
            _show(frames[name])
        if given.out:
            for name, frame in frames.items():
                frame.write.mode("overwrite").parquet(f"{given.out.rstrip('/')}/{name}")


if __name__ == "__main__":
    main()
