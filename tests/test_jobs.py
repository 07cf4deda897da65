"""The jobs by their command line, on tables with their usual names."""

from __future__ import annotations

import json
from datetime import datetime
from pathlib import Path

import pytest

from tests.helpers import silver_rows
from tidewatch import fixed
from tidewatch.__main__ import _arguments, _topic_sink, main
from tidewatch.operators.windows import user_activity
from tidewatch.plans.gold import gold_edit_volume
from tidewatch.plans.page import dashboard_page
from tidewatch.versions import current_version, read_version

AS_OF = "1970-01-03T06:00:00"
MADE = (
    fixed.BRONZE_EDITS_TABLE,
    fixed.BRONZE_PAGE_TABLE,
    fixed.SILVER_TABLE,
    fixed.VOLUME_TABLE,
    fixed.USER_TABLE,
)


@pytest.fixture
def feed(spark, folder):
    """A recorded event stream: 100 edits and one page event."""
    lines = []
    for n in range(101):
        event = {
            "type": "log" if n == 100 else "edit",
            "server_name": fixed.SITE,
            "id": n,
            "timestamp": 172_800 + 30 * n,
            "user": f"u{n % 4}",
            "bot": n % 2 == 0,
            "title": "p",
            "length": {"old": 1, "new": n},
            "comment": "rv",
        }
        lines += ["event: message", f"id: {n}", f"data: {json.dumps(event)}", ""]
    Path(folder, "feed").mkdir()
    Path(folder, "feed", "a.txt").write_text("\n".join([":ok", *lines]))
    yield f"{folder}/feed"
    for name in MADE:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_all_jobs_in_a_row(spark, folder, feed, capsys):
    topics, checkpoint = f"{folder}/topics", f"{folder}/ck"
    for _ in range(2):
        words = ["--topics", topics, "--checkpoint"]
        limits = ["--feed-option", "maxFilesPerTrigger=1"]
        main(["ingest", "--feed", feed, "--sse", *limits, *words, f"{checkpoint}/ingest"])
        main(["bronze", *words, f"{checkpoint}/bronze", "--option", "maxFilesPerTrigger=5"])
        main(["silver", "--checkpoint", f"{checkpoint}/silver", "--files-per-day", "2"])
        main(["gold", "--as-of", AS_OF])
    assert spark.table(fixed.BRONZE_EDITS_TABLE).count() == 100
    assert spark.table(fixed.BRONZE_PAGE_TABLE).count() == 1
    assert spark.table(fixed.SILVER_TABLE).count() == 100
    assert spark.table(fixed.VOLUME_TABLE).count() == 50 + 10
    main(["gold", "--as-of", AS_OF, "--warm"])
    assert spark.table(fixed.VOLUME_TABLE).count() == 50 + 10
    main(["gold", "--as-of", "1980-01-01"])
    main(["report", "--as-of", AS_OF])
    page = ["page", "--as-of", AS_OF, "--hours", "6", "--granularity", "1min"]
    main([*page, "--out", f"{folder}/page"])
    shown = capsys.readouterr().out
    assert "volume_series" in shown and "only showing" not in shown
    assert spark.read.parquet(f"{folder}/page/volume_series").count() == 50
    assert "replaced from 1970-01-01 on" in shown and "nothing found from 1979-12-30 on" in shown
    assert "namespace_label" in shown and "distinct_users" in shown and "avg_bot_ratio" in shown


def test_late_windows_and_flags(spark, folder, feed, capsys):
    topics, checkpoint = f"{folder}/topics", f"{folder}/ck"
    words = ["--topics", topics, "--checkpoint"]
    main(["ingest", "--feed", feed, "--sse", *words, f"{checkpoint}/ingest"])
    main(["bronze", *words, f"{checkpoint}/bronze"])
    main(["silver", "--checkpoint", f"{checkpoint}/silver", "--distinct-within", "1 hour"])
    gold = ["--window", "10min=600", "--baseline", "7200", "--sigma", "1.5", "--by", "wiki"]
    versions = ["--versions", f"{folder}/gold"]
    for _ in range(2):
        main(["late", "--checkpoint", f"{checkpoint}/late", *gold, *versions])
    shown = capsys.readouterr().out
    assert "replaced: 1970-01-03" in shown and "replaced: nothing" in shown
    volume = read_version(spark, f"{folder}/gold", fixed.VOLUME_TABLE)
    assert volume.count() == 5 and {row.window_duration for row in volume.collect()} == {"10min"}
    main(["gold", "--as-of", AS_OF, *gold, *versions])
    assert current_version(spark, f"{folder}/gold").number == 2
    windows = f"{folder}/windows"
    main(["windows", "--checkpoint", f"{checkpoint}/windows", "--out", windows, "--delay", "5 minutes"])
    # the last edit is at 49:30, so windows that end up to 44:30 are closed
    closed = spark.read.parquet(windows)
    assert closed.where("window_duration = '1min'").count() == 44
    flags = f"{folder}/flags"
    main(["flags", "--checkpoint", f"{checkpoint}/flags", "--windows", windows, "--out", flags])
    assert spark.read.parquet(flags).where("window_duration = '1min'").count() == 34


def test_options_of_a_topic_sink():
    words = ["ingest", "--feed", "f", "--servers", "s", "--checkpoint", "c", "--option", "a=b"]
    given = _arguments(words)
    given.option = dict(option.split("=", 1) for option in given.option)
    sink = _topic_sink(given)
    assert sink["a"] == "b" and sink["kafka.bootstrap.servers"] == "s"
    assert "startingOffsets" not in sink


def test_topics_are_on_servers_or_in_files():
    for words in ([], ["--servers", "s", "--topics", "t"]):
        with pytest.raises(SystemExit):
            main(["bronze", "--checkpoint", "x", *words])


def test_page(spark):
    quiet = [{"t": 60 * n, "user": "q"} for n in range(10)]
    source = silver_rows(spark, quiet + [{"t": 600, "user": f"b{n % 2}"} for n in range(40)])
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("page", "")
    frames = dashboard_page(
        gold_edit_volume(source),
        user_activity(source),
        as_of=datetime(1970, 1, 1, 6, 4),
        granularity="1min",
    )
    assert not tracker.getJobIdsForGroup("page")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    counts = {name: frame.count() for name, frame in frames.items()}
    assert counts == {
        "volume": 11,
        "users": 12,
        "key_figures": 1,
        "distinct_users": 1,
        "volume_series": 11,
        "bot_series": 11,
        "z_score_series": 11,
        "top_editors": 2,
        "anomalies": 1,
    }
    assert frames["distinct_users"].first().unique_users == 3
