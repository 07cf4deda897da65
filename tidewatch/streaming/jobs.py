"""Streaming jobs.  Each takes what its source has now, appends it, and stops.

Ingest, bronze and silver are stateless: a row goes through filter and projection only, so tasks follow
the source partitions and nothing is shuffled.  Windows, flags and distinct edits keep state, on the
executors' disks and in the checkpoint.  Checkpoints make a rerun continue where the last one ended.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import date
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch import fixed
from tidewatch.functions import lit_date
from tidewatch.operators.bronze import bronze_edits, bronze_page_events
from tidewatch.operators.ingest import messages
from tidewatch.operators.silver import edit_features
from tidewatch.plans.gold import USUAL, affected_dates, refresh_dates
from tidewatch.session import state_on_disk
from tidewatch.sinks import append_stream, await_all, write_messages
from tidewatch.sources.tables import SILVER_PARTITION
from tidewatch.streaming.anomaly import anomaly_stream
from tidewatch.streaming.volume import DELAY, volume_stream


def ingest_job(
    raw: DataFrame,
    checkpoint: str,
    fmt: str = "kafka",
    path: str | None = None,
    site: str = fixed.SITE,
    **options: str,
) -> None:
    """Raw event stream -> topics."""
    await_all([write_messages(messages(raw, site), checkpoint, fmt, path, **options)])


def bronze_job(
    edit_records: DataFrame,
    page_records: DataFrame,
    checkpoints: str,
    edit_target: dict[str, str] | None = None,
    page_target: dict[str, str] | None = None,
    fmt: str = "parquet",
) -> None:
    """Both record streams -> their bronze tables, side by side.

    A target is ``{"table": name}`` or ``{"path": folder}``.
    """
    edit_target = edit_target or {"table": fixed.BRONZE_EDITS_TABLE}
    page_target = page_target or {"table": fixed.BRONZE_PAGE_TABLE}
    await_all(
        [
            append_stream(
                bronze_edits(edit_records), f"{checkpoints}/edits", fmt=fmt, **edit_target
            ),
            append_stream(
                bronze_page_events(page_records), f"{checkpoints}/pages", fmt=fmt, **page_target
            ),
        ]
    )


def silver_stream(
    bronze: DataFrame,
    files_per_day: int | None = None,
    labels: Mapping[int, str] | DataFrame = fixed.NAMESPACE_LABELS,
    other_label: str = fixed.OTHER_NAMESPACE,
    revert_pattern: str = fixed.REVERT_PATTERN,
    distinct_within: str | None = None,
) -> DataFrame:
    """Silver rows with the storage-only day column the table is partitioned by.

    With ``files_per_day`` the rows are shuffled by day first, so that a batch writes at most so many
    files for each day; a day of many rows is spread over them.  With ``distinct_within`` (a length of
    time) an edit that arrives again so soon after its first arrival is left out, as after a reconnect
    of the feed.  Arrival is when bronze stored it (``ingested_at``), so an old edit that comes late
    is no late row here; ids are forgotten after that time.  Without either, nothing is shuffled and
    no state is kept.
    """
    rows = edit_features(bronze, labels, other_label, revert_pattern)
    if distinct_within:
        rows = rows.withWatermark("ingested_at", distinct_within)
        rows = rows.dropDuplicatesWithinWatermark(["id"])
    rows = rows.withColumn(SILVER_PARTITION, F.to_date("edit_timestamp"))
    if files_per_day is None:
        return rows
    return rows.repartition(SILVER_PARTITION, F.pmod(F.xxhash64("id"), F.lit(files_per_day)))


def silver_job(
    bronze: DataFrame,
    checkpoint: str,
    target: dict[str, str] | None = None,
    fmt: str = "parquet",
    files_per_day: int | None = None,
    labels: Mapping[int, str] | DataFrame = fixed.NAMESPACE_LABELS,
    other_label: str = fixed.OTHER_NAMESPACE,
    revert_pattern: str = fixed.REVERT_PATTERN,
    distinct_within: str | None = None,
) -> None:
    """Bronze edits stream -> silver table, whose schema may not change.

    The table is partitioned by day, so that the gold lookback lists and reads its days only.  Each
    task writes a file for every day it meets; for a replay of a long history, give
    ``files_per_day``.  The other arguments are those of :func:`silver_stream`.
    """
    rows = silver_stream(
        bronze, files_per_day, labels, other_label, revert_pattern, distinct_within
    )
    with state_on_disk(bronze.sparkSession):
        query = append_stream(
            rows,
            checkpoint,
            fmt=fmt,
            partition_by=[SILVER_PARTITION],
            **(target or {"table": fixed.SILVER_TABLE}),
        )
    await_all([query])


def volume_job(
    silver: DataFrame,
    checkpoint: str,
    target: dict[str, str],
    delay: str = DELAY,
    granularities: Mapping[str, int] = fixed.GRANULARITIES,
    by: Sequence[str] = (),
    fmt: str = "parquet",
) -> None:
    """Silver stream -> table of closed windows (:func:`volume_stream`), partitioned by date."""
    rows = volume_stream(silver, delay, granularities, by)
    with state_on_disk(silver.sparkSession):
        query = append_stream(rows, checkpoint, fmt=fmt, partition_by=["date"], **target)
    await_all([query])


def anomaly_job(
    volume: DataFrame,
    checkpoint: str,
    target: dict[str, str],
    delay: str = DELAY,
    baseline_seconds: int = fixed.BASELINE_SECONDS,
    sigma: float = fixed.SIGMA,
    by: Sequence[str] = (),
    fmt: str = "parquet",
) -> None:
    """Stream of closed windows -> table of their baselines and flags (:func:`anomaly_stream`)."""
    rows = anomaly_stream(volume, delay, baseline_seconds, sigma, by)
    with state_on_disk(volume.sparkSession):
        query = append_stream(rows, checkpoint, fmt=fmt, **target)
    await_all([query])


def late_edits_job(
    stream: DataFrame,
    silver: Callable[[], DataFrame],
    checkpoint: str,
    before: date | None = None,
    **gold: Any,
) -> list[str]:
    """Silver stream -> the gold dates that new edits belong to, however old; returns these dates.

    A regular refresh replaces the dates of its lookback.  This one derives from each batch of new
    edits the dates they change, and recomputes those alone from what ``silver`` reads at that moment;
    with ``before``, only dates before that one, so that the lookback is left to the regular refresh.
    The other arguments are those of :func:`~tidewatch.plans.gold.refresh_dates`.  On its first run
    all of the stream is new: it computes every date.  A batch repeated after a failure gives the same
    tables.  The driver gets one short entry for each date of a batch.
    """
    spark, refreshed = stream.sparkSession, set()
    settings = gold.get("settings", USUAL)

    def refresh(batch: DataFrame, _: int) -> None:
        dates = affected_dates(batch, settings)
        if before is not None:
            dates = dates.where(F.col("date") < lit_date(before))
        dates = dates.select(F.col("date").cast("string").alias("day"), "edited")
        found = {row.day: row.edited for row in dates.collect()}
        if found:
            edited = sorted(day for day, own in found.items() if own)
            refresh_dates(spark, silver(), sorted(found), edited, **gold)
            refreshed.update(found)

    query = (
        stream.writeStream.foreachBatch(refresh)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    await_all([query])
    return sorted(refreshed)
