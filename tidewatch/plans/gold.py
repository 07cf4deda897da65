"""Silver -> the two gold tables, and their refresh."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from datetime import date, datetime, timedelta
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch import fixed
from tidewatch.functions import lit_date, lookback_start
from tidewatch.operators.anomaly import flag_anomalies
from tidewatch.operators.dashboard import since
from tidewatch.operators.windows import edit_volume, user_activity
from tidewatch.session import MAX_SHUFFLE_PARTITIONS, scan_bytes, sized_shuffles
from tidewatch.sinks import create_table, replace_listed_dates, table_exists, write_by_date
from tidewatch.sources.tables import SILVER_PARTITION, edits_since, read_table
from tidewatch.versions import Change, publish


# Bytes that one byte of a stored table becomes in a shuffle, per window length.
EXPANSION = 4


@dataclass(frozen=True)
class Settings:
    """What the gold tables are computed with; group columns are none by default."""

    granularities: Mapping[str, int] = field(default_factory=lambda: dict(fixed.GRANULARITIES))
    baseline_seconds: int = fixed.BASELINE_SECONDS
    sigma: float = fixed.SIGMA
    by: Sequence[str] = ()


USUAL = Settings()


def gold_edit_volume(silver: DataFrame, settings: Settings = USUAL) -> DataFrame:
    """All window lengths of the volume table, each compared with its own past."""
    volume = edit_volume(silver, settings.granularities, settings.by)
    return flag_anomalies(volume, settings.baseline_seconds, settings.sigma, by=settings.by)


def gold_edit_volume_since(
    silver: DataFrame, start: date, warm_baseline: bool = False, settings: Settings = USUAL
) -> DataFrame:
    """Volume rows from midnight of ``start`` on.

    Normally the baseline begins empty at ``start``, so the windows of its first hour see a shorter
    past.  With ``warm_baseline`` the hour before is read as well, used, and left out of the result.
    """
    if not warm_baseline:
        return gold_edit_volume(edits_since(silver, start), settings)
    midnight = datetime(start.year, start.month, start.day)
    history = edits_since(silver, midnight - timedelta(seconds=settings.baseline_seconds))
    return since(gold_edit_volume(history, settings), midnight)


def affected_dates(edits: DataFrame, settings: Settings = USUAL) -> DataFrame:
    """``date, edited``: dates with gold rows that depend on ``edits``.

    Those are the dates of the edits (``edited``) and the ones their windows are in the baseline of:
    the next date, too, for edits of its last hour.  Combined on the map side to a row per date.
    """
    epoch = F.unix_seconds("edit_timestamp")
    # a cast, as timestamp_seconds raises at the far end of time
    last = F.to_date((epoch + settings.baseline_seconds).cast("timestamp"))
    spans = (
        edits.where(F.col("edit_timestamp").isNotNull())
        .select(F.to_date("edit_timestamp").alias("first"), last.alias("last"))
        .groupBy("first", "last")
        .agg(F.lit(0).alias("none"))
    )
    days = spans.select("first", F.explode(F.sequence("first", "last")).alias("date"))
    return days.groupBy("date").agg(F.bool_or(F.col("first") == F.col("date")).alias("edited"))


def _history_of(silver: DataFrame, days: Sequence[str], settings: Settings) -> DataFrame:
    """Edits of these days and of the baseline before each."""
    listed = [F.lit(day).cast("date") for day in days]
    epoch, length = F.unix_seconds("edit_timestamp"), settings.baseline_seconds
    steps = [*range(0, length, 86_400), length]
    reached = [F.to_date((epoch + step).cast("timestamp")).isin(*listed) for step in steps]
    recent = silver.where(reduce(or_, reached))
    if SILVER_PARTITION in silver.columns:
        back = range(1 + -(-length // 86_400))
        stored = [F.date_sub(day, n) for day in listed for n in back]
        recent = recent.where(F.col(SILVER_PARTITION).isin(*stored))
    return recent


def gold_edit_volume_on(
    silver: DataFrame, days: Sequence[str], settings: Settings = USUAL
) -> DataFrame:
    """Volume rows of these dates (as text), each with its whole baseline."""
    listed = [F.lit(day).cast("date") for day in days]
    history = _history_of(silver, days, settings)
    return gold_edit_volume(history, settings).where(F.col("date").isin(*listed))


def refresh_dates(
    spark: SparkSession,
    silver: DataFrame,
    volume_days: Sequence[str],
    user_days: Sequence[str],
    volume_table: str = fixed.VOLUME_TABLE,
    user_table: str = fixed.USER_TABLE,
    fmt: str = "parquet",
    location: str | None = None,
    settings: Settings = USUAL,
    max_partitions: int = MAX_SHUFFLE_PARTITIONS,
    versions: str | None = None,
) -> None:
    """Recompute these dates of the gold tables from silver; all other dates keep their files.

    Days are given as Spark writes dates.  Every window has its whole baseline, as with
    ``warm_baseline``.  Running it again gives the same tables.  ``versions`` is as in
    :func:`refresh_gold`.
    """
    edits = _history_of(silver, user_days, replace(settings, baseline_seconds=0))
    jobs = [
        (volume_table, volume_days, gold_edit_volume_on(silver, volume_days, settings)),
        (user_table, user_days, user_activity(edits, settings.granularities, settings.by)),
    ]
    shuffled = scan_bytes(edits) * EXPANSION * len(settings.granularities)
    with sized_shuffles(spark, shuffled, max_partitions):
        if versions:
            publish(spark, versions, {t: Change(rows, _among(days)) for t, days, rows in jobs if days})
            return
        for table, days, rows in jobs:
            if days and table_exists(spark, table):
                replace_listed_dates(rows, table, days, fmt)
            elif days:
                options = {"path": f"{location}/{table}"} if location else {}
                create_table(rows, table, fmt, **options)


def _among(days: Sequence[str]) -> Callable[[Column], Column]:
    listed = [F.lit(day).cast("date") for day in days]
    return lambda day: day.isin(*listed)


@dataclass(frozen=True)
class Refresh:
    """What a refresh did: the first date it replaced, and whether there was anything to write."""

    start: date
    written: bool


def refresh_gold(
    spark: SparkSession,
    silver_table: str | None = None,
    silver_path: str | None = None,
    volume_table: str = fixed.VOLUME_TABLE,
    user_table: str = fixed.USER_TABLE,
    as_of: datetime | None = None,
    lookback_days: int = fixed.LOOKBACK_DAYS,
    warm_baseline: bool = False,
    fmt: str = "parquet",
    silver: DataFrame | None = None,
    location: str | None = None,
    silver_fmt: str = "parquet",
    settings: Settings = USUAL,
    max_partitions: int = MAX_SHUFFLE_PARTITIONS,
    versions: str | None = None,
) -> Refresh:
    """Recompute the dates of the lookback from silver and replace them in both gold tables.

    An edit that came late is taken up if its date is within the lookback.  If silver has no edit
    there, nothing is written.  Running it again gives the same tables, also after a failure.
    With ``location``, tables created here are external ones in folders below it.  Silver is given
    by one of ``silver``, ``silver_table`` and ``silver_path`` (in ``silver_fmt``), or else is the
    table of the usual name; ``fmt`` is that of the gold tables.  The shuffles are sized from the
    lookback for the duration of the refresh.  With ``versions``, a folder, both tables are kept there
    (see :mod:`tidewatch.versions`), and all dates of both change at once for their readers.
    """
    start = lookback_start(as_of, lookback_days)
    if sum(given is not None for given in (silver, silver_table, silver_path)) > 1:
        raise ValueError("give one of silver, silver_table and silver_path")
    if silver is None:
        if silver_table is None and silver_path is None:
            silver_table = fixed.SILVER_TABLE
        silver = read_table(spark, silver_table, silver_path, silver_fmt)
    recent = edits_since(silver, start)
    if recent.isEmpty():
        return Refresh(start, written=False)
    volume = gold_edit_volume_since(silver, start, warm_baseline, settings)
    users = user_activity(recent, settings.granularities, settings.by)
    shuffled = scan_bytes(recent) * EXPANSION * len(settings.granularities)
    with sized_shuffles(spark, shuffled, max_partitions):
        if versions:
            first = lit_date(start)
            changes = {volume_table: volume, user_table: users}
            changes = {t: Change(rows, lambda day: day >= first) for t, rows in changes.items()}
            publish(spark, versions, changes)
            return Refresh(start, written=True)
        for table, rows in ((volume_table, volume), (user_table, users)):
            options = {"path": f"{location}/{table}"} if location else {}
            write_by_date(rows, table, start, fmt, **options)
    return Refresh(start, written=True)
