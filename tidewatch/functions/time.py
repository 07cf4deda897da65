"""Window arithmetic on columns, and cut-off times computed on the driver."""

from __future__ import annotations

from datetime import UTC, date, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewatch import fixed


def window_epoch(timestamp: Column, seconds: Column) -> Column:
    """Start, in epoch seconds, of the epoch-aligned window of that length holding ``timestamp``."""
    epoch = F.unix_seconds(timestamp)
    return epoch - F.pmod(epoch, seconds)


def lit_moment(moment: date) -> Column:
    """A UTC date or datetime as a timestamp of the session (a date means its midnight)."""
    return F.lit(str(moment)).cast("timestamp")


def _utc(moment: datetime) -> datetime:
    return moment.astimezone(UTC).replace(tzinfo=None) if moment.tzinfo else moment


def utc_date(moment: date) -> date:
    """The UTC date of a date or datetime; one without zone is taken as UTC."""
    return _utc(moment).date() if isinstance(moment, datetime) else moment


def lit_date(moment: date) -> Column:
    """:func:`utc_date` as a column, to bound a partition column with."""
    return F.lit(str(utc_date(moment))).cast("date")


def lookback_start(as_of: datetime | None = None, days: int = fixed.LOOKBACK_DAYS) -> date:
    """First date a refresh recomputes: that many whole days before the UTC date of ``as_of``."""
    return (_utc(as_of or datetime.now(UTC)) - timedelta(days=days)).date()


def floor_minutes(moment: datetime, minutes: int = fixed.NOW_FLOOR_MINUTES) -> datetime:
    whole = _utc(moment).replace(second=0, microsecond=0)
    return whole - timedelta(minutes=whole.minute % minutes)


def slice_start(as_of: datetime | None = None, hours: int = fixed.DEFAULT_HOURS) -> datetime:
    """First window start of a dashboard slice (UTC, without zone)."""
    if not fixed.MIN_HOURS <= hours <= fixed.MAX_HOURS:
        raise ValueError(f"hours must be {fixed.MIN_HOURS} to {fixed.MAX_HOURS}, not {hours}")
    return floor_minutes(as_of or datetime.now(UTC)) - timedelta(hours=hours)
