"""Column expressions on single edits.  All of them are built-ins, so they stay in codegen."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewatch import fixed


def byte_delta(new: Column, old: Column) -> Column:
    """``new - old`` as int; null if either is null or the difference does not fit."""
    return F.try_subtract(new.cast("int"), old.cast("int"))


def byte_magnitude(delta: Column) -> Column:
    """Absolute value; null, not an error, for the one int that has no positive counterpart."""
    return F.when(delta >= 0, delta).otherwise(F.try_subtract(F.lit(0), delta))


def namespace_label(
    namespace: Column,
    labels: Mapping[int, str] = fixed.NAMESPACE_LABELS,
    other: str = fixed.OTHER_NAMESPACE,
) -> Column:
    entries = [F.lit(part) for entry in labels.items() for part in entry]
    return F.coalesce(F.try_element_at(F.create_map(*entries), namespace), F.lit(other))


def is_revert(comment: Column, pattern: str = fixed.REVERT_PATTERN) -> Column:
    """True if ``comment`` contains a revert word; false, never null, otherwise."""
    return F.coalesce(comment.rlike(pattern), F.lit(False))


def percent(part: Column, whole: Column) -> Column:
    """``part`` as a percentage of ``whole``; null if ``whole`` is zero."""
    return F.try_divide(part, whole) * 100


def editor_label(user: Column, bot: Column, marker: str = fixed.BOT_MARKER) -> Column:
    return F.concat(user, F.when(bot, F.lit(marker)).otherwise(F.lit("")))
