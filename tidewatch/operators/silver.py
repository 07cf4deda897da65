"""Bronze edits -> one feature row per edit.  Filter and projection only: no shuffle, no state."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch import fixed
from tidewatch.functions import (
    byte_delta,
    byte_magnitude,
    is_revert,
    namespace_label,
    percent,
)
from tidewatch.schemas import SOURCE_FILE
from tidewatch.session import scan_bytes

RECORD_METADATA = ("offset", "partition", "kafka_timestamp", SOURCE_FILE)


def has_identity(bronze: DataFrame) -> DataFrame:
    """The quality gate: rows without id or time go no further."""
    return bronze.filter(F.col("id").isNotNull() & F.col("timestamp").isNotNull())


# A table of labels up to this size goes to all tasks; a larger one is joined by shuffling.
LOOKUP_BYTES = 64 * 2**20


def labelled(edits: DataFrame, labels: DataFrame, at_most: int = LOOKUP_BYTES) -> DataFrame:
    """``edits`` with ``label__`` from the table ``labels`` (``namespace, label``): null where the
    namespace is null or not in the table.

    A namespace that is there twice fails the query, one that is null there is left out.  The table is
    broadcast only if what it is read from is no larger than ``at_most``; otherwise both sides are
    shuffled, where adaptive execution splits a namespace that many edits have.
    """
    number = F.col("namespace").cast("int")
    said = F.concat(F.lit("two labels for namespace "), F.col("namespace__").cast("string"))
    single = (
        labels.where(number.isNotNull())
        .groupBy(number.alias("namespace__"))
        .agg(F.first("label").alias("label__"), F.count("*").alias("times__"))
        .withColumn("label__", F.when(F.col("times__") > 1, F.raise_error(said)).otherwise(F.col("label__")))
        .select("namespace__", "label__")
    )
    if scan_bytes(labels) <= at_most:
        single = F.broadcast(single)
    return edits.join(single, edits["namespace"] == F.col("namespace__"), "left").drop("namespace__")


def edit_features(
    bronze: DataFrame,
    labels: Mapping[int, str] | DataFrame = fixed.NAMESPACE_LABELS,
    other_label: str = fixed.OTHER_NAMESPACE,
    revert_pattern: str = fixed.REVERT_PATTERN,
) -> DataFrame:
    """Time, size, namespace and revert features of the edits that pass the gate.

    ``labels`` is a map, or a table ``namespace, label`` that is looked up (:func:`labelled`).
    """
    # a cast, as timestamp_seconds raises on values too large for a timestamp
    timed = has_identity(bronze).withColumn("edit_timestamp", F.col("timestamp").cast("timestamp"))
    sized = timed.withColumn("bytes_delta", byte_delta(F.col("length_new"), F.col("length_old")))
    if isinstance(labels, DataFrame):
        sized, label = labelled(sized, labels), F.coalesce(F.col("label__"), F.lit(other_label))
    else:
        label = namespace_label(F.col("namespace"), labels, other_label)
    return sized.select(
        *[name for name in bronze.columns if name not in RECORD_METADATA],
        "edit_timestamp",
        F.hour("edit_timestamp").alias("edit_hour"),
        F.dayofweek("edit_timestamp").alias("edit_day_of_week"),
        "bytes_delta",
        byte_magnitude(F.col("bytes_delta")).alias("abs_bytes_delta"),
        label.alias("namespace_label"),
        is_revert(F.col("comment"), revert_pattern).alias("is_revert"),
        F.current_timestamp().alias("silver_processed_at"),
    )


def feature_report(silver: DataFrame) -> DataFrame:
    """Rows, reverts and bot edits with their percentages, in one pass; one row."""
    counts = silver.agg(
        F.count("*").alias("total_rows"),
        F.count_if("is_revert").alias("revert_rows"),
        F.count_if("bot").alias("bot_rows"),
    )
    return counts.withColumns(
        {
            "revert_pct": percent(F.col("revert_rows"), F.col("total_rows")),
            "bot_pct": percent(F.col("bot_rows"), F.col("total_rows")),
        }
    )


def namespace_breakdown(silver: DataFrame) -> DataFrame:
    """Rows per namespace label, most frequent first."""
    return silver.groupBy("namespace_label").count().orderBy(F.desc("count"), "namespace_label")
