"""Source records -> typed columns, source metadata and an ingest stamp."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewatch.schemas import EDIT_MESSAGE, PAGE_MESSAGE, SOURCE_FILE


def typed_records(records: DataFrame, schema: StructType) -> DataFrame:
    """Parse ``value`` with ``schema`` and keep where and when the record came from.

    A value that is no JSON object gives a row of nulls, and a mistyped field gives a null field:
    nothing is dropped here.  Records of files that say which one (``source_file``) keep that, too.
    """
    origin = [SOURCE_FILE] if SOURCE_FILE in records.columns else []
    return records.select(
        F.from_json(F.col("value").cast("string"), schema).alias("message"),
        F.col("timestamp").alias("kafka_timestamp"),
        "offset",
        "partition",
        *origin,
    ).select(
        "message.*",
        "kafka_timestamp",
        "offset",
        "partition",
        *origin,
        F.current_timestamp().alias("ingested_at"),
    )


def bronze_edits(records: DataFrame) -> DataFrame:
    return typed_records(records, EDIT_MESSAGE)


def bronze_page_events(records: DataFrame) -> DataFrame:
    return typed_records(records, PAGE_MESSAGE)
