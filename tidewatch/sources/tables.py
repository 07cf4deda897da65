"""Table scans, tables read as streams, and SQL text over DataFrames."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date
from typing import Any

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamReader
from pyspark.sql.types import StructType

from tidewatch.functions import lit_date, lit_moment

# Storage-only partition column of the silver table, so that a lookback reads its days only.
SILVER_PARTITION = "edit_date"


# Input of one micro-batch of a file stream unless the caller sets a limit: a replay of a large
# table then runs as many batches, and a failure repeats one of them only.
BATCH_BYTES = 2**40


def reader_for(
    spark: SparkSession, stream: bool, options: Mapping[str, str | int]
) -> DataFrameReader | DataStreamReader:
    """A batch or stream reader for files, the latter with a bounded micro-batch."""
    if not stream:
        return spark.read.options(**options)
    limits = {"maxFilesPerTrigger", "maxBytesPerTrigger"} & options.keys()
    bound = {} if limits else {"maxBytesPerTrigger": BATCH_BYTES}
    return spark.readStream.options(**bound, **options)


def read_table(
    spark: SparkSession, table: str | None = None, path: str | None = None, fmt: str = "parquet"
) -> DataFrame:
    return spark.read.table(table) if table else spark.read.format(fmt).load(path)


def stream_table(
    spark: SparkSession,
    table: str | None = None,
    path: str | None = None,
    schema: StructType | None = None,
    fmt: str = "parquet",
    **options: str | int,
) -> DataFrame:
    """An append-only table, by name or folder, as a stream.  A file format read by folder needs
    its schema."""
    reader = reader_for(spark, True, options)
    if table:
        return reader.table(table)
    reader = reader.format(fmt)
    return (reader.schema(schema) if schema else reader).load(path)


def edits_since(silver: DataFrame, start: date) -> DataFrame:
    """Edits at or after ``start``.  Where the table is partitioned by day, only those days are
    listed and read."""
    recent = silver.filter(F.col("edit_timestamp") >= lit_moment(start))
    if SILVER_PARTITION in silver.columns:
        recent = recent.filter(F.col(SILVER_PARTITION) >= lit_date(start))
    return recent


def read_silver(
    spark: SparkSession,
    table: str | None = None,
    path: str | None = None,
    fmt: str = "parquet",
    start: date | None = None,
) -> DataFrame:
    """The silver table, from ``start`` on if given, without its storage-only column."""
    silver = read_table(spark, table, path, fmt)
    return (silver if start is None else edits_since(silver, start)).drop(SILVER_PARTITION)


def run_sql(
    spark: SparkSession, text: str, args: Mapping[str, Any] | None = None, **tables: DataFrame
) -> DataFrame:
    """Run SQL text.  ``{name}`` stands for a DataFrame passed by that name, ``:name`` for a value
    in ``args``; neither is spliced into the text."""
    return spark.sql(text, args=dict(args or {}), **tables)
