"""Sinks: append streams, topic messages, and tables whose recent partitions are replaced."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from contextlib import contextmanager
from datetime import date
from threading import Lock

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tidewatch.sources.tables import read_table


def table_exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table)


def require_schema(frame: DataFrame, target: StructType) -> None:
    """Raise unless ``frame`` has the columns and types of ``target``, in any order."""
    ours = {field.name: field.dataType for field in frame.schema}
    theirs = {field.name: field.dataType for field in target}
    if ours != theirs:
        differing = sorted(
            name for name in ours.keys() | theirs.keys() if ours.get(name) != theirs.get(name)
        )
        raise ValueError(f"schema differs from that of the target in: {', '.join(differing)}")


# Error conditions of a folder without a table in it; the last one is that of a stream's folder to
# which no batch has brought a row yet.
_NOTHING_WRITTEN = {
    "PATH_NOT_FOUND",
    "UNABLE_TO_INFER_SCHEMA",
    "DELTA_TABLE_NOT_FOUND",
    "_LEGACY_ERROR_TEMP_1134",
}


def _existing_schema(spark, table, path, fmt) -> StructType | None:
    if table and not table_exists(spark, table):
        return None
    try:
        return read_table(spark, table, path, fmt).schema
    except AnalysisException as error:
        if error.getCondition() in _NOTHING_WRITTEN:
            return None
        raise


def append_stream(
    stream: DataFrame,
    checkpoint: str,
    table: str | None = None,
    path: str | None = None,
    fmt: str = "parquet",
    partition_by: Iterable[str] = (),
    evolve: bool = False,
) -> StreamingQuery:
    """Start appending what ``stream`` has now to a table or folder; stops when that is done.

    Progress is kept in ``checkpoint``, so a rerun takes up new input only.  A target of another
    schema is refused before anything is written, unless ``evolve`` is set.
    """
    if not evolve:
        known = _existing_schema(stream.sparkSession, table, path, fmt)
        if known is not None:
            require_schema(stream, known)
    writer = (
        stream.writeStream.format(fmt)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.toTable(table) if table else writer.start(path)


def write_messages(
    messages: DataFrame, checkpoint: str, fmt: str = "kafka", path: str | None = None, **options
) -> StreamingQuery:
    """Send a stream of ``topic, key, value`` rows to their topics.

    The Kafka sink reads the topic from the row; any file format gets one folder per topic.
    """
    writer = (
        messages.writeStream.format(fmt)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .options(**options)
        .trigger(availableNow=True)
    )
    return writer.start() if fmt == "kafka" else writer.partitionBy("topic").start(path)


def await_all(queries: Iterable[StreamingQuery]) -> None:
    """Wait for queries that run side by side; if one fails, the others are stopped."""
    queries = list(queries)
    try:
        for query in queries:
            query.awaitTermination()
    finally:
        for query in queries:
            if query.isActive:
                query.stop()


def laid_out(frame: DataFrame) -> DataFrame:
    """Rows as they are stored: few files per date, a hot date split, and sorted within each file,
    so that a slice of some hours skips the row groups of the rest of the day."""
    return frame.hint("rebalance", "date").sortWithinPartitions(
        "date", "window_duration", "window_start"
    )


def create_table(frame: DataFrame, table: str, fmt: str = "parquet", **options: str) -> None:
    """Write the whole table, partitioned by date, with whatever schema ``frame`` has."""
    (
        laid_out(frame)
        .write.format(fmt)
        .partitionBy("date")
        .mode("overwrite")
        .option("overwriteSchema", "true")
        .options(**options)
        .saveAsTable(table)
    )


# Replacements of this process follow each other, as their mode belongs to the session.
_OVERWRITING = Lock()


@contextmanager
def _dynamic_overwrite(spark: SparkSession) -> Iterator[None]:
    # inserting into a catalog table reads this mode from the session only: as a writer option it
    # is ignored, and the insert would empty the other partitions
    key = "spark.sql.sources.partitionOverwriteMode"
    with _OVERWRITING:
        before = spark.conf.get(key)
        spark.conf.set(key, "dynamic")
        try:
            yield
        finally:
            spark.conf.set(key, before)


def _dates_where(spark: SparkSession, table: str, wanted: Column) -> dict[str, str]:
    """Existing partitions whose ``day`` is ``wanted``, one short entry per day from the catalog: the
    value of the partition, and the date as Spark writes it.  Dates are compared by Spark, as those
    beyond the year 9999 are no dates in Python."""
    value = F.substring_index("partition", "=", -1)
    found = (
        spark.sql(f"SHOW PARTITIONS {table}")
        .select(value.alias("value"))
        .withColumn("day", F.expr("try_cast(value AS date)"))
        .where(wanted)
        .select("value", F.col("day").cast("string").alias("day"))
    )
    return {row.value: row.day for row in found.collect()}


def _replace(
    frame: DataFrame, table: str, fits: Callable[[Column], Column], refused: str
) -> None:
    """Replace the partitions whose date ``fits`` by ``frame``; a row of another date fails the write.

    A dynamic partition overwrite, followed by removing the partitions for which ``frame`` has no
    rows; each partition is replaced as a whole, but not all of them at once.
    """
    spark = frame.sparkSession
    target = spark.table(table)
    require_schema(frame, target.schema)
    existing = _dates_where(spark, table, fits(F.col("day")))
    checked = F.when(fits(F.col("date")), F.col("date")).otherwise(
        F.raise_error(F.concat(F.lit(f"{refused}: "), F.col("date").cast("string")))
    )
    written = Observation()
    rows = (
        laid_out(frame.withColumn("date", checked))
        # as text: one short entry per written day, of any year
        .observe(written, F.collect_set(F.col("date").cast("string")).alias("days"))
        .select(*target.columns)
    )
    with _dynamic_overwrite(spark):
        rows.write.mode("overwrite").insertInto(table)
    kept = set(written.get["days"] or ())
    _remove_dates(spark, table, [value for value, day in existing.items() if day not in kept])


def _replace_where(frame: DataFrame, table: str, condition: str) -> None:
    """What the lines above do, as one transaction of Delta."""
    writer = laid_out(frame).write.format("delta").partitionBy("date").mode("overwrite")
    writer.option("replaceWhere", condition).saveAsTable(table)


def replace_dates(frame: DataFrame, table: str, start: date, fmt: str = "parquet") -> None:
    """Replace the partitions ``date >= start`` of ``table`` by ``frame``; older ones stay.

    Delta does it in one transaction; for plain files see :func:`_replace`.  A row before ``start``
    fails the write.
    """
    if fmt == "delta":
        _replace_where(frame, table, f"date >= '{start}'")
        return
    first = F.lit(str(start)).cast("date")
    _replace(frame, table, lambda day: day >= first, f"row before {start}")


def replace_listed_dates(
    frame: DataFrame, table: str, days: Sequence[str], fmt: str = "parquet"
) -> None:
    """Replace the partitions of these dates (as Spark writes them) by ``frame``; all others keep
    their files.  A row of another date fails the write."""
    listed = [F.lit(day).cast("date") for day in days]
    if fmt == "delta":
        _replace_where(frame, table, "date IN (%s)" % ", ".join(f"'{day}'" for day in days))
        return
    _replace(frame, table, lambda day: day.isin(*listed), "row of a date that is not replaced")


def _remove_dates(spark: SparkSession, table: str, values: list[str]) -> None:
    """Remove whole partitions with their rows, whether the table is managed or external.

    Dropping the partitions of a managed table removes their files.  Those of an external one are
    emptied first.
    """
    if not values:
        return
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Type'").first()
    if described.data_type == "EXTERNAL":
        columns = [name for name in spark.table(table).columns if name != "date"]
        nothing = spark.createDataFrame([], spark.table(table).select(*columns).schema)
        for value in values:
            spark.sql(
                f"INSERT OVERWRITE TABLE {table} PARTITION (date = '{value}') "
                "SELECT * FROM {rows}",
                rows=nothing,
            )
    listed = ", ".join(f"PARTITION (date = '{value}')" for value in values)
    spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {listed}")


def write_by_date(
    frame: DataFrame, table: str, start: date, fmt: str = "parquet", **options: str
) -> None:
    """Create ``table`` on the first run, replace its dates from ``start`` on later ones."""
    if table_exists(frame.sparkSession, table):
        replace_dates(frame, table, start, fmt)
    else:
        create_table(frame, table, fmt, **options)
