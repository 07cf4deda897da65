"""Sources of raw events and of topic records.  Batch and streaming differ in the reader only."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.schemas import RECORD, SOURCE_FILE, TOPIC_MESSAGE
from tidewatch.sources.tables import reader_for

# Security and offset settings of the message bus.
KAFKA_DEFAULTS = {
    "kafka.security.protocol": "SASL_SSL",
    "kafka.sasl.mechanism": "PLAIN",
    "kafka.ssl.endpoint.identification.algorithm": "https",
    "startingOffsets": "earliest",
    "failOnDataLoss": "false",
}
# Records of one micro-batch unless the caller sets a limit: without it, the first run over a topic
# would be one batch of everything it holds.
BATCH_RECORDS = 200_000_000


def kafka_options(servers: str, **options: str) -> dict[str, str]:
    """Connector options; credentials and rate limits (``maxOffsetsPerTrigger``) go in as options,
    and so does ``minPartitions``, which splits a topic partition that holds most of the data."""
    limits = {"maxOffsetsPerTrigger": str(BATCH_RECORDS)}
    return {**KAFKA_DEFAULTS, **limits, "kafka.bootstrap.servers": servers, **options}


def kafka_records(
    spark: SparkSession, topic: str, options: Mapping[str, str], stream: bool = True
) -> DataFrame:
    """Records of one topic: ``value, timestamp, offset, partition``.  Needs the Kafka connector."""
    reader = spark.readStream if stream else spark.read
    loaded = reader.format("kafka").option("subscribe", topic).options(**options).load()
    return loaded.select(*RECORD.names)


def raw_text(
    spark: SparkSession, path: str, stream: bool = False, **options: str | int
) -> DataFrame:
    """Raw events from text files, one JSON text per line, in a column ``value``."""
    return reader_for(spark, stream, options).text(path)


def raw_records(
    spark: SparkSession, topic: str, options: Mapping[str, str], stream: bool = True
) -> DataFrame:
    """Raw events that arrive as records of a topic, in a column ``value``."""
    return kafka_records(spark, topic, options, stream).select(F.col("value").cast("string"))


def sse_blocks(
    spark: SparkSession,
    path: str,
    stream: bool = False,
    line_break: str = "\n",
    **options: str | int,
) -> DataFrame:
    """A recorded server-sent event stream from text files, one event (the lines up to a blank one)
    per row.  A file is not split, as blank lines are found from its beginning only."""
    return raw_text(spark, path, stream, lineSep=2 * line_break, **options)


def sse_payloads(blocks: DataFrame) -> DataFrame:
    """The event texts of :func:`sse_blocks`: what follows ``data:`` in the lines of a row, joined by
    line breaks.

    Other lines (event names, ids, comments) are dropped, and so are events without a data line.
    """
    lines = F.split("value", "\r\n|\n|\r")
    data = F.filter(lines, lambda line: line.startswith("data:"))
    payload = F.array_join(F.transform(data, lambda x: F.regexp_extract(x, "^data: ?(.*)$", 1)), "\n")
    return blocks.filter(F.size(data) > 0).select(payload.alias("value"))


def topic_file_records(
    spark: SparkSession,
    path: str,
    topic: str,
    stream: bool = False,
    source_file: bool = False,
    **options: str | int,
) -> DataFrame:
    """Records of one topic from the folder a topic file sink writes.

    Files have no offset and partition, so both are null; the timestamp is the file's.  With
    ``source_file`` each record says which file it is from, and bronze keeps it.
    """
    origin = [F.col("_metadata.file_path").alias(SOURCE_FILE)] if source_file else []
    rows = reader_for(spark, stream, options).schema(TOPIC_MESSAGE).parquet(path)
    return rows.filter(F.col("topic") == topic).select(
        F.col("value").cast("binary").alias("value"),
        F.col("_metadata.file_modification_time").alias("timestamp"),
        F.lit(None).cast("bigint").alias("offset"),
        F.lit(None).cast("int").alias("partition"),
        *origin,
    )
