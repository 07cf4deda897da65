from tidewatch.sources.messages import (
    kafka_options,
    kafka_records,
    raw_records,
    raw_text,
    sse_blocks,
    sse_payloads,
    topic_file_records,
)
from tidewatch.sources.tables import read_silver, read_table, run_sql, stream_table

__all__ = [
    "kafka_options",
    "kafka_records",
    "raw_records",
    "raw_text",
    "read_silver",
    "read_table",
    "run_sql",
    "sse_blocks",
    "sse_payloads",
    "stream_table",
    "topic_file_records",
]
