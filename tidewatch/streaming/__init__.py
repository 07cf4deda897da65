from tidewatch.streaming.anomaly import anomaly_stream
from tidewatch.streaming.jobs import (
    anomaly_job,
    bronze_job,
    ingest_job,
    late_edits_job,
    silver_job,
    silver_stream,
    volume_job,
)
from tidewatch.streaming.volume import late_counts, volume_stream

__all__ = [
    "anomaly_job",
    "anomaly_stream",
    "bronze_job",
    "ingest_job",
    "late_counts",
    "late_edits_job",
    "silver_job",
    "silver_stream",
    "volume_job",
    "volume_stream",
]
