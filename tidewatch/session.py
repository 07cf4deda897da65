"""Session settings the library relies on, and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import DataFrame, SparkSession

_RUNTIME_SETTINGS = {
    # hour, day of week, date and day boundaries are those of UTC
    "spark.sql.session.timeZone": "UTC",
    # runtime coalescing, skew splitting and size-checked broadcast conversion
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # JSON objects may repeat a key; the last value wins instead of the row being undecodable
    "spark.sql.variant.allowDuplicateKeys": "true",
}


# Shuffle data per task that is sorted or hashed in memory without spilling.
SHUFFLE_TASK_BYTES = 128 * 2**20
# Beyond this many, keeping track of the shuffle blocks costs the driver more than spilling does.
MAX_SHUFFLE_PARTITIONS = 32_768

_UNITS = ("B", "KiB", "MiB", "GiB", "TiB", "PiB", "EiB")


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings above to ``spark`` and return it."""
    for key, value in _RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def scan_bytes(frame: DataFrame) -> int:
    """Estimated size of what ``frame`` reads, from the file listing; runs no job."""
    plan = frame.sparkSession.sql("EXPLAIN COST SELECT * FROM {frame}", frame=frame).first()[0]
    number, unit = re.search(r"sizeInBytes=([\d.]+(?:E\+?\d+)?) (\w+)", plan).groups()
    return int(float(number) * 1024 ** _UNITS.index(unit))


_PARTITIONS = "spark.sql.shuffle.partitions"


def size_shuffles(
    spark: SparkSession, data_bytes: int, at_most: int = MAX_SHUFFLE_PARTITIONS
) -> int:
    """Raise the number of shuffle partitions to what ``data_bytes`` needs; returns the number.

    It is never lowered: with more partitions than needed, small ones are merged at run time, but
    too few of them spill.  Beyond ``at_most`` the tasks get larger instead of more.
    """
    needed = min(-(-data_bytes // SHUFFLE_TASK_BYTES), at_most)
    partitions = max(int(spark.conf.get(_PARTITIONS)), needed)
    spark.conf.set(_PARTITIONS, partitions)
    return partitions


@contextmanager
def sized_shuffles(
    spark: SparkSession, data_bytes: int, at_most: int = MAX_SHUFFLE_PARTITIONS
) -> Iterator[int]:
    """:func:`size_shuffles` for the duration of a block; the setting before is restored."""
    before = spark.conf.get(_PARTITIONS)
    try:
        yield size_shuffles(spark, data_bytes, at_most)
    finally:
        spark.conf.set(_PARTITIONS, before)


_STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
_ON_DISK = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Streams started in this block keep their state on the executors' disks instead of their heaps;
    a stream that was started before goes on with what its checkpoint says."""
    before = spark.conf.get(_STATE_STORE)
    spark.conf.set(_STATE_STORE, _ON_DISK)
    try:
        yield
    finally:
        spark.conf.set(_STATE_STORE, before)


@cache
def _local_folder() -> tempfile.TemporaryDirectory:
    """Removed when this process ends."""
    return tempfile.TemporaryDirectory(prefix="run-", dir="/tmp", ignore_cleanup_errors=True)


def scratch_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, which every executor can reach.

    A machine-local folder is used only in local mode and only when that setting is absent.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.conf.get("spark.master", "")
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        base = _local_folder().name
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
