"""Settings, shuffle sizing and the scratch folder."""

from __future__ import annotations

from pathlib import Path

import pytest

from tidewatch import session


class Settings(dict):
    def set(self, key, value):
        self[key] = value


class Session:
    def __init__(self, **settings):
        self.conf = Settings({key.replace("_", "."): value for key, value in settings.items()})


def test_scratch_is_below_the_shared_folder():
    shared = Session(spark_checkpoint_dir="s3://shared/x/", spark_master="spark://host:7077")
    first, second = (session.scratch_folder(shared, "job") for _ in range(2))
    assert first.startswith("s3://shared/x/job-") and first != second


def test_no_local_scratch_on_a_cluster():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.scratch_folder(Session(spark_master="spark://host:7077"), "job")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.scratch_folder(Session(spark_master="local-cluster[2,1,1024]"), "job")
    for master in ("local", "local[2]", "local[*]"):
        made = session.scratch_folder(Session(spark_master=master), "job")
        assert made.startswith("/tmp/run-")


def test_shuffles_are_sized_upwards_only(spark):
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    try:
        assert session.size_shuffles(spark, 10) == int(before)
        assert session.size_shuffles(spark, 10 * session.SHUFFLE_TASK_BYTES * 10 + 1) == 101
        assert session.size_shuffles(spark, 0) == 101
        assert session.size_shuffles(spark, 10**18) == session.MAX_SHUFFLE_PARTITIONS
        assert session.size_shuffles(spark, 10**18, at_most=40_000) == 40_000
    finally:
        spark.conf.set(key, before)


def test_sizing_ends_with_its_block(spark):
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    with pytest.raises(ValueError), session.sized_shuffles(spark, 2**40) as partitions:
        assert int(spark.conf.get(key)) == partitions == 2**40 // session.SHUFFLE_TASK_BYTES
        raise ValueError
    assert spark.conf.get(key) == before


def test_scan_bytes(spark, folder):
    spark.range(100_000).write.parquet(f"{folder}/t")
    size = sum(file.stat().st_size for file in Path(f"{folder}/t").glob("*.parquet"))
    assert session.scan_bytes(spark.read.parquet(f"{folder}/t")) == pytest.approx(size, rel=0.01)
