"""The physical plans: one scan, no unpartitioned window, no per-row Python, no products."""

from __future__ import annotations

import pytest

from tidewatch.operators import ingest
from tidewatch.operators.windows import user_activity
from tidewatch.plans import fixture
from tidewatch.plans.gold import gold_edit_volume
from tidewatch.plans.registry import QUERIES, _silver, registered
from tidewatch.streaming import silver_stream

SF_DIR = "/root/testdata/sf0.001"
WRITING = {name for name in QUERIES if name.startswith(("stream", "refresh"))}
# results of one row, combined on the map side first
GLOBAL = {
    "silver_report", "time_range", "anomaly_summary", "volume_table_report", "user_table_report",
    "kpis", "slice_users",
}


def physical(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [name for name in QUERIES if name not in WRITING])
def test_no_costly_node(spark, name):
    plan = physical(registered()[name](spark, SF_DIR))
    for node in ("CartesianProduct", "NestedLoop", "EvalPython", "InPandas", "MapInArrow"):
        assert node not in plan
    assert ("SinglePartition" in plan) <= (name in GLOBAL)


def test_gold_is_one_scan_and_one_window(spark):
    plan = physical(gold_edit_volume(_silver(spark, SF_DIR)))
    assert plan.count("FileScan") == 1
    assert plan.count("Window [") == 1 and plan.count("Sort [") == 1
    assert plan.count("Exchange hashpartitioning(") == 3
    assert "props" not in plan.split("ReadSchema", 1)[1]


def test_activity_combines_before_each_shuffle(spark):
    plan = physical(user_activity(_silver(spark, SF_DIR)))
    assert plan.count("FileScan") == 1 and plan.count("Exchange hashpartitioning(") == 2
    assert "partial_count(1)" in plan and "partial_count(distinct title" in plan


def test_stream_steps_do_not_shuffle(spark):
    edits = fixture.edits(fixture.load_events(spark, SF_DIR))
    sent = ingest.messages(fixture.raw_events(fixture.load_events(spark, SF_DIR)))
    for frame in (silver_stream(edits), sent):
        assert "Exchange" not in physical(frame)
