"""Rolling baseline and anomaly flags on a stream of closed windows.

A range frame is no streaming operator, so each series keeps the windows of its last hour in keyed
state.  A window waits there until the watermark has passed its start, when every earlier window has
come, and is then compared with what the state holds; a timer wakes the series for it.  So the order of
arrival makes no difference, and a restart goes on from the checkpoint.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from math import sqrt

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructField, StructType

from tidewatch import fixed
from tidewatch.streaming.volume import DELAY

_STATE = "epochs array<bigint>, totals array<bigint>, done bigint"
_FLAGS = [
    "window_start timestamp",
    "total_edits bigint",
    "rolling_mean_edits double",
    "rolling_stddev_edits double",
    "anomaly_threshold double",
    "is_anomaly boolean",
    "z_score double",
]
_NEVER = -(2**62)


def spread(values: Sequence[int]) -> tuple[float, float]:
    """Mean and sample deviation (0.0 of one value) in one ordered pass, as the batch frame adds up."""
    mean = squares = 0.0
    for n, value in enumerate(values, 1):
        gap = value - mean
        step = gap / n
        mean += step
        squares += gap * (gap - step)
    exact = sum(values) / len(values)
    return exact, sqrt(squares / (len(values) - 1)) if len(values) > 1 else 0.0


class _Baseline(StatefulProcessor):
    """State of a series: the windows of the baseline and those that wait, by start."""

    def __init__(self, keys: list[str], seconds: int, sigma: float) -> None:
        self.keys, self.seconds, self.sigma = keys, seconds, sigma

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("windows", _STATE)

    def _load(self) -> tuple[dict[int, int], int]:
        found = self.state.get()
        if found is None:
            return {}, _NEVER
        epochs, totals, done = found
        return dict(zip(epochs, totals, strict=True)), done

    def _store(self, windows: dict[int, int], done: int) -> None:
        epochs = sorted(windows)
        self.state.update((epochs, [windows[epoch] for epoch in epochs], done))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        windows, done = self._load()
        for batch in rows:
            for epoch, total in zip(batch["epoch"], batch["total_edits"], strict=True):
                if epoch > done:
                    windows[int(epoch)] = int(total)
        waiting = [epoch for epoch in windows if epoch > done]
        if waiting:
            self._store(windows, done)
            self.handle.registerTimer(min(waiting) * 1000)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        windows, done = self._load()
        passed = timerValues.getCurrentWatermarkInMs()
        order = sorted(windows)
        ready = [epoch for epoch in order if epoch > done and epoch * 1000 <= passed]
        out, first = [], 0
        for epoch in ready:
            while order[first] < epoch - self.seconds:
                first += 1
            frame = [windows[e] for e in order[first : order.index(epoch, first) + 1]]
            total, (mean, deviation) = windows[epoch], spread(frame)
            threshold = mean + self.sigma * deviation
            z = (total - mean) / deviation if deviation > 0 else 0.0
            start = pd.Timestamp(epoch, unit="s", tz="UTC")
            out.append((*key, start, total, mean, deviation, threshold, total > threshold, z))
        if ready:
            done = ready[-1]
            self._store({e: n for e, n in windows.items() if e >= done - self.seconds}, done)
        waiting = [epoch for epoch in order if epoch > done]
        if waiting:
            self.handle.registerTimer(waiting[0] * 1000)
        names = [*self.keys, *[field.split()[0] for field in _FLAGS]]
        yield pd.DataFrame(out, columns=names)

    def close(self) -> None:
        pass


def anomaly_stream(
    volume: DataFrame,
    delay: str = DELAY,
    baseline_seconds: int = fixed.BASELINE_SECONDS,
    sigma: float = fixed.SIGMA,
    by: Sequence[str] = (),
) -> DataFrame:
    """``window_duration``, the columns ``by``, and the window's start, edits, baseline and flag.

    ``volume`` is a stream of closed windows; a window is flagged ``delay`` after its start has been
    passed by the stream, so that windows may come out of order by less than that.  Values are those of
    the batch baseline over the same windows.  (Spark's watermark begins at 1970: older windows are late.)  The state of a series is its windows of ``baseline_seconds``
    and of the delay; series are spread over tasks by ``window_duration`` and ``by``.
    """
    keys = ["window_duration", *by]
    fields = {field.name: field for field in volume.schema}
    schema = StructType([fields[key] for key in keys])
    for name, kind in (field.split() for field in _FLAGS):
        schema.add(StructField(name, StructType.fromDDL(f"{name} {kind}")[name].dataType))
    timed = volume.select(*keys, "window_start", "total_edits").withWatermark("window_start", delay)
    return (
        timed.withColumn("epoch", F.unix_seconds("window_start"))
        .groupBy(*keys)
        .transformWithStateInPandas(
            statefulProcessor=_Baseline(keys, baseline_seconds, float(sigma)),
            outputStructType=schema,
            outputMode="Append",
            timeMode="EventTime",
        )
    )
