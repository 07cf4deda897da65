"""Rolling baseline over window rows, and the anomaly flag derived from it.

A window is compared with all windows that start in the ``baseline_seconds`` before it, itself
included.  Rows are cut into time chunks that are worked on in parallel; each chunk also receives
the rows of the baseline length before it, so every frame is complete and the result is the one a
single ordered pass would give.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tidewatch import fixed
from tidewatch.functions import percent

CHUNK_SECONDS = 86_400


def rolling_baseline(
    volume: DataFrame,
    baseline_seconds: int = fixed.BASELINE_SECONDS,
    chunk_seconds: int = CHUNK_SECONDS,
    by: Sequence[str] = (),
    more: Callable[[WindowSpec], Sequence[Column]] = lambda frame: (),
) -> DataFrame:
    """Add ``rolling_mean_edits`` and ``rolling_stddev_edits`` (0.0 where only one row is seen).

    With ``by``, each value of those columns is compared with its own past.  ``more`` gives further
    columns over the same frame.
    """

    def chunk_of(epoch):
        return epoch - F.pmod(epoch, F.lit(chunk_seconds))

    epoch = F.col("epoch")
    last_chunk = chunk_of(epoch + baseline_seconds)
    spread = (
        volume.withColumn("epoch", F.unix_seconds("window_start"))
        .withColumn("own_chunk", chunk_of(epoch))
        .withColumn(
            "chunk", F.explode(F.sequence("own_chunk", last_chunk, F.lit(chunk_seconds)))
        )
    )
    # both columns in one select: one sort and one window node
    frame = (
        Window.partitionBy("window_duration", "chunk", *by)
        .orderBy("epoch")
        .rangeBetween(-baseline_seconds, 0)
    )
    return (
        spread.select(
            *volume.columns,
            "own_chunk",
            "chunk",
            F.avg("total_edits").over(frame).alias("rolling_mean_edits"),
            F.coalesce(F.stddev_samp("total_edits").over(frame), F.lit(0.0)).alias(
                "rolling_stddev_edits"
            ),
            *more(frame),
        )
        .filter(F.col("chunk") == F.col("own_chunk"))
        .drop("own_chunk", "chunk")
    )


def _above(sigma: float) -> Callable[[WindowSpec], Sequence[Column]]:
    """Whether a window is above mean + sigma * deviation of its frame, in whole numbers.

    With n windows of sum s and sum of squares q, and sigma = a / b, that is (n x - s) > 0 and
    (n x - s)^2 (n - 1) b^2 > a^2 n (n q - s^2).
    """
    ratio = Fraction(str(sigma))
    whole = lambda column: column.cast("decimal(38,0)")

    def columns(frame: WindowSpec) -> Sequence[Column]:
        edits = F.col("total_edits")
        n, s, q = (
            whole(x.over(frame))
            for x in (F.count(edits), F.sum(edits), F.sum(whole(edits) * whole(edits)))
        )
        gap = whole(n * whole(edits)) - s
        left = whole(whole(gap * gap) * (n - 1)) * F.lit(ratio.denominator**2)
        right = whole(whole(n * q) - whole(s * s)) * whole(n * F.lit(ratio.numerator**2))
        return [((gap > 0) & (whole(left) > whole(right))).alias("above__")]

    return columns


def flag_anomalies(
    volume: DataFrame,
    baseline_seconds: int = fixed.BASELINE_SECONDS,
    sigma: float = fixed.SIGMA,
    chunk_seconds: int = CHUNK_SECONDS,
    by: Sequence[str] = (),
    exact: bool = False,
) -> DataFrame:
    """Add the rolling baseline, ``anomaly_threshold``, ``is_anomaly`` and ``z_score``.

    The flag compares floating-point numbers, so a window that lies on its threshold may have either.
    With ``exact`` it compares whole numbers: such a window is no anomaly.
    """
    edits, mean, spread = (
        F.col(name) for name in ("total_edits", "rolling_mean_edits", "rolling_stddev_edits")
    )
    more = _above(sigma) if exact else lambda frame: ()
    above = F.col("above__") if exact else edits > F.col("anomaly_threshold")
    return (
        rolling_baseline(volume, baseline_seconds, chunk_seconds, by, more)
        .withColumn("anomaly_threshold", mean + F.lit(float(sigma)) * spread)
        .withColumns(
            {
                "is_anomaly": above,
                "z_score": F.when(spread > 0, (edits - mean) / spread).otherwise(0.0),
            }
        )
        .drop("above__")
    )


def anomaly_summary(volume: DataFrame) -> DataFrame:
    """Windows, anomalous windows and their percentage; one row."""
    return volume.agg(
        F.count("*").alias("total_windows"),
        F.count_if("is_anomaly").alias("anomalous_windows"),
    ).withColumn("anomalous_pct", percent(F.col("anomalous_windows"), F.col("total_windows")))
