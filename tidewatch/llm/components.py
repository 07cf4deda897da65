"""Connected components of a distributed edge list by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import stored


def _rewired(pairs: DataFrame) -> DataFrame:
    """Each ``(u, v)`` with the smallest of u and its neighbours in ``pairs``, as ``low``."""
    # Written before the join, so that both its sides can be split by adaptive execution.
    lows = stored(pairs.groupBy("u").agg(F.min("v").alias("low")), "lows")
    return pairs.join(lows.withColumnRenamed("u", "w"), F.col("u") == F.col("w")).select(
        "u", "v", F.least("u", "low").alias("low")
    )


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    wired = _rewired(both).where("v > u and v != low")
    return wired.select(F.col("v").alias("u"), F.col("low").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    wired = _rewired(down)
    kept = wired.select(F.col("v").alias("u"), F.col("low").alias("v"))
    own = down.groupBy("u").agg(F.min("v").alias("v"))
    return kept.unionByName(own).where("u != v")


def components(edges: DataFrame) -> DataFrame:
    """``vertex, root`` of every vertex of ``edges`` (``u, v`` of an ordered type, no nulls).

    The root is the smallest vertex of the component and is not listed itself. Repeated edges, loops
    and both directions are fine; an empty list gives an empty result. Each round shuffles the edges
    by one end, combined on the map side; a vertex of many edges is on the side of the join that
    adaptive execution splits.
    """
    edges = edges.where("u != v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    )
    edges, before = stored(edges.distinct(), "edges"), None
    while True:
        state = edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if state == before:
            return edges.select(F.col("u").alias("vertex"), F.col("v").alias("root"))
        before = state
        large = _large_star(edges).distinct()
        edges = stored(_small_star(large).distinct(), "edges")
