"""Packing documents into windows: counts of length combinations by non-negative least squares.

Documents are tokenised and cut at multiples of the window; only the last pieces are shorter. Their
histogram (at most one bin for each length below the window) goes to the driver, where shallow
combinations of lengths that fill a window exactly are listed, and how often to use each is solved
as a non-negative least-squares problem against the histogram. The counts are rounded down, and what
is left is packed greedily, length by length. The plan consists of runs of equal windows, so its size
depends on the window alone; every piece finds its place from its rank among the pieces of its
length. Ranks are counted within tasks and added up over tasks, so no length is gathered anywhere.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewatch.llm.common import stored, table, texts
from tidewatch.llm.tokens import encoder

WINDOW = 2048
# Combinations of three lengths in the least-squares problem, those of the most frequent lengths.
TRIPLES = 6000
STEPS = 400
# Documents encoded together.
DOCS = 2048

_PIECES_DDL = (
    "doc_id long, start long, length int, ids_crc32 long, doc_tokens long, part int, nth long"
)


def cut_documents(docs: DataFrame, *, tokenizer: str, end_id: int, window: int = WINDOW) -> DataFrame:
    """Pieces of the token ids of ``docs``: full windows, then what is left of each document.

    Returns ``doc_id, start, length, ids_crc32, doc_tokens``, the task (``part``) that cut the piece
    and its rank there among pieces of its length (``nth``). Null texts count as empty and give the
    end id alone; repeated rows are cut as often as they occur.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen, tokenize = TaskContext.get().partitionId(), Counter(), encoder(tokenizer)
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            for at in range(0, batch.num_rows, DOCS):
                some = batch.slice(at, DOCS)
                rows = []
                found = tokenize.encode(some.column(1).to_pylist())
                for doc, ids in zip(some.column(0).to_pylist(), found, strict=True):
                    ids += end
                    total = len(ids) // 4
                    for start in range(0, total, window):
                        piece = ids[4 * start : 4 * (start + window)]
                        length = len(piece) // 4
                        rows.append(
                            (doc, start, length, zlib.crc32(piece), total, part, seen[length])
                        )
                        seen[length] += 1
                kinds = [pa.int64()] * 2 + [pa.int32()] + [pa.int64()] * 2 + [pa.int32(), pa.int64()]
                names = [name.split()[0] for name in _PIECES_DDL.split(", ")]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                    names,
                )

    return texts(docs).mapInArrow(cut, _PIECES_DDL)


def combinations(histogram: np.ndarray, triples: int = TRIPLES) -> np.ndarray:
    """Ascending combinations of two or three present lengths that fill the window exactly.

    ``histogram[n]`` counts pieces of length n; the window is its last index. Of two-piece rows the
    first column is 0. The number of rows depends on the window and ``triples`` alone.
    """
    window = len(histogram) - 1
    here = histogram > 0
    low = np.arange(1, window // 2 + 1)
    low = low[here[low] & here[window - low]]
    pairs = np.stack([np.zeros_like(low), low, window - low], 1)
    a, b = np.meshgrid(np.arange(1, window // 3 + 1), np.arange(1, window // 2 + 1), indexing="ij")
    a, b = a.ravel(), b.ravel()
    c = window - a - b
    fine = (a <= b) & (b <= c)
    a, b, c = a[fine], b[fine], c[fine]
    supply = np.minimum(np.minimum(histogram[a], histogram[b]), histogram[c])
    best = np.argsort(-supply, kind="stable")[:triples]
    best = best[supply[best] > 0]
    return np.concatenate([pairs, np.stack([a[best], b[best], c[best]], 1)]).astype(np.int64)


def solve(histogram: np.ndarray, combos: np.ndarray, steps: int = STEPS) -> np.ndarray:
    """How often to use each combination: x >= 0 that brings its lengths near the histogram.

    Accelerated projected gradient; the problem is sparse, a combination touches three bins.
    """
    target = histogram.astype(float)
    target[0] = 0.0
    x = np.zeros(len(combos))
    if not len(combos):
        return x

    def apply(v: np.ndarray) -> np.ndarray:
        made = np.zeros(len(histogram))
        for column in combos.T:
            made += np.bincount(column, v, len(histogram))
        made[0] = 0.0
        return made

    probe = np.ones(len(combos))
    for _ in range(20):
        probe = apply(probe)[combos].sum(1)
        scale = np.linalg.norm(probe)
        probe /= scale
    scale *= 1.05
    y, t = x, 1.0
    for _ in range(steps):
        ahead = np.maximum(0.0, y - (apply(y) - target)[combos].sum(1) / scale)
        t_next = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = ahead + (t - 1) / t_next * (ahead - x)
        x, t = ahead, t_next
    return x


def _fill(left: np.ndarray, room: int) -> list[int]:
    """Lengths that together fill ``room`` as well as what is ``left`` allows, exactly if they can.

    One, two or three lengths that fit exactly are tried first, then the longest that fits is taken.
    """
    out: list[int] = []
    left = left.copy()
    while room > 0:
        if left[room]:
            return [*out, room]
        low = np.arange(1, room // 2 + 1)
        enough = np.where(low * 2 == room, 2, 1)
        exact = low[(left[low] >= enough) & (left[room - low] > 0)]
        if len(exact):
            return [*out, int(room - exact[0]), int(exact[0])]
        there = np.flatnonzero(left[: room + 1])
        if not len(there):
            return out
        longest = int(there[-1])
        out.append(longest)
        left[longest] -= 1
        room -= longest
    return out


@dataclass
class Plan:
    """Runs of windows: ``runs[i]`` is (lengths in a window, how many such windows)."""

    window: int
    runs: list[tuple[tuple[int, ...], int]]

    def places(self) -> dict[str, np.ndarray]:
        """For each length, runs of ranks: from which rank, in which window the run begins, where."""
        ranks, first, rows = Counter(), 0, []
        for lengths, times in self.runs:
            offset = 0
            for length in lengths:
                rows.append((length, ranks[length], first, offset))
                ranks[length] += times
                offset += length
            first += times
        rows.sort()
        columns = np.array(rows, np.int64).reshape(-1, 4).T
        return dict(zip(("length", "rank", "sequence", "offset"), columns, strict=True))


def plan_windows(histogram: np.ndarray, triples: int = TRIPLES) -> Plan:
    """A plan for all pieces of ``histogram`` (``histogram[n]`` pieces of length n; the last index is
    the window)."""
    window = len(histogram) - 1
    left = histogram.astype(np.int64).copy()
    left[0] = 0
    runs: list[tuple[tuple[int, ...], int]] = []

    def use(lengths: list[int], times: int) -> None:
        runs.append((tuple(lengths), times))
        for length in lengths:
            left[length] -= times

    if left[window]:
        use([window], int(left[window]))
    combos = combinations(left, triples)
    found = solve(left, combos)
    for i in np.argsort(-found, kind="stable"):
        lengths = [int(x) for x in combos[i] if x]
        most = min(int(left[n]) // k for n, k in Counter(lengths).items())
        times = min(int(found[i] + 1e-6), most)
        if times > 0:
            use(lengths, times)
    while left.any():
        longest = int(np.flatnonzero(left)[-1])
        left[longest] -= 1
        lengths = [longest, *_fill(left, window - longest)]
        left[longest] += 1
        use(lengths, min(int(left[n]) // k for n, k in Counter(lengths).items()))
    return Plan(window, runs)


def pack(
    docs: DataFrame, *, tokenizer: str, end_id: int, window: int = WINDOW, triples: int = TRIPLES
) -> DataFrame:
    """Place every token of ``docs`` (``doc_id, text``) into sequences of at most ``window`` tokens.

    Returns one row for each piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset``. Only documents longer than a window are cut, at multiples of it. Sequences are numbered
    from 0; the pieces of one follow each other from offset 0 without a gap. An empty table gives an
    empty result; null texts count as empty, null ids stay null, repeated rows are packed each.
    """
    pieces = stored(
        cut_documents(docs, tokenizer=tokenizer, end_id=end_id, window=window), "pieces"
    )
    counts = pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    counts = stored(counts, "piece-counts")
    histogram = np.zeros(window + 1, np.int64)
    for row in counts.groupBy("length").agg(F.sum("n").alias("n")).collect():
        histogram[row["length"]] = row["n"]
    places = plan_windows(histogram, triples).places()
    # Runs of one length lie together; a rank is found by its place in (length, rank) order.
    step = int(histogram.max(initial=0)) + 1
    keys = places["length"] * step + places["rank"]

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        at = np.searchsorted(keys, length.to_numpy("int64") * step + rank.to_numpy(), "right") - 1
        return pd.DataFrame(
            {
                "sequence_id": places["sequence"][at] + rank.to_numpy() - places["rank"][at],
                "offset": places["offset"][at],
            }
        )

    before = Window.partitionBy("length").orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = counts.select(
        "part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")
    )
    ranked = pieces.join(offsets, ["part", "length"]).withColumn(
        "placed", place("length", F.col("before") + F.col("nth"))
    )
    return ranked.select(
        "doc_id",
        "start",
        F.col("length").cast("long").alias("length"),
        "ids_crc32",
        "doc_tokens",
        "placed.sequence_id",
        "placed.offset",
    )


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(
        table(spark, sf_dir, "documents"),
        tokenizer=public_tokenizers.path("byte_bpe_50k.json"),
        end_id=1,
    )
