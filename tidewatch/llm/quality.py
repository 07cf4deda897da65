"""Quality by ordinal regression: hashed-text weights shared by all grades, ordered thresholds.

P(grade <= j) = sigmoid(threshold_j - w.x): one weight vector over hashed words and a few traits of
the text, and thresholds that stay in order because their gaps are exponentials. The fit averages the
weights of a fixed number of shards after each round.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm.common import held_out, stored, table, texts

# The model is fitted on so many rated rows at most, those of the smallest hashes of their ids.
FIT_ROWS = 30_000
SLOTS = 1 << 16
SHARDS = 8
ROUNDS = 6
RATE = 0.3
PENALTY = 1e-6
SPAN_CHARS = 1 << 20
KNOWN_WORDS = 200_000

_WORD = re.compile(r"\w+|[^\w\s]+")
_CUT = re.compile(r"\s")


@dataclass
class Ordinal:
    """Weights of the hashed slots and the thresholds between grades, ascending."""

    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, slots: np.ndarray, values: np.ndarray) -> np.ndarray:
        """P(grade > j) for each threshold j."""
        z = float(self.weights[slots] @ values)
        return 1 / (1 + np.exp(np.clip(self.thresholds - z, -30, 30)))


class Slots(dict):
    """Slots of words, hashed once each."""

    def __missing__(self, word: str) -> int:
        if len(self) > KNOWN_WORDS:
            self.clear()
        slot = zlib.crc32(word.encode("utf-8", "surrogatepass")) % SLOTS
        self[word] = slot
        return slot


def _level(share: float) -> int:
    return min(int(share * 20), 19)


def _traits(n: int, marks: int, distinct: int, upper: int, chars: int, lines: Counter) -> list[str]:
    """Traits of a text as words that no text has: how long, mixed, loud and repetitive it is."""
    total = sum(lines.values())
    again = total - len(lines)
    top = max(lines.values(), default=0)
    return [
        f"\0length {int(np.log2(n + 1))}",
        f"\0marks {_level(marks / max(n, 1))}",
        f"\0distinct {_level(distinct / max(n, 1))}",
        f"\0upper {_level(upper / max(chars, 1))}",
        f"\0word {min(chars // max(n, 1), 30)}",
        f"\0lines {_level(again / max(total, 1))} {min(top, 5)}",
    ]


def featurise(text: str, known: Slots) -> tuple[np.ndarray, np.ndarray]:
    """Slots and values of a whole text: damped counts of words of length one, traits in full."""
    counts: Counter = Counter()
    n = marks = upper = start = 0
    lines: Counter = Counter(x for x in text.split("\n") if x.strip())
    while True:
        cut = _CUT.search(text, start + SPAN_CHARS) if len(text) - start > SPAN_CHARS else None
        span = text[start : cut.start()] if cut else text[start:]
        words = _WORD.findall(span)
        n += len(words)
        counts.update(words)
        if not cut:
            break
        start = cut.start()
    for word, times in counts.items():
        if not word[0].isalnum():
            marks += times
        elif len(word) > 1 and word.isupper():
            upper += times * len(word)
    slots = np.fromiter((known[w.lower()] for w in counts), np.int64, len(counts))
    values = np.log1p(np.fromiter(counts.values(), float, len(counts)))
    values /= np.sqrt((values**2).sum()) or 1.0
    traits = _traits(n, marks, len(counts), upper, len(text), lines)
    slots = np.concatenate([slots, [known[x] for x in traits]]).astype(np.int64)
    return slots, np.concatenate([values, np.full(len(traits), 0.5)])


_ROW_DDL = "shard int, grade int, slots binary, values binary"


def _rated(docs: DataFrame, ratings: DataFrame, fit_rows: int) -> DataFrame:
    """Features of at most ``fit_rows`` rated rows; of several with one id, that of the smallest text."""
    ids = F.col("doc_id").cast("long")
    known = (
        ratings.where("doc_id is not null and grade is not null")
        .where(~held_out(ids))
        .groupBy(ids.alias("rated_id"))
        .agg(F.min(F.col("grade").cast("int")).alias("grade"))
    )
    order = F.xxhash64("rated_id")
    # At most fit_rows rows of two numbers, so the broadcast has a bound.
    sample = F.broadcast(stored(known.orderBy(order, "rated_id").limit(fit_rows), "ratings"))
    rows = texts(docs).join(sample, F.col("doc_id") == F.col("rated_id"))
    rows = rows.groupBy("doc_id", "grade").agg(F.min("text").alias("text"))
    rows = rows.select(F.pmod(F.xxhash64("doc_id", "text"), F.lit(SHARDS)).alias("shard"), "grade", "text")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Slots()
        for batch in batches:
            shards, grades, whole = (c.to_pylist() for c in batch.columns)
            found = [featurise(text, known) for text in whole]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(shards, pa.int32()),
                    pa.array(grades, pa.int32()),
                    pa.array([s.astype("<i4").tobytes() for s, _ in found], pa.binary()),
                    pa.array([v.astype("<f4").tobytes() for _, v in found], pa.binary()),
                ],
                ["shard", "grade", "slots", "values"],
            )

    return stored(rows.mapInArrow(build, _ROW_DDL), "rated")


def train_shard(
    rows: list[tuple[int, np.ndarray, np.ndarray]], weights: np.ndarray, free: np.ndarray, rate: float
) -> tuple[np.ndarray, np.ndarray]:
    """One pass of stochastic gradient over ``rows`` (grade, slots, values).

    ``free`` holds the first threshold and the logarithms of the gaps to the next ones.
    """
    weights, free = weights.copy(), free.copy()
    for grade, slots, values in rows:
        thresholds = free[0] + np.concatenate([[0.0], np.cumsum(np.exp(free[1:]))])
        z = weights[slots] @ values
        up = 1 / (1 + np.exp(np.clip(z - thresholds, -30, 30)))  # P(grade <= j)
        high = up[grade] if grade < len(up) else 1.0
        low = up[grade - 1] if grade > 0 else 0.0
        p = max(high - low, 1e-6)
        d_high = high * (1 - high) if grade < len(up) else 0.0
        d_low = low * (1 - low) if grade > 0 else 0.0
        # Gradients of log p by the thresholds on both sides, and by z.
        by_threshold = np.zeros(len(up))
        if grade < len(up):
            by_threshold[grade] += d_high / p
        if grade > 0:
            by_threshold[grade - 1] -= d_low / p
        by_z = np.clip((d_low - d_high) / p, -5, 5)
        np.add.at(weights, slots, rate * (by_z * values - PENALTY * weights[slots]))
        by_free = np.concatenate(
            [[by_threshold.sum()], np.cumsum(by_threshold[::-1])[::-1][1:] * np.exp(free[1:])]
        )
        free += 0.1 * rate * np.clip(by_free, -5, 5)
    return weights, free


def fit(
    docs: DataFrame, ratings: DataFrame, *, grades: int, fit_rows: int = FIT_ROWS, rounds: int = ROUNDS
) -> Ordinal:
    """Learn from ``ratings`` (``doc_id``, ``grade`` from 0 to ``grades`` - 1).

    Rows whose crc32(id) mod 5 is 0 are never used. At most ``fit_rows`` rated rows are, in
    ``SHARDS`` shards; each round passes every shard once and averages the weights of the shards,
    ``SHARDS`` arrays of ``SLOTS`` numbers. Grades outside the range are brought into it. Without
    rated rows every text gets the same grade.
    """
    rows = _rated(docs, ratings, fit_rows)
    weights, free = np.zeros(SLOTS), np.zeros(grades - 1)
    free[0] = -(grades - 2) / 2

    for round_ in range(rounds):
        now, rate = (weights, free), RATE / (1 + round_)

        def train(batches: Iterator[pa.RecordBatch], now=now, rate=rate) -> Iterator[pa.RecordBatch]:
            shards: dict[int, list] = {}
            for batch in batches:
                for shard, grade, slots, values in zip(
                    *[c.to_pylist() for c in batch.columns], strict=True
                ):
                    row = (
                        min(max(grade, 0), grades - 1),
                        np.frombuffer(slots, "<i4"),
                        np.frombuffer(values, "<f4").astype(float),
                    )
                    shards.setdefault(shard, []).append(row)
            for found in shards.values():
                order = np.random.default_rng(7).permutation(len(found))
                w, f = train_shard([found[i] for i in order], *now, rate)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([len(found)], pa.int64()),
                        pa.array([w.astype("<f4").tobytes()], pa.binary()),
                        pa.array([f.tobytes()], pa.binary()),
                    ],
                    ["n", "weights", "free"],
                )

        dealt = rows.repartition(SHARDS, "shard").sortWithinPartitions("shard", "slots")
        parts = dealt.mapInArrow(train, "n long, weights binary, free binary").collect()
        total = sum(p["n"] for p in parts)
        if not total:
            break
        weights = sum(p["n"] / total * np.frombuffer(p["weights"], "<f4").astype(float) for p in parts)
        free = sum(p["n"] / total * np.frombuffer(p["free"]) for p in parts)
    return Ordinal(weights, free[0] + np.concatenate([[0.0], np.cumsum(np.exp(free[1:]))]))


def grade_documents(docs: DataFrame, model: Ordinal) -> DataFrame:
    """``doc_id, expected_grade, tails`` of each row of ``docs`` (``doc_id, text``).

    ``tails`` has P(grade >= 1), P(grade >= 2) and so on; their sum is the expected grade. Whole texts
    count; null ones count as empty and are graded by their traits. Repeated rows are graded each; an
    empty table gives an empty result.
    """
    small = Ordinal(model.weights.astype(np.float32), model.thresholds)

    def grade(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Slots()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                tails = [small.tails(*featurise(x, known)) for x in some.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        some.column(0),
                        pa.array([float(x.sum()) for x in tails], pa.float64()),
                        pa.array([x.tolist() for x in tails], pa.list_(pa.float64())),
                    ],
                    ["doc_id", "expected_grade", "tails"],
                )

    return texts(docs).mapInArrow(
        grade, "doc_id long, expected_grade double, tails array<double>"
    )


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grades 0 (poor), 1 (good but toxic), 2 (good), from the two labels."""
    labels = table(spark, sf_dir, "labels")
    grade = F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).when(F.col("quality") == 1, 2)
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, labels.select("doc_id", grade.alias("grade")), grades=3)
    return grade_documents(docs, model).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "expected_grade",
        F.col("tails")[0].alias("p_good"),
        F.col("tails")[1].alias("p_best"),
        (F.col("tails")[0] >= 0.5).alias("kept"),
    )
