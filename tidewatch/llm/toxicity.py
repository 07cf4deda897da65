"""Toxic passages: maximum-scoring segments over token log-odds, with extreme-value calibration.

Terms get log-odds of toxic against other documents under an informative Dirichlet prior. A linear
scan finds all maximal scoring segments of a text; how surprising a segment of some score is in a
text of some length follows the extreme-value law of local scores, with its two constants estimated
from background texts. Surprise, added up over the significant segments of a document, is turned
into a probability by a logistic fit on labelled rows that the counts have not seen.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm.common import KEY, held_out, row_key, stored, table, texts, with_rows

# The model is fitted on so many labelled rows at most, those of the smallest hashes of their ids.
FIT_ROWS = 40_000
# Terms in the model at most, those of the largest z-scores; fewer pass the test as a rule.
MODEL_TERMS = 20_000
LEAST_Z = 3.5
# Weight of the Dirichlet prior: this share of the counted documents, and so many at least.
PRIOR_SHARE, PRIOR_LEAST = 0.05, 50.0
# Beginnings of words are terms of their own, for inflected and compound forms.
BEGINNINGS = (5, 4)
# Distinct words whose scores a task remembers.
KNOWN_WORDS = 200_000
# What a term without evidence adds to a segment.
DRIFT = -0.15
# Expected number of equally good segments in a background text, below which one is significant.
E_VALUE = 0.05
# Where the two constants of the law are looked for; without hits in background texts they are 1, as
# for scores that are log-likelihood ratios.
RATES, SCALES = (0.25, 4.0), (1e-6, 1.0)
SPAN_CHARS = 1 << 20
# Distinct terms that a task counts before it passes them on.
COUNT_TERMS = 200_000

_WORD = re.compile(r"[^\W_]+(?:['’][^\W_]+)*")
_CUT = re.compile(r"\s")


@dataclass
class Model:
    """``scores`` of terms; the law of background segments (``rate``, ``scale``); the logistic fit."""

    scores: dict[str, float]
    rate: float = 1.0
    scale: float = 1.0
    weights: np.ndarray = field(default_factory=lambda: np.zeros(4))


def _terms(word: str) -> list[str]:
    """A word and its beginnings, which are marked."""
    return [word, *["^" + word[:n] for n in BEGINNINGS if len(word) > n]]


class Words(dict):
    """Scores of words, found once each: that of the word or else of its longest known beginning."""

    def __init__(self, scores: dict[str, float]) -> None:
        self.scores = scores

    def __missing__(self, word: str) -> float:
        if len(self) > KNOWN_WORDS:
            self.clear()
        found = next((self.scores[t] for t in _terms(word) if t in self.scores), 0.0)
        self[word] = found
        return found


def _spans(text: str) -> Iterator[tuple[int, str]]:
    start = 0
    while len(text) - start > SPAN_CHARS:
        cut = _CUT.search(text, start + SPAN_CHARS)
        if not cut:
            break
        yield start, text[start : cut.start()]
        start = cut.start()
    yield start, text[start:]


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments: (first, one after the last, score), in their order.

    One pass over the positive scores with a list of candidates; each carries the sum before it, the sum
    at its end, and a link to the last candidate before it with a smaller sum before it.  The search for
    the one to join with follows the links, so that a candidate is passed over once.
    """
    sums = np.concatenate([[0.0], np.cumsum(scores)])
    out: list[tuple[int, int, float, float]] = []
    links: list[int] = []
    for i in np.flatnonzero(scores > 0).tolist():
        first, before, after = i, float(sums[i]), float(sums[i + 1])
        at = len(out) - 1
        while True:
            while at >= 0 and out[at][2] >= before:
                at = links[at]
            if at < 0 or out[at][3] >= after:
                break
            first, before = out[at][0], out[at][2]
            del out[at:]
            at = links[at]
            del links[len(out) :]
        out.append((first, i + 1, before, after))
        links.append(at)
    return [(first, last, after - before) for first, last, before, after in out]


def token_scores(text: str, known: Words) -> tuple[np.ndarray, np.ndarray]:
    """Score and place (first character) of each token of a whole text."""
    scores, places = [], []
    for start, span in _spans(text):
        words = _WORD.findall(span.lower()) if span.isascii() else None
        if words is None:
            found = [(m.group().lower(), m.start()) for m in _WORD.finditer(span)]
            words, at = [w for w, _ in found], [a for _, a in found]
        else:
            at = None
        values = np.array([known[w] for w in words])
        if at is None and values.any():
            at = [m.start() for m in _WORD.finditer(span)]
        scores.append(values)
        places.append(np.array(at if at is not None else np.zeros(len(words), int)) + start)
    values = np.concatenate(scores)
    return np.where(values == 0, DRIFT, values), np.concatenate(places).astype(np.int64)


def features(scores: np.ndarray, model: Model) -> tuple[np.ndarray, list[tuple]]:
    """Of one text: what the logistic fit looks at, and its significant segments.

    A segment is (first token, one after the last, score, expected number by chance).
    """
    n = len(scores)
    found, surprise, best = [], 0.0, 0.0
    for first, last, score in segments(scores):
        log_chance = np.log(model.scale * max(n, 1)) - model.rate * score
        if log_chance < np.log(E_VALUE):
            found.append((first, last, score, float(np.exp(log_chance))))
            surprise -= log_chance
            best = max(best, -log_chance)
    hits = float((scores > 0).sum())
    return np.array([1.0, np.log1p(surprise), np.log1p(best), hits / max(n, 1) ** 0.5]), found


def _sample(labels: DataFrame, fit_rows: int) -> DataFrame:
    """Labelled ids to fit on, at most ``fit_rows``; ``half`` tells counting and fitting rows apart."""
    ids = F.col("doc_id").cast("long")
    known = (
        labels.where("doc_id is not null and toxic is not null")
        .where(~held_out(ids))
        .groupBy(ids.alias("label_id"))
        .agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    )
    order = F.xxhash64("label_id")
    return known.orderBy(order, "label_id").limit(fit_rows).withColumn("half", F.pmod(order, F.lit(2)))


_COUNTS = ("other_0", "toxic_0", "other_1", "toxic_1")


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of each half and label that hold a term."""
    counts = [Counter() for _ in _COUNTS]

    def rows() -> pa.RecordBatch:
        terms = list(set().union(*counts))
        columns = [pa.array([c[t] for t in terms], pa.int64()) for c in counts]
        for c in counts:
            c.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array(terms, pa.string()), *columns], ["term", *_COUNTS]
        )

    for batch in batches:
        for text, toxic, half in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            words: set[str] = set()
            for _, span in _spans(text):
                words.update(_WORD.findall(span.lower()))
            counts[2 * half + (toxic > 0)].update({t for word in words for t in _terms(word)})
            if sum(map(len, counts)) > COUNT_TERMS:
                yield rows()
    yield rows()


def _term_scores(counts: DataFrame, toxic: str, other: str, n_toxic: int, n_other: int) -> DataFrame:
    """``term, score, z`` of the terms that toxic documents hold significantly more often.

    Counts are numbers of documents, so that one document cannot make a term. The prior spreads its
    documents over the terms as all counted documents do.
    """
    n = n_toxic + n_other
    prior = max(PRIOR_LEAST, PRIOR_SHARE * n)
    y_toxic, y_other = F.expr(toxic), F.expr(other)
    alpha = (y_toxic + y_other) / n * prior
    held_toxic, held_other = y_toxic + alpha, y_other + alpha
    score = F.ln(held_toxic / (n_toxic + prior - held_toxic + 1e-3)) - F.ln(
        held_other / (n_other + prior - held_other + 1e-3)
    )
    z = score / F.sqrt(1 / held_toxic + 1 / held_other)
    return counts.where(y_toxic >= 3).select("term", score.alias("score"), z.alias("z"))


def _unpacked(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Places and scores of the hits of a text."""
    places, values = np.frombuffer(raw, "<i4"), np.frombuffer(raw, "<f4")
    half = len(values) // 2
    return places[:half], values[half:]


def _expanded(n: int, places: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Scores of ``n`` tokens from the places and scores of the hits among them."""
    scores = np.full(n, DRIFT)
    scores[places] = values
    return scores


def _rate(values: np.ndarray, times: np.ndarray, plain: int) -> float | None:
    """The root of E[exp(rate * score)] = 1 over hits with these scores and ``plain`` other tokens."""
    hits = times.sum()
    if not hits or (values * times).sum() + plain * DRIFT >= 0:
        return None

    def mean(rate: float) -> float:
        return ((np.exp(rate * values) * times).sum() + plain * np.exp(rate * DRIFT)) / (plain + hits)

    low, high = RATES
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if mean(middle) < 1 else (low, middle)
    return low


def _law(scored: DataFrame, model: Model) -> None:
    """Estimate ``rate`` and ``scale`` from the hits of background texts.

    The scale makes the expected number of texts with a segment above a middling score agree with the
    number seen. The driver gets a number for each distinct score, and two for each text.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hits = [_unpacked(raw)[1] for raw in batch.column("hits").to_pylist()]
            values, times = np.unique(np.concatenate(hits or [np.zeros(0)]), return_counts=True)
            columns = [pa.array(values.astype(float)), pa.array(times.astype(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, ["value", "times"])

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, raws = (batch.column(name).to_pylist() for name in ("n", "hits"))
            tops = [
                max((s for *_, s in segments(_expanded(n, *_unpacked(raw)))), default=0.0)
                for n, raw in zip(sizes, raws, strict=True)
            ]
            columns = [batch.column("n"), pa.array(tops, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, ["n", "top"])

    other = scored.where("toxic <= 0")
    counted = other.mapInArrow(count, "value double, times long").groupBy("value")
    counted = counted.agg(F.sum("times").alias("times")).orderBy("value").collect()
    values, times = (np.array([row[i] for row in counted], float) for i in (0, 1))
    tops = other.mapInArrow(best, "n long, top double").collect()
    tokens = sum(row["n"] for row in tops)
    rate = _rate(values, times, tokens - int(times.sum()))
    if rate is None:
        return
    model.rate = rate
    level = float(np.median([row["top"] for row in tops if row["top"] > 0]))
    above = sum(row["top"] >= level for row in tops)
    model.scale = float(np.clip(above / (tokens * np.exp(-rate * level)), *SCALES))


def logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1e-2, steps: int = 50) -> np.ndarray:
    """Weights of a logistic regression, by Newton steps."""
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + penalty * w
        hessian = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + penalty * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(
    docs: DataFrame,
    labels: DataFrame,
    *,
    fit_rows: int = FIT_ROWS,
    least_z: float = LEAST_Z,
    model_terms: int = MODEL_TERMS,
) -> Model:
    """Learn from ``labels`` (``doc_id, toxic``); rows whose crc32(id) mod 5 is 0 are never used.

    At most ``fit_rows`` labelled rows are used (of several with one id, that of the smallest text), in
    two halves: each is scored with the counts of the other to fit the calibration, the final terms
    come from both. Without rows of both kinds every text gets the same score.
    """
    # At most fit_rows rows of three numbers, so the broadcast has a bound.
    sample = F.broadcast(stored(_sample(labels, fit_rows), "labels"))
    rows = texts(docs).join(sample, F.col("doc_id") == F.col("label_id"))
    rows = rows.groupBy("label_id", "toxic", F.col("half").cast("int").alias("half"))
    rows = stored(rows.agg(F.min("text").alias("text")).select("text", "toxic", "half"), "labelled")
    n = [0] * 4
    for row in rows.groupBy("half", "toxic").agg(F.count(F.lit(1)).alias("n")).collect():
        n[2 * row["half"] + (row["toxic"] > 0)] += row["n"]
    counted = rows.mapInArrow(_count, "term string, " + ", ".join(f"{c} long" for c in _COUNTS))
    sums = counted.groupBy("term").agg(*[F.sum(c).alias(c) for c in _COUNTS])
    sums = stored(sums.where("toxic_0 + toxic_1 >= 3"), "terms")

    def terms(toxic: str, other: str, n_toxic: int, n_other: int) -> dict[str, float]:
        if not (n_toxic and n_other):
            return {}
        best = _term_scores(sums, toxic, other, n_toxic, n_other).where(F.col("z") >= least_z)
        best = best.orderBy(F.desc("z"), "term").limit(model_terms)
        return {r["term"]: r["score"] for r in best.collect()}

    other_half = [terms("toxic_1", "other_1", n[3], n[2]), terms("toxic_0", "other_0", n[1], n[0])]
    whole = terms("toxic_0 + toxic_1", "other_0 + other_1", n[1] + n[3], n[0] + n[2])
    model = Model(whole)

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = [Words(scores) for scores in other_half]
        for batch in batches:
            sizes, packed, kinds = [], [], []
            for text, toxic, half in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                scores = token_scores(text, known[half])[0]
                # The background tokens between hits all have the same score.
                hits = np.flatnonzero(scores > 0)
                sizes.append(len(scores))
                packed.append(hits.astype("<i4").tobytes() + scores[hits].astype("<f4").tobytes())
                kinds.append(toxic)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(sizes, pa.int64()),
                    pa.array(packed, pa.binary()),
                    pa.array(kinds, pa.int32()),
                ],
                ["n", "hits", "toxic"],
            )

    scored = stored(rows.mapInArrow(tokens, "n long, hits binary, toxic int"), "hits")
    if all((n[0] + n[2], n[1] + n[3])):
        _law(scored, model)

        def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                sizes, raws = (batch.column(name).to_pylist() for name in ("n", "hits"))
                x = [
                    features(_expanded(size, *_unpacked(raw)), model)[0].tolist()
                    for size, raw in zip(sizes, raws, strict=True)
                ]
                columns = [pa.array(x, pa.list_(pa.float64())), batch.column("toxic")]
                yield pa.RecordBatch.from_arrays(columns, ["x", "toxic"])

        # At most fit_rows rows of a few numbers.
        found = scored.mapInArrow(describe, "x array<double>, toxic int").collect()
        x = np.array([row["x"] for row in found])
        model.weights = logistic(x, np.array([float(row["toxic"] > 0) for row in found]))
    return model


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, row key, ``score`` and ``passages`` of each row of ``docs`` (``doc_id, text``).

    A passage is (first character, one after the last token's first character, score, expected
    number by chance). Whole texts are scored; null and empty ones get the score of a text without
    evidence. An empty table gives an empty result; other columns are no input.
    """
    kind = pa.list_(
        pa.struct(
            [
                ("first", pa.int64()),
                ("last", pa.int64()),
                ("score", pa.float64()),
                ("chance", pa.float64()),
            ]
        )
    )

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Words(model.scores)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                some = batch.slice(start, 256)
                scored, passages = [], []
                for text in some.column(3).to_pylist():
                    scores, places = token_scores(text, known)
                    x, found = features(scores, model)
                    scored.append(float(1 / (1 + np.exp(-np.clip(x @ model.weights, -30, 30)))))
                    passages.append(
                        [
                            {
                                "first": int(places[a]),
                                "last": int(places[b - 1]) + 1,
                                "score": s,
                                "chance": e,
                            }
                            for a, b, s, e in found
                        ]
                    )
                yield pa.RecordBatch.from_arrays(
                    [*some.columns[:3], pa.array(scored, pa.float64()), pa.array(passages, kind)],
                    ["doc_id", *KEY, "score", "passages"],
                )

    rows = row_key(texts(docs)).select("doc_id", *KEY, "text")
    return rows.mapInArrow(
        score,
        "doc_id long, doc__ long, tag__ long, score double, "
        "passages array<struct<first: long, last: long, score: double, chance: double>>",
    )


def drop_toxic(docs: DataFrame, labels: DataFrame, *, least: float = 0.5) -> DataFrame:
    """``docs`` without rows that score ``least`` or more, all columns as they were.

    A null text is an empty one; empty texts score as texts without evidence do. Rows equal in id and
    text stay or go together. Texts are scored whole, however long. Extra columns may have any name. An
    empty table gives an empty result; without labels of both kinds all rows score alike.
    """
    scored = score_documents(docs, fit(docs, labels))
    kept = scored.select(*KEY, (F.col("score") < least).alias("kept"))
    # Toxic rows only go by key; rows repeated in the table are none of this operator's business.
    gone = stored(kept.where("not kept").select(*KEY).distinct(), "toxic")
    return with_rows(docs).join(gone, KEY, "left_anti").select("original__.*")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels"))
    return score_documents(docs, model).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        F.size("passages").alias("n_passages"),
    )
