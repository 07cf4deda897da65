"""Exact top-k by inner product: branch and bound over blocks of dimensions.

Vectors are stored in chunks in a vertical layout, one block of dimensions after the other. A task
compares a block of queries with the chunks dealt to it: products are accumulated dimension block by
dimension block, and after each block the candidates are kept whose sum so far, plus the most that
the remaining lengths of both vectors allow (Cauchy-Schwarz), can still reach the query's k-th best.
When few are left, they are compacted to a list of pairs. Only the best k of each query leave a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewatch.llm.common import stored, table

CHUNK = 2048
QUERIES = 2048
DIMENSIONS = 16
# Chunks that one task compares with a block of queries.
CHUNKS_PER_TASK = 16
# Share of candidates left at which they are compacted to pairs.
SPARSE = 0.1
LEAST_LONG, MOST_LONG = -(2**63), 2**63 - 1

_CHUNK_DDL = "part int, nth int, dim int, size int, ids array<long>, vectors binary"


def quantised(vector: Column, scale: float = 256.0) -> Column:
    """floor(scale * x) of each component, as double; null for vectors that take no part."""
    value = vector.cast("array<double>")
    bad = F.exists(value, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    floors = F.transform(value, lambda x: F.floor(x * F.lit(scale)).cast("double"))
    return F.when(~F.coalesce(bad, F.lit(True)), floors)


def _chunks(rows: DataFrame) -> DataFrame:
    """Chunks of (``id``, ``vector``): vectors of one length, vertical, as 64-bit floats."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, nth, open_ = TaskContext.get().partitionId(), 0, {}

        def close(dim: int) -> pa.RecordBatch:
            nonlocal nth
            ids, vectors = open_.pop(dim)
            columns = np.array(vectors, "<f8").reshape(len(ids), dim).T
            row = [part, nth, dim, len(ids), ids, columns.tobytes()]
            nth += 1
            kinds = [pa.int32()] * 4 + [pa.list_(pa.int64()), pa.binary()]
            return pa.RecordBatch.from_arrays(
                [pa.array([x], k) for x, k in zip(row, kinds, strict=True)],
                [x.split()[0] for x in _CHUNK_DDL.split(", ")],
            )

        for batch in batches:
            for i, vector in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                ids, vectors = open_.setdefault(len(vector), ([], []))
                ids.append(i)
                vectors.append(vector)
                if len(ids) == CHUNK:
                    yield close(len(vector))
        for dim in list(open_):
            yield close(dim)

    return rows.mapInArrow(build, _CHUNK_DDL)


class _Best:
    """The best k of each query so far: scores, ids and rows, unused places last."""

    def __init__(self, queries: int, k: int) -> None:
        self.k = k
        self.scores = np.full((queries, k), -np.inf)
        self.ids = np.zeros((queries, k), np.int64)

    @property
    def least(self) -> np.ndarray:
        return self.scores[:, -1]

    def offer(self, query: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """Take in candidates (parallel arrays); ties go to the smaller id."""
        good = scores >= self.least[query]
        query, scores, ids = query[good], scores[good], ids[good]
        if not len(query):
            return
        touched = np.unique(query)
        held = self.scores[touched] > -np.inf
        query = np.concatenate([query, np.repeat(touched, held.sum(1))])
        scores = np.concatenate([scores, self.scores[touched][held]])
        ids = np.concatenate([ids, self.ids[touched][held]])
        order = np.lexsort((ids, -scores, query))
        query, scores, ids = query[order], scores[order], ids[order]
        first = np.searchsorted(query, touched)
        place = np.arange(len(query)) - np.repeat(first, np.diff(np.append(first, len(query))))
        top = place < self.k
        self.scores[touched] = -np.inf
        self.scores[query[top], place[top]] = scores[top]
        self.ids[query[top], place[top]] = ids[top]


def _rest(vectors: np.ndarray) -> np.ndarray:
    """Length of what is left of each (vertical) vector from each block of dimensions on."""
    squares = np.add.reduceat(vectors**2, np.arange(0, len(vectors), DIMENSIONS))
    return np.sqrt(np.cumsum(squares[::-1], 0)[::-1])


def search_chunk(
    best: _Best, queries: np.ndarray, vectors: np.ndarray, ids: np.ndarray, own: np.ndarray
) -> None:
    """Offer all vectors of a chunk to ``best``; both matrices are vertical.

    ``own[i]`` is the place of query i in this chunk, or -1. Candidates are dropped only when their
    bound is below the k-th best, so ties stay.
    """
    dim, n = vectors.shape
    if dim == 0:
        scores = np.zeros((queries.shape[1], n))
        scores[own >= 0, own[own >= 0]] = -np.inf
        at = np.nonzero(scores > -np.inf)
        best.offer(at[0], scores[at], ids[at[1]])
        return
    rest_q, rest_v = _rest(queries), _rest(vectors)
    scores = np.zeros((queries.shape[1], n))
    least = best.least
    for block, start in enumerate(range(0, dim, DIMENSIONS)):
        scores += queries[start : start + DIMENSIONS].T @ vectors[start : start + DIMENSIONS]
        if start + DIMENSIONS >= dim:
            break
        bound = scores + rest_q[block + 1][:, None] * rest_v[block + 1] * (1 + 1e-9) + 1e-6
        alive = bound >= least[:, None]
        left = int(alive.sum())
        if left == 0:
            return
        if left < SPARSE * alive.size:
            _search_pairs(best, queries, vectors, ids, own, scores, alive, block + 1)
            return
    here = np.flatnonzero(own >= 0)
    scores[here, own[here]] = -np.inf
    k = min(best.k, n)
    # The k-th best of the chunk; all that tie with it are offered, the order by id decides.
    kth = np.partition(scores, n - k, axis=1)[:, n - k]
    at = np.nonzero((scores >= np.maximum(kth, least)[:, None]) & (scores > -np.inf))
    best.offer(at[0], scores[at], ids[at[1]])


def _search_pairs(best, queries, vectors, ids, own, scores, alive, block) -> None:
    """The same from block ``block`` on, for the pairs that are left."""
    query, vector = np.nonzero(alive)
    keep = own[query] != vector
    query, vector = query[keep], vector[keep]
    sums = scores[query, vector]
    rest_q, rest_v, least = _rest(queries), _rest(vectors), best.least
    for b in range(block, len(rest_q)):
        span = slice(b * DIMENSIONS, (b + 1) * DIMENSIONS)
        sums = sums + np.einsum("ij,ij->j", queries[span][:, query], vectors[span][:, vector])
        if b + 1 < len(rest_q):
            bound = sums + rest_q[b + 1][query] * rest_v[b + 1][vector] * (1 + 1e-9) + 1e-6
            keep = bound >= least[query]
            query, vector, sums = query[keep], vector[keep], sums[keep]
    best.offer(query, sums, ids[vector])


def _large(queries: np.ndarray, vectors: np.ndarray) -> bool:
    """Whether products may exceed what 64-bit floats hold exactly."""
    if not queries.size or not vectors.size:
        return False
    return float(np.abs(queries).max()) * float(np.abs(vectors).max()) * len(queries) >= 2.0**52


def _search_exactly(queries, vectors, ids, own, k):
    """Brute force in integers of any size, for components too large for floats."""
    q = [[int(x) for x in column] for column in queries.T]
    v = [[int(x) for x in column] for column in vectors.T]
    for i, query in enumerate(q):
        scored = [
            (-sum(a * b for a, b in zip(query, x, strict=True)), int(ids[j]))
            for j, x in enumerate(v)
            if own[i] != j
        ]
        for score, j in sorted(scored)[:k]:
            yield i, min(max(-score, LEAST_LONG), MOST_LONG), j


_ASKED_DDL = f"{_CHUNK_DDL}, places array<int>, blocks long, groups long"


def _cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks reduced to the vectors in their ``places``."""
    for batch in batches:
        for i in range(batch.num_rows):
            part = batch.slice(i, 1)
            row = part.to_pylist()[0]
            places, whole = row["places"], np.frombuffer(row["vectors"], "<f8")
            matrix = whole.reshape(row["dim"], row["size"])[:, places]
            made = {
                "size": [len(places)],
                "ids": [[row["ids"][place] for place in places]],
                "vectors": [matrix.tobytes()],
            }
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(made[f.name], f.type) if f.name in made else part.column(f.name)
                    for f in batch.schema
                ],
                batch.schema.names,
            )


_TOP_DDL = "part int, nth int, place int, query_id long, vec_id long, score long"


def top_k(
    vectors: DataFrame,
    is_query: Column,
    *,
    k: int = 5,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    scale: float = 256.0,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` best other rows of each query row.

    ``is_query`` is a condition on ``id_column``. The score is the inner product of the quantised
    vectors, ties go to the smaller id. Vectors that are null or hold a null or non-finite component
    take no part; only vectors of the same length are compared, empty ones score 0. Rows with a null
    id are left out. Of rows repeated under an id each is a query and a candidate for the others.
    Scores beyond the range of a long become its limits. An empty table gives an empty result.
    """
    rows = vectors.select(
        F.col(f"`{id_column}`").cast("long").alias("id"),
        quantised(F.col(f"`{vector_column}`"), scale).alias("vector"),
    )
    rows = rows.where("id is not null and vector is not null")
    chunks = stored(_chunks(rows), "chunks")
    # How many blocks of queries and groups of chunks there are for each length of vectors.
    named = chunks.select("dim", "part", "nth", F.posexplode("ids").alias("place", id_column))
    wanted = stored(
        named.where(is_query).select("dim", "part", "nth", "place", F.col(id_column).alias("query")),
        "queries",
    )
    sizes = (
        chunks.groupBy("dim")
        .agg(F.ceil(F.count(F.lit(1)) / CHUNKS_PER_TASK).alias("groups"))
        .join(
            wanted.groupBy("dim").agg(F.ceil(F.count(F.lit(1)) / QUERIES).alias("blocks")), "dim"
        )
    )
    spread = F.xxhash64("part", "nth")
    dealt = chunks.join(sizes, "dim").withColumn("group", F.pmod(spread, "groups"))
    candidates = dealt.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    # Queries keep the place of their row, so that it is told apart from others of its id. They are cut
    # out of their chunks once; only they go to every group.
    asked = (
        wanted.groupBy("dim", "part", "nth")
        .agg(F.sort_array(F.collect_list("place")).alias("places"))
        .join(dealt, ["dim", "part", "nth"])
        .select(*[field.split()[0] for field in _ASKED_DDL.split(", ")])
        .mapInArrow(_cut_out, _ASKED_DDL)
        .withColumn("block", F.pmod(F.xxhash64("nth", "part"), "blocks"))
        .withColumn("group", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)))
    )
    columns = ["dim", "block", "group", "part", "nth", "size", "ids", "vectors"]
    both = asked.select(*columns, "places").unionByName(
        candidates.select(*columns, F.lit(None).cast("array<int>").alias("places"))
    )
    both = both.withColumn("kind", F.when(F.col("places").isNull(), 1).otherwise(0))
    order = ["dim", "block", "group", "kind"]
    together = both.repartition("dim", "block", "group").sortWithinPartitions(*order)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _search(batches, k)

    found = together.mapInArrow(search, _TOP_DDL)
    row = ["part", "nth", "place"]
    rank = F.row_number().over(Window.partitionBy(*row).orderBy(F.desc("score"), "vec_id"))
    ranked = found.withColumn("rank", rank).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _search(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Queries come first in each (dim, block, group), then the chunks they are compared with."""
    key, queries, places, names, best, exact = None, [], [], [], None, []

    def answer() -> pa.RecordBatch:
        rows = [(*places[i], names[i], j, s) for i, s, j in exact]
        if best is not None:
            rows += [
                (*places[i], names[i], int(best.ids[i, r]), int(best.scores[i, r]))
                for i, r in zip(*np.nonzero(best.scores > -np.inf), strict=True)
            ]
        kinds = [pa.int32()] * 3 + [pa.int64()] * 3
        columns = list(zip(*rows, strict=True)) or [[]] * 6
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
            [x.split()[0] for x in _TOP_DDL.split(", ")],
        )

    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            now = (row["dim"], row["block"], row["group"])
            if now != key:
                if key is not None:
                    yield answer()
                key, queries, places, names, best, exact = now, [], [], [], None, []
            matrix = np.frombuffer(row["vectors"], "<f8").reshape(row["dim"], row["size"])
            if row["kind"] == 0:
                queries.append(matrix)
                places += [(row["part"], row["nth"], place) for place in row["places"]]
                names += row["ids"]
                continue
            if not queries:
                continue
            if len(queries) > 1:
                queries = [np.concatenate(queries, 1)]
            own = np.array(
                [p if (a, b) == (row["part"], row["nth"]) else -1 for a, b, p in places]
            )
            ids = np.array(row["ids"], np.int64)
            if _large(queries[0], matrix):
                exact += list(_search_exactly(queries[0], matrix, ids, own, k))
                continue
            best = best or _Best(len(places), k)
            search_chunk(best, queries[0], matrix, ids, own)
    if key is not None:
        yield answer()


def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


SQL = {
    "op6_topk": r"""
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
            FROM embeddings
            WHERE embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (
            SELECT q.vec_id AS query_id, c.vec_id,
                   CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))
                        AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
            WHERE q.vec_id % 50 = 0),
        r AS (
            SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)
                           AS INTEGER) AS rank
            FROM s)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
    """
}
