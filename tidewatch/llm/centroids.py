"""Exact k-means on whole numbers: bounds, a remembered second-nearest centroid, a shrinking ball.

Each vector carries its centroid, the second-nearest one it last saw, and bounds on its distances to
the first and to all others. If the bounds leave its centroid the nearest, nothing is computed. Else
both remembered centroids are measured, the closer one is where the search starts, and its neighbours
are taken in ascending distance from it: one farther from it than the vector's own distance to it plus
that to the second-nearest so far cannot come closer than either, so the search ends there, and the ball
shrinks with each find. Bounds are floating-point numbers with a margin; vectors that they do not settle
are compared in integers.

Vectors are kept in chunks with their bounds. A round is one pass over the chunks without a shuffle; of
it only sums for each centroid come to the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from tidewatch.llm.common import intermediate, stored, table
from tidewatch.llm.topk import quantised
from tidewatch.session import scratch_folder

CHUNK = 4096
# Relative error allowed for in bounds, far above that of their few operations.
MARGIN = 1e-9

_STATE = "size int, width int, ids binary, vectors binary, near binary, second binary, upper binary, "
_STATE += "lower binary, counts array<long>, sums array<decimal(38,0)>"
_NAMES = [field.split()[0] for field in _STATE.split(", ")]
_KINDS = [pa.int32(), pa.int32(), *[pa.binary()] * 6, pa.list_(pa.int64()), pa.list_(pa.decimal128(38, 0))]
_RESULT = "vec_id long, cluster int, distance long"


def _squares(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances of rows, exact; beyond 64 bits as Python's integers, which do not overflow."""
    largest = max(np.abs(x.astype(np.float64)).max(initial=0) for x in (vectors, centroids))
    if (2 * largest) ** 2 * vectors.shape[1] < 2**62:
        gap = vectors.astype(np.int64) - centroids
        return np.einsum("ij,ij->i", gap, gap)
    gap = vectors.astype(object) - centroids.astype(object)
    return (gap * gap).sum(1)


def _roots(squares: np.ndarray) -> np.ndarray:
    return np.sqrt(squares.astype(np.float64))


class Centroids:
    """What a round needs to know of its centroids, ``k`` rows of whole numbers."""

    def __init__(self, rows: np.ndarray, before: np.ndarray | None = None) -> None:
        self.rows, k = rows, len(rows)
        every = np.arange(k)
        exact = [_squares(np.repeat(rows[i : i + 1], k, 0), rows) for i in range(k)]
        apart = np.array([_roots(x) for x in exact])
        apart[every, every] = -1.0  # a centroid is the first of its own neighbours
        self.neighbours = np.argsort(apart, 1, kind="stable")[:, 1:]
        self.apart = np.take_along_axis(apart, self.neighbours, 1)
        # Nearer than half way to the next centroid, no other is nearer.
        self.half = self.apart[:, 0] / 2 if k > 1 else np.full(k, np.inf)
        moved = np.zeros(k) if before is None else _roots(_squares(rows, before)) * (1 + MARGIN)
        self.moved = moved
        order = np.argsort(moved)
        top, next_ = (moved[order[-1]], moved[order[-2]]) if k > 1 else (0.0, 0.0)
        self.others_moved = np.full(k, top)
        self.others_moved[order[-1]] = next_


def assign(vectors: np.ndarray, state: tuple, to: Centroids) -> tuple[tuple, int]:
    """The state of vectors after a round, and how many distances were computed.

    ``state`` is the number of the nearest centroid, of the second-nearest seen, and the bounds on the
    distance to the first from above, to all others from below. Of equally near centroids the one of
    the smaller number is the nearest.
    """
    near, second, upper, lower = (x.copy() for x in state)
    upper += to.moved[near]
    lower -= to.others_moved[near]
    least = np.maximum(lower, to.half[near])
    open_ = np.flatnonzero(~(upper * (1 + MARGIN) < least * (1 - MARGIN)))
    computed = len(open_)
    best = _squares(vectors[open_], to.rows[near[open_]])
    upper[open_] = _roots(best)
    still = ~(upper[open_] * (1 + MARGIN) < least[open_] * (1 - MARGIN))
    open_, best = open_[still], best[still]
    if len(to.rows) == 1 or not len(open_):
        return (near, second, upper, lower), computed

    # Start from the closer of the two remembered ones.
    one, two = near[open_], second[open_]
    other = _squares(vectors[open_], to.rows[two])
    computed += len(open_)
    swap = (other < best) | ((other == best) & (two < one))
    first, follower = np.where(swap, two, one), np.where(swap, one, two)
    best, other = np.where(swap, other, best), np.where(swap, best, other)
    start, seen, reach = first.copy(), follower.copy(), _roots(best)
    live = np.arange(len(open_))
    for nth in range(to.neighbours.shape[1]):
        ball = (reach[live] + _roots(other[live])) * (1 + MARGIN)
        live = live[to.apart[start[live], nth] <= ball]
        if not len(live):
            break
        number = to.neighbours[start[live], nth]
        unseen = number != seen[live]
        some, number = live[unseen], number[unseen]
        squares = _squares(vectors[open_[some]], to.rows[number])
        computed += len(some)
        nearer = (squares < best[some]) | ((squares == best[some]) & (number < first[some]))
        closer = ~nearer & (squares < other[some])
        win, mid = some[nearer], some[closer]
        other[win], follower[win] = best[win], first[win]
        best[win], first[win] = squares[nearer], number[nearer]
        other[mid], follower[mid] = squares[closer], number[closer]
    near[open_], second[open_] = first, follower
    upper[open_], lower[open_] = _roots(best), _roots(other)
    return (near, second, upper, lower), computed


def _whole(vectors: list, width: int) -> np.ndarray:
    """Components as the smallest kind of integers that holds them."""
    exact = np.array([[int(x) for x in v] for v in vectors], object).reshape(len(vectors), width)
    largest = int(np.abs(exact).max(initial=0))
    for kind in ("<i2", "<i4", "<i8"):
        if largest <= np.iinfo(kind).max:
            return exact.astype(kind)
    raise ValueError("a component times the scale does not fit 64 bits")


def _integers(column: pa.ListArray, width: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    largest = np.abs(flat).max(initial=0)
    for kind in ("<i2", "<i4"):
        if largest <= np.iinfo(kind).max:
            return flat.astype(kind).reshape(-1, width)
    return _whole(flat.reshape(-1, width).tolist(), width)


def _fresh(ids: pa.Array, vectors: np.ndarray) -> list:
    """A chunk that was never assigned: no bound holds."""
    n = len(vectors)
    raw = [ids.cast(pa.int64()).fill_null(0).to_numpy().astype("<i8"), vectors]
    raw += [np.zeros(n, "<i4"), np.ones(n, "<i4"), np.full(n, np.inf), np.full(n, -np.inf)]
    known = np.packbits(ids.is_valid().to_numpy(zero_copy_only=False)).tobytes()
    return [n, vectors.dtype.itemsize, raw[0].tobytes() + known, *[x.tobytes() for x in raw[1:]]]


def _unpacked(row: dict, width: int) -> tuple[np.ndarray, tuple]:
    vectors = np.frombuffer(row["vectors"], f"<i{row['width']}").reshape(-1, width)
    near, second = (np.frombuffer(row[n], "<i4") for n in ("near", "second"))
    return vectors, (near, second, *[np.frombuffer(row[n], "<f8") for n in ("upper", "lower")])


def _batch(rows: list[list]) -> pa.RecordBatch:
    columns = [pa.array(column, kind) for column, kind in zip(zip(*rows, strict=True), _KINDS, strict=True)]
    return pa.RecordBatch.from_arrays(columns, _NAMES)


def _sums(vectors: np.ndarray, near: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Vectors and component sums of each centroid, exact: a chunk of 64-bit numbers in two halves."""
    counts = np.bincount(near, minlength=k)
    present = np.flatnonzero(counts)
    firsts = (np.cumsum(counts) - counts)[present]
    sums = np.zeros((k, vectors.shape[1]), object)
    if len(present):
        wide = vectors[np.argsort(near, kind="stable")].astype(np.int64)
        high, low = (np.add.reduceat(x, firsts, 0) for x in (wide >> 32, wide & 0xFFFFFFFF))
        sums[present] = high.astype(object) * 2**32 + low
    return counts, sums


def _chunks(kept: DataFrame, width: int) -> DataFrame:
    """Rows of (``vec_id``, ``vector``) in chunks, where they are."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK):
                some = batch.slice(at, CHUNK)
                vectors = _integers(some.column(1), width)
                yield _batch([[*_fresh(some.column(0), vectors), [], []]])

    return kept.mapInArrow(build, _STATE)


def _round(chunks: DataFrame, to: Centroids) -> DataFrame:
    """Chunks after one more assignment; each task adds a row without vectors that holds its sums."""
    k, width = to.rows.shape

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros(k, np.int64), np.zeros((k, width), object)
        for batch in batches:
            for row in batch.to_pylist():
                vectors, state = _unpacked(row, width)
                (near, second, upper, lower), _ = assign(vectors, state, to)
                more = _sums(vectors, near, k)
                counts, sums = counts + more[0], sums + more[1]
                state = [near.astype("<i4"), second.astype("<i4"), upper, lower]
                head = [row[name] for name in _NAMES[:4]]
                yield _batch([[*head, *[x.tobytes() for x in state], [], []]])
        if counts.any():
            yield _batch([[0, 0, *[b""] * 6, counts.tolist(), sums.ravel().tolist()]])

    return chunks.where("size > 0").mapInArrow(step, _STATE)


def _moved(chunks: DataFrame, rows: np.ndarray) -> np.ndarray:
    """Centroids at the floor of the means of their vectors; without vectors they stay.

    The driver gets ``k * width`` sums, whatever the number of vectors.
    """
    k, width = rows.shape
    long = DecimalType(38, 0)

    def summed(name: str) -> dict[int, int]:
        flat = chunks.where("size = 0").select(F.posexplode(F.col(name)).alias("at", "value"))
        return dict(flat.groupBy("at").agg(F.sum(F.col("value").cast(long)).alias("value")).collect())

    counts, sums = summed("counts"), summed("sums")
    moved = rows.astype(object)
    for c in range(k):
        if n := int(counts.get(c, 0)):
            moved[c] = [int(sums[c * width + d]) // n for d in range(width)]
    return moved.astype(np.int64)


def _assigned(chunks: DataFrame, to: Centroids) -> DataFrame:
    """``vec_id, cluster, distance`` of each vector: one last assignment, distances exact."""
    width = to.rows.shape[1]

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                vectors, state = _unpacked(row, width)
                near = assign(vectors, state, to)[0][0]
                n = row["size"]
                ids = np.frombuffer(row["ids"], "<i8", n)
                known = np.unpackbits(np.frombuffer(row["ids"][8 * n :], np.uint8))[:n].astype(bool)
                squares = [int(x) for x in _squares(vectors, to.rows[near])]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids, pa.int64(), mask=~known),
                        pa.array(near.astype(np.int32)),
                        pa.array(squares, pa.int64()),
                    ],
                    ["vec_id", "cluster", "distance"],
                )

    return chunks.where("size > 0").mapInArrow(step, _RESULT)


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def cluster(
    vectors: DataFrame,
    *,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    width: int = 64,
    k: int = 40,
    rounds: int = 5,
    scale: float = 256.0,
    seed: str = "2",
) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of each vector that
    takes part.

    Those are the vectors of ``width`` components, none null or not finite; each becomes
    floor(scale * x). The first centroids are the ``k`` vectors of the smallest sha256 of
    ``seed:vec_id``, or all if there are fewer. ``distance`` is the squared one to the centroid after
    ``rounds`` rounds, the inertias its sums. Of equally near centroids the smaller number is taken.

    Vectors without id are assigned, but no first centroid; if all are, the result is empty. Rows that
    repeat an id are vectors of their own (their hashes tie; the smaller vector comes first). Equal
    vectors may be several centroids, of which the first gets all. Other columns are not looked at. An
    empty table gives an empty result. A distance that does not fit 64 bits raises.
    """
    spark = vectors.sparkSession
    value: Column = F.col(f"`{vector_column}`")
    kept = vectors.where(F.size(value) == width).select(
        F.col(f"`{id_column}`").cast("long").alias("vec_id"), quantised(value, scale).alias("vector")
    )
    kept = kept.where(F.col("vector").isNotNull())
    with intermediate(spark):
        name = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
        first = kept.where("vec_id IS NOT NULL").orderBy(name, "vector").limit(k).collect()
        rows = _whole([row.vector for row in first], width).astype(np.int64)
        if not len(rows):
            nothing = f"{_RESULT}, cluster_inertia long, inertia long, centroid_sha256 string"
            return spark.createDataFrame([], nothing)
        before, folder = None, scratch_folder(spark, "rounds")
        chunks = stored(_chunks(kept, width), "chunks")
        for nth in range(rounds):
            path = f"{folder}/{nth}"
            _round(chunks, Centroids(rows, before)).write.option("compression", "zstd").parquet(path)
            chunks = spark.read.schema(chunks.schema).parquet(path)
            if nth:
                _delete(spark, f"{folder}/{nth - 1}")
            before, rows = rows, _moved(chunks, rows)
        found = stored(_assigned(chunks, Centroids(rows, before)), "assigned")
        sums = dict(found.groupBy("cluster").agg(F.sum("distance")).collect())  # k rows at most
        named = [
            (c, sums[c], sum(sums.values()), hashlib.sha256(",".join(map(str, row)).encode()).hexdigest())
            for c, row in enumerate(rows.tolist())
            if c in sums
        ]
        names = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
        result = found.join(F.broadcast(spark.createDataFrame(named, names)), "cluster")
        result = stored(
            result.select(
                "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
            ),
            "clusters",
            keep=True,
        )
        _delete(spark, folder)
        return result


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster(table(spark, sf_dir, "embeddings"))


def _sql(width: int = 64, k: int = 40, rounds: int = 5) -> str:
    """The same rounds in plain form: all distances of each."""
    text = f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS nr, vec_id,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE len(embedding) = {width}
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {width}
), parts AS MATERIALIZED (
  SELECT nr, unnest(v) AS x, generate_subscripts(v, 1) AS d FROM kept
), c0 AS MATERIALIZED (
  SELECT c, unnest(v) AS y, generate_subscripts(v, 1) AS d FROM (
    SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id), v) - 1 AS c, v FROM kept
    WHERE vec_id IS NOT NULL QUALIFY c < {k})
)"""
    for nth in range(rounds + 1):
        text += f""", a{nth} AS MATERIALIZED (
  SELECT nr, arg_min(c, (s, c)) AS c, min(s) AS s FROM (
    SELECT nr, c, sum((x - y) * (x - y)) AS s FROM parts JOIN c{nth} USING (d) GROUP BY nr, c)
  GROUP BY nr
)"""
        if nth < rounds:
            text += f""", c{nth + 1} AS MATERIALIZED (
  SELECT c{nth}.c, c{nth}.d, coalesce(m.y, c{nth}.y) AS y FROM c{nth} LEFT JOIN (
    SELECT c, d, floor(sum(x) / count(*))::BIGINT AS y FROM parts JOIN a{nth} USING (nr)
    GROUP BY c, d) AS m USING (c, d)
)"""
    return f"""{text}
SELECT vec_id, a.c::INTEGER AS cluster, a.s::BIGINT AS distance,
  (sum(a.s) OVER (PARTITION BY a.c))::BIGINT AS cluster_inertia,
  (sum(a.s) OVER ())::BIGINT AS inertia, centroid_sha256
FROM a{rounds} AS a JOIN kept USING (nr) JOIN (
  SELECT c, sha256(string_agg(y, ',' ORDER BY d)) AS centroid_sha256 FROM c{rounds} GROUP BY c
) AS h USING (c)"""


SQL: dict[str, str] = {"op11_centroids": _sql()}
