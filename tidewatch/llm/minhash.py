"""Near duplicates: minima of universal hashes, bands, verified links, connected components.

Documents with the same shingle set are one class from the start. Classes that share a band of their
signatures are candidates. First each member of a bucket is compared with one centre only, and the
links that hold are contracted to components; that settles the large groups in linear time. Then only
members of one bucket that are still in different components are compared with each other, in
blocks, so that no link is lost. Every link is confirmed on full shingle sets, which are computed
again from the text for candidates alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm.common import KEY, intermediate, keep_rows, row_key, stored, table, texts
from tidewatch.llm.components import components
from tidewatch.llm.shingles import common, mix, shingle_sets

# There are as many bands as it takes to miss a pair at the threshold with a probability below MISS:
# 19 at 0.85, 27 at 0.8.
BAND_ROWS = 4
MISS = 1e-6
# More hashes, of which the signature keeps a byte each; they sharpen the estimate of a pair.
EXTRA = 160
# Standard deviations that the signature may fall short of the threshold before a pair is left out:
# at the threshold less than 1e-8 of the pairs that share a band, so bands and this stay below MISS.
DEVIATIONS = 6.0
# Members of a bucket that one task compares with as many others.
BLOCK = 256

def _bands(threshold: float) -> int:
    return int(np.ceil(np.log(MISS) / np.log1p(-(threshold**BAND_ROWS))))


def _universal(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Factors and addends of ``count`` multiply-add hashes on 64-bit values."""
    random = np.random.default_rng(4711)
    factors = random.integers(1, 2**63, count, np.uint64) * np.uint64(2) + np.uint64(1)
    return factors, random.integers(0, 2**63, count, np.uint64)


def signature(sets: list[np.ndarray], hashes: int) -> np.ndarray:
    """Minima of universal hashes over each (non-empty) set, one row of bytes each.

    ``hashes`` minima of 32 bits, for bands, are followed by ``EXTRA`` ones of a byte.
    """
    factors, addends = _universal(hashes + EXTRA)
    values = np.concatenate(sets)
    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    out = np.empty((len(sets), hashes + EXTRA), np.uint32)
    # Spans of values that stay in the cache of the processor while all hashes are taken.
    at = 0
    while at < len(sets):
        end = max(at + 1, int(np.searchsorted(starts, starts[at] + 32768)))
        stop = starts[end] if end < len(sets) else len(values)
        span, cuts = values[starts[at] : stop], starts[at:end] - starts[at]
        for j in range(hashes + EXTRA):
            low = np.minimum.reduceat(span * factors[j] + addends[j], cuts)
            out[at:end, j] = low >> np.uint64(32)
        at = end
    wide = np.ascontiguousarray(out[:, :hashes]).view(np.uint8)
    return np.concatenate([wide, out[:, hashes:].astype(np.uint8)], 1)


_SKETCH_DDL = (
    "doc_id long, doc__ long, tag__ long, n_shingles long, class binary, signature binary"
)


def sketches(docs: DataFrame, *, words: int, hashes: int) -> DataFrame:
    """Each row of ``docs`` with its set's size, 128-bit hash (``class``) and signature.

    The class and signature of an empty set are null.
    """

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                sets = shingle_sets(some.column("text").to_pylist(), words)
                full = [s for s in sets if len(s)]
                signed = iter(signature(full, hashes) if full else ())
                classes, signatures = [], []
                for s in sets:
                    if len(s):
                        pair = np.array([s.sum(), mix(s + np.uint64(1)).sum()], np.uint64)
                        classes.append(pair.tobytes())
                        signatures.append(next(signed).tobytes())
                    else:
                        classes.append(None)
                        signatures.append(None)
                yield pa.RecordBatch.from_arrays(
                    [
                        *[some.column(n) for n in ("doc_id", "doc__", "tag__")],
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(classes, pa.binary()),
                        pa.array(signatures, pa.binary()),
                    ],
                    ["doc_id", "doc__", "tag__", "n_shingles", "class", "signature"],
                )

    rows = row_key(texts(docs)).select("doc_id", "doc__", "tag__", "text")
    return rows.mapInArrow(sketch, _SKETCH_DDL)


def _least(slots: int, share: float) -> float:
    """Equal slots of two signatures below which a pair is left out."""
    return slots * (share - DEVIATIONS * np.sqrt(share * (1 - share) / slots))


def _near(hashes: int, share: float) -> Column:
    """Whether the signatures ``sig_a`` and ``sig_b`` and the set sizes allow a link."""
    def same(i: int) -> Column:
        parts = [F.substring(name, 4 * i + 1, 4) for name in ("sig_a", "sig_b")]
        return (parts[0] == parts[1]).cast("int")

    equal = same(0)
    for i in range(1, hashes):
        equal = equal + same(i)
    sizes = F.least("n_a", "n_b") >= F.lit(share - 1e-9) * F.greatest("n_a", "n_b")
    return sizes & (equal >= F.lit(float(_least(hashes, share))))


def _with_classes(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """``pairs`` (``a, b``) with the sizes and signatures of both."""
    for side in ("a", "b"):
        facts = classes.select(
            F.col("class").alias(f"class_{side}"),
            F.col("n_shingles").alias(f"n_{side}"),
            F.col("signature").alias(f"sig_{side}"),
        )
        pairs = pairs.join(facts, F.col(side) == F.col(f"class_{side}")).drop(f"class_{side}")
    return pairs


def _shingles_of(docs: DataFrame, classes: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """``class, shingles`` for the ``wanted`` classes, from the text of one row of each."""
    rows = classes.join(wanted, "class", "left_semi").select("class", "first.doc__", "first.tag__")
    picked = (
        row_key(texts(docs))
        .join(rows, KEY)
        .select("class", "text")
    )

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                keys, found = [], []
                for key, s in zip(
                    some.column(0).to_pylist(),
                    shingle_sets(some.column(1).to_pylist(), words),
                    strict=True,
                ):
                    pair = np.array([s.sum(), mix(s + np.uint64(1)).sum()], np.uint64)
                    if pair.tobytes() == key:  # else another text of the same name
                        keys.append(key)
                        found.append(s.tobytes())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.binary()), pa.array(found, pa.binary())],
                    ["class", "shingles"],
                )

    made = picked.mapInArrow(compute, "class binary, shingles binary")
    return stored(made.dropDuplicates(["class"]), "shingles")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of ``pairs`` (``a, b``) with 100 * intersection >= percent * union."""
    both = pairs.select("a", "b")
    for side in ("a", "b"):
        own = sets.select(
            F.col("class").alias(f"class_{side}"), F.col("shingles").alias(f"set_{side}")
        )
        both = both.join(own, F.col(side) == F.col(f"class_{side}")).drop(f"class_{side}")

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fine = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = (np.frombuffer(s.as_buffer(), np.uint64) for s in (x, y))
                shared = common(x, y)
                fine.append(100 * shared >= percent * (len(x) + len(y) - shared))
            yield batch.select([0, 1]).filter(pa.array(fine, pa.bool_()))

    return both.select("a", "b", "set_a", "set_b").mapInArrow(confirm, "a binary, b binary")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows of one ``(key, x, y)`` together, from rows sorted by it."""
    rest = None
    for batch in batches:
        part = pa.Table.from_batches([batch])
        part = part if rest is None else pa.concat_tables([rest, part])
        names = ("key", "x", "y")
        keys = np.stack([part.column(n).to_numpy().astype(np.int64) for n in names], 1)
        start = 0
        for end in (np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1).tolist():
            yield part.slice(start, end - start)
            start = end
        rest = part.slice(start).combine_chunks()
    if rest is not None and rest.num_rows:
        yield rest


def _dealt(members: DataFrame) -> DataFrame:
    """Members of buckets with more than one component, dealt to pairs of blocks.

    ``members``: ``key, band, class, root, n_shingles, signature``. A bucket is cut into blocks of
    about ``BLOCK`` members; ``x`` and ``y`` are the blocks that meet in one place.
    """
    sizes = members.groupBy("key").agg(
        F.count(F.lit(1)).alias("size"), F.min("root").alias("r0"), F.max("root").alias("r1")
    )
    mixed = sizes.where("r0 != r1").select(
        F.col("key").alias("bucket"), F.ceil(F.col("size") / BLOCK).alias("blocks")
    )
    dealt = members.join(stored(mixed, "mixed"), F.col("key") == F.col("bucket"))
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("class"), F.col("blocks"))).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    )
    return dealt.select(
        "key",
        F.least("own", "other").alias("x"),
        F.greatest("own", "other").alias("y"),
        "own",
        "band",
        "class",
        "root",
        "n_shingles",
        "signature",
    )


def _candidates(run: pa.Table, hashes: int, share: float) -> list[tuple[int, np.ndarray]]:
    """Pairs of a run that are in different components and may be links: (i, [j, ...]).

    A pair is taken in the first band that it shares, so that it is looked at once.
    """
    if run.num_rows < 2:
        return []
    root = np.unique(run.column("root").to_numpy(zero_copy_only=False), return_inverse=True)[1]
    own, size = run.column("own").to_numpy(), run.column("n_shingles").to_numpy()
    band = run.column("band")[0].as_py()
    width = 4 * BAND_ROWS
    signs = np.stack([np.frombuffer(s, np.uint8) for s in run.column("signature").to_pylist()])
    wide = np.ascontiguousarray(signs[:, : 4 * hashes]).view(np.uint32)
    bands = np.ascontiguousarray(signs[:, : 4 * hashes]).view(f"V{width}")[:, :band]
    bands = np.unique(bands.ravel(), return_inverse=True)[1].reshape(len(signs), -1)
    extra = signs[:, 4 * hashes :]
    least = _least(hashes + EXTRA, share)
    across = run.column("x")[0].as_py() != run.column("y")[0].as_py()
    out = []
    for i in range(run.num_rows - 1):
        other = root[i + 1 :] != root[i]
        if across:
            other &= own[i + 1 :] != own[i]
        small, large = np.minimum(size[i + 1 :], size[i]), np.maximum(size[i + 1 :], size[i])
        at = np.flatnonzero(other & (small >= (share - 1e-9) * large)) + i + 1
        if len(at):
            equal = (wide[at] == wide[i]).sum(1) + (extra[at] == extra[i]).sum(1)
            at = at[equal >= least]
        if len(at) and band:
            at = at[~(bands[at] == bands[i]).any(1)]
        if len(at):
            out.append((i, at))
    return out


def _across(docs: DataFrame, classes: DataFrame, members: DataFrame, sets: DataFrame, words: int,
            hashes: int, percent: int) -> DataFrame:
    """Links between members of one bucket that are in different components.

    First the members that have a candidate at all are found from signatures, then their sets are
    brought to the places where blocks meet, and pairs are confirmed there. Of the links of one place
    only those are given that join components, so no more than there are members.
    """
    dealt = stored(_dealt(members), "dealt")
    share = percent / 100

    def promising(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in _runs(batches):
            found = _candidates(run, hashes, share)
            rows = sorted({i for i, _ in found}.union(*[at.tolist() for _, at in found]))
            if rows:
                yield from run.take(pa.array(rows)).combine_chunks().to_batches()

    together = dealt.repartition("key", "x", "y").sortWithinPartitions("key", "x", "y")
    likely = stored(together.mapInArrow(promising, dealt.schema), "likely")
    missing = likely.select("class").distinct().join(sets.select("class"), "class", "left_anti")
    sets = sets.unionByName(_shingles_of(docs, classes, missing, words))
    brought = likely.join(
        sets.withColumnRenamed("class", "of"), F.col("class") == F.col("of")
    ).drop("of")

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in _runs(batches):
            above: dict[bytes, bytes] = {}

            def top(x: bytes, above: dict[bytes, bytes] = above) -> bytes:
                while x in above:
                    x = above[x]
                return x

            roots, names = run.column("root").to_pylist(), run.column("class").to_pylist()
            found = [np.frombuffer(s, np.uint64) for s in run.column("shingles").to_pylist()]
            a, b = [], []
            for i, at in _candidates(run, hashes, share):
                for j in at.tolist():
                    x, y = top(roots[i]), top(roots[j])
                    if x == y:
                        continue
                    shared = common(found[i], found[j])
                    if 100 * shared >= percent * (len(found[i]) + len(found[j]) - shared):
                        above[x] = y
                        a.append(names[i])
                        b.append(names[j])
            if a:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"]
                )

    together = brought.repartition("key", "x", "y").sortWithinPartitions("key", "x", "y")
    return together.mapInArrow(confirm, "a binary, b binary")


def _rooted(docs: DataFrame, words: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Rows with the root of their component, and the first row of each component."""
    share = percent / 100
    bands = _bands(share)
    hashes = bands * BAND_ROWS
    rows = stored(sketches(docs, words=words, hashes=hashes), "sketches")
    classes = (
        rows.where("class is not null")
        .groupBy("class", "n_shingles")
        .agg(F.first("signature").alias("signature"), F.min(F.struct(*KEY)).alias("first"))
    )
    classes = stored(classes, "classes")
    width = 4 * BAND_ROWS
    keys = [
        F.xxhash64(F.lit(i), F.substring("signature", width * i + 1, width)) for i in range(bands)
    ]
    banded = classes.select("class", F.posexplode(F.array(*keys)).alias("band", "key"))
    centres = (
        banded.groupBy("key")
        .agg(F.min("class").alias("centre"), F.max("class").alias("last"))
        .where("centre != last")
        .select(F.col("key").alias("bucket"), "centre")
    )
    shared = stored(
        banded.join(stored(centres, "centres"), F.col("key") == F.col("bucket")).select(
            "key", "band", "class", "centre"
        ),
        "buckets",
    )
    to_centre = (
        shared.where("class != centre")
        .select(F.col("centre").alias("a"), F.col("class").alias("b"))
        .distinct()
    )
    to_centre = stored(
        _with_classes(to_centre, classes).where(_near(hashes, share)).select("a", "b"), "to-centre"
    )
    wanted = to_centre.select(F.explode(F.array("a", "b")).alias("class")).distinct()
    sets = _shingles_of(docs, classes, wanted, words)
    links = stored(_confirmed(to_centre, sets, percent), "links")
    roots = components(links.select(F.col("a").alias("u"), F.col("b").alias("v")))
    facts = classes.select("class", "n_shingles", "signature")
    members = (
        shared.select("key", "band", "class")
        .join(facts, "class")
        .join(roots, F.col("class") == F.col("vertex"), "left")
        .select(
            "key", "band", "class", F.coalesce("root", "class").alias("root"), "n_shingles", "signature"
        )
    )
    members = stored(members, "members")
    links = links.unionByName(_across(docs, classes, members, sets, words, hashes, percent))
    roots = components(links.select(F.col("a").alias("u"), F.col("b").alias("v")))
    named = rows.select(*[c for c in rows.columns if c != "signature"]).withColumn(
        "row", F.monotonically_increasing_id()
    )
    named = stored(
        named.join(roots, F.col("class") == F.col("vertex"), "left").withColumn(
            "root", F.coalesce("root", "class")
        ).drop("vertex"),
        "rooted",
        keep=True,
    )
    first = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "row")
    groups = (
        named.where("root is not null")
        .groupBy("root")
        .agg(F.min(first).alias("first"))
        .select(F.col("root").alias("group"), "first")
    )
    groups = stored(groups, "groups", keep=True)
    return named, groups


def near_duplicates(docs: DataFrame, *, words: int = 5, percent: int = 80) -> DataFrame:
    """Each row of ``docs`` with its component of near duplicates.

    Takes ``doc_id`` and ``text``; returns ``doc_id, n_shingles, component_id, kept`` and the row key
    of :func:`row_key`. Documents are linked if their sets of ``words``-word shingles have an
    intersection of at least ``percent`` hundredths of their union. ``component_id`` is the smallest id
    reachable over links. One row of each component is kept, the one of that id; of rows repeated
    under it an arbitrary one; nulls come last. Null, empty and blank texts have empty sets and no
    links. An empty table gives an empty result.

    Links between documents that share no band, or whose signatures fall ``DEVIATIONS`` short of the
    threshold, are missed; both together have a probability less than ``MISS`` at the threshold, and
    much less above it.
    """
    with intermediate(docs.sparkSession):
        named, groups = _rooted(docs, words, percent)
    grouped = F.col("group").isNotNull()
    return named.join(groups, F.col("root") == F.col("group"), "left").select(
        "doc_id",
        *KEY,
        "n_shingles",
        F.when(grouped, F.col("first.doc_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.when(grouped, F.col("row") == F.col("first.row")).otherwise(True).alias("kept"),
    )


def drop_near_copies(docs: DataFrame, *, words: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one document of each group of near duplicates, all columns as they were.

    Which one, and what null, empty and repeated texts are, is as in :func:`near_duplicates`; of rows
    equal in id and text one stays where others of their group go. Texts are compared whole, however
    long. Extra columns may have any name. An empty table gives an empty result.
    """
    found = near_duplicates(docs, words=words, percent=percent).select(*KEY, "kept")
    return keep_rows(docs, stored(found, "near-copies"))


def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"), words=3, percent=85)
    # of rows that repeat an id, all or none
    kept = (F.col("doc_id") == F.col("component_id")).alias("kept")
    return found.select("doc_id", "n_shingles", "component_id", kept)
