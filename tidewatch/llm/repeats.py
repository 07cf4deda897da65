"""Repeated byte strings across a corpus: an enhanced suffix array, cut into buckets by anchors.

Every window of ``min_bytes`` bytes chooses an anchor, the string of ``ANCHOR`` bytes in it with the
smallest hash; equal windows choose at the same place, so two occurrences of a repeat meet in the
bucket of an anchor. Only anchors are exchanged, about two for every 160 bytes of text. Occurrences
whose whole surroundings agree (copies, the inside of long passages) are one class, found by
counting. What is left are the ends of repeats: their surroundings are read from the text, the
suffixes at the anchor are sorted (a suffix array of the bucket), a scan with a stack over the common
prefixes of neighbours gives the tree of common-prefix intervals, and in each interval the left
sides are sorted and scanned the same way. An interval on both sides, of members that differ in the
next byte to the left and to the right, is a maximal repeat with all its occurrences.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm.common import KEY, intermediate, row_key, stored, table, texts, with_rows
from tidewatch.llm.shingles import mix

MIN_BYTES = 200
ANCHOR = 40
# Bytes of text hashed together; a longer text is cut into overlapping spans.
SPAN_BYTES = 1 << 17
# Members of a bucket that one task sorts; a bucket of more is resolved by counting windows.
BUCKET = 100_000

_BITS = 18
_MASK = np.uint64((1 << _BITS) - 1)
_BASE = 0x9E3779B97F4A7C15 | 1
_BYTE = np.random.default_rng(19).integers(1, 2**63, 256, np.uint64)
_POWERS = np.cumprod(np.full(1 << _BITS, _BASE, np.uint64))
_INVERSES = np.cumprod(np.full(1 << _BITS, pow(_BASE, -1, 1 << 64), np.uint64))


class _Hashed:
    """Hashes of any substrings of ``data`` (at most 2**18 bytes) from its prefix sums."""

    def __init__(self, data: np.ndarray) -> None:
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE[data] * _POWERS[: len(data)], out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * _INVERSES[starts])


def _smallest(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` values in a row."""
    size = 1
    while size * 2 <= width:
        values = np.minimum(values[: len(values) - size], values[size:])
        size *= 2
    rest = width - size
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def _anchors(data: np.ndarray, ends: np.ndarray, first: int, last: int, min_bytes: int):
    """Anchors of the windows that begin in [first, last) and lie within one text.

    ``ends[i]`` is where the text of byte i ends. Returns places and the prefix hashes.
    """
    hashed = _Hashed(data)
    at = np.arange(max(0, len(data) - ANCHOR + 1))
    grams = hashed.of(at, at + ANCHOR)
    coded = (grams & ~_MASK) | at.astype(np.uint64)
    width = min_bytes - ANCHOR + 1
    if len(coded) < width:
        return np.zeros(0, np.int64), grams, hashed
    low = _smallest(coded, width)
    begin = np.arange(len(low))
    fine = (begin + min_bytes <= ends[: len(low)]) & (begin >= first) & (begin < last)
    marked = np.zeros(len(data), bool)
    marked[(low[fine] & _MASK).astype(np.int64)] = True
    return np.flatnonzero(marked), grams, hashed


_ANCHOR_DDL = "bucket long, around long, doc__ long, tag__ long, at int, sides int"
_ANCHOR_SCHEMA = pa.schema(
    [
        ("bucket", pa.int64()),
        ("around", pa.int64()),
        ("doc__", pa.int64()),
        ("tag__", pa.int64()),
        ("at", pa.int32()),
        ("sides", pa.int32()),
    ]
)


def _spans(contents: list[bytes], min_bytes: int, span: int) -> Iterator[tuple[bytes, list[tuple]]]:
    """Buffers with their pieces: (text, place in the buffer, place in the text, own windows)."""
    halo = min_bytes
    buffer, pieces, size = [], [], 0
    for i, content in enumerate(contents):
        if len(content) < min_bytes:
            continue
        if len(content) > span:
            for start in range(0, len(content) - min_bytes + 1, span):
                begin = max(0, start - halo)
                part = content[begin : start + span + 2 * halo]
                yield part, [(i, 0, begin, start - begin, start - begin + span)]
            continue
        if buffer and size + len(content) > span:
            yield b"".join(buffer), pieces
            buffer, pieces, size = [], [], 0
        pieces.append((i, size, 0, 0, len(content)))
        buffer.append(content)
        size += len(content)
    if pieces:
        yield b"".join(buffer), pieces


def anchor_rows(
    docs: DataFrame, *, min_bytes: int = MIN_BYTES, span_bytes: int = SPAN_BYTES
) -> DataFrame:
    """All anchors: the hash of the anchor (``bucket``), of its surroundings (``around``), its row,
    ``at`` (the place in the text) and ``sides`` (bytes there are to the left and right)."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            contents = [x.as_py().encode() for x in batch.column(2)]
            docs_, tags = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            seen: tuple[int, np.ndarray] = (-1, np.zeros(0, np.int64))
            for buffer, pieces in _spans(contents, min_bytes, span_bytes):
                data = np.frombuffer(buffer, np.uint8)
                bounds = np.array([p[1] for p in pieces] + [len(data)])
                ends = np.repeat(bounds[1:], np.diff(bounds))
                single = len(pieces) == 1
                first, last = pieces[0][3:] if single else (0, len(data))
                places, grams, hashed = _anchors(data, ends, first, last, min_bytes)
                piece = np.searchsorted(bounds, places, "right") - 1
                row = np.array([p[0] for p in pieces])[piece]
                # A span of a long text has text before and after it, counted in its sides.
                inside = places - bounds[piece]
                left = np.minimum(inside, min_bytes - ANCHOR)
                right = np.minimum(bounds[piece + 1] - places, min_bytes)
                around = hashed.of(places - left, places + right)
                sides = (left * (min_bytes + 1) + right).astype(np.int64)
                around = mix(around ^ mix(sides.astype(np.uint64)))
                start = inside + np.array([p[2] for p in pieces])[piece]
                if single:  # anchors that the span before has chosen, too
                    text = pieces[0][0]
                    new = ~np.isin(start, seen[1]) if seen[0] == text else np.ones(len(start), bool)
                    seen = (text, start)
                    around, sides, start = around[new], sides[new], start[new]
                    places, row = places[new], row[new]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(grams[places].astype(np.int64)),
                        pa.array(around.astype(np.int64)),
                        pa.array(docs_[row]),
                        pa.array(tags[row]),
                        pa.array(start.astype(np.int32)),
                        pa.array(sides.astype(np.int32)),
                    ],
                    schema=_ANCHOR_SCHEMA,
                )

    keyed = row_key(texts(docs)).select(*KEY, "text")
    return keyed.mapInArrow(find, _ANCHOR_DDL)


def _same(x: bytes, y: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(x), len(y))
    x, y = x[:n], y[:n]
    if x == y:
        return n
    differ = int.from_bytes(x, "big") ^ int.from_bytes(y, "big")
    return n - (differ.bit_length() + 7) // 8


def intervals(common: list[int]) -> Iterator[tuple[int, int, int]]:
    """Common-prefix intervals of a sorted list: (first, last, length), inner ones first.

    ``common[i]`` is the common prefix of items i and i + 1. A scan with a stack of open intervals,
    each closed when a shorter common prefix is met.
    """
    stack: list[tuple[int, int]] = []
    for i, length in enumerate([*common, -1]):
        first = i
        while stack and stack[-1][1] > length:
            first, depth = stack.pop()
            yield first, i, depth
        if length >= 0 and (not stack or stack[-1][1] < length):
            stack.append((first, length))


def maximal_repeats(
    lefts: list[bytes], rights: list[bytes], least: int
) -> Iterator[tuple[int, int, list[int]]]:
    """Maximal repeats around an anchor: (bytes to the left, bytes to the right, members).

    ``rights`` are sorted suffixes at the anchor, ``lefts`` the bytes before it, nearest first. Only
    repeats of at least ``least`` bytes are given. Right sides of an interval differ in what follows;
    members are tested for diversity on the left by the intervals of their left sides. A repeat that
    could be extended on the right (all its members lie in one inner interval) is left out.
    """
    common = [_same(x, y) for x, y in zip(rights, rights[1:], strict=False)]
    reach = max(map(len, lefts), default=0)
    order = sorted(range(len(lefts)), key=lefts.__getitem__)
    rank = [0] * len(order)
    for place, i in enumerate(order):
        rank[i] = place
    for first, last, right in intervals(common):
        if right + reach < least:
            continue
        members = sorted(range(first, last + 1), key=rank.__getitem__)
        beside = [
            _same(lefts[a], lefts[b]) for a, b in zip(members, members[1:], strict=False)
        ]
        child = _children(common, first, last, right)
        for a, b, left in intervals(beside):
            if left + right < least:
                continue
            group = members[a : b + 1]
            if len({child[i - first] for i in group}) > 1:
                yield left, right, group


def _children(common: list[int], first: int, last: int, depth: int) -> list[int]:
    """For each item of an interval, the number of the inner interval or single item it is in."""
    out = [0]
    for i in range(first, last):
        out.append(out[-1] + (common[i] == depth))
    return out


# Keys that a task remembers.
SEEN_KEYS = 100_000
_CONTEXT_DDL = (
    "bucket long, doc__ long, tag__ long, at int, single boolean, left binary, right binary"
)


def _contexts(docs: DataFrame, wanted: DataFrame, min_bytes: int) -> DataFrame:
    """Surroundings of the ``wanted`` anchors (``bucket``, key, ``at, single``), from the texts.

    Of rows equal in id and text, which share a key and meet in a task, one is enough.
    """
    places = wanted.groupBy(*KEY).agg(
        F.collect_list(F.struct("bucket", "at", "single")).alias("places")
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack, seen = zstandard.ZstdDecompressor(), set()
        for batch in batches:
            for i in range(batch.num_rows):
                doc, tag = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                if (doc, tag) in seen:
                    continue
                if len(seen) >= SEEN_KEYS:
                    seen.clear()
                seen.add((doc, tag))
                content = unpack.decompress(batch.column(2)[i].as_py())
                rows = []
                for place in batch.column(3)[i].as_py():
                    at = place["at"]
                    left = content[max(0, at - min_bytes + ANCHOR) : at][::-1]
                    right = content[at : at + min_bytes]
                    rows.append((place["bucket"], doc, tag, at, place["single"], left, right))
                kinds = [pa.int64()] * 3 + [pa.int32(), pa.bool_()] + [pa.binary()] * 2
                names = [x.split()[0] for x in _CONTEXT_DDL.split(", ")]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                    names,
                )

    joined = _packed(docs).join(places, KEY).select(*KEY, "content", "places")
    return joined.mapInArrow(cut, _CONTEXT_DDL)


def _packed(docs: DataFrame) -> DataFrame:
    """The key and compressed bytes of each text, for joins that have to move all of it."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            content = [packer.compress(x.as_py().encode()) for x in batch.column(3)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(content, pa.binary())],
                ["doc_id", *KEY, "content"],
            )

    rows = row_key(texts(docs)).select("doc_id", *KEY, "text")
    return rows.mapInArrow(pack, "doc_id long, doc__ long, tag__ long, content binary")


def _by_bucket(work: Callable, kinds: list[pa.DataType], ddl: str) -> Callable:
    """A task over contexts sorted by bucket: the rows that ``work`` gives for each bucket."""
    names = [column.split()[0] for column in ddl.split(", ")]

    def answer(out: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*out, strict=True)) or [[]] * len(kinds)
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, names)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run: list[tuple] = []
        for batch in batches:
            out: list[tuple] = []
            for row in zip(*[column.to_pylist() for column in batch.columns], strict=True):
                if run and run[-1][0] != row[0]:
                    out.extend(work(run))
                    run = []
                run.append(row)
            yield answer(out)
        if run:
            yield answer(list(work(run)))

    return scan


_REACH_DDL = "doc__ long, tag__ long, at int, left int, right int"


def _scanned(contexts: DataFrame, min_bytes: int) -> DataFrame:
    """How far repeats reach around each single anchor, from the interval trees of the buckets."""

    def flush(rows: list[tuple]) -> Iterator[tuple]:
        if len(rows) < 2:
            return
        reach: dict[int, tuple[int, int]] = {}
        lefts, rights = [r[5] for r in rows], [r[6] for r in rows]
        for left, right, group in maximal_repeats(lefts, rights, min_bytes):
            for i in group:
                if rows[i][4]:
                    old = reach.get(i, (0, 0))
                    reach[i] = (max(old[0], left), max(old[1], right))
        for i, (left, right) in reach.items():
            yield *rows[i][1:4], left, right

    kinds = [pa.int64()] * 2 + [pa.int32()] * 3
    dealt = contexts.repartition("bucket").sortWithinPartitions("bucket", "right")
    return dealt.mapInArrow(_by_bucket(flush, kinds, _REACH_DDL), _REACH_DDL)


def _windows(contexts: DataFrame, min_bytes: int) -> tuple[DataFrame, DataFrame]:
    """All windows around the anchors of ``contexts``, and those that occur again.

    Spread by window, so that a bucket of any size is many tasks.
    """

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in zip(*[column.to_pylist() for column in batch.columns], strict=True):
                bucket, doc, tag, at, single, left, right = row
                data = np.frombuffer(left[::-1] + right, np.uint8)
                starts = np.arange(len(data) - min_bytes + 1)
                offsets = len(left) - starts
                fine = offsets >= 0
                starts, offsets = starts[fine], offsets[fine]
                hashes = _Hashed(data).of(starts, starts + min_bytes)
                n = len(starts)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(n, bucket)),
                        pa.array(hashes.astype(np.int64)),
                        pa.array(offsets.astype(np.int32)),
                        pa.array(np.full(n, doc)),
                        pa.array(np.full(n, tag)),
                        pa.array(np.full(n, at, np.int32)),
                        pa.array(np.full(n, single)),
                    ],
                    ["bucket", "window", "offset", *KEY, "at", "single"],
                )

    ddl = "bucket long, window long, offset int, doc__ long, tag__ long, at int, single boolean"
    rows = contexts.mapInArrow(windows, ddl)
    # A class of several members counts for one here; those members are covered already.
    again = rows.groupBy("bucket", "window", "offset").count().where("count > 1").drop("count")
    return rows, stored(again, "windows")


def _counted(contexts: DataFrame, min_bytes: int) -> DataFrame:
    """How far repeats reach, for buckets of too many members: each window is counted."""
    rows, again = _windows(contexts, min_bytes)
    found = rows.where("single").join(again, ["bucket", "window", "offset"], "left_semi")
    return found.groupBy(*KEY, "at").agg(
        F.max("offset").alias("left"), (F.lit(min_bytes) - F.min("offset")).alias("right")
    )


def repeated_spans(
    docs: DataFrame,
    *,
    min_bytes: int = MIN_BYTES,
    bucket: int = BUCKET,
    span_bytes: int = SPAN_BYTES,
) -> DataFrame:
    """Spans of bytes that lie in a string of ``min_bytes`` bytes which also starts elsewhere.

    Takes ``doc_id`` and ``text``; returns ``doc__, tag__`` (see :func:`row_key`) and ``first``,
    ``last`` (exclusive), in bytes of the text's UTF-8. Spans of a text overlap. Rows repeated in the
    table repeat each other. Null, empty and short texts have no spans.
    """
    with intermediate(docs.sparkSession):
        return stored(_reaches(docs, min_bytes, bucket, span_bytes), "spans", keep=True)


def _reaches(docs: DataFrame, min_bytes: int, bucket: int, span_bytes: int) -> DataFrame:
    """How far repeats reach from each anchor, as spans."""
    met, classes, ends = _anchored(docs, min_bytes, bucket, span_bytes)
    side = min_bytes + 1
    left, right = F.floor(F.col("sides") / side), F.col("sides") % side
    several = classes.where("members > 1").select("bucket", "around", "sides")
    whole = met.join(several, ["bucket", "around", "sides"], "left_semi").select(
        *KEY,
        "at",
        left.cast("int").alias("left"),
        right.cast("int").alias("right"),
    )
    small = _contexts(docs, ends.where("not large").drop("large"), min_bytes)
    parts = [whole, _scanned(small, min_bytes)]
    if not ends.where("large").isEmpty():
        large = _contexts(docs, ends.where("large").drop("large"), min_bytes)
        parts.append(_counted(stored(large, "large-buckets"), min_bytes))
    reach = parts[0]
    for part in parts[1:]:
        reach = reach.unionByName(part)
    return reach.select(
        *KEY,
        (F.col("at") - F.col("left")).alias("first"),
        (F.col("at") + F.col("right")).alias("last"),
    )


def _anchored(
    docs: DataFrame, min_bytes: int, bucket: int, span_bytes: int
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Anchors that occur again, their classes, and one member of each class in a bucket of several.

    A class is what agrees in bucket and whole surroundings; ``one`` stands for it.
    """
    anchors = anchor_rows(docs, min_bytes=min_bytes, span_bytes=span_bytes)
    # Written before they are joined, so that a frequent bucket can be split by adaptive execution.
    again = stored(anchors.groupBy("bucket").count().where("count > 1").select("bucket"), "again")
    met = stored(anchors.join(again, "bucket", "left_semi"), "anchors")
    classes = met.groupBy("bucket", "around", "sides").agg(
        F.count(F.lit(1)).alias("members"), F.min(F.struct(*KEY, "at")).alias("one")
    )
    classes = stored(classes, "anchor-classes")
    sizes = classes.groupBy("bucket").agg(F.count(F.lit(1)).alias("classes"))
    sizes = stored(sizes.where("classes > 1"), "bucket-sizes")
    ends = classes.join(sizes, "bucket").select(
        "bucket",
        "one.doc__",
        "one.tag__",
        "one.at",
        (F.col("members") == 1).alias("single"),
        (F.col("classes") > bucket).alias("large"),
    )
    return met, classes, stored(ends, "repeat-ends")


_GROUP_DDL = "bucket long, group long, left int, right int, doc__ long, tag__ long, at int"


def _grouped(contexts: DataFrame, min_bytes: int) -> DataFrame:
    """Maximal repeats of each bucket with one row for each class that has them."""

    def name(text: bytes) -> int:
        return int.from_bytes(hashlib.blake2b(text, digest_size=8).digest(), "little", signed=True)

    def groups(rows: list[tuple]) -> Iterator[tuple]:
        # A class of several members is there twice, so that what they share is an interval, too.
        rows = [row for row in rows for _ in range(1 if row[4] else 2)]
        lefts, rights = [r[5] for r in rows], [r[6] for r in rows]
        for left, right, group in maximal_repeats(lefts, rights, min_bytes):
            string = lefts[group[0]][:left][::-1] + rights[group[0]][:right]
            # In a periodic string the anchor may be the choice of windows beyond it only; there it
            # need not be one at other places, and another anchor of the string has them all.
            data = np.frombuffer(string, np.uint8)
            ends = np.full(len(data), len(data))
            if left not in _anchors(data, ends, 0, len(data), min_bytes)[0]:
                continue
            found = name(string)
            for i in group:
                yield rows[i][0], found, left, right, *rows[i][1:4]

    dealt = contexts.repartition("bucket").sortWithinPartitions("bucket", "right")
    kinds = [pa.int64()] * 2 + [pa.int32()] * 2 + [pa.int64()] * 2 + [pa.int32()]
    return dealt.mapInArrow(_by_bucket(groups, kinds, _GROUP_DDL), _GROUP_DDL)


def repeat_groups(
    docs: DataFrame,
    *,
    min_bytes: int = MIN_BYTES,
    bucket: int = BUCKET,
    span_bytes: int = SPAN_BYTES,
) -> DataFrame:
    """Maximal repeats with all their occurrences: ``group, n_bytes, doc__, tag__, first, last``.

    A group is one string of at least ``min_bytes`` bytes; its rows are all the places where it
    occurs, and neither the byte before nor the one after agrees in all of them. Strings are followed
    to ``min_bytes`` - ``ANCHOR`` bytes before and ``min_bytes`` bytes after an anchor; a longer repeat
    is a chain of groups that overlap, and in a bucket of more than ``bucket`` surroundings its windows
    of ``min_bytes`` bytes are the groups. Takes and treats ``docs`` like :func:`repeated_spans`.
    """
    met, classes, ends = _anchored(docs, min_bytes, bucket, span_bytes)
    side = min_bytes + 1
    small = _contexts(docs, ends.where("not large").drop("large"), min_bytes)
    large = _contexts(docs, ends.where("large").drop("large"), min_bytes)
    rows, again = _windows(large, min_bytes)
    windows = rows.join(again, ["bucket", "window", "offset"], "left_semi").select(
        "bucket",
        F.col("window").alias("group"),
        F.col("offset").alias("left"),
        (F.lit(min_bytes) - F.col("offset")).alias("right"),
        *KEY,
        "at",
    )
    inner = _grouped(small, min_bytes).unionByName(windows).select(
        "group", "left", "right", F.col("bucket").alias("b"), F.struct(*KEY, "at").alias("rep")
    )
    same = (F.col("bucket") == F.col("b")) & (F.col("one") == F.col("rep"))
    named = classes.join(inner, same).select("bucket", "around", "sides", "group", "left", "right")
    alone = classes.join(ends.select("bucket").distinct(), "bucket", "left_anti")
    whole = alone.where("members > 1").select(
        "bucket",
        "around",
        "sides",
        F.xxhash64("bucket", "around", "sides").alias("group"),
        F.floor(F.col("sides") / side).cast("int").alias("left"),
        (F.col("sides") % side).cast("int").alias("right"),
    )
    return met.join(
        stored(named.unionByName(whole), "groups"), ["bucket", "around", "sides"]
    ).select(
        "group",
        (F.col("left") + F.col("right")).alias("n_bytes"),
        *KEY,
        (F.col("at") - F.col("left")).alias("first"),
        (F.col("at") + F.col("right")).alias("last"),
    ).distinct()


def _merged(spans: list[dict]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for first, last in sorted((s["first"], s["last"]) for s in spans):
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], last))
        else:
            out.append((first, last))
    return out


def _rest(content: bytes, spans: list[tuple[int, int]]) -> bytes:
    out, start = [], 0
    for first, last in spans:
        out.append(content[start:first])
        start = last
    out.append(content[start:])
    return b"".join(out)


def remove_repeats(
    docs: DataFrame,
    *,
    min_bytes: int = MIN_BYTES,
    bucket: int = BUCKET,
    span_bytes: int = SPAN_BYTES,
) -> DataFrame:
    """Each row of ``docs`` without its repeated bytes.

    Returns ``doc_id``, the row key, ``n_bytes``, ``n_removed``, ``spans`` (maximal removed runs, as
    pairs of first byte and the one after the last), ``kept_bytes``. Every occurrence of a repeat is
    removed; strings are judged on the input. An empty table gives an empty result.
    """
    spans = repeated_spans(
        docs, min_bytes=min_bytes, bucket=bucket, span_bytes=span_bytes
    )
    spans = spans.groupBy(*KEY).agg(F.collect_set(F.struct("first", "last")).alias("spans"))

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                some = batch.slice(start, 256)
                sizes, removed, runs, kept = [], [], [], []
                for content, found in zip(
                    some.column(3).to_pylist(), some.column(4).to_pylist(), strict=True
                ):
                    content = unpack.decompress(content)
                    merged = _merged(found or [])
                    rest = _rest(content, merged) if merged else content
                    sizes.append(len(content))
                    removed.append(len(content) - len(rest))
                    runs.append([{"first": a, "last": b} for a, b in merged])
                    kept.append(rest)
                yield pa.RecordBatch.from_arrays(
                    [
                        *some.columns[:3],
                        pa.array(sizes, pa.int64()),
                        pa.array(removed, pa.int64()),
                        pa.array(
                            runs, pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))
                        ),
                        pa.array(kept, pa.binary()),
                    ],
                    ["doc_id", *KEY, "n_bytes", "n_removed", "spans", "kept_bytes"],
                )

    joined = _packed(docs).join(spans, KEY, "left").select("doc_id", *KEY, "content", "spans")
    return joined.mapInArrow(
        remove,
        "doc_id long, doc__ long, tag__ long, n_bytes long, n_removed long, "
        "spans array<struct<first: int, last: int>>, kept_bytes binary",
    )


def _cut_text(text: pd.Series, spans: pd.Series) -> pd.Series:
    """Texts without their spans of bytes, widened to whole characters."""

    def cut(whole: str, found: list) -> str:
        content = whole.encode()
        wide = []
        for first, last in _merged(found):
            while first > 0 and content[first] & 0xC0 == 0x80:
                first -= 1
            while last < len(content) and content[last] & 0xC0 == 0x80:
                last += 1
            wide.append({"first": first, "last": last})
        return _rest(content, _merged(wide)).decode()

    pairs = zip(text, spans, strict=True)
    return pd.Series([w if s is None or not len(s) else cut(w, list(s)) for w, s in pairs], dtype=object)


def drop_repeats(docs: DataFrame, *, min_bytes: int = MIN_BYTES) -> DataFrame:
    """``docs`` with ``text`` freed of repeated strings; all rows and columns stay.

    Every occurrence goes, as in :func:`remove_repeats`; a character that is cut into goes as a whole.
    If there is a column ``n_chars``, it is counted anew where the text has changed. Null texts stay
    null; a text may become empty.
    """
    spans = repeated_spans(docs, min_bytes=min_bytes)
    spans = spans.groupBy(*KEY).agg(F.collect_set(F.struct("first", "last")).alias("spans__"))
    joined = with_rows(docs).join(spans, KEY, "left")
    # Texts without spans do not pass through Python.
    cut = F.pandas_udf(_cut_text, "string")("original__.text", "spans__")
    changed = F.col("original__").withField("text", F.col("cut__"))
    if "n_chars" in docs.columns:
        count = F.char_length("cut__").cast(docs.schema["n_chars"].dataType)
        changed = changed.withField("n_chars", count)
    changed = joined.where("spans__ is not null").withColumn("cut__", cut).select(
        changed.alias("original__")
    )
    same = joined.where("spans__ is null").select("original__")
    return same.unionByName(changed).select("original__.*")


def op7_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_bytes",
        "n_removed",
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept_bytes", 256).alias("kept_sha256"),
    )
