"""Token-ID files: documents compressed one by one with a shared zstandard dictionary.

The file format is a Parquet folder of blocks in the order of document ids. A block holds the frames
of some documents, one behind the other, with an offset index (where each frame begins, and the ids
and token counts of its documents), so that one short document is read by decompressing one frame.
Ids are serialised as little-endian unsigned 16-bit integers where the vocabulary allows it, 32-bit
otherwise. The dictionary lies beside the blocks; each block names its hash.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewatch.llm.common import NO_ID, table, texts
from tidewatch.llm.tokens import encoder
from tidewatch.session import scratch_folder

# The dictionary is trained on so many documents at most, of so many bytes of text each at most.
DICTIONARY_DOCS = 2000
DICTIONARY_DOC_BYTES = 1 << 16
DICTIONARY_BYTES = 1 << 16
# A block is closed when its frames have so many bytes.
BLOCK_BYTES = 4 << 20
LEVEL = 3
# Documents encoded together.
DOCS = 2048

_BLOCK = pa.schema(
    [
        ("part", pa.int32()),
        ("block", pa.int32()),
        ("first_id", pa.int64()),
        ("last_id", pa.int64()),
        ("part_start", pa.int64()),
        ("tokens", pa.int64()),
        ("ids", pa.list_(pa.int64())),
        ("counts", pa.list_(pa.int32())),
        ("offsets", pa.list_(pa.int64())),
        ("frames", pa.binary()),
        ("dictionary", pa.string()),
    ]
)
_BLOCK_DDL = (
    "part int, block int, first_id long, last_id long, part_start long, tokens long, "
    "ids array<long>, counts array<int>, offsets array<long>, frames binary, dictionary string"
)


@dataclass(frozen=True)
class Dictionary:
    """``data`` may be empty: frames then need no dictionary."""

    data: bytes

    @property
    def hash(self) -> str:
        return hashlib.sha256(self.data).hexdigest()

    def _shared(self) -> zstandard.ZstdCompressionDict | None:
        return zstandard.ZstdCompressionDict(self.data) if self.data else None

    def compressor(self, level: int = LEVEL) -> zstandard.ZstdCompressor:
        return zstandard.ZstdCompressor(level=level, dict_data=self._shared())

    def decompressor(self) -> zstandard.ZstdDecompressor:
        return zstandard.ZstdDecompressor(dict_data=self._shared())


def _width(tokenizer: str, end_id: int) -> str:
    size = encoder(tokenizer).tokenizer.get_vocab_size(with_added_tokens=True)
    return "<u2" if max(size - 1, end_id) < 1 << 16 else "<u4"


def _serialised(found: list[bytes], end_id: int, kind: str) -> list[np.ndarray]:
    return [np.append(np.frombuffer(ids, "<u4"), end_id).astype(kind) for ids in found]


def train_dictionary(docs: DataFrame, tokenizer: str, end_id: int) -> Dictionary:
    """A dictionary trained on id arrays of a bounded sample of ``docs``.

    The sample is those of at most ``DICTIONARY_DOC_BYTES`` bytes among the ``DICTIONARY_DOCS``
    documents of the smallest hashes of ids; it affects the size of the frames only. Too small a sample
    is used as it is, without training.
    """
    rank = F.xxhash64("doc_id")
    lowest = texts(docs).select(rank.alias("h")).orderBy("h").limit(DICTIONARY_DOCS)
    highest = lowest.agg(F.max("h")).first()[0]
    sample = []
    if highest is not None:
        near = texts(docs).where((rank <= highest) & (F.octet_length("text") <= DICTIONARY_DOC_BYTES))
        sample = near.select("text").limit(DICTIONARY_DOCS).collect()
    kind = _width(tokenizer, end_id)
    found = encoder(tokenizer).encode([row.text for row in sample])
    samples = [ids.tobytes() for ids in _serialised(found, end_id, kind)]
    try:
        return Dictionary(zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes())
    except zstandard.ZstdError:
        return Dictionary(b"".join(samples)[-DICTIONARY_BYTES:] if len(samples) > 1 else b"")


def _blocks(tokenizer: str, end_id: int, kind: str, dictionary: Dictionary, block_bytes: int):
    name = dictionary.hash

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        pack, tokenize = dictionary.compressor(), encoder(tokenizer)
        ids, counts, frames, size, start, block = [], [], [], 0, 0, 0

        def close() -> pa.RecordBatch:
            nonlocal ids, counts, frames, size, start, block
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in frames])]).tolist()
            row = {
                "part": part,
                "block": block,
                "first_id": NO_ID if ids[0] is None else ids[0],
                "last_id": NO_ID if ids[-1] is None else ids[-1],
                "part_start": start,
                "tokens": sum(counts),
                "ids": ids,
                "counts": counts,
                "offsets": offsets,
                "frames": b"".join(frames),
                "dictionary": name,
            }
            start, block = start + row["tokens"], block + 1
            ids, counts, frames, size = [], [], [], 0
            return pa.RecordBatch.from_pylist([row], schema=_BLOCK)

        for batch in batches:
            for at in range(0, batch.num_rows, DOCS):
                some = batch.slice(at, DOCS)
                found = tokenize.encode(some.column(1).to_pylist())
                for doc, array in zip(
                    some.column(0).to_pylist(), _serialised(found, end_id, kind), strict=True
                ):
                    frame = pack.compress(array.tobytes())
                    ids.append(doc)
                    counts.append(len(array))
                    frames.append(frame)
                    size += len(frame)
                    if size >= block_bytes:
                        yield close()
        if ids:
            yield close()

    return encode


def write_token_file(
    docs: DataFrame,
    path: str,
    *,
    tokenizer: str,
    end_id: int,
    block_bytes: int = BLOCK_BYTES,
) -> None:
    """Encode ``docs`` (``doc_id, text``) and write them to ``path`` in ascending ``doc_id`` order.

    Whole texts are encoded, ``end_id`` is appended to each. Null texts count as empty, null ids come
    first, rows of one id are in the order of their texts' hashes; repeated rows are written as often
    as they occur. An empty table gives a file of no blocks.
    """
    dictionary = train_dictionary(docs, tokenizer, end_id)
    kind = _width(tokenizer, end_id)
    spark = docs.sparkSession
    about = [(dictionary.hash, bytearray(dictionary.data), kind, end_id)]
    spark.createDataFrame(about, "hash string, data binary, kind string, end_id long").coalesce(
        1
    ).write.parquet(f"{path}/dictionary")
    # Texts are dealt by id before they are encoded: dealing samples its input, and would otherwise
    # encode everything twice.
    # The row number spreads rows that are equal in both; their order makes no difference.
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), F.col("row__")]
    numbered = texts(docs).withColumn("row__", F.monotonically_increasing_id())
    dealt = numbered.repartitionByRange(*order).sortWithinPartitions(*order).drop("row__")
    blocks = dealt.mapInArrow(_blocks(tokenizer, end_id, kind, dictionary, block_bytes), _BLOCK_DDL)
    blocks.write.option("compression", "uncompressed").parquet(f"{path}/blocks")


def _open(spark: SparkSession, path: str) -> tuple[DataFrame, Dictionary, str]:
    about = spark.read.parquet(f"{path}/dictionary").first()
    dictionary = Dictionary(bytes(about["data"]))
    if dictionary.hash != about["hash"]:
        raise ValueError(f"the dictionary of {path} is damaged")
    return spark.read.schema(_BLOCK_DDL).parquet(f"{path}/blocks"), dictionary, about["kind"]


def _decode(dictionary: Dictionary, kind: str, wanted: frozenset | None = None):
    """Documents of blocks: their start, ids as little-endian unsigned 32-bit integers, and CRC."""
    name = dictionary.hash

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = dictionary.decompressor()
        for batch in batches:
            for row in (batch.slice(i, 1).to_pylist()[0] for i in range(batch.num_rows)):
                if row["dictionary"] != name:
                    raise ValueError("a block was written with another dictionary")
                frames, offsets = memoryview(row["frames"]), row["offsets"]
                start, rows = row["start"], []
                for i, (doc, count) in enumerate(zip(row["ids"], row["counts"], strict=True)):
                    if wanted is None or doc in wanted:
                        frame = unpack.decompress(frames[offsets[i] : offsets[i + 1]])
                        ids = np.frombuffer(frame, kind).astype("<u4").tobytes()
                        rows.append((doc, start, count, zlib.crc32(ids), ids))
                    start += count
                columns = list(zip(*rows, strict=True)) or [[]] * 5
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                    ["doc_id", "start", "n_tokens", "ids_crc32", "ids"],
                )

    return decode


_DOCS_DDL = "doc_id long, start long, n_tokens long, ids_crc32 long, ids binary"


def _placed(blocks: DataFrame) -> DataFrame:
    """Blocks with ``start``, the ids of all documents before them."""
    totals = blocks.groupBy("part").agg(F.sum("tokens").alias("all"))
    # One row for each written file, so at most as many as the shuffle has partitions.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("part", F.coalesce(F.sum("all").over(before), F.lit(0)).alias("before"))
    start = F.col("before") + F.col("part_start")
    return blocks.join(F.broadcast(offsets), "part").withColumn("start", start)


def read_token_file(spark: SparkSession, path: str) -> DataFrame:
    """Every document of the file: ``doc_id, start, n_tokens, ids_crc32, ids``."""
    blocks, dictionary, kind = _open(spark, path)
    return _placed(blocks).mapInArrow(_decode(dictionary, kind), _DOCS_DDL)


def read_documents(spark: SparkSession, path: str, ids: list[int]) -> DataFrame:
    """Some documents by id: only blocks that may hold them are read, only their frames unpacked.

    Ids that are not there give no row, an id written several times gives each, and without ``ids``
    the result is empty. Documents without id cannot be asked for. An empty text has its end id.
    """
    blocks, dictionary, kind = _open(spark, path)
    near = F.lit(False)
    for one in ids:
        near = near | ((F.col("first_id") <= one) & (F.col("last_id") >= one))
    return (
        _placed(blocks).where(near).mapInArrow(_decode(dictionary, kind, frozenset(ids)), _DOCS_DDL)
    )


def op2_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_folder(spark, "token-file")
    write_token_file(
        table(spark, sf_dir, "documents"),
        path,
        tokenizer=public_tokenizers.path("word_bpe_49k.json"),
        end_id=2,
    )
    return read_token_file(spark, path).select("doc_id", "start", "n_tokens", "ids_crc32")
