"""Token counts from a cache: contents that were counted before are not encoded again.

The cache is a table of content digests and counts, in one folder for each version of a tokenizer (a
digest of its file, its library and how it is called). Contents are digested while scanning, their
digests joined with the cache, and one text for each digest that misses is encoded and appended. Then
every document finds its count there.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm.common import NO_ID, intermediate, stored, table, texts
from tidewatch.llm.piece import META, USER, PieceModel, read_model, separable
from tidewatch.session import scratch_folder

# Distinct words in each of the two generations of the counter's memory.
WORDS = 300_000
# Rows and bytes of text encoded at a time; a longer text is encoded by itself.
ROWS, SLICE_BYTES = 256, 8 << 20
# Contents that at least one row in so many has are sent to all tasks: at most so many digests.
FREQUENT = 1000
# Goes into the version digest: raise it if the way of counting changes.
METHOD = "1"

_CACHE = "digest binary, n_tokens long"


class PieceCounter:
    """Numbers of pieces as the sentencepiece library gives them.

    Where no piece goes on after a blank, a text has the pieces of its words, and each word is encoded
    once for as long as it is remembered; other texts are encoded whole.
    """

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        m = read_model(path)
        self.words = separable(m) and m.dummy_prefix and not m.charsmap and not m.remove_extra
        self.words = self.words and not any(kind == USER for *_, kind in m.pieces)
        self.young: dict[str, int] = {}
        self.old: dict[str, int] = {}

    def _encode(self, some: list[str]) -> list[int]:
        return [len(ids) for ids in self.library.encode(some, num_threads=1)]

    def count(self, column: pa.LargeStringArray) -> np.ndarray:
        """Number of pieces of each text."""
        if not self.words:
            return np.array(self._encode(column.to_pylist()), np.int64)
        # A word is what stands between single blanks; the others go whole.
        odd = pc.match_substring_regex(column, f"^ |  | $|{META}|^$")
        lists = pc.split_pattern(pc.if_else(odd, pa.scalar("", pa.large_string()), column), " ")
        named = lists.flatten().dictionary_encode()
        words = named.dictionary.to_pylist()
        new = [word for word in words if word not in self.young]
        fresh = [word for word in new if word not in self.old]
        self.young.update((word, self.old[word]) for word in new if word in self.old)
        self.young.update(zip(fresh, self._encode(fresh), strict=True))
        known = np.fromiter(map(self.young.__getitem__, words), np.int64, len(words))
        ends = np.concatenate([[0], np.cumsum(known[named.indices.to_numpy()])])
        bounds = lists.offsets.to_numpy()
        counts = np.diff(ends[bounds - bounds[0]])
        whole = np.flatnonzero(odd.to_numpy(zero_copy_only=False))
        counts[whole] = self._encode(column.take(pa.array(whole)).to_pylist())
        if len(self.young) > WORDS:
            self.young, self.old = {}, self.young
        return counts


class JsonCounter:
    """Numbers of tokens as the tokenizers library gives them, of whole texts."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()

    def count(self, column: pa.LargeStringArray) -> np.ndarray:
        found = self.tokenizer.encode_batch_fast(column.to_pylist(), add_special_tokens=False)
        return np.array([len(x.ids) for x in found], np.int64)


_COUNTERS: dict[str, PieceCounter | JsonCounter] = {}


def _counter(path: str) -> PieceCounter | JsonCounter:
    """The counter of this Python process; tasks that follow each other share its words."""
    if path not in _COUNTERS:
        _COUNTERS.clear()
        _COUNTERS[path] = PieceCounter(path) if path.endswith(".model") else JsonCounter(path)
    return _COUNTERS[path]


def tokenizer_digest(path: str) -> str:
    """Names a version of a tokenizer: its file, library and library version, and :data:`METHOD`."""
    if path.endswith(".model"):
        import sentencepiece as library
    else:
        import tokenizers as library
    with open(path, "rb") as file:
        content = file.read()
    said = f"{library.__name__} {library.__version__} {METHOD} ".encode()
    return hashlib.sha256(said + content).hexdigest()


def normalised(text: Column, path: str) -> Column:
    """What is digested: the text, less what this tokenizer is known to take no notice of.

    A sentencepiece model that removes extra blanks (and has no other rules) sees them once between
    words and not at the ends.
    """
    model = read_model(path) if path.endswith(".model") else PieceModel([], remove_extra=False)
    if not model.remove_extra or model.charsmap:
        return text
    return F.trim(F.regexp_replace(text, " {2,}", " "))


def _count_slices(path: str):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use = _counter(path)
        for batch in batches:
            wide = batch.column(1).cast(pa.large_string())
            ends = np.cumsum(pc.binary_length(wide).to_numpy())
            at = 0
            while at < len(wide):
                begin = int(ends[at - 1]) if at else 0
                end = int(np.searchsorted(ends, begin + SLICE_BYTES, "right"))
                end = min(max(end, at + 1), at + ROWS, len(wide))
                counts = use.count(wide.slice(at, end - at))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, end - at), pa.array(counts)], ["digest", "n_tokens"]
                )
                at = end

    return count


def read_cache(spark: SparkSession, cache: str, version: str) -> DataFrame:
    """``digest, n_tokens`` of one tokenizer version; each digest once, whoever appended it."""
    try:
        found = spark.read.schema(_CACHE).parquet(f"{cache}/tokenizer={version}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _CACHE)
    return found.groupBy("digest").agg(F.min("n_tokens").alias("n_tokens"))


def _misses(rows: DataFrame, known: DataFrame) -> DataFrame:
    """``digest, doc_id`` of one row of each digest that the cache lacks."""
    return rows.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).join(known, "digest", "left_anti")


def fill_cache(docs: DataFrame, rows: DataFrame, *, tokenizer: str, cache: str) -> None:
    """Append the counts of contents of ``docs`` (``digest, doc_id, text``) that ``cache`` lacks.

    ``rows`` is its ``digest, doc_id``. One row for each digest is encoded; rows are dealt by digest and
    id, so that the copies of a text meet in no one task. Equal rows of an id are encoded where they
    meet, and appended once.
    """
    version = tokenizer_digest(tokenizer)
    missing = stored(_misses(rows, read_cache(docs.sparkSession, cache, version)), "missing")
    if missing.isEmpty():
        return
    wanted = docs.join(missing, ["digest", "doc_id"], "left_semi").select("digest", "text")
    counts = wanted.mapInArrow(_count_slices(tokenizer), _CACHE)
    new = counts.groupBy("digest").agg(F.min("n_tokens").alias("n_tokens"))
    new.write.mode("append").option("compression", "zstd").parquet(f"{cache}/tokenizer={version}")


def _with_counts(rows: DataFrame, known: DataFrame) -> DataFrame:
    """``rows`` with ``n_tokens``: frequent digests, at most :data:`FREQUENT`, go to all tasks."""
    sizes = rows.groupBy("digest").agg(F.count("*").alias("rows"))
    often = sizes.where(F.col("rows") >= max(2, -(-rows.count() // FREQUENT)))
    often = stored(often.select("digest").join(known, "digest"), "frequent")
    marked = rows.join(
        F.broadcast(often.withColumnRenamed("n_tokens", "known__")), "digest", "left"
    )
    rest = marked.where("known__ IS NULL").drop("known__").join(known, "digest")
    return marked.where("known__ IS NOT NULL").withColumnRenamed("known__", "n_tokens").unionByName(rest)


def count_tokens(
    docs: DataFrame, *, tokenizer: str, cache: str | None = None, limit: int = 4096
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of each row of ``docs`` (``doc_id, text``).

    ``tokenizer`` is a ``.json`` file of the tokenizers library or a ``.model`` file of sentencepiece;
    texts get the plain call of that library, without added tokens. ``cache`` is a folder all executors
    reach; without it a new one is made below ``spark.checkpoint.dir``. Another version of the file or
    the library is counted anew. Runs may share a cache: one appended to by two at once has some
    digests twice, which are read once.

    A null text is an empty one of 0 bytes. Null ids and repeated rows stay as they are. Texts are
    counted whole, however long. Other columns are not looked at. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    cache = cache or scratch_folder(spark, "token-counts")
    with intermediate(spark):
        content = F.unhex(F.sha2(normalised(F.col("text"), tokenizer), 256))
        plain = texts(docs).withColumn("digest", content)
        rows = stored(
            plain.select("doc_id", "digest", F.octet_length("text").cast("long").alias("n_bytes")),
            "digests",
        )
        no_id = F.coalesce("doc_id", F.lit(NO_ID)).alias("doc_id")
        fill_cache(
            plain.select("digest", no_id, "text"),
            rows.select("digest", no_id),
            tokenizer=tokenizer,
            cache=cache,
        )
        known = read_cache(spark, cache, tokenizer_digest(tokenizer))
        counted = _with_counts(rows, known).select(
            "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
        )
        return stored(counted, "counted", keep=True)


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("piece_bpe_32k.model")
    return count_tokens(table(spark, sf_dir, "documents"), tokenizer=path)
