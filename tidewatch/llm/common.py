"""What the operators share: tables, intermediate results, row keys."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.session import configure, scratch_folder

Query = Callable[[SparkSession, str], DataFrame]

# Stands for a null document id where a number is needed.
NO_ID = -(2**63)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


# Rows that Spark hands to Python at a time: whole texts, so fewer than usual.
BATCH_ROWS = 1000


def texts(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id`` and ``text`` alone: other columns cannot clash, a null text is an empty one."""
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return docs.select(
        F.col(f"`{id_column}`").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"`{text_column}`").cast("string"), F.lit("")).alias("text"),
    )


def row_key(docs: DataFrame) -> DataFrame:
    """Add ``doc__`` and ``tag__``: together they name a row by its ``doc_id`` and ``text``.

    They are 128 bits of hash of both, so that many rows of one id (or without one) with different
    texts get different names, and are spread in joins; equal rows share the name.
    """
    named = [F.col("doc_id").cast("long"), F.coalesce(F.col("text"), F.lit(""))]
    return docs.withColumn("doc__", F.xxhash64(F.lit(1), *named)).withColumn(
        "tag__", F.xxhash64(F.lit(2), *named)
    )


KEY = ["doc__", "tag__"]


def with_rows(docs: DataFrame) -> DataFrame:
    """:data:`KEY` and the whole row as ``original__``: none of its columns can clash with others."""
    named = docs.select(F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("original__"))
    keyed = row_key(
        named.withColumn("doc_id", F.col("original__.doc_id")).withColumn(
            "text", F.col("original__.text")
        )
    )
    return keyed.select("original__", *KEY)


def keep_rows(docs: DataFrame, decisions: DataFrame) -> DataFrame:
    """Rows of ``docs`` that ``decisions`` (:data:`KEY` and ``kept``, one for each row) keeps.

    Of rows equal in id and text all stay if all are kept, else one if any is; all columns are
    returned as they were.
    """
    marks = (
        decisions.groupBy(*KEY)
        .agg(F.bool_or("kept").alias("stays__"), F.bool_and("kept").alias("all__"))
        .where("not all__")
    )
    keyed = with_rows(docs)
    single = keyed.join(marks, KEY, "left_anti")
    repeated = keyed.join(marks.where("stays__"), KEY, "left_semi").dropDuplicates(KEY)
    return single.unionByName(repeated).select("original__.*")


def held_out(ids: Column) -> Column:
    """Whether rows of these ids are kept from every fit: crc32 of the id as text, mod 5, is 0."""
    return F.coalesce(F.crc32(ids.cast("string").cast("binary")) % 5 == 0, F.lit(False))


# The folder of the innermost block of :func:`intermediate`.
_FOLDER: ContextVar[str | None] = ContextVar("folder", default=None)


@contextmanager
def intermediate(spark: SparkSession) -> Iterator[None]:
    """Tables that are :func:`stored` in this block are deleted at its end.

    What the block hands on has to be stored with ``keep``.
    """
    folder = scratch_folder(spark, "intermediate")
    before = _FOLDER.set(folder)
    try:
        yield
    finally:
        _FOLDER.reset(before)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stored(frame: DataFrame, purpose: str, *, keep: bool = False) -> DataFrame:
    """Write ``frame`` once to the shared folder and read it back.

    Cuts the lineage, and survives a lost executor. The files are compressed, unlike those of a
    checkpoint.
    """
    spark = frame.sparkSession
    folder = None if keep else _FOLDER.get()
    path = f"{folder or scratch_folder(spark, purpose)}/{purpose}-{uuid.uuid4().hex}"
    frame.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(frame.schema).parquet(path)
