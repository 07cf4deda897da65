"""Exact duplicates by progressive refinement: length, then prefix hash, then full hash.

Built-in functions only. A first pass looks at the length of the normalised text, a second at a
hash of its beginning, and the full content is hashed for rows alone that share both with another
row. The passes exchange narrow rows that are combined on the map side; the joins back to the rows
have the rows on the side that adaptive execution can split, so a group with a third of all rows is
spread.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm.common import KEY, keep_rows, row_key, stored, table, texts

# Characters that do not count when texts are compared: blank and the controls 9 to 13.
BLANKS = " \t\n\x0b\x0c\r"
PREFIX_CHARS = 128


def normalised(text: Column) -> Column:
    return F.translate(text, BLANKS, "")


def exact_groups(
    docs: DataFrame, *, prefix_chars: int = PREFIX_CHARS, hash_all: bool = False
) -> DataFrame:
    """Rows of ``docs`` with their group of equal texts.

    Takes ``doc_id`` and ``text``; returns ``doc_id, keep_id, group_size, kept, text_sha256``, one
    row for each input row. Of equal texts (white space aside) the one with the most code points
    stays, then the one with the smallest id; null ids come last, and of rows that agree in id and
    length an arbitrary one stays. Null counts as empty; empty texts equal each other. An empty table
    gives an empty result. ``text_sha256`` is null for rows that no other row resembles, unless
    ``hash_all`` asks for it; then the hash is taken while scanning, and no text is shuffled.
    """
    return _grouped(docs, prefix_chars, hash_all).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256"
    )


def _grouped(docs: DataFrame, prefix_chars: int, hash_all: bool) -> DataFrame:
    rows = row_key(texts(docs)).select(
        "doc_id",
        *KEY,
        F.char_length("text").alias("points"),
        normalised(F.col("text")).alias("norm"),
    )
    rows = rows.withColumn("length", F.octet_length("norm"))
    by_length = rows.groupBy("length").count().where("count > 1").select("length")
    rows = rows.withColumn("prefix", F.xxhash64(F.substring("norm", 1, prefix_chars)))
    # Combined before the test of the length, so that a frequent length is few rows there.
    by_prefix = rows.groupBy("length", "prefix").count()
    shared = (
        by_prefix.join(by_length, "length", "left_semi")
        .where("count > 1")
        .select("length", "prefix", F.lit(True).alias("survives"))
    )
    full = F.sha2("norm", 256)
    if hash_all:
        hashed = (
            rows.withColumn("text_sha256", full)
            .drop("norm")
            .join(shared, ["length", "prefix"], "left")
        )
    else:
        hashed = rows.join(shared, ["length", "prefix"], "left").withColumn(
            "text_sha256", F.when(F.col("survives"), full)
        )
    hashed = stored(
        hashed.select(
            "doc_id",
            *KEY,
            "points",
            "length",
            "text_sha256",
            F.coalesce("survives", F.lit(False)).alias("survives"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "exact",
    )
    order = F.struct(
        (-F.col("points")).alias("points"),
        F.col("doc_id").isNull().alias("nameless"),
        "doc_id",
        "row",
    )
    groups = (
        hashed.where("survives")
        .groupBy("length", "text_sha256")
        .agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("size"))
        .where("size > 1")
        .select(
            F.col("length").alias("g_length"),
            F.col("text_sha256").alias("g_hash"),
            F.col("first.doc_id").alias("g_keep"),
            F.col("first.row").alias("g_row"),
            "size",
        )
    )
    groups = stored(groups, "groups")
    same = (
        F.col("survives")
        & (F.col("length") == F.col("g_length"))
        & (F.col("text_sha256") == F.col("g_hash"))
    )
    grouped = F.col("size").isNotNull()
    return hashed.join(groups, same, "left").select(
        "doc_id",
        *KEY,
        F.when(grouped, F.col("g_keep")).otherwise(F.col("doc_id")).alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("row") == F.col("g_row"), F.lit(True)).alias("kept"),
        "text_sha256",
    )


def drop_copies(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group of equal texts, all columns as they were.

    A null text is an empty one, and empty and blank texts are equal to each other. Of equal texts the
    one with the most code points in the original stays, then that of the smallest id (nulls last), of
    rows equal in both an arbitrary one. Texts are compared whole, however long. Extra columns may have
    any name. An empty table gives an empty result.
    """
    groups = stored(_grouped(docs, PREFIX_CHARS, False).select(*KEY, "kept"), "exact-groups")
    return keep_rows(docs, groups)


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"), hash_all=True)


SQL = {
    "op5_exact_dedup": r"""
        WITH t AS (
            SELECT doc_id, length(coalesce(text, '')) AS points,
                   sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g'))
                       AS text_sha256
            FROM documents),
        n AS (
            SELECT *, row_number() OVER (PARTITION BY text_sha256 ORDER BY points DESC, doc_id)
                          AS place,
                   count(*) OVER (PARTITION BY text_sha256) AS group_size,
                   first_value(doc_id) OVER (PARTITION BY text_sha256
                                             ORDER BY points DESC, doc_id) AS keep_id
            FROM t)
        SELECT doc_id, keep_id, group_size, place = 1 AS kept, text_sha256 FROM n
    """
}
