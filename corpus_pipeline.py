"""From raw documents to packed sequences, one operator a stage.

Each stage works on all that its predecessor kept. Between stages the documents are written as
Parquet to the shared folder and read again. In all stages a null text is an empty one, texts are taken
whole, however long, null ids stay null, extra columns stay as they are (packing returns its own), and an
empty table gives an empty result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidewatch.llm.common import stored, table
from tidewatch.llm.exact import drop_copies
from tidewatch.llm.minhash import drop_near_copies
from tidewatch.llm.packing import pack
from tidewatch.llm.repeats import drop_repeats
from tidewatch.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.5 or more go; the model is fitted on ``labels``.

    Empty texts score as texts without evidence do; repeated rows stay or go together.
    """
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, white space aside, one stays: the longest, then that of the smallest id.

    Empty and blank texts are equal to each other; of repeated rows one stays.
    """
    return drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by 0.8 of their five-word shingles, one stays: that of the smallest id.

    Texts without words are linked with nothing; of repeated rows one stays.
    """
    return drop_near_copies(docs, words=5, percent=80)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 200 bytes and more that occur again are cut out of the texts.

    All their places go, in repeated rows as well, so a text may become empty; its row stays.
    """
    return drop_repeats(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens: one row for each piece of a document.

    An empty text is its end id alone; repeated rows are packed each.
    """
    return pack(docs, tokenizer=public_tokenizers.path("byte_bpe_50k.json"), end_id=1)


STAGES = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("suffix_dedup", suffix_dedup),
    ("packing", packing),
]

# SQL cannot express the stages; the tests hold them against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, applied to the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
