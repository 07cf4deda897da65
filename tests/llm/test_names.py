"""Rows of one id with different texts whose 32-bit hashes agree stay different rows."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from tidewatch.llm import exact, minhash, repeats, toxicity
from tidewatch.llm.common import KEY, row_key, texts

FIRST = brute.PASSAGE + "a13646"
SECOND = " ".join(f"w{i}" for i in range(100)) + " b169726"


@pytest.fixture(scope="module")
def clash(spark):
    rows = [(None, FIRST), (None, SECOND), (1, brute.PASSAGE + "other")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").cache()
    hashes = {r.h for r in frame.where("doc_id is null").select(F.hash("text").alias("h")).collect()}
    assert len(hashes) == 1
    return frame


def test_names_differ(clash):
    assert row_key(texts(clash)).select(*KEY).distinct().count() == 3


@pytest.mark.parametrize("drop", [exact.drop_copies, minhash.drop_near_copies])
def test_dedup_keeps_both(clash, drop):
    found = {r.text for r in drop(clash.where("doc_id is null")).collect()}
    assert found == {FIRST, SECOND}


def test_repeats_cut_their_own_text(clash):
    rows = [r.text.encode() for r in clash.collect()]
    expected = sorted(brute.removed(rows, 200))
    found = repeats.remove_repeats(clash).select(
        "n_bytes", "n_removed", F.size("spans"), F.sha2("kept_bytes", 256)
    )
    assert sorted(map(tuple, found.collect())) == expected
    assert SECOND in {r.text for r in repeats.drop_repeats(clash).collect()}


def test_toxic_namesake_goes_alone(clash, monkeypatch):
    def score(docs, model):
        toxic = F.col("text") == FIRST
        return row_key(texts(docs)).select("doc_id", *KEY, toxic.cast("double").alias("score"))

    monkeypatch.setattr(toxicity, "fit", lambda docs, labels: None)
    monkeypatch.setattr(toxicity, "score_documents", score)
    found = {r.text for r in toxicity.drop_toxic(clash, None).collect()}
    assert found == {SECOND, brute.PASSAGE + "other"}


def test_unlinked_equal_rows_all_stay(spark):
    """Rows without shingles are linked with nothing, so repeated ones stay, too."""
    rows = [(None, None, "a"), (None, None, "b"), (None, "", "c"), (3, " ", "d"), (3, " ", "e")]
    rows += [(4, SECOND, "f"), (4, SECOND, "f")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    decided = minhash.near_duplicates(frame).where("kept").collect()
    found = minhash.drop_near_copies(frame).collect()
    assert len(decided) == len(found) == 6
    assert {r.source for r in found} == set("abcdef")
