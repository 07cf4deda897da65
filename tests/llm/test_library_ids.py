"""Token ids are those of the plain library call, whatever the text; scans are linear."""

from __future__ import annotations

import random
import time

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tests.llm.brute import awkward
from tidewatch.llm.minhash import near_duplicates
from tidewatch.llm.tokens import Encoder
from tidewatch.llm.toxicity import segments

FILES = ("word_bpe_49k.json", "byte_bpe_50k.json")
PARTS = [
    "a", "Word", "  ", " ", "\n", "\t", "\r\n", "\0", "İ", "İ>", "é", "ß", "ﬁ", "ª", "µ", "日本", "क़", "יִ", "😀",
    "don't", ",", ".", ">", "<|endoftext|>", "<|startoftext|>", "<|STARTOFTEXT|>", "<|EndOfText|>", "1234",
    "x̂", "́", "\x85", "\xa0", " ", "\x1c", "'s", "'", "!", "Σ", "ς", "ŉ", ")", "_", "﻿", "가", "ᄀ", "ᅡ",
]


def ids(raw):
    return np.frombuffer(raw, "<u4").tolist()


@pytest.mark.parametrize("name", FILES)
def test_ids_of_odd_texts(spark, name):
    rng = random.Random(name)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 25))) for _ in range(5000)]
    texts += ["", "\0", "İ>", "a <|endoftext|> b", "word " * 50_000, "ab" * 30_000]
    texts += [row.text or "" for row in awkward(spark).collect()]
    path = public_tokenizers.path(name)
    plain, cut = Tokenizer.from_file(path), Encoder(path)
    for start in range(0, len(texts), 1000):
        some = texts[start : start + 1000]
        for text, found in zip(some, cut.encode(some), strict=True):
            assert ids(found) == plain.encode(text, add_special_tokens=False).ids, text[:80]


@pytest.mark.parametrize("name", FILES)
def test_special_strings_as_ordinary_text(name):
    path = public_tokenizers.path(name)
    plain, cut = Tokenizer.from_file(path), Encoder(path, ordinary=True)
    plain.encode_special_tokens = True
    for text in ("a <|endoftext|> b", "<|startoftext|>", "x<|endoftext|>"):
        assert ids(cut.encode([text])[0]) == plain.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("pattern", [[1, -1.5], [1.5, -1.4, 1], [2, -0.2, -0.2], [1, -0.9, 1, -1.2]])
def test_a_million_scores(pattern):
    """Each pattern was quadratic in a scan that passes over candidates one by one."""
    began = time.perf_counter()
    found = segments(np.tile(np.array(pattern, float), 1_000_000 // len(pattern)))
    assert time.perf_counter() - began < 20 and found


def maximal(scores):
    """By definition: the segment of the largest sum, and those of what is left on either side."""
    sums = np.concatenate([[0.0], np.cumsum(scores)])
    best = max(((sums[b] - sums[a], a - b, a, b) for a in range(len(sums)) for b in range(a + 1, len(sums))), default=None)
    if best is None or best[0] <= 0:
        return []
    _, _, a, b = best
    return [*maximal(scores[:a]), (a, b, best[0]), *[(x + b, y + b, s) for x, y, s in maximal(scores[b:])]]


def test_segments_by_definition():
    rng = random.Random(2)
    for _ in range(200):
        # sums of distinct powers of two, so that no two segments tie
        scores = [rng.choice([-1, 1]) * (1 + rng.random()) for _ in range(rng.randint(0, 25))]
        found, right = segments(np.array(scores)), maximal(np.array(scores))
        assert [(a, b) for a, b, _ in found] == [(a, b) for a, b, _ in right]
        assert [s for *_, s in found] == pytest.approx([s for *_, s in right])


def test_one_row_of_a_repeated_id_is_kept(spark):
    text = "one two three four five six seven eight nine ten"
    rows = [(6, text), (6, text + " eleven"), (9, text), (9, "other words are here now"), (None, text)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = near_duplicates(docs, words=3, percent=70).collect()
    linked = [r for r in found if r.component_id == 6]
    assert len(linked) == 4 and sum(r.kept for r in linked) == 1


def test_kept_column_of_the_query(spark, folder):
    from tidewatch.llm.minhash import op8_minhash

    text = " ".join(f"word{n}" for n in range(60))
    rows = [(6, text), (6, text + " more"), (9, text), (None, text)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{folder}/documents.parquet")
    found = op8_minhash(spark, folder).collect()
    assert {(r.doc_id, r.component_id, r.kept) for r in found} == {(6, 6, True), (9, 6, False), (None, 6, None)}
    assert sum(r.doc_id == 6 for r in found) == 2


def test_equal_rows_are_spread_in_a_token_file(spark, folder):
    from tidewatch.llm.tokenfile import read_token_file, write_token_file

    docs = spark.range(3000, numPartitions=8).selectExpr("7L AS doc_id", "'the same words again' AS text")
    path = public_tokenizers.path("word_bpe_49k.json")
    merging = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(merging, "false")
    try:
        write_token_file(docs, f"{folder}/t", tokenizer=path, end_id=2)
    finally:
        spark.conf.set(merging, "true")
    blocks = spark.read.parquet(f"{folder}/t/blocks")
    files = blocks.selectExpr("_metadata.file_path AS file", "size(ids) AS n").groupBy("file").sum("n").collect()
    assert len(files) > 4 and max(row[1] for row in files) < 1500
    starts = sorted(row.start for row in read_token_file(spark, f"{folder}/t").collect())
    assert len(starts) == 3000 and len({b - a for a, b in zip(starts, starts[1:])}) == 1


def test_equal_rows_are_one_context(spark):
    """Rows repeated in the table do not fill a bucket, and are removed all the same."""
    from tests.llm import brute
    from tidewatch.llm import repeats

    rng = random.Random(12)
    words = [f"w{n}" for n in range(500)]
    common = " ".join(rng.choice(words) for _ in range(80))
    texts = [" ".join(rng.choice(words) for _ in range(60)) + common + f" end {n}" for n in range(5)]
    rows = [(n, t) for n, t in enumerate(texts)] + [(0, texts[0])] * 3000
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    with repeats.intermediate(spark):
        _, _, ends = repeats._anchored(docs, 200, repeats.BUCKET, repeats.SPAN_BYTES)
        contexts = repeats._contexts(docs, ends.drop("large"), 200)
        assert 0 < contexts.count() <= 8 * ends.count()
        assert contexts.count() < 1000
    found = {tuple(r) for r in repeats.remove_repeats(docs).select("doc_id", "n_bytes", "n_removed").collect()}
    right = brute.removed([t.encode() for t in [*texts, texts[0]]], 200)
    assert found == {(n, *right[n][:2]) for n in range(5)}
