"""Queries with SQL against another engine, the others against brute force, on given tables."""

from __future__ import annotations

import struct
import zlib

import duckdb
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from __spark_entry__ import queries
from tests.llm import brute
from tidewatch.llm import registry

SF_DIR = "/root/testdata/sf0.01"
SMALL = "/root/testdata/sf0.001"
TABLES = "documents embeddings pages benchmark labels conversations".split()


def crc(ids):
    return zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))


def test_registered():
    assert registry.QUERIES.keys() <= queries().keys()
    numbers = sorted(int(name[2:].split("_")[0]) for name in registry.QUERIES)
    assert numbers == list(range(1, 14))
    assert "pipeline" in queries()


@pytest.mark.parametrize("name", registry.ORACLE)
def test_same_as_sql(spark, name):
    duck = duckdb.connect()
    for t in TABLES:
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    frame, relation = registry.QUERIES[name](spark, SF_DIR), duck.sql(registry.ORACLE[name])
    assert sorted(frame.columns) == sorted(relation.columns)
    theirs = relation.select(", ".join(f'"{c}"' for c in frame.columns)).fetchall()
    assert sorted(map(tuple, frame.collect())) == sorted(theirs)


def documents(spark, sf_dir):
    return sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect())


def test_token_file(spark):
    encode = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")).encode
    expected, start = [], 0
    for i, text in documents(spark, SMALL):
        ids = [*encode(text, add_special_tokens=False).ids, 2]
        expected.append((i, start, len(ids), crc(ids)))
        start += len(ids)
    found = registry.QUERIES["op2_token_file"](spark, SMALL)
    assert sorted(map(tuple, found.collect())) == expected


def test_repeats(spark):
    rows = documents(spark, SMALL)
    expected = brute.removed([text.encode() for _, text in rows], 200)
    found = registry.QUERIES["op7_repeats"](spark, SMALL)
    assert sorted(map(tuple, found.collect())) == [
        (i, *x) for (i, _), x in zip(rows, expected, strict=True)
    ]


def test_minhash(spark):
    rows = documents(spark, SMALL)
    roots, sets = brute.components(rows, 3, 85)
    first = {}
    for (i, _), root in zip(rows, roots, strict=True):
        first.setdefault(root, i)
    found = sorted(map(tuple, registry.QUERIES["op8_minhash"](spark, SMALL).collect()))
    assert found == [
        (i, len(s), first[root], i == first[root])
        for (i, _), root, s in zip(rows, roots, sets, strict=True)
    ]


def test_packing(spark):
    encode = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")).encode
    found = registry.QUERIES["op9_packing"](spark, SMALL).collect()
    ids = {i: [*encode(t, add_special_tokens=False).ids, 1] for i, t in documents(spark, SMALL)}
    at = dict.fromkeys(ids, 0)
    for row in sorted(found, key=lambda r: (r.doc_id, r.start)):
        assert row.start == at[row.doc_id] and row.doc_tokens == len(ids[row.doc_id])
        at[row.doc_id] += row.length
        assert row.ids_crc32 == crc(ids[row.doc_id][row.start : at[row.doc_id]])
    assert at == {i: len(x) for i, x in ids.items()}
    windows = {}
    for row in sorted(found, key=lambda r: r.offset):
        assert row.offset == windows.get(row.sequence_id, 0)
        windows[row.sequence_id] = row.offset + row.length
    assert max(windows.values()) <= 2048 and sorted(windows) == list(range(len(windows)))
    padding = sum(2048 - n for n in windows.values() if n & (n - 1))
    assert padding < 0.01 * sum(at.values())


def test_pieces(spark):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    found = registry.QUERIES["op10_pieces"](spark, SMALL).collect()
    right = {i: library.encode(text) for i, text in documents(spark, SMALL)}
    assert len(found) == len(right)
    for row in found:
        assert (row.n_tokens, row.ids_crc32) == (len(right[row.doc_id]), crc(right[row.doc_id]))
        assert row.parity and row.round_trip


def auc(scores, truth):
    pairs = sorted(zip(scores, truth, strict=True))
    good = [s for s, t in pairs if t]
    bad = [s for s, t in pairs if not t]
    wins = sum((g > b) + 0.5 * (g == b) for g in good for b in bad)
    return wins / (len(good) * len(bad))


def test_toxicity_on_held_out_rows(spark):
    sf_dir = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    found = registry.QUERIES["op3_toxicity"](spark, sf_dir).collect()
    assert len(found) == 10_000
    for row in found:
        assert row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 5 == 0)
        assert 0 <= row.score <= 1 and row.predicted == (row.score >= 0.5)
    held = [r for r in found if r.held_out and r.doc_id in labels]
    right = sum(r.predicted == labels[r.doc_id] for r in held) / len(held)
    assert right > 0.98
    assert auc([r.score for r in held], [labels[r.doc_id] for r in held]) > 0.95


def test_quality_on_held_out_rows(spark):
    sf_dir = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    found = registry.QUERIES["op4_quality"](spark, sf_dir).collect()
    assert len(found) == 10_000
    held = [r for r in found if r.held_out and r.doc_id in labels]
    assert auc([r.p_good for r in held], [labels[r.doc_id] for r in held]) > 0.97
    assert sum(r.kept == labels[r.doc_id] for r in held) / len(held) > 0.94
    assert all(r.p_good >= r.p_best for r in found)
