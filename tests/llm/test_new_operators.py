"""Centroids, token counts and source divergence against brute force, on awkward tables."""

from __future__ import annotations

import hashlib
import math
import random
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tests.llm.brute import awkward
from tidewatch.llm import centroids, divergence, tokencounts

SMALL = "/root/testdata/sf0.001"
MODEL = public_tokenizers.path("piece_bpe_32k.model")


# Centroids


def lloyd(rows, k, rounds, scale=256.0):
    """(id, cluster, distance, its inertia, inertia, centroid hash) of each row, sorted."""
    kept = [(i, [math.floor(scale * float(x)) for x in v]) for i, v in rows]
    named = [(hashlib.sha256(f"2:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None]
    centers = [v for _, v in sorted(named)[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), n) for n, c in enumerate(centers))

    for _ in range(rounds):
        members = defaultdict(list)
        for _, v in kept:
            members[nearest(v)[1]].append(v)
        centers = [
            [sum(x) // len(x) for x in zip(*members[n], strict=True)] if members[n] else c
            for n, c in enumerate(centers)
        ]
    found = [(i, *nearest(v)[::-1]) for i, v in kept]
    inertia = Counter()
    for _, c, d in found:
        inertia[c] += d
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centers]
    return sorted(
        ((i, c, d, inertia[c], sum(inertia.values()), digests[c]) for i, c, d in found), key=repr
    )


def vectors(spark, rows, extra=True):
    table = [(i, v, "n", 1) for i, v in rows]
    names = "vec_id long, embedding array<float>, near string, cluster int"
    frame = spark.createDataFrame(table, names)
    return frame if extra else frame.select("vec_id", "embedding")


@pytest.mark.parametrize("k", [1, 2, 7, 500])
def test_awkward_vectors(spark, k):
    rng = random.Random(k)
    some = [[rng.choice([-0.5, 0.0, 0.25, 1.0]) for _ in range(3)] for _ in range(40)]
    rows = [(rng.choice([n, n, None, 7]), some[rng.randrange(40)]) for n in range(300)]
    rows += [(1000 + n, [0.5, 0.5, 0.5]) for n in range(200)]
    rows += [(2000 + n, [rng.gauss(0, 1) for _ in range(3)]) for n in range(200)]
    bad = [(1, None), (2, []), (3, [1.0, None, 2.0]), (4, [float("nan")] * 3), (5, [float("inf")] * 3)]
    bad += [(6, [1.0] * 4)]
    found = centroids.cluster(vectors(spark, rows + bad).repartition(5), width=3, k=k, rounds=4)
    exact = [(i, np.array(v, np.float32).tolist()) for i, v in rows]
    assert sorted(map(tuple, found.collect()), key=repr) == lloyd(exact, k, 4)


def test_large_components(spark):
    rng = random.Random(3)
    rows = [(n, [rng.choice([-1, 1]) * 2.0 ** rng.randrange(10, 22) for _ in range(4)]) for n in range(60)]
    found = centroids.cluster(vectors(spark, rows), width=4, k=5, rounds=3)
    assert sorted(map(tuple, found.collect()), key=repr) == lloyd(rows, 5, 3)
    with pytest.raises(Exception, match="64 bits"):
        centroids.cluster(vectors(spark, [(1, [1e30] * 4)]), width=4)


def test_no_vectors(spark):
    for rows in ([], [(None, [1.0, 2.0])], [(1, [1.0])]):
        found = centroids.cluster(vectors(spark, rows), width=2)
        assert found.isEmpty() and len(found.columns) == 6


def test_bounds_save_distances():
    rng = np.random.default_rng(1)
    spots = rng.integers(-4000, 4000, (40, 64))
    points = spots[rng.integers(0, 40, 20_000)] + rng.integers(-30, 30, (20_000, 64))
    start = points[:40].astype(np.int64)
    state = np.zeros(20_000, int), np.ones(20_000, int), np.full(20_000, np.inf), np.full(20_000, -np.inf)
    before, computed = None, []
    for _ in range(5):
        state, n = centroids.assign(points, state, centroids.Centroids(start, before))
        squares = ((points[:, None] - start[None]) ** 2).sum(2)
        assert (state[0] == squares.argmin(1)).all()
        computed.append(n)
        before = start
        start = np.array(
            [points[state[0] == c].sum(0) // max((state[0] == c).sum(), 1) for c in range(40)]
        )
    assert computed[0] < 40 * 20_000 and computed[-1] < 20_000


# Token counts


def library_counts(rows):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    out = []
    for i, text in rows:
        n = len(library.encode(text or ""))
        out.append((i, len((text or "").encode()), n, n > 4096))
    return sorted(out, key=repr)


def sorted_rows(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


def odd_texts():
    rng = random.Random(11)
    parts = ["a", "Word", "  ", " ", "\n", "\t", "\0", "▁", "<s>", "</s>", "<unk>", "<0x41>", "İ", "é"]
    parts += ["日本", "😀", "don't", ",", " ", "　", "x▁y", "1234", "﻿", "​"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(3000)]


def test_counts_of_odd_texts(spark):
    rows = list(enumerate(odd_texts())) + [(None, None), (None, ""), (1, "word " * 100_000), (1, "same")] * 2
    docs = spark.createDataFrame([(*r, "d") for r in rows], "doc_id long, text string, digest string")
    assert sorted_rows(tokencounts.count_tokens(docs.repartition(7), tokenizer=MODEL)) == library_counts(rows)


def test_counts_by_tokenizers(spark, folder):
    path = public_tokenizers.path("byte_bpe_50k.json")
    encode = Tokenizer.from_file(path).encode
    texts = [*odd_texts()[:500], "a <|endoftext|> b"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = tokencounts.count_tokens(docs, tokenizer=path, cache=folder)
    right = [len(encode(text, add_special_tokens=False).ids) for text in texts]
    assert [row.n_tokens for row in found.orderBy("doc_id").collect()] == right


def test_cache(spark, folder):
    docs = awkward(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    right = library_counts(rows)
    version = tokencounts.tokenizer_digest(MODEL)
    count = lambda frame: tokencounts.count_tokens(frame, tokenizer=MODEL, cache=folder)
    stored = lambda: spark.read.parquet(f"{folder}/tokenizer={version}")
    assert sorted_rows(count(docs)) == right
    # one row for each content, and no more after another run
    assert stored().count() == len({text or "" for _, text in rows})
    files = set(stored().inputFiles())
    assert sorted_rows(count(docs)) == right
    assert set(stored().inputFiles()) == files
    # only what is new is added, a digest that is there twice counts once
    more = docs.select("doc_id", "text").union(spark.createDataFrame([(9, "quite new")], "a long, b string"))
    assert sorted_rows(count(more)) == library_counts([*rows, (9, "quite new")])
    added = set(stored().inputFiles()) - files
    assert spark.read.parquet(*added).count() == 1
    spark.read.parquet(*files).write.mode("append").parquet(f"{folder}/tokenizer={version}")
    assert sorted_rows(count(docs)) == right
    # what is stored is believed, of this version of the tokenizer only
    digest = hashlib.sha256(b"believed").digest()
    known = spark.createDataFrame([(bytearray(digest), 77)], "digest binary, n_tokens long")
    known.write.mode("append").parquet(f"{folder}/tokenizer={version}")
    known.write.mode("append").parquet(f"{folder}/tokenizer=other")
    one = spark.createDataFrame([(1, "believed")], "doc_id long, text string")
    assert count(one).first().n_tokens == 77
    other = public_tokenizers.path("byte_bpe_50k.json")
    assert tokencounts.count_tokens(one, tokenizer=other, cache=folder).first().n_tokens < 77


def test_counts_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert tokencounts.count_tokens(docs, tokenizer=MODEL).isEmpty()


def test_normalised_content(spark, monkeypatch):
    from tidewatch.llm.piece import PieceModel

    frame = spark.createDataFrame([("  a   b ",)], "text string")
    monkeypatch.setattr(tokencounts, "read_model", lambda path: PieceModel([], remove_extra=True))
    assert frame.select(tokencounts.normalised(frame.text, "x.model")).first()[0] == "a b"
    monkeypatch.setattr(tokencounts, "read_model", lambda path: PieceModel([], remove_extra=False))
    assert frame.select(tokencounts.normalised(frame.text, "x.model")).first()[0] == "  a   b "


# Source divergence


def divergence_by_sql(docs, min_docs):
    duck = duckdb.connect()
    frame = docs.select("doc_id", "text", "lang", "source")
    duck.register("documents", pa.Table.from_batches(frame.toArrow().to_batches()))
    sql = divergence.SQL["op13_divergence"].replace(f">= {divergence.MIN_DOCS}", f">= {min_docs}")
    return sorted(duck.sql(sql).select("lang, source, part, item, value, rank").fetchall())


def letters(rng, n):
    words = ["a", "bb", "Bb", "éa", "ÉA", "naïve", "x1y", "日本", "don't", *[f"w{chr(97 + i)}" for i in range(20)]]
    return " ".join(words[int(rng.random() ** 3 * len(words))] for _ in range(n))


def sources(spark, n_sources, n_rows, seed):
    rng = random.Random(seed)
    rows = [
        (i, letters(rng, rng.randint(0, 60)), rng.choice(["en", "de", None]), f"s{rng.randrange(n_sources)}", 1, "x")
        for i in range(n_rows)
    ]
    rows += [(1, None, "xx", None, 1, "x"), (1, "", "xx", "b", 1, "x"), (None, "1 2 3", None, None, 1, "x")]
    rows += [(5, "solo word", "one", "only", 1, "x")] * 5 + [(7, "Aa " * 50_000 + "é", "en", "s1", 1, "x")]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n long, term string"
    )


@pytest.mark.parametrize(("n_sources", "min_docs"), [(4, 2), (4, 1000), (150, 3)])
def test_divergence(spark, n_sources, min_docs):
    docs = sources(spark, n_sources, 600, n_sources).repartition(6)
    found = divergence.source_divergence(docs, min_docs=min_docs)
    assert sorted(map(tuple, found.collect())) == divergence_by_sql(docs, min_docs)


def test_joint_tables(spark):
    docs = sources(spark, 70, 400, 9)
    counts, in_docs = defaultdict(Counter), defaultdict(Counter)
    for row in docs.collect():
        text = "".join(c.lower() if c < "\x80" else c for c in row.text or "")
        words = "".join(c if c.isalpha() or c > "\x7f" else " " for c in text).split(" ")
        words = [w for w in words if w]
        counts[row.lang or "", row.source or ""].update(words)
        in_docs[row.lang or ""].update(set(words))
    right = Counter()
    for (lang, a), one in counts.items():
        for (other_lang, b), other in counts.items():
            if lang == other_lang and a < b:
                for term, n in in_docs[lang].items():
                    if n >= 2:
                        right[lang, a, one[term], b, other[term]] += 1
    found = divergence.joint_tables(docs, min_docs=2)
    assert {tuple(row)[:5]: row.terms for row in found.collect()} == dict(right)


def test_divergence_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string")
    assert divergence.source_divergence(docs).isEmpty()
    assert divergence.joint_tables(docs).isEmpty()
    docs = spark.createDataFrame([(1, None, None, None), (2, "", "en", "a")], docs.schema)
    assert divergence.source_divergence(docs).isEmpty()


def test_awkward_documents(spark):
    docs = awkward(spark)
    found = divergence.source_divergence(docs, min_docs=2)
    assert sorted(map(tuple, found.collect())) == divergence_by_sql(docs, 2)
