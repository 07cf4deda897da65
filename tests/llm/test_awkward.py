"""Every operator on awkward and on empty tables, against brute force where there is a result."""

from __future__ import annotations

import math
from collections import Counter, defaultdict

import corpus_pipeline
import pytest
import public_tokenizers
from pyspark.sql import functions as F

from tests.llm import brute
from tidewatch.llm import chat, exact, minhash, packing, piece, quality, repeats, tokenfile, topk, toxicity

WORD, BYTE = (public_tokenizers.path(f"{n}.json") for n in ("word_bpe_49k", "byte_bpe_50k"))
PIECE = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def docs(spark):
    return brute.awkward(spark).cache()


@pytest.fixture(scope="module")
def rows(docs):
    return [(r.doc_id, r.text) for r in docs.collect()]


@pytest.fixture(scope="module")
def labels(spark):
    known = [(i, i % 2, i % 3 % 2) for i in range(40, 70)] + [(None, 1, 0), (6, None, None), (41, 1, 1)]
    return spark.createDataFrame(known, "doc_id long, quality int, toxic int")


def key(row):
    return tuple((x is None, x) for x in row)


def test_exact_groups(docs, rows):
    def norm(text):
        return brute.BLANK.sub("", text or "")

    groups = defaultdict(list)
    for i, text in rows:
        groups[norm(text)].append((-len(text or ""), i is None, i))
    for every in (True, False):
        found = exact.exact_groups(docs, hash_all=every).collect()
        assert len(found) == len(rows)
        assert sum(r.kept for r in found) == len(groups)
        expected = [(i, min(groups[norm(t)])[2], len(groups[norm(t)])) for i, t in rows]
        assert sorted([(r.doc_id, r.keep_id, r.group_size) for r in found], key=key) == sorted(
            expected, key=key
        )
    kept = exact.drop_copies(docs)
    assert kept.columns == docs.columns
    assert Counter(norm(r.text) for r in kept.collect()) == Counter(dict.fromkeys(groups, 1))


def test_near_duplicates(docs, rows):
    roots, sets = brute.components(rows, 5, 80)
    found = minhash.near_duplicates(docs).collect()
    assert sorted((r.doc_id is None, r.doc_id, r.n_shingles) for r in found if r.doc_id) == sorted(
        (i is None, i, len(s)) for (i, _), s in zip(rows, sets, strict=True) if i
    )
    first = defaultdict(list)
    for (i, _), root in zip(rows, roots, strict=True):
        first[root].append((i is None, i))
    expected = [(i, min(first[root])[1]) for (i, _), root in zip(rows, roots, strict=True)]
    assert sorted([(r.doc_id, r.component_id) for r in found], key=key) == sorted(expected, key=key)
    assert sum(r.kept for r in found) == len(set(roots))
    kept = minhash.drop_near_copies(docs)
    # Empty texts have no links, but rows repeated under one id and text are one.
    assert kept.columns == docs.columns and kept.count() == len(set(roots))


@pytest.mark.parametrize("block", [256, 2])
def test_links_are_not_lost_in_families(spark, block, monkeypatch):
    """A chain of texts, each linked to the next only, in buckets they share."""
    monkeypatch.setattr(minhash, "BLOCK", block)
    words = [f"t{i}" for i in range(300)]
    table = [(i, " ".join([*words[6 * i : 6 * i + 120]])) for i in range(30)]
    frame = spark.createDataFrame(table, "doc_id long, text string")
    roots, _ = brute.components(table, 3, 85)
    found = {r.doc_id: r.component_id for r in minhash.near_duplicates(frame, words=3, percent=85).collect()}
    first = {}
    for (i, _), root in zip(table, roots, strict=True):
        first.setdefault(root, i)
    assert found == {i: first[root] for (i, _), root in zip(table, roots, strict=True)}


@pytest.mark.parametrize(("bucket", "span"), [(100_000, 1 << 17), (1, 1000)])
def test_repeats(docs, rows, bucket, span):
    expected = brute.removed([(t or "").encode() for _, t in rows], 200)
    found = repeats.remove_repeats(docs, bucket=bucket, span_bytes=span).select(
        "doc_id", "n_bytes", "n_removed", F.size("spans"), F.sha2("kept_bytes", 256)
    )
    assert sorted(map(tuple, found.collect()), key=key) == sorted(
        [(i, *x) for (i, _), x in zip(rows, expected, strict=True)], key=key
    )
    cut = repeats.drop_repeats(docs)
    assert cut.columns == docs.columns and cut.count() == len(rows)
    assert not any(brute.PASSAGE in (r.text or "") for r in cut.collect())


def test_repeat_groups(spark, docs, rows):
    """A group is one string, at all its places, and could not be longer."""
    found = defaultdict(set)
    names = {}
    from tidewatch.llm.common import row_key, texts

    for r in row_key(texts(docs)).collect():
        names[r.doc__, r.tag__] = r.text.encode()
    for r in repeats.repeat_groups(docs, span_bytes=5000).collect():
        found[r.group].add((r.doc__, r.tag__, r.first, r.last))
    assert found
    kept = {k: c for k, c in names.items()}
    for places in found.values():
        strings = {kept[d, t][a:b] for d, t, a, b in places}
        assert len(strings) == 1
        (string,) = strings
        assert len(string) >= 200
        if len(string) < 360:
            listed = {(d, t, a) for d, t, a, _ in places}
            for (d, t), content in kept.items():
                if len(content) < 5000:  # of periodic texts only anchored places are listed
                    at = content.find(string)
                    while at >= 0:
                        assert (d, t, at) in listed
                        at = content.find(string, at + 1)


def test_maximal_repeats():
    """Left and right sides of an anchor; groups are closed to both sides."""
    lefts = [b"aax", b"aay", b"abz", b"aax"]
    rights = [b"mnop", b"mnoq", b"mnor", b"mz"]
    found = set()
    for left, right, group in repeats.maximal_repeats(lefts, rights, 3):
        found.add((left, right, tuple(sorted(group))))
    assert found == {(2, 3, (0, 1)), (1, 3, (0, 1, 2)), (3, 1, (0, 3)), (2, 1, (0, 1, 3))}


def test_token_file(spark, docs, rows, folder):
    tokenfile.write_token_file(docs, f"{folder}/ids", tokenizer=WORD, end_id=2, block_bytes=2000)
    found = tokenfile.read_token_file(spark, f"{folder}/ids").collect()
    assert sorted([r.doc_id for r in found], key=lambda i: (i is not None, i)) == sorted(
        [i for i, _ in rows], key=lambda i: (i is not None, i)
    )
    start = 0
    for row in sorted(found, key=lambda r: r.start):
        assert row.start == start and len(row.ids) == 4 * row.n_tokens
        start += row.n_tokens
    order = [r.doc_id for r in sorted(found, key=lambda r: r.start)]
    named = [i for i in order if i is not None]
    assert named == sorted(named) and order[: len(order) - len(named)] == [None] * 4
    some = tokenfile.read_documents(spark, f"{folder}/ids", [6, 30, 99_999]).collect()
    assert sorted(r.doc_id for r in some) == [6, 6, 30]


def test_packing(docs, rows):
    found = packing.pack(docs, tokenizer=BYTE, end_id=1, window=64).collect()
    used = Counter()
    for row in sorted(found, key=lambda r: (r.sequence_id, r.offset)):
        assert row.offset == used[row.sequence_id] and row.length > 0
        used[row.sequence_id] += row.length
    assert max(used.values()) <= 64
    starts = Counter(r.doc_id for r in found if r.start == 0)
    assert starts == Counter(i for i, _ in rows)


def test_plan_fills_windows():
    import numpy as np

    # Short pieces are more frequent than long ones, as those of documents are.
    histogram = np.random.default_rng(0).poisson(60 * np.exp(-np.arange(129) / 40))
    plan = packing.plan_windows(histogram)
    used = Counter()
    for lengths, times in plan.runs:
        assert sum(lengths) <= 128 and times > 0
        for length in lengths:
            used[length] += times
    assert [used[i] for i in range(1, 129)] == histogram[1:].tolist()
    windows = sum(times for _, times in plan.runs)
    assert windows * 128 - (np.arange(129) * histogram).sum() < 0.002 * windows * 128
    assert packing.plan_windows(np.zeros(129, np.int64)).runs == []


def test_pieces(docs, rows):
    found = piece.encode_pieces(docs, model=PIECE)
    assert all(r.parity and r.round_trip for r in found.collect())
    back = piece.decode_pieces(found, model=PIECE).collect()
    assert Counter(map(tuple, back)) == Counter((i, t or "") for i, t in rows)


def test_unigram_model(tmp_path):
    """A small unigram model file, written field by field."""
    import struct

    import sentencepiece

    def field(number, data):
        return bytes([number << 3 | 2, len(data)]) + data

    pieces = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)]
    pieces += [("▁he", -2.0, 1), ("llo", -2.5, 1), ("▁", -4.0, 1)]
    pieces += [(c, -5.0 - i / 10, 1) for i, c in enumerate("helowrd")]
    data = b""
    for text, score, kind in pieces:
        inner = field(1, text.encode()) + b"\x15" + struct.pack("<f", score) + bytes([3 << 3, kind])
        data += field(1, inner)
    data += field(2, bytes([3 << 3, 1])) + field(3, field(1, b"identity"))
    path = str(tmp_path / "m.model")
    with open(path, "wb") as file:
        file.write(data)
    use = piece.PieceEncoder(path)
    texts = ["hello world", "", "he  hello ", "low"]
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    for (ids, same), right in zip(use.encode(texts), library.encode(texts), strict=True):
        assert same and ids == struct.pack(f"<{len(right)}I", *right)


def test_classifiers(docs, rows, labels):
    model = toxicity.fit(docs, labels)
    found = toxicity.score_documents(docs, model).collect()
    assert len(found) == len(rows) and all(0 <= r.score <= 1 for r in found)
    grades = labels.select("doc_id", F.col("quality").alias("grade"))
    graded = quality.grade_documents(docs, quality.fit(docs, grades, grades=4, rounds=2)).collect()
    assert len(graded) == len(rows)
    for row in graded:
        assert row.tails == sorted(row.tails, reverse=True) and not math.isnan(row.expected_grade)


def test_segments():
    """All maximal segments of every short list of scores, by their definition."""
    import random

    import numpy as np

    rng = random.Random(3)

    def expected(scores):
        if not scores:
            return []
        ends = [(a, b) for a in range(len(scores)) for b in range(a + 1, len(scores) + 1)]
        sums = [(sum(scores[a:b]), a - b, -a, a, b) for a, b in ends]
        total, _, _, a, b = max(sums)
        if total <= 0:
            return []
        left, right = expected(scores[:a]), expected(scores[b:])
        return [*left, (a, b), *[(x + b, y + b) for x, y in right]]

    for _ in range(300):
        many = rng.randint(0, 9)
        scores = [rng.choice([-7, -5, -3, 2, 4.5, 8.25]) + rng.random() / 100 for _ in range(many)]
        found = [(a, b) for a, b, _ in toxicity.segments(np.array(scores, float))]
        assert found == expected(scores)


def test_chats(spark):
    rows = [
        (1, 0, "user", "hi"), (1, 1, "bot", "yo"),
        (2, 0, "user", "hi"), (2, 1, "bot", "yo"), (2, 2, "user", "more"),
        (3, 0, "user", "hi"), (3, 1, "bot", "yo"), (3, 2, "user", "more"),
        (4, 0, "user", "hi"), (5, 0, "user", None), (6, None, None, ""),
        (7, 5, "user", "hi"), (7, 5, "user", "hi"),
        (None, 0, "user", "lost"), (None, 1, "bot", "found"),
    ]
    rows += [(8, t, "user", f"t{t}") for t in range(40)] + [(9, t, "user", f"t{t}") for t in range(30)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    frame = frame.withColumn("position", F.lit("x")).withColumn("segment", F.lit("y"))
    for segment in (4096, 7):
        found = chat.collapse_snapshots(frame, segment_turns=segment)
        kept = {r.conv_id: (r.kept, r.n_copies, r.n_turns) for r in found.collect()}
        assert {i for i, (k, _, _) in kept.items() if k} == {2, 5, 6, 7, 8, None}
        assert kept[2] == (True, 2, 3) and kept[3][0] is False and kept[9] == (False, 1, 30)
    shown = {r.conv_id: r.chat for r in chat.format_chats(frame).collect()}
    assert shown[None] == "<|im_start|>user\nlost<|im_end|>\n<|im_start|>bot\nfound<|im_end|>\n"


def test_top_k(spark):
    nan, inf = float("nan"), float("inf")
    vectors = {1: [0.5, 1.0], 2: [0.5, 1.0], 3: [-1.0, 0.25], 4: None, 5: [nan, 1.0], 6: [inf, 0.0],
               7: [None, 1.0], 8: [], 9: [1.0], 10: [2.0, 2.0], 11: [0.0039, -0.0039], 12: [1e30, 1e30]}
    rows = [*vectors.items(), (2, [0.5, 1.0]), (None, [1.0, 1.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("dim", F.lit("x"))
    found = topk.top_k(frame, F.col("vec_id") > 0, k=3).collect()
    take = [(i, [math.floor(256 * x) for x in v]) for i, v in rows
            if i and v is not None and all(x is not None and math.isfinite(x) for x in v) and i != 12]
    big = [int(math.floor(256 * x)) for x in spark.createDataFrame([([1e30],)], "v array<float>").first().v]
    take.append((12, big * 2))
    expected = []
    for n, (i, v) in enumerate(take):
        scored = sorted(
            (-min(max(sum(a * b for a, b in zip(v, w, strict=True)), -(2**63)), 2**63 - 1), j)
            for m, (j, w) in enumerate(take) if m != n and len(v) == len(w)
        )
        expected += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scored[:3])]
    assert sorted(map(tuple, found)) == sorted(expected)


@pytest.mark.parametrize("threshold", [topk.SPARSE, 1.1])
def test_top_k_of_many(spark, threshold, monkeypatch):
    import numpy as np

    monkeypatch.setattr(topk, "SPARSE", threshold)
    rng = np.random.default_rng(2)
    data = rng.normal(0, 1, (300, 40)) * np.geomspace(3, 0.01, 40)
    data[100:140] = data[7]
    ints = np.floor(256 * data).astype(np.int64)
    best = topk._Best(300, 5)
    for start in range(0, 300, 64):
        part = ints[start : start + 64].T.astype(float)
        own = np.array([i - start if start <= i < start + part.shape[1] else -1 for i in range(300)])
        topk.search_chunk(best, ints.T.astype(float), part, np.arange(start, start + part.shape[1]), own)
    scores = ints @ ints.T
    for i in range(300):
        order = sorted((-int(scores[i, j]), j) for j in range(300) if j != i)[:5]
        assert [(-int(s), int(j)) for s, j in zip(best.scores[i], best.ids[i], strict=True)] == order


def test_empty_tables(spark, docs, labels, folder):
    none, no_labels = docs.where("false"), labels.where("false")
    assert exact.exact_groups(none).count() == 0 and exact.drop_copies(none).count() == 0
    assert minhash.near_duplicates(none).count() == 0
    assert repeats.remove_repeats(none).count() == 0
    assert packing.pack(none, tokenizer=BYTE, end_id=1).count() == 0
    assert piece.encode_pieces(none, model=PIECE).count() == 0
    tokenfile.write_token_file(none, f"{folder}/none", tokenizer=WORD, end_id=2)
    assert tokenfile.read_token_file(spark, f"{folder}/none").count() == 0
    turns = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.format_chats(turns).count() == 0
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.top_k(vectors, F.col("vec_id") > 0).count() == 0
    assert toxicity.score_documents(none, toxicity.fit(none, no_labels)).count() == 0
    scores = {r.score for r in toxicity.score_documents(docs, toxicity.fit(docs, no_labels)).collect()}
    assert scores == {0.5}
    grades = no_labels.select("doc_id", F.col("quality").alias("grade"))
    assert quality.grade_documents(none, quality.fit(docs, grades, grades=2)).count() == 0


def test_pipeline_stages(spark, docs, labels, folder):
    """Every stage on awkward rows: columns stay, results hold against brute force."""
    labels.write.parquet(f"{folder}/labels.parquet")
    for frame in (docs, docs.where("false")):
        kept = frame
        for name, stage in corpus_pipeline.STAGES:
            before, kept = kept, stage(spark, kept, folder)
            if name != "packing":
                assert kept.columns == docs.columns and kept.schema == docs.schema
                kept = spark.createDataFrame(kept.collect(), docs.schema)
            if name == "exact_dedup":
                old, new = (
                    [brute.BLANK.sub("", r.text or "") for r in x.collect()] for x in (before, kept)
                )
                assert len(new) == len(set(new)) and set(new) == set(old)
            elif name == "near_dedup":
                roots, _ = brute.components([(r.doc_id, r.text) for r in before.collect()], 5, 80)
                assert kept.count() == len(set(roots))
            elif name == "suffix_dedup":
                assert kept.count() == before.count()
                whole = [(r.text or "").encode() for r in before.collect()]
                counts = Counter(t[p : p + 200] for t in whole for p in range(len(t) - 199))
                again = {s for s, n in counts.items() if n > 1}
                for r in kept.collect():
                    content = (r.text or "").encode()
                    assert not any(content[p : p + 200] in again for p in range(len(content) - 199))
                    assert r.n_chars == len(r.text or "")
            elif name == "packing":
                packed = Counter(r.doc_id for r in kept.collect() if r.start == 0)
                assert packed == Counter(r.doc_id for r in before.collect())


def test_pipeline_query(spark):
    found = corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()
    assert found and {r.doc_id for r in found} <= set(range(200))
