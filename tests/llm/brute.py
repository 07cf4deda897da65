"""Brute-force versions of the operators, and a table of awkward documents."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

BLANK = re.compile(r"[\x20\x09-\x0D]+")
PASSAGE = "the quick grey heron walked over the wet stones of the old harbour wall " * 5


def awkward(spark, *, extra=True):
    """Documents with nulls, empty and long texts, ties, repeated rows and clashing columns."""
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)] + ["naïve", "日本語", "Ünder", "don't", "x.\ny"]

    def text(n):
        return " ".join(rng.choice(words) for _ in range(n))

    base, near = text(300), text(200).split(" ")
    rows = [(None, None), (None, "only text"), (1, None), (2, ""), (3, " \n\t "), (4, "a"), (5, "A")]
    rows += [(6, base), (7, base), (8, base + " "), (6, base), (9, " " + base.replace(" ", "  "))]
    rows += [(10, " ".join(near)), (11, " ".join([*near[:-1], "changed"])), (11, text(20))]
    rows += [(20 + i, text(30) + " " + PASSAGE + text(30)) for i in range(4)]
    rows += [(30, text(30_000)), (31, "ab" * 3000), (32, "word " * 2000), (33, "word " * 2100)]
    rows += [(40 + i, text(rng.randint(1, 400))) for i in range(30)]
    rows += [(None, text(50)), (None, base), (-5, text(40)), (2**62, text(40))]
    table = [(i, t, "en", f"s{n % 3}", len(t or ""), n, "x") for n, (i, t) in enumerate(rows)]
    names = "doc_id long, text string, lang string, source string, n_chars long"
    if not extra:
        return spark.createDataFrame([r[:5] for r in table], names)
    clashes = "doc__ long, tag__ string"
    more = "kept string, length string, prefix string, class string, row string, original__ string"
    table = [(*r, "k", "l", "p", "c", "r", "o") for r in table]
    return spark.createDataFrame(table, f"{names}, {clashes}, {more}")


def shingles(text, k):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in BLANK.split(text) if w]
    k = min(k, len(words))
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if k else set()


def components(rows, k, percent):
    """Root index of each (id, text) row under links of shingle sets."""
    sets = [shingles(text, k) for _, text in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            shared = len(sets[i] & sets[j])
            if shared and 100 * shared >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    return [find(i) for i in range(len(rows))], sets


def removed(contents, least):
    """(bytes, removed, runs, hash of the rest) of each text without its repeated strings."""
    counts = Counter(c[p : p + least] for c in contents for p in range(len(c) - least + 1))
    out = []
    for c in contents:
        gone = bytearray(len(c))
        for p in range(len(c) - least + 1):
            if counts[c[p : p + least]] > 1:
                gone[p : p + least] = b"\1" * least
        rest = bytes(x for x, g in zip(c, gone, strict=True) if not g)
        runs = len(re.findall(b"\1+", bytes(gone)))
        out.append((len(c), sum(gone), runs, hashlib.sha256(rest).hexdigest()))
    return out
