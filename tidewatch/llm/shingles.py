"""Sets of word shingles as 64-bit hashes, computed for many texts at once with numpy."""

from __future__ import annotations

import re

import numpy as np

# Bytes hashed together; a longer text is cut between words.
SPAN_BYTES = 1 << 20

_RANDOM = np.random.default_rng(20240229)
_BYTE = _RANDOM.integers(1, 2**63, 256, np.uint64)
_PLACE = np.cumprod(np.full(1 << 12, 0x9E3779B97F4A7C15, np.uint64))
_ORDER = _RANDOM.integers(1, 2**63, 64, np.uint64) | np.uint64(1)
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_BLANK_BYTE = re.compile(rb"[\x20\x09-\x0D]")


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (Stafford's variant 13)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _hash_words(buffer: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and first bytes of the words of ``buffer``."""
    data = np.frombuffer(buffer, np.uint8)
    blank = _BLANK[data]
    edge = np.flatnonzero(np.diff(blank, prepend=True, append=True))
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64), starts
    lengths = ends - starts
    inside = np.arange(len(data))
    inside[starts[0] :] -= np.repeat(starts, np.append(starts[1:], len(data)) - starts)
    value = _BYTE[data] * _PLACE[inside & (len(_PLACE) - 1)]
    if lengths.max() > len(_PLACE):
        value *= (2 * (inside >> 12) + 1).astype(np.uint64)
    value[blank] = 0
    return mix(np.add.reduceat(value, starts) + lengths.astype(np.uint64)), starts


def _spans(text: bytes) -> list[bytes]:
    """``text`` cut between words into spans of about ``SPAN_BYTES``."""
    out, start = [], 0
    while len(text) - start > SPAN_BYTES:
        cut = _BLANK_BYTE.search(text, start + SPAN_BYTES)
        if not cut:
            break
        out.append(text[start : cut.start()])
        start = cut.end()
    out.append(text[start:])
    return out


def word_hashes(texts: list[str]) -> list[np.ndarray]:
    """Hashes of the words of each text: runs of characters that are not ASCII white space, A-Z
    lower-cased."""
    spans = [
        (i, span)
        for i, text in enumerate(texts)
        for span in _spans(text.encode("utf-8", "surrogatepass").lower())
    ]
    found: list[list[np.ndarray]] = [[] for _ in texts]
    at = 0
    while at < len(spans):
        end, size = at, 0
        while end < len(spans) and (end == at or size + len(spans[end][1]) <= SPAN_BYTES):
            size += len(spans[end][1]) + 1
            end += 1
        hashes, starts = _hash_words(b" ".join([span for _, span in spans[at:end]]))
        edges = np.cumsum([0] + [len(span) + 1 for _, span in spans[at:end]])
        cuts = np.searchsorted(starts, edges)
        for k, (i, _) in enumerate(spans[at:end]):
            found[i].append(hashes[cuts[k] : cuts[k + 1]])
        at = end
    return [parts[0] if len(parts) == 1 else np.concatenate(parts) for parts in found]


def shingle_sets(texts: list[str], words: int) -> list[np.ndarray]:
    """The set of shingles of each text as sorted distinct hashes.

    A shingle is ``words`` words in a row. With fewer words the whole sequence is one; without words
    the set is empty.
    """
    out = []
    for hashes in word_hashes(texts):
        size = min(words, len(hashes))
        if not size:
            out.append(hashes)
            continue
        n = len(hashes) - size + 1
        total = np.full(n, size, np.uint64)
        for place in range(size):
            total += hashes[place : place + n] * _ORDER[place % 64]
            total = mix(total) if place % 64 == 63 else total
        out.append(np.unique(mix(total)))
    return out


def common(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets of hashes."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.searchsorted(b, a)
    at[at == len(b)] = len(b) - 1
    return int((b[at] == a).sum())
