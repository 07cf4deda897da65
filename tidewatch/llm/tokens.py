"""Token ids of whole texts by the tokenizers library, with a cache of words.

For the two pre-tokenizers recognised below no token crosses certain places, so text is cut there and
each distinct piece is encoded once for as long as the cache holds it. Any other tokenizer file gets
whole texts.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Distinct pieces in each of the two generations of the cache.
CACHE_PIECES = 300_000
# Characters cut into pieces at a time, so that a very long text needs no long list.
SPAN_CHARS = 1 << 21

# Words of which the normal form is plain: no case or composition rules but those of Latin-1.
_LETTERS = re.compile(r"[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")
# The byte-level alphabet: bytes that print stand for themselves, the others for characters from
# U+0100 on. A blank between words stays a blank here.
_PRINTING = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_OTHERS = [byte for byte in range(256) if byte not in _PRINTING]
_BYTE_NAMES = {byte: 256 + i for i, byte in enumerate(_OTHERS) if byte != 0x20}
_BLANK_NAME, _BREAK_NAME = (chr(256 + _OTHERS.index(byte)) for byte in (0x20, 0x0A))
# A piece that no blank precedes begins with this; texts that hold it are encoded as they are.
_INNER = "\0"
# Before a blank that a non-blank follows; the blank belongs to the piece after it.
_BLANK = re.compile(r" (?=\S)")
# The same for a whole text: a blank before another one, or at the end.
_SPACES = r"\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_UNEVEN = f" ([{_SPACES}]|$)|{_INNER}"
# Between a letter or digit and a mark, before or after which no token goes on. The apostrophe is no
# such mark: it may belong to the letters after it. Where texts are normalised, only letters are taken
# that stay letters: others (dotted capital I) end in a combining mark then, which joins what follows.
_P = r"[!-&(-/:-@\[-`{-~]"
_BEFORE_MARK = rf"([\pL\pN])({_P})"
_STABLE_BEFORE_MARK = rf"([A-Za-z0-9\x{{c0}}-\x{{d6}}\x{{d8}}-\x{{f6}}\x{{f8}}-\x{{ff}}])({_P})"
# Between a mark and one line break, and after that break.
_BREAK = rf"({_P})\n([\pL\pN])"


def _chunking(spec: dict) -> str | None:
    """How texts may be cut for a tokenizer file: blanks kept, blanks dropped, or not at all."""
    kind, norm = spec.get("pre_tokenizer") or {}, spec.get("normalizer")
    if kind.get("type") == "ByteLevel" and kind.get("use_regex") and norm is None:
        return None if kind.get("add_prefix_space") else "kept"
    if kind.get("type") == "Sequence":
        first = kind["pretokenizers"][0]
        pattern = (first.get("pattern") or {}).get("Regex", "")
        dropped = first.get("behavior") == "Removed" and first.get("invert")
        letters = pattern.endswith(r"[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
        names = [n["type"] for n in (norm or {}).get("normalizers", [])]
        if dropped and letters and set(names) <= {"NFC", "Replace", "Lowercase"}:
            return "dropped"
    return None


class Encoder:
    """Encodes texts to the bytes of little-endian unsigned 32-bit ids.

    The ids are those of the plain call of the library, where the string of an added token in a text is
    that token; with ``ordinary`` the strings of special tokens are ordinary text.
    """

    def __init__(self, path: str, *, ordinary: bool = False) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = ordinary
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.chunking = _chunking(spec)
        # Texts that hold such a string are encoded whole, whatever the case of its letters.
        added = [re.escape(token["content"]) for token in spec.get("added_tokens") or []]
        self.added = f"(?i){'|'.join(added)}" if added and not ordinary else None
        # With blanks kept, a piece stands for itself with a blank before it.
        self.lead = " " if self.chunking == "kept" else ""
        self.edges = self._word_edges() if self.chunking else None
        self.line_break = self.tokenizer.token_to_id(_BREAK_NAME)
        # The same model for words whose normal form is known: no step before it but splitting.
        self.bare = Tokenizer.from_file(path)
        self.bare.normalizer = normalizers.Sequence([])
        self.bare.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _encode(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, "<u4").tobytes() for x in found]

    def _word_edges(self) -> np.ndarray | None:
        """For each id, whether it begins (blanks kept) or ends (blanks dropped) a word."""
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        edges = np.zeros(max(vocab.values(), default=0) + 1, bool)
        if self.chunking == "kept":
            edges[[i for token, i in vocab.items() if token.startswith(_BLANK_NAME)]] = True
        else:
            suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
            if not suffix:
                return None
            edges[[i for token, i in vocab.items() if token.endswith(suffix)]] = True
        return edges

    def _encode_words(self, words: list[str], inner: bool = False) -> list[bytes]:
        """Ids of words of Latin letters, all in one call; the edges of words tell them apart."""
        between = " " if not inner else f" {_BREAK_NAME} "
        text = " ".join(words)
        if not self.lead:
            text = text.lower()
        if not text.isascii():
            text = text.encode().decode("latin-1").translate(_BYTE_NAMES)
        if inner:
            text = text.replace(" ", between)
        elif self.lead:
            text = _BLANK_NAME + text.replace(" ", " " + _BLANK_NAME)
        ids = np.array(self.bare.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
        raw = ids.tobytes()
        if inner:
            ends = [*np.flatnonzero(ids == self.line_break).tolist(), len(ids)]
            begins = [0, *[end + 1 for end in ends[:-1]]]
        elif self.lead:
            begins = np.flatnonzero(self.edges[ids]).tolist()
            ends = [*begins[1:], len(ids)]
        else:
            ends = (np.flatnonzero(self.edges[ids]) + 1).tolist()
            begins = [0, *ends[:-1]]
        if len(begins) != len(words):
            return self._encode([word if inner else self.lead + word for word in words])
        return [raw[4 * a : 4 * b] for a, b in zip(begins, ends, strict=True)]

    def _learn(self, pieces: list[str]) -> None:
        """See that all ``pieces`` are in the young generation."""
        young, old = self.young, self.old
        new = []
        for piece in pieces:
            known = old.get(piece)
            if known is None:
                new.append(piece)
            else:
                young[piece] = known
        plain = _LETTERS.fullmatch if self.edges is not None else lambda _: None
        words = [x for x in new if plain(x)]
        inner = [x for x in new if x[:1] == _INNER and plain(x, 1)] if self.lead else []
        done = {*words, *inner}
        odd = [x for x in new if x not in done]
        for start in range(0, len(words), 8192):
            some = words[start : start + 8192]
            young.update(zip(some, self._encode_words(some), strict=True))
        for start in range(0, len(inner), 8192):
            some = inner[start : start + 8192]
            found = self._encode_words([x[1:] for x in some], inner=True)
            young.update(zip(some, found, strict=True))
        texts = [x[1:] if self.lead and x[:1] == _INNER else self.lead + x for x in odd]
        young.update(zip(odd, self._encode(texts), strict=True))

    def _spans(self, text: str) -> Iterator[str]:
        """``text`` cut before blanks; the blank goes with what follows it."""
        start = 0
        while len(text) - start > SPAN_CHARS:
            cut = _BLANK.search(text, start + SPAN_CHARS)
            if not cut:
                break
            yield text[start : cut.start()]
            start = cut.start()
        yield text[start:]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text."""
        if self.chunking is None:
            return self._encode(texts)
        if self.added and texts:
            held = pc.match_substring_regex(pa.array(texts, pa.large_string()), self.added)
            if pc.any(held).as_py():
                return self._encode_some_whole(texts, held.to_pylist())
        return self._encode_plain(texts)

    def _encode_some_whole(self, texts: list[str], whole: list[bool]) -> list[bytes]:
        odd = iter(self._encode([x for x, by_itself in zip(texts, whole, strict=True) if by_itself]))
        plain = iter(self._encode_plain([x for x, by_itself in zip(texts, whole, strict=True) if not by_itself]))
        return [next(odd if by_itself else plain) for by_itself in whole]

    def _encode_plain(self, texts: list[str]) -> list[bytes]:
        """Ids of texts without the strings of added tokens, cut into pieces."""
        spans = [(i, span) for i, text in enumerate(texts) for span in self._spans(text)]
        ids: list[list[bytes]] = [[] for _ in texts]
        start = 0
        while start < len(spans):
            end, chars = start, 0
            while end < len(spans) and (end == start or chars < SPAN_CHARS):
                chars += len(spans[end][1])
                end += 1
            found = self._encode_spans([span for _, span in spans[start:end]])
            for (i, _), part in zip(spans[start:end], found, strict=True):
                ids[i].append(part)
            start = end
        return [parts[0] if len(parts) == 1 else b"".join(parts) for parts in ids]

    def _pieces(self, spans: pa.Array) -> pa.ListArray:
        """Spans cut into pieces that are encoded by themselves.

        Where blanks are kept, a piece stands for itself with a blank before it, or begins with
        ``_INNER``. Where they are dropped, any white space is a place to cut.
        """
        if self.lead:
            # The blank that begins a later span of a long text is that of its first piece.
            inner, nothing = (pa.scalar(x, pa.large_string()) for x in (_INNER, ""))
            marked = pc.binary_join_element_wise(inner, spans, nothing)
            spans = pc.if_else(pc.starts_with(spans, " "), pc.utf8_slice_codeunits(spans, 1), marked)
            spans = pc.replace_substring_regex(spans, _BREAK, f"\\1 {_INNER}\n {_INNER}\\2")
            spans = pc.replace_substring_regex(spans, _BEFORE_MARK, rf"\1 {_INNER}\2")
        else:
            spans = pc.replace_substring_regex(spans, r"[\t\n\x0b\f\r]", " ")
            spans = pc.replace_substring_regex(spans, _STABLE_BEFORE_MARK, r"\1 \2")
        return pc.split_pattern(spans, " ")

    def _encode_spans(self, spans: list[str]) -> list[bytes]:
        """Pieces are cut and numbered by Arrow; each distinct one is looked up once."""
        column = pa.array(spans, pa.large_string())
        uneven = pc.match_substring_regex(column, _UNEVEN) if self.lead else pc.equal(column, None)
        whole = [i for i, x in enumerate(uneven.to_pylist()) if x]
        if whole:
            column = pc.if_else(uneven, pa.scalar("", pa.large_string()), column)
        lists = self._pieces(column)
        bounds = lists.offsets.to_numpy()
        bounds = bounds - bounds[0]
        named = lists.flatten().dictionary_encode()
        pieces = named.dictionary.to_pylist()
        young = self.young
        new = [piece for piece in pieces if piece not in young]
        if new:
            self._learn(new)
        known = list(map(young.__getitem__, pieces))
        index = named.indices.to_numpy()
        lengths = np.fromiter(map(len, known), np.int64, len(known)) // 4
        begins = np.cumsum(lengths) - lengths
        counts = lengths[index]
        ends = np.cumsum(counts)
        total = int(ends[-1]) if len(ends) else 0
        places = np.repeat(begins[index] - (ends - counts), counts) + np.arange(total)
        ids = np.frombuffer(b"".join(known), "<u4")[places]
        edges = np.concatenate([[0], ends])[bounds].tolist()
        out = [ids[a:b].tobytes() for a, b in zip(edges, edges[1:], strict=False)]
        for i, found in zip(whole, self._encode([spans[i] for i in whole]), strict=True):
            out[i] = found
        if len(young) > CACHE_PIECES:
            self.young, self.old = {}, young
        return out


_ENCODERS: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str, *, ordinary: bool = False) -> Encoder:
    """The encoder of this Python process; tasks that follow each other share its cache."""
    if (path, ordinary) not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[path, ordinary] = Encoder(path, ordinary=ordinary)
    return _ENCODERS[path, ordinary]
