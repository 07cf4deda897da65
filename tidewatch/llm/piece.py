"""SentencePiece models on the tokenizers library: encoding and decoding.

The model file is a protobuf message; its few fields are read here, and normaliser, metaspace marker,
piece scores and byte fallback are rebuilt as a tokenizers pipeline. Unigram models keep their scores;
of BPE models the merges are listed from the scores. Batches are encoded by several threads. Parity
with the sentencepiece library is checked piece by piece while encoding.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tidewatch.llm.common import table, texts

META = "▁"
# Distinct pieces in each of the two generations of the cache.
CACHE_PIECES = 300_000
# Words encoded in one text; texts of a batch go to different threads.
JOINED_WORDS = 2048
THREADS = 2

# Fixed values of the file format: types of pieces and of models.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


@dataclass
class PieceModel:
    """What a model file says."""

    pieces: list[tuple[str, float, int]]
    kind: int = UNIGRAM
    byte_fallback: bool = False
    charsmap: bytes = b""
    dummy_prefix: bool = True
    remove_extra: bool = True
    escape: bool = True

    @property
    def unknown(self) -> int:
        return next((i for i, (_, _, kind) in enumerate(self.pieces) if kind == UNKNOWN), 0)


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of each field of a protobuf message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = varint()
        if key & 7 == 0:
            yield key >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(key & 7)
        if size is None:
            if key & 7 != 2:
                raise ValueError("this is no sentencepiece model")
            size = varint()
        yield key >> 3, data[at : at + size]
        at += size


def read_model(path: str) -> PieceModel:
    """Parse a SentencePiece model file."""
    with open(path, "rb") as file:
        data = file.read()
    model = PieceModel([])
    for number, value in _fields(data):
        if number == 1:
            piece, score, kind = "", 0.0, NORMAL
            for inner, x in _fields(value):
                if inner == 1:
                    piece = x.decode()
                elif inner == 2:
                    score = struct.unpack("<f", x)[0]
                elif inner == 3:
                    kind = x
            model.pieces.append((piece, score, kind))
        elif number == 2:
            for inner, x in _fields(value):
                if inner == 3:
                    model.kind = x
                elif inner == 35:
                    model.byte_fallback = bool(x)
        elif number == 3:
            for inner, x in _fields(value):
                if inner == 2:
                    model.charsmap = x
                elif inner in (3, 4, 5):
                    name = {3: "dummy_prefix", 4: "remove_extra", 5: "escape"}[inner]
                    setattr(model, name, bool(x))
    if model.kind not in (UNIGRAM, BPE):
        raise ValueError("only unigram and BPE models are supported")
    return model


def _merges(model: PieceModel) -> list[tuple[str, str]]:
    """Merges in the order of the scores of what they make."""
    places = {piece: i for i, (piece, _, kind) in enumerate(model.pieces) if kind == NORMAL}
    order = sorted(places, key=lambda piece: (-model.pieces[places[piece]][1], places[piece]))
    merges = []
    for piece in order:
        splits = [(piece[:n], piece[n:]) for n in range(1, len(piece))]
        splits = [(a, b) for a, b in splits if a in places and b in places]
        merges += sorted(splits, key=lambda pair: (places[pair[0]], places[pair[1]]))
    return merges


def build(model: PieceModel):
    """The tokenizers pipeline of a model."""
    from tokenizers import AddedToken, Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

    if model.kind == UNIGRAM:
        vocab = [(piece, score) for piece, score, _ in model.pieces]
        core = models.Unigram(vocab, model.unknown, model.byte_fallback)
    else:
        core = models.BPE(
            {piece: i for i, (piece, _, _) in enumerate(model.pieces)},
            _merges(model),
            unk_token=model.pieces[model.unknown][0],
            fuse_unk=True,
            byte_fallback=model.byte_fallback,
        )
    tokenizer = Tokenizer(core)
    steps = [normalizers.Precompiled(model.charsmap)] if model.charsmap else []
    if model.remove_extra:
        steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
    if model.dummy_prefix:
        steps.append(normalizers.Prepend(META if model.escape else " "))
    if model.escape:
        steps.append(normalizers.Replace(" ", META))
    tokenizer.normalizer = normalizers.Sequence(steps)
    if separable(model):
        tokenizer.pre_tokenizer = pre_tokenizers.Split(
            Regex(f"{META}+[^{META}]*"), "isolated", invert=False
        )
    user = [AddedToken(p, normalized=False) for p, _, kind in model.pieces if kind == USER]
    tokenizer.add_tokens(user)
    tokenizer.decoder = decoders.Sequence(
        [
            decoders.Replace(META, " "),
            decoders.ByteFallback(),
            decoders.Fuse(),
            *([decoders.Strip(" ", 1, 0)] if model.dummy_prefix else []),
        ]
    )
    return tokenizer


def separable(model: PieceModel) -> bool:
    """Whether no piece goes on after a blank, so that words can be encoded one by one."""
    plain = [piece for piece, _, kind in model.pieces if kind in (NORMAL, USER)]
    return model.escape and not any(META in piece.lstrip(META) for piece in plain)


class PieceEncoder:
    """Encodes and decodes whole texts; remembers words where the model allows it."""

    def __init__(self, path: str, *, threads: int = THREADS, check: bool = True) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "true" if threads > 1 else "false"
        os.environ.setdefault("RAYON_NUM_THREADS", str(threads))
        self.model = read_model(path)
        self.tokenizer = build(self.model)
        m = self.model
        self.words = separable(m) and m.dummy_prefix and not m.charsmap and not m.remove_extra
        self.words = self.words and not any(kind == USER for *_, kind in m.pieces)
        self.begins = np.array([piece.startswith(META) for piece, *_ in m.pieces])
        self.library = None
        if check:
            import sentencepiece

            self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = [self._bytes(piece, kind) for piece, _, kind in m.pieces]
        self.young: dict[str, tuple[bytes, bool]] = {}
        self.old: dict[str, tuple[bytes, bool]] = {}

    def _bytes(self, piece: str, kind: int) -> bytes:
        if kind == BYTE:
            return bytes([int(piece[3:5], 16)])
        if kind == CONTROL:
            return b""
        if kind == UNKNOWN:
            return " ⁇ ".encode()
        return piece.replace(META, " ").encode()

    def _whole(self, texts_: list[str]) -> list[tuple[bytes, bool]]:
        found = self.tokenizer.encode_batch_fast(texts_, add_special_tokens=False)
        return self._checked(texts_, [np.array(x.ids, "<u4").tobytes() for x in found])

    def _checked(self, texts_: list[str], found: list[bytes]) -> list[tuple[bytes, bool]]:
        if self.library is None:
            return [(ids, True) for ids in found]
        right = self.library.encode(texts_, num_threads=1)
        return [
            (ids, ids == np.array(other, "<u4").tobytes())
            for ids, other in zip(found, right, strict=True)
        ]

    def _learn(self, words: set[str]) -> None:
        new = []
        for word in words:
            known = self.old.get(word)
            if known is None:
                new.append(word)
            else:
                self.young[word] = known
        plain = [w for w in new if w and " " not in w]
        groups = [plain[i : i + JOINED_WORDS] for i in range(0, len(plain), JOINED_WORDS)]
        encoded = self.tokenizer.encode_batch_fast(
            [" ".join(group) for group in groups], add_special_tokens=False
        )
        for group, found in zip(groups, encoded, strict=True):
            ids = np.array(found.ids, "<u4")
            cuts = np.flatnonzero(self.begins[ids]).tolist()
            raw = ids.tobytes()
            if len(cuts) == len(group):
                ends = [*cuts[1:], len(ids)]
                parts = [raw[4 * a : 4 * b] for a, b in zip(cuts, ends, strict=True)]
                self.young.update(zip(group, self._checked(group, parts), strict=True))
            else:
                self.young.update(zip(group, self._whole(group), strict=True))
        odd = [w for w in new if not w or " " in w]
        # An empty word stands for a blank by itself, which as a text of its own is not encoded.
        blank = [(ids, ok) for ids, ok in self._blank([w for w in odd if not w.strip(" ")])]
        self.young.update(zip([w for w in odd if not w.strip(" ")], blank, strict=True))
        mixed = [w for w in odd if w.strip(" ")]
        self.young.update(zip(mixed, self._whole(mixed), strict=True))

    def _blank(self, words: list[str]) -> list[tuple[bytes, bool]]:
        """Blanks at the end of a text: what is left after a word that is known to be a piece."""
        head = "a"
        skip = len(self._whole([head])[0][0])
        return [(ids[skip:], ok) for ids, ok in self._whole([head + " " + w for w in words])]

    def encode(self, texts_: list[str]) -> list[tuple[bytes, bool]]:
        """For each text its ids (little-endian unsigned 32-bit) and whether sentencepiece agrees."""
        if not self.words:
            return self._whole(texts_)
        cut, distinct = [], set()
        for text in texts_:
            if not text or META in text:
                pieces = None
            elif "  " in text or text[0] == " " or text[-1] == " ":
                pieces = [p[1:] for p in _BLANKS.findall(" " + text)]
            else:
                pieces = text.split(" ")
            cut.append(pieces)
            distinct.update(pieces or ())
        self._learn({word for word in distinct if word not in self.young})
        whole = iter(self._whole([t for t, p in zip(texts_, cut, strict=True) if p is None]))
        out = []
        for pieces in cut:
            if pieces is None:
                out.append(next(whole))
                continue
            known = list(map(self.young.__getitem__, pieces))
            out.append((b"".join([ids for ids, _ in known]), all([ok for _, ok in known])))
        if len(self.young) > CACHE_PIECES:
            self.young, self.old = {}, self.young
        return out

    def decode(self, ids: bytes) -> str:
        """The text of ids."""
        text = b"".join([self.bytes[i] for i in np.frombuffer(ids, "<u4").tolist()])
        text = text.decode("utf-8", "replace")
        return text[1:] if self.model.dummy_prefix and text.startswith(" ") else text


_BLANKS = re.compile(r" +[^ ]*")
_ENCODERS: dict[tuple, PieceEncoder] = {}


def _encoder(path: str, threads: int, check: bool) -> PieceEncoder:
    key = (path, threads, check)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = PieceEncoder(path, threads=threads, check=check)
    return _ENCODERS[key]


def encode_pieces(
    docs: DataFrame, *, model: str, threads: int = THREADS, check: bool = True
) -> DataFrame:
    """``doc_id, ids, parity, round_trip`` of each row of ``docs`` (``doc_id, text``).

    ``ids`` are the bytes of little-endian unsigned 32-bit integers of the whole text, ``parity``
    tells whether sentencepiece encodes every piece of it the same way (true without ``check``),
    ``round_trip`` whether decoding gives the text again. Null texts count as empty and have no ids;
    null ids and repeated rows stay as they are; an empty table gives an empty result.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use = _encoder(model, threads, check)
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                some = batch.slice(at, 128)
                whole = some.column(1).to_pylist()
                found = use.encode(whole)
                back = [use.decode(ids) == text for (ids, _), text in zip(found, whole, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        some.column(0),
                        pa.array([ids for ids, _ in found], pa.binary()),
                        pa.array([ok for _, ok in found], pa.bool_()),
                        pa.array(back, pa.bool_()),
                    ],
                    ["doc_id", "ids", "parity", "round_trip"],
                )

    return texts(docs).mapInArrow(
        encode, "doc_id long, ids binary, parity boolean, round_trip boolean"
    )


def decode_pieces(encoded: DataFrame, *, model: str) -> DataFrame:
    """``doc_id, text`` from ``doc_id, ids`` as :func:`encode_pieces` gives them; null ids are empty."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use = _encoder(model, 1, False)
        for batch in batches:
            back = [use.decode(ids or b"") for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(back, pa.string())], ["doc_id", "text"]
            )

    return encoded.select("doc_id", "ids").mapInArrow(decode, "doc_id long, text string")


def op10_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("piece_bpe_32k.model")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(1).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(x) // 4 for x in ids], pa.int64()),
                    pa.array([zlib.crc32(x) for x in ids], pa.int64()),
                    *batch.columns[2:],
                ],
                ["doc_id", "n_tokens", "ids_crc32", "parity", "round_trip"],
            )

    return encode_pieces(table(spark, sf_dir, "documents"), model=path).mapInArrow(
        digest, "doc_id long, n_tokens long, ids_crc32 long, parity boolean, round_trip boolean"
    )
