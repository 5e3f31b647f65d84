"""Byte-level BPE encoding and decoding by a sentencepiece model made from the vocabulary.

The vocabulary gives each token's bytes a rank.  It is written out as a sentencepiece BPE
model: a piece per token, every byte standing as one character (U+0100 and up), scored by
the negative rank, normalisation switched off.  Merging the best scored pair first, the
leftmost of equals, is then the same as merging the lowest rank first, so the model gives
the vocabulary's own ids.  Texts are cut by the vocabulary's pattern, each cut is encoded by
itself, once per worker while its cache holds it; decoding takes each id's bytes.

A vocabulary may hold tokens that no sequence of merges builds.  A cut that is such a token
as a whole is that token; these are found when the model is made, and travel with it.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courier.llm.common import text_of
from courier.llm.pretokens import Cutter, PieceCache, tokenizer_path

VOCABULARY = "byte_bpe_multi_50k.tiktoken"

#: Rows encoded or decoded at a time.
SLICE = 256

_AS_TEXT = {b: chr(0x100 + b) for b in range(256)}
# Fixed values of sentencepiece's model format: kinds of piece, and the BPE model's number.
_NORMAL, _UNKNOWN, _BPE = 1, 2, 2


def read_ranks(path: str) -> dict[bytes, int]:
    """Bytes and rank of each token of a ``.tiktoken`` file; the rank is the id."""
    with open(path, "rb") as lines:
        return {base64.b64decode(t): int(r) for t, r in map(bytes.split, lines)}


def _as_text(data: bytes) -> str:
    return data.decode("latin-1").translate(_AS_TEXT)


# --- the model ---------------------------------------------------------------------


def _varint(number: int) -> bytes:
    out = bytearray()
    while number > 127:
        out.append(number & 127 | 128)
        number >>= 7
    out.append(number)
    return bytes(out)


def _field(number: int, value: int | float | bytes) -> bytes:
    """One field of a protocol buffer: a number, a 32-bit float, or bytes."""
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    if isinstance(value, int):
        return _varint(number << 3) + _varint(value)
    return _varint(number << 3 | 2) + _varint(len(value)) + value


def _piece(text: str, score: float, kind: int) -> bytes:
    return _field(1, _field(1, text.encode()) + _field(2, score) + _field(3, kind))


def sentencepiece_model(tokens: list[bytes]) -> bytes:
    """A serialised sentencepiece BPE model whose piece ``i`` is token ``i``, in rank order.

    One further piece, the last, stands for unknown characters; no text of bytes has any, as
    long as the vocabulary holds all 256 single bytes.
    """
    pieces = [_piece(_as_text(t), -float(i), _NORMAL) for i, t in enumerate(tokens)]
    pieces.append(_piece("<unk>", 0.0, _UNKNOWN))
    trainer = _field(3, _BPE) + _field(4, len(pieces)) + _field(40, len(tokens))
    off = _field(3, 0) + _field(4, 0) + _field(5, 0)  # prefix, space trimming, space escapes
    normalizer = _field(1, b"identity") + off
    return b"".join(pieces) + _field(2, trainer) + _field(3, normalizer)


@dataclass(frozen=True)
class Vocabulary:
    """What workers need: the model, the ids of its pieces, and tokens that merges miss."""

    digest: str
    model: bytes
    ids: tuple[int, ...]
    tokens: tuple[bytes, ...]
    whole: dict[bytes, int]

    @classmethod
    def from_ranks(cls, ranks: dict[bytes, int]) -> "Vocabulary":
        import sentencepiece

        if any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("a byte-level vocabulary holds every single byte")
        tokens = sorted(ranks, key=ranks.__getitem__)
        model = sentencepiece_model(tokens)
        processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        built = processor.encode([_as_text(t) for t in tokens], num_threads=1)
        whole = {t: ranks[t] for i, (t, ids) in enumerate(zip(tokens, built)) if ids != [i]}
        ids = tuple(ranks[t] for t in tokens)
        digest = hashlib.sha256(model + repr(ids).encode()).hexdigest()
        return cls(digest, model, ids, tuple(tokens), whole)


@lru_cache(maxsize=4)
def load_vocabulary(name: str) -> Vocabulary:
    return Vocabulary.from_ranks(read_ranks(tokenizer_path(name)))


# --- in the workers ----------------------------------------------------------------


@lru_cache(maxsize=1)
def _one_cut():
    """Does the pattern, as the tokenizer's library reads it, keep two characters together?

    The probe's vocabulary joins a, 1 or ! to any byte after it, which happens only inside
    one cut.
    """
    import public_tokenizers
    import tiktoken

    joined = [bytes([first, b]) for first in b"a1!" for b in range(256)]
    ranks = {t: i for i, t in enumerate([*(bytes([b]) for b in range(256)), *joined])}
    probe = tiktoken.Encoding(
        "probe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    return lambda text: probe.encode_ordinary(text)[0] >= 256


class _Encoder:
    """A vocabulary's model, cutter and cache, one for each worker process."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        import public_tokenizers
        import sentencepiece

        self._processor = sentencepiece.SentencePieceProcessor(model_proto=vocabulary.model)
        self._whole = vocabulary.whole
        self._ids = np.asarray(vocabulary.ids, "<u4")
        self.cut = Cutter(public_tokenizers.PATTERN, _one_cut())
        self.cache = PieceCache(self._encode)

    def _encode(self, pieces: list[str]) -> Iterator[np.ndarray]:
        data = [p.encode() for p in pieces]
        for raw, built in zip(
            data, self._processor.encode([_as_text(d) for d in data], num_threads=1)
        ):
            yield [self._whole[raw]] if raw in self._whole else self._ids[built]

    def __call__(self, texts: list[str]) -> list[bytes]:
        return self.cache.ids([self.cut(t) for t in texts])


class _Decoder:
    """Bytes of ids, looked up in one column of tokens."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self._place = np.full(max(vocabulary.ids) + 1, -1, np.int64)
        self._place[list(vocabulary.ids)] = np.arange(len(vocabulary.ids))
        self._tokens = pa.array(vocabulary.tokens, pa.large_binary())

    def __call__(self, ids: list[bytes]) -> list[bytes | None]:
        return [self._text(i) for i in ids]

    def _text(self, data: bytes) -> bytes | None:
        if len(data) % 4:
            return None
        ids = np.frombuffer(data, "<u4")
        place = self._place[np.minimum(ids, len(self._place) - 1)]
        if (ids >= len(self._place)).any() or (place < 0).any():
            return None
        taken = self._tokens.take(pa.array(place))
        if not len(taken):
            return b""
        offsets = np.frombuffer(taken.buffers()[1], np.int64)
        return taken.buffers()[2].to_pybytes()[offsets[0] : offsets[len(taken)]]


#: Encoders and decoders of a worker process, by vocabulary.
_coders: dict[tuple, object] = {}


def _coder(kind: type, vocabulary: Vocabulary):
    key = (kind.__name__, vocabulary.digest)
    if key not in _coders:
        _coders[key] = kind(vocabulary)
    return _coders[key]


# --- the operator ------------------------------------------------------------------


def _broadcast(df: DataFrame, vocabulary: str):
    """The vocabulary for all workers: a few MB, as its file is."""
    return df.sparkSession.sparkContext.broadcast(load_vocabulary(vocabulary))


def encode_documents(
    docs: DataFrame,
    vocabulary: str = VOCABULARY,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``doc_id, n_tokens, ids`` for every row, in one pass without a shuffle.

    ``ids`` holds the token ids as little-endian unsigned 32-bit integers.  There are no
    special tokens: their strings are text like any other.  A null text counts as empty and
    has no ids.  Null and repeated ids keep their rows, other columns are not looked at, and
    a table without rows gives none.
    """
    shared = _broadcast(docs, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _coder(_Encoder, shared.value)
        for batch in batches:
            for low in range(0, batch.num_rows, SLICE):
                part = batch.slice(low, SLICE)
                ids = encode(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array([len(i) // 4 for i in ids], pa.int64()),
                        pa.array(ids, pa.binary()),
                    ],
                    names=["doc_id", "n_tokens", "ids"],
                )

    slim = docs.select(F.col(id_column).cast("bigint"), text_of(text_column))
    return slim.mapInArrow(run, "doc_id bigint, n_tokens bigint, ids binary")


def decode_documents(encoded: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """``doc_id, n_tokens, ids, decoded``: the bytes that the ids stand for.

    No ids, or null, give empty bytes.  Ids that the vocabulary does not have, or a length
    that is no multiple of four bytes, give null.
    """
    shared = _broadcast(encoded, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = _coder(_Decoder, shared.value)
        for batch in batches:
            for low in range(0, batch.num_rows, SLICE):
                part = batch.slice(low, SLICE)
                decoded = decode([i or b"" for i in part.column(2).to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(decoded, pa.binary())],
                    names=["doc_id", "n_tokens", "ids", "decoded"],
                )

    slim = encoded.select("doc_id", "n_tokens", "ids")
    return slim.mapInArrow(run, "doc_id bigint, n_tokens bigint, ids binary, decoded binary")
