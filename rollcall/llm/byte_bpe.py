"""Byte-level BPE encoding and decoding (operator 7).

The ranks of a vocabulary become a sentencepiece BPE model as they are: a piece
for each token, its bytes written as printable characters, its score the negative
rank, no normalisation.  Such a model merges the pair with the lowest rank first,
as the rank file asks for, so it encodes each pre-token; decoding looks the bytes
of each id up.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterable
from functools import lru_cache

import public_tokenizers
import regex
import sentencepiece
from pyspark.sql import DataFrame

from rollcall.llm.batches import map_texts
from rollcall.llm.byte_symbols import BYTE_SYMBOLS

#: Encoded pre-tokens that a Python worker remembers; beyond it, it starts anew.
REMEMBERED = 200_000
# Fixed values of the model format: wire types, field numbers, enum members.
_VARINT, _BYTES, _FLOAT = 0, 2, 5
_PIECES, _TRAINER, _NORMALIZER = 1, 2, 3
_PIECE, _SCORE, _TYPE = 1, 2, 3
_UNKNOWN = 2
_MODEL_TYPE, _BPE = 3, 2
_NAME, _DUMMY_PREFIX, _EXTRA_WHITESPACE, _ESCAPE_WHITESPACE = 1, 3, 4, 5


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    return bytes(out) + bytes([n])


def _field(number: int, value: int | float | bytes) -> bytes:
    if isinstance(value, bytes):
        return _varint(number << 3 | _BYTES) + _varint(len(value)) + value
    if isinstance(value, float):
        return _varint(number << 3 | _FLOAT) + struct.pack("<f", value)
    return _varint(number << 3 | _VARINT) + _varint(value)


def as_symbols(data: bytes) -> str:
    return "".join([BYTE_SYMBOLS[b] for b in data])


def model_bytes(ranks: dict[bytes, int]) -> bytes:
    """The vocabulary as a serialised sentencepiece model; ids are ranks."""
    tokens = sorted(ranks, key=ranks.get)
    if [ranks[t] for t in tokens] != list(range(len(tokens))) or len(tokens) >= 1 << 24:
        raise ValueError("ranks must run from 0 without a gap, below 2^24")
    if missing := [b for b in range(256) if bytes([b]) not in ranks]:
        raise ValueError(f"bytes without a token: {missing}")
    unknown = "<unk>"
    while any(as_symbols(t) == unknown for t in tokens if len(t) == len(unknown)):
        unknown += ">"
    parts = [_field(_PIECES, _field(_PIECE, as_symbols(t).encode()) + _field(_SCORE, -float(i))) for i, t in enumerate(tokens)]
    parts.append(_field(_PIECES, _field(_PIECE, unknown.encode()) + _field(_SCORE, 0.0) + _field(_TYPE, _UNKNOWN)))
    parts.append(_field(_TRAINER, _field(_MODEL_TYPE, _BPE)))
    plain = [_field(n, 0) for n in (_DUMMY_PREFIX, _EXTRA_WHITESPACE, _ESCAPE_WHITESPACE)]
    parts.append(_field(_NORMALIZER, _field(_NAME, b"identity") + b"".join(plain)))
    return b"".join(parts)


class ByteBpe:
    """Encoder and decoder for one rank file."""

    def __init__(self, path: str):
        ranks = read_ranks(path)
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model_bytes(ranks))
        self.bytes_of = {str(rank): token for token, rank in ranks.items()}
        self.find = regex.compile(public_tokenizers.PATTERN).findall
        self.ids_of: dict[str, str] = {}

    def encode(self, texts: Iterable[str]) -> list[list[str]]:
        """The ids of each text, as decimal strings."""
        found = [self.find(text) for text in texts]
        known = self.ids_of
        new = list({piece for pieces in found for piece in pieces if piece not in known})
        ids = self.model.encode([as_symbols(p.encode()) for p in new], out_type=int, num_threads=1)
        known.update((piece, " ".join(map(str, own))) for piece, own in zip(new, ids))
        out = [" ".join(map(known.__getitem__, pieces)).split() for pieces in found]
        if len(known) > REMEMBERED:
            known.clear()
        return out

    def decode(self, ids: Iterable[str]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


@lru_cache(maxsize=2)
def byte_bpe(path: str) -> ByteBpe:
    return ByteBpe(path)


def encode_documents(
    documents: DataFrame, path: str, keys: tuple[str, ...] = ("doc_id",), text: str = "text"
) -> DataFrame:
    """``keys`` and ``ids array<int>`` for every row; a null or empty text has no ids."""

    def work(texts):
        return [[list(map(int, own)) for own in byte_bpe(path).encode(t or "" for t in texts)]]

    return map_texts(documents, keys, text, "ids array<int>", work)


def decode_documents(encoded: DataFrame, path: str, keys: tuple[str, ...] = ("doc_id",), ids: str = "ids") -> DataFrame:
    """``keys`` and ``decoded binary`` for every row; null ids give null, no ids no bytes."""
    from pyspark.sql import functions as F

    def work(lists):
        coder = byte_bpe(path)
        return [[None if own is None else coder.decode(own.split()) for own in lists]]

    joined = F.when(F.col(ids).isNotNull(), F.array_join(F.col(ids).cast("array<string>"), " "))
    return map_texts(encoded.withColumn("_ids", joined), keys, "_ids", "decoded binary", work)


def encode_and_decode(
    documents: DataFrame, path: str, keys: tuple[str, ...] = ("doc_id",), text: str = "text"
) -> DataFrame:
    """``keys``, ``n_tokens``, ``ids_sha256`` and ``decoded_sha256`` for every row.

    The ids are decoded again in the same pass, from the ids alone.  A null text
    counts as empty; keys may be null or repeat; an empty table gives an empty one.
    """

    def work(texts):
        coder = byte_bpe(path)
        ids = coder.encode(t or "" for t in texts)
        digests = [hashlib.sha256(" ".join(own).encode()).hexdigest() for own in ids]
        return [[len(own) for own in ids], digests, [hashlib.sha256(coder.decode(own)).hexdigest() for own in ids]]

    return map_texts(documents, keys, text, "n_tokens bigint, ids_sha256 string, decoded_sha256 string", work)


def op7_byte_bpe(spark, folder):
    documents = spark.read.parquet(f"{folder}/documents.parquet")
    return encode_and_decode(documents, public_tokenizers.path("byte_bpe_50k.tiktoken"))
