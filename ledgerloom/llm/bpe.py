"""Byte-level BPE encoding and decoding with a sentencepiece model made from the vocabulary.

The ranks of a byte-level vocabulary become a sentencepiece model of type BPE
without training: every byte is mapped to a printable character, a piece's score
is its negative rank, so the merge with the lowest rank wins, and nothing is
normalised. Pre-tokens are encoded one by one; ids are the ranks. Decoding maps
each id back to its bytes.

NULL texts count as empty; an empty text has no ids. Ties between equal pairs go
to the leftmost, repeated rows are encoded alike, an empty table gives an empty
result, and columns other than those asked for are not read.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Sequence
from functools import lru_cache
from itertools import accumulate, chain

import numpy as np
import public_tokenizers
import regex
import sentencepiece
from pyspark.sql import DataFrame

from ledgerloom.llm.common import add_to_rows, map_rows
from ledgerloom.llm.vocabulary import TEXTS_AT_ONCE, WordCache

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
# Bytes stand in the pieces as characters from here on; no white space or control among them.
_FIRST_CHARACTER = 0x4E00
# Fixed values of the sentencepiece model format: field numbers and enum values.
_UNKNOWN, _NORMAL, _BPE = 2, 1, 2
_PIECES, _TRAINER, _NORMALIZER = 1, 2, 3


def read_ranks(path: str) -> list[bytes]:
    """The tokens of a rank file in order of rank."""
    with open(path, "rb") as file:
        pairs = [line.split() for line in file if line.strip()]
    ranks = {int(rank): base64.b64decode(token) for token, rank in pairs}
    if sorted(ranks) != list(range(len(ranks))):
        raise ValueError("ranks must run from 0 without a gap")
    return [ranks[i] for i in range(len(ranks))]


def _varint(n: int) -> bytes:
    out = b""
    while n > 127:
        out += bytes([n & 127 | 128])
        n >>= 7
    return out + bytes([n])


def _number(field: int, n: int) -> bytes:
    return _varint(field << 3) + _varint(n)


def _message(field: int, content: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(content)) + content


def sentencepiece_model(tokens: Sequence[bytes]) -> bytes:
    """A serialised sentencepiece BPE model whose piece ids are the ranks; the unknown piece comes last."""

    def piece(text: str, score: float, kind: int) -> bytes:
        return _message(_PIECES, _message(1, text.encode()) + b"\x15" + struct.pack("<f", score) + _number(3, kind))

    pieces = [piece(_mapped(token), -float(rank), _NORMAL) for rank, token in enumerate(tokens)]
    pieces.append(piece("<unk>", 0.0, _UNKNOWN))
    no_id = (1 << 64) - 1  # -1
    trainer = _number(3, _BPE) + _number(4, len(pieces)) + _number(40, len(tokens))
    trainer += b"".join(_number(field, no_id) for field in (41, 42, 43))
    trainer += _number(24, 0)  # white space is no suffix
    # identity: no character map, no added prefix, no spaces removed or escaped
    normalizer = _message(1, b"identity") + b"".join(_number(field, 0) for field in (3, 4, 5))
    return b"".join(pieces) + _message(_TRAINER, trainer) + _message(_NORMALIZER, normalizer)


def _mapped(raw: bytes) -> str:
    return (np.frombuffer(raw, np.uint8) + np.uint16(_FIRST_CHARACTER)).astype("<u2").tobytes().decode("utf-16-le")


class Codec:
    """Encoder and decoder of one rank file."""

    def __init__(self, path: str, pattern: str):
        self.tokens = read_ranks(path)
        self.pattern = regex.compile(pattern)
        self.model = sentencepiece.SentencePieceProcessor(model_proto=sentencepiece_model(self.tokens))
        self.words = WordCache(self._encode, np.array([len(t) for t in self.tokens]), lines=pattern == public_tokenizers.PATTERN)

    def _apart(self, pre_tokens: Sequence[str]) -> list[list[int]]:
        """The ids of each pre-token. All are mapped at once, and one call encodes them: a call costs as much as many pre-tokens."""
        raw = [p.encode() for p in pre_tokens]
        mapped, ends = _mapped(b"".join(raw)), list(accumulate(map(len, raw)))
        flat = [mapped[i:j] for i, j in zip([0, *ends], ends)]
        return self.model.encode(flat, num_threads=1) if flat else []

    def _encode(self, text: str) -> np.ndarray:
        """The pre-tokens of a text, encoded separately."""
        return np.fromiter(chain.from_iterable(self._apart(self.pattern.findall(text))), np.int64)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.frombuffer(ids, "<i4") for ids in self.words.values_of(texts)]

    def sizes(self, pre_tokens: Sequence[str]) -> list[int]:
        """Tokens of each pre-token."""
        return list(map(len, self._apart(pre_tokens)))

    def decode(self, ids: Sequence[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


@lru_cache(4)
def codec(path: str = RANKS, pattern: str = public_tokenizers.PATTERN) -> Codec:
    """One codec per Python process; the serialised model takes a moment to load."""
    return Codec(path, pattern)


def encode(
    df: DataFrame,
    text: str = "text",
    keep: Sequence[str] = ("doc_id",),
    path: str = RANKS,
    pattern: str = public_tokenizers.PATTERN,
) -> DataFrame:
    """``keep`` and ``ids`` (array of int), the ranks of the tokens of every whole text."""
    return add_to_rows(df, text, keep, "ids array<int>", lambda texts: [codec(path, pattern).encode(texts)], TEXTS_AT_ONCE)


def decode(df: DataFrame, ids: str = "ids", keep: Sequence[str] = ("doc_id",), path: str = RANKS) -> DataFrame:
    """``keep`` and ``decoded`` (binary), the bytes that the ids stand for; NULL ids give no bytes."""
    def run(part):
        return [[codec(path).decode(row or ()) for row in part.column("_0").to_pylist()]]

    return map_rows(df, [ids], keep, "decoded binary", run)
