"""Token ids of whole texts by a public tokenizer, each word looked up once.

The pre-tokenizer splits at every single space between two characters that are
not white space, so a text is the sequence of its words, each with the space in
front of it, and the ids of a word do not depend on its neighbours. Words are
encoded by the tokenizer itself and remembered. Texts with white space next to a
space, or at an end, are encoded whole.

A pre-tokenizer that looks for nothing but ``public_tokenizers.PATTERN`` also splits in front of
a run of line breaks behind other characters, so lines begin words of their own: the breaks and what follows up to the next space.
"""

from __future__ import annotations

import json
import os
from collections.abc import Callable, Sequence
from functools import lru_cache
from itertools import compress
from operator import is_

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
# Words of a generation; a Python process remembers two. Bounds its memory, not its results.
REMEMBERED_WORDS = 400_000
# Texts looked up together, if an Arrow batch has so many: a word that several of them have is looked up once.
TEXTS_AT_ONCE = 4096
# Pre-tokenizers split each of these from an ASCII letter in front of it.
MARKS = ".,;:!?"
_MARK = np.zeros(256, np.int64)
_MARK[list(MARKS.encode())] = np.arange(len(MARKS)) + 1
_LETTER = np.array([chr(i).isalpha() and i < 128 for i in range(256)])


class Remembered(dict):
    """Ids of words. Once ``most`` are known, they become the older generation, from which words that occur again return, and
    the one before is forgotten: frequent words stay."""

    def __init__(self) -> None:
        self.older: dict[str, bytes] = {}

    def known(self, words: list[str]) -> tuple[list[bytes | None], list[int]]:
        """The ids of ``words``, None for those not remembered, and the places of these."""
        found = list(map(self.get, words))
        if not self.older:
            return found, [i for i, ids in enumerate(found) if ids is None]
        places = [i for i, ids in enumerate(found) if ids is None]
        missing = []
        for i, ids in zip(places, map(self.older.get, [words[i] for i in places])):
            if ids is None:
                missing.append(i)
            else:
                found[i] = self[words[i]] = ids
        return found, missing

    def age(self, most: int) -> None:
        if len(self) > most:
            self.older = dict(self)
            self.clear()


def _without_mark(words: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words without a single mark behind an ASCII letter, and the place of the mark in MARKS from 1, 0 for none."""
    if not len(words):
        return words, np.zeros(0, np.int64)
    sizes = np.asarray(pc.binary_length(words)).astype(np.int64)
    raw = np.frombuffer(words.buffers()[2] or b"\0", np.uint8)
    stops = np.frombuffer(words.buffers()[1], np.int32)[words.offset + 1 : words.offset + len(words) + 1]
    long = sizes > 1
    mark = np.where(long & _LETTER[raw[np.where(long, stops - 2, 0)]], _MARK[raw[np.where(long, stops - 1, 0)]], 0)
    cut = pa.array(mark > 0)
    return pc.if_else(cut, pc.utf8_slice_codeunits(words, 0, -1), words), mark


def _lines_apart(text: str) -> str:
    """The text with one more space in front of each run of line breaks, except behind a carriage return.

    A run behind a space makes an empty word, one in front of a space a word that ends with white space; both are encoded whole.
    """
    # twice, since a break ends one replaced pair and cannot begin the next
    apart = text.replace("\n", " \n").replace("\n \n", "\n\n").replace("\n \n", "\n\n")
    return apart.replace("\r \n", "\r\n")


class WordCache:
    """The ids of texts, each word (with the space in front of it) encoded once, as little-endian 32-bit integers.

    ``encode`` gives the ids of a text, ``lengths`` the bytes each id stands for. Words that begin or end with
    white space (or are empty) are not remembered, and their texts are encoded whole: the split next to those depends on their neighbours.
    With ``lines`` the first word of a line is one by itself, with the line breaks in front of it.
    """

    def __init__(self, encode: Callable[[str], np.ndarray], lengths: np.ndarray, most: int = REMEMBERED_WORDS, lines: bool = False):
        self.encode, self.lengths, self.most, self.lines = encode, lengths, most, lines
        self.inner, self.first = Remembered(), Remembered()

    def __len__(self) -> int:
        return len(self.inner) + len(self.first)

    def _encode_words(self, words: list[str], space: str) -> list[bytes]:
        """All words in one call: joined by white space they are still split where they meet."""
        if not words:
            return []
        # the white space belongs to the word behind it, is a token of its own, or the words bring it along
        ids = self.encode("".join(words) if space == "\n" else " " + " ".join(words) if space else "\n".join(words))
        raw, stops = ids.astype("<u4").tobytes(), np.cumsum(self.lengths[ids])
        sizes = np.asarray(pc.binary_length(pa.array(words, pa.string()))).astype(np.int64) + (space != "\n")
        last = (np.searchsorted(stops, np.cumsum(sizes) - (not space)) + 1).tolist()
        start = [0] + (last[:-1] if space else [n + 1 for n in last[:-1]])
        return [raw[4 * i : 4 * j] for i, j in zip(start, last)]

    def _known(self, words: list[str], space: str) -> list[bytes | None]:
        """The ids of different words; None where the split depends on their neighbours."""
        remembered = self.inner if space else self.first
        found, missing = remembered.known(words)
        new = [words[i] for i in missing]
        # stripping gives back the very text if there is nothing to strip
        safe = {space: [bool(w) and same for w, same in zip(new, map(is_, map(str.strip, new), new))]}
        if self.lines and space:
            safe["\n"] = [w[:1] == "\n" and w.rstrip() is w for w in new]
        for kind, chosen in safe.items():
            places, words = list(compress(missing, chosen)), list(compress(new, chosen))
            ids = self._encode_words(words, kind)
            remembered.update(zip(words, ids))
            for i, own in zip(places, ids):
                found[i] = own
        remembered.age(self.most)
        return found

    def _ids_of(self, words: pa.Array, space: str) -> pa.Array:
        """The ids of different words as binary values; a mark behind a letter is looked up by itself."""
        bare, mark = _without_mark(words)
        bare = bare.dictionary_encode()
        ids = pa.array(self._known(bare.dictionary.to_pylist(), space), pa.large_binary()).take(bare.indices)
        marks = pa.array([b"", *(self.encode(m).astype("<u4").tobytes() for m in MARKS)], pa.large_binary())
        return pc.binary_join_element_wise(ids, marks.take(pa.array(mark)), pa.scalar(b"", pa.large_binary()))

    def values_of(self, texts: Sequence[str]) -> list[bytes]:
        """The ids of every text."""
        if not len(texts):
            return []
        lists = pc.split_pattern(pa.array(map(_lines_apart, texts) if self.lines else texts, pa.string()), " ")
        sizes = np.asarray(lists.value_lengths()).astype(np.int64)
        starts = np.cumsum(sizes) - sizes
        encoded = lists.flatten().dictionary_encode()
        place = np.asarray(encoded.indices).astype(np.int64)
        # the first word of a text has no space in front
        leading, own = np.unique(place[starts], return_inverse=True)
        place[starts] = len(encoded.dictionary) + own
        held = pa.concat_arrays([self._ids_of(encoded.dictionary, " "), self._ids_of(encoded.dictionary.take(pa.array(leading)), "")])
        unsafe = np.asarray(held.is_null())
        whole = np.logical_or.reduceat(unsafe[place], starts)
        bounds = np.frombuffer(held.buffers()[1], np.int64, len(held) + 1) // 4
        flat = np.frombuffer(held.buffers()[2] or b"", "<u4")
        begins, counts = bounds[:-1], np.diff(bounds)
        n = counts[place]
        before = np.cumsum(n) - n
        gathered = flat[np.repeat(begins[place] - before, n) + np.arange(int(n.sum()))]
        ends = np.append(before[starts][1:], len(gathered)).tolist()
        return [
            self.encode(text).astype("<u4").tobytes() if by_itself else gathered[i:j].tobytes()
            for text, by_itself, i, j in zip(texts, whole.tolist(), before[starts].tolist(), ends)
        ]


@lru_cache(4)
def _byte_bpe(path: str) -> WordCache:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    # byte-level: one character of a token for each byte
    lengths = np.zeros(tokenizer.get_vocab_size(), np.int64)
    for token, i in tokenizer.get_vocab().items():
        lengths[i] = len(token)

    def encode(text: str) -> np.ndarray:
        return np.array(tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.int64)

    known = json.loads(tokenizer.to_str())
    given = known["pre_tokenizer"] or {}
    lines = given.get("type") == "ByteLevel" and given["use_regex"] and not given["add_prefix_space"] and known["normalizer"] is None
    return WordCache(encode, lengths, lines=lines)


def encoded(texts: list[str], path: str = BYTE_BPE, words: int = REMEMBERED_WORDS) -> list[bytes]:
    """The ids of every text as little-endian unsigned 32-bit integers; ``words`` of a generation are remembered."""
    cache = _byte_bpe(path)
    cache.most = words
    return cache.values_of(texts)
