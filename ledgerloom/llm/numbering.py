"""Words of many texts as Arrow and NumPy arrays: splitting, numbering, hashing and counting without an object for each word."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_MIX = np.uint64(0x9E3779B97F4A7C15)


def binary(values: Sequence[bytes] = ()) -> pa.Array:
    return pa.array(values, pa.binary())


def lengths_of(values: pa.Array) -> np.ndarray:
    return np.asarray(pc.binary_length(values)).astype(np.int64)


def split(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words between ASCII white space, and the number of the text each is from; texts and words are binary."""
    lists = pc.ascii_split_whitespace(texts.view(pa.string()))
    words = lists.flatten().view(pa.binary())
    text = np.repeat(np.arange(len(texts)), np.asarray(lists.value_lengths()))
    some = lengths_of(words) > 0
    return words.filter(pa.array(some)), text[some]


class Numbers:
    """Numbers of binary values from 0, in order of first sight."""

    def __init__(self) -> None:
        self.values = binary()

    def __len__(self) -> int:
        return len(self.values)

    def of(self, found: pa.Array) -> np.ndarray:
        """The number of every value; those not seen before get the next ones."""
        n = len(self.values)
        encoded = pa.concat_arrays([self.values, found]).dictionary_encode()
        self.values = encoded.dictionary
        return np.asarray(encoded.indices)[n:].astype(np.int64)


def hashes_of(values: pa.Array, seed: int, most: int | None = None, marked: np.ndarray | None = None) -> np.ndarray:
    """64-bit hashes of the first ``most`` bytes of binary values, with a mark for each (default: whether it is longer)."""
    sizes = lengths_of(values)
    used = sizes if most is None else np.minimum(sizes, most)
    marked = sizes > used if marked is None else marked
    data = np.frombuffer(values.buffers()[2], np.uint8) if len(values) and values.buffers()[2] else np.zeros(1, np.uint8)
    offsets = np.frombuffer(values.buffers()[1], np.int32)[values.offset : values.offset + len(values)].astype(np.int64) if len(values) else sizes
    found = (used.astype(np.uint64) * np.uint64(2) + marked.astype(np.uint64)) * _MIX + np.uint64(seed)
    left = np.arange(len(values))
    for at in range(0, int(used.max(initial=0)), 8):
        left = left[used[left] > at]
        word = np.zeros(len(left), np.uint64)
        for byte in range(8):
            inside = used[left] > at + byte
            place = np.where(inside, offsets[left] + at + byte, 0)
            word |= np.where(inside, data[place], 0).astype(np.uint64) << np.uint64(8 * byte)
        mixed = (found[left] ^ word) * _MIX
        found[left] = mixed ^ mixed >> np.uint64(29)
    mixed = (found ^ found >> np.uint64(32)) * _MIX
    return mixed ^ mixed >> np.uint64(29)


def distinct_pairs(first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different pairs of two arrays of numbers below 2 ** 31."""
    codes = first << 32 | second
    codes.sort()
    codes = codes[np.append(True, codes[1:] != codes[:-1])] if len(codes) else codes
    return codes >> 32, codes & ((1 << 32) - 1)


class Sums:
    """Counts under pairs of numbers, added up when asked for."""

    def __init__(self) -> None:
        self.codes: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.held = 0

    def add(self, first: np.ndarray, second: np.ndarray) -> None:
        codes, counts = np.unique(first << 32 | second, return_counts=True)
        self.codes.append(codes)
        self.counts.append(counts)
        self.held += len(codes)

    def together(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First number, second number and count of every pair."""
        if not self.codes:
            return (np.zeros(0, np.int64),) * 3
        codes, where = np.unique(np.concatenate(self.codes), return_inverse=True)
        counts = np.bincount(where, np.concatenate(self.counts), len(codes)).astype(np.int64)
        return codes >> 32, codes & ((1 << 32) - 1), counts


class Waiting:
    """Rows of record batches held back by the value of their first column until there are enough of one to work on."""

    def __init__(self, most_bytes: int, columns: int):
        self.most, self.columns = most_bytes, columns
        self.rows: dict[str, list[list[pa.Array]]] = {}
        self.bytes: dict[str, int] = {}

    def add(self, batch: pa.RecordBatch):
        """Take the rows of a batch; yields (value, columns) for values with enough rows."""
        first = batch.column(0).dictionary_encode()
        for number, value in enumerate(first.dictionary.to_pylist()):
            some = batch if len(first.dictionary) == 1 else batch.filter(pc.equal(first.indices, number))
            held = self.rows.setdefault(value, [[] for _ in range(self.columns)])
            for column, rows in enumerate(held):
                rows.append(some.column(column + 1))
            self.bytes[value] = self.bytes.get(value, 0) + some.nbytes
            if self.bytes[value] >= self.most:
                yield self._out(value)
        if sum(self.bytes.values()) >= 4 * self.most:
            yield from self.rest()

    def _out(self, value: str):
        del self.bytes[value]
        return value, [pa.concat_arrays(rows) for rows in self.rows.pop(value)]

    def rest(self):
        for value in list(self.rows):
            yield self._out(value)
