"""A membership filter of bounded size, built by Spark and handed to tasks.

Hashes of the members set bits of a table whose size is bounded by a parameter, however many
members there are. It never misses a member; others may pass, so that what passes must still be counted.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Bits that a member sets, bits of a sieve per member (one in 200 others passes), and the most bits a sieve has (8 MB).
PROBES = 3
BITS_PER_MEMBER = 16
MOST_BITS = 1 << 26
LEAST_BITS = 1 << 16


def hash_of(value: bytes, seed: int = 0) -> int:
    return xxhash.xxh64_intdigest(value, seed)


def _places(hashes: np.ndarray, bits: int) -> list[np.ndarray]:
    """The bits of each hash."""
    step = hashes >> np.uint64(32) | np.uint64(1)
    return [(hashes + np.uint64(i) * step) & np.uint64(bits - 1) for i in range(PROBES)]


class Sieve:
    """A hash passes if all of its bits are set."""

    def __init__(self, words: np.ndarray):
        self.words = words

    def passes(self, hashes: np.ndarray) -> np.ndarray:
        found = np.ones(len(hashes), bool)
        for place in _places(hashes, 64 * len(self.words)):
            found &= self.words[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63)) & np.uint64(1) == 1
        return found


def sieve_of(members: DataFrame, hashes: Callable[[pa.RecordBatch], np.ndarray], most_bits: int = MOST_BITS) -> Sieve:
    """The sieve of all rows of ``members``; ``hashes`` gives the 64-bit hashes of some rows.

    The driver receives at most ``most_bits`` / 64 pairs of longs.
    """
    bits = LEAST_BITS
    while bits < min(most_bits, BITS_PER_MEMBER * members.count()):
        bits *= 2

    def run(batches):
        for batch in batches:
            place = np.concatenate(_places(hashes(batch), bits))
            word, bit = (place >> np.uint64(6)).astype(np.int64), np.uint64(1) << (place & np.uint64(63))
            yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(bit.view(np.int64))], names=["word", "bit"])

    table = members.mapInArrow(run, "word long, bit long").groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    words = np.zeros(bits // 64, np.uint64)
    words[table.column("word").to_numpy()] = table.column("bits").to_numpy().view(np.uint64)
    return Sieve(words)
