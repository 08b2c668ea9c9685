"""SimHash fingerprints of word shingles and the groups that few differing bits link.

A fingerprint is cut into so few segments that, within the distance allowed, one
segment differs by at most one bit. Every segment is indexed as it is and with
each of its bits replaced by a wildcard; two fingerprints meet under one key either
at the whole segment, or at the wildcard on the one bit in which the segment differs. The variants are shuffled by key
once, and all pairs that meet are verified on all bits there.

Equal fingerprints are one row before they are indexed, so copies cost nothing. A key that
many different fingerprints share is not searched: its rows get further keys from their
remaining bits by the same rule, until the bits left bound the rows of a key. No link is lost.

Texts that are NULL or without words have fingerprint zero, linked like any other; shorter
texts than a shingle are one shingle; repeated rows and ids fall into one group; an empty
table gives an empty result; other columns are not read. Ids that are NULL get the smallest other id
of their group.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.columns import as_column
from ledgerloom.llm.common import add_to_rows, connected_components, stored
from ledgerloom.operators.skew import left_join_unique

SHINGLE = 3
MAX_DISTANCE = 3
SEED = 42
BITS = 64
# Different fingerprints under one key that are compared with each other directly.
ROWS_PER_KEY = 128
# With no more bits left to cut, a key has at most 2 ** FEWEST_BITS rows, times two per wildcard.
FEWEST_BITS = 8

_WHOLE = 2  # the side of a segment indexed as it is; else the bit under the wildcard
_AT_ONCE = 1 << 16


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """Bit i is set if it is set in more than half of the hashes of the shingles."""
    words = text.encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = [n - 1 for n in accumulate(len(w) + 1 for w in words)]
    starts = [0, *[n + 1 for n in ends[:-1]]]
    spans = zip(starts, ends[shingle - 1 :]) if len(words) >= shingle else [(0, len(joined))]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[i:j], SEED) for i, j in spans], "<u8")
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), _AT_ONCE):
        bits = hashes[at : at + _AT_ONCE].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(bits, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(df: DataFrame, text: str = "text", keep: Sequence[str] = ("doc_id",), shingle: int = SHINGLE) -> DataFrame:
    """``keep`` and ``fingerprint``, the 64 bits as a signed long."""
    return add_to_rows(df, text, keep, "fingerprint long", lambda texts: [[fingerprint(t, shingle) for t in texts]])


def hexadecimal(bits: Column) -> Column:
    return F.lower(F.lpad(F.hex(bits), 16, "0"))


def _variants(key: Column, rest: Column, side: Column, bits: int, segments: int, level: int) -> Column:
    """An array of the keys of one row: every segment of its remaining bits, whole and with one wildcard."""
    found = []
    edges = [bits * i // segments for i in range(segments + 1)]
    for i, (low, high) in enumerate(zip(edges, edges[1:])):
        width = high - low
        segment = F.shiftrightunsigned(rest, low).bitwiseAND(F.lit((1 << width) - 1)) if width < 64 else rest
        above = F.shiftleft(F.shiftrightunsigned(rest, high), low) if high < 64 else F.lit(0).cast("long")
        others = above.bitwiseOR(rest.bitwiseAND(F.lit((1 << low) - 1)))
        for wildcard in range(-1, width):
            if wildcard < 0:
                masked, own = segment, F.lit(_WHOLE)
            else:
                masked = segment.bitwiseAND(F.lit(~(1 << wildcard) if wildcard < 63 else (1 << 63) - 1))
                own = F.shiftrightunsigned(segment, wildcard).bitwiseAND(F.lit(1)).cast("int")
            found.append(
                F.struct(
                    F.xxhash64(key, F.lit(i * BITS + wildcard), masked).alias("key"),
                    others.alias("rest"),
                    side.bitwiseOR(F.shiftleft(own, 2 * level)).alias("side"),
                )
            )
    return F.array(*found)


_FOUND = "a long, b long, key long, rest long, side int"


def _met(key: np.ndarray, fp: np.ndarray, side: np.ndarray, size: np.ndarray, levels: int, distance: int) -> pa.RecordBatch:
    """The links among rows that share a key; equal keys lie side by side, ``size`` counts them."""
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, int)
    place = np.arange(len(key)) - np.repeat(first, size[first])
    links: list[tuple[np.ndarray, np.ndarray]] = []
    at = np.flatnonzero(size > 1)
    step = 1
    while len(at):
        at = at[place[at] + step < size[at]]
        a, b = fp[at], fp[at + step]
        meets = (np.bitwise_count((a ^ b).view(np.uint64)) <= distance) & (a != b)
        for level in range(levels):
            left, right = (side[i] >> 2 * level & 3 for i in (at, at + step))
            meets &= (left == _WHOLE) | (right == _WHOLE) | (left != right)
        links.append((np.minimum(a, b)[meets], np.maximum(a, b)[meets]))
        step += 1
    ends = [np.concatenate([pair[i] for pair in links]) if links else np.zeros(0, np.int64) for i in (0, 1)]
    empty = pa.nulls(len(ends[0]), pa.int64())
    return pa.RecordBatch.from_arrays(
        [pa.array(ends[0], pa.int64()), pa.array(ends[1], pa.int64()), empty, empty, pa.nulls(len(ends[0]), pa.int32())], names=_NAMES
    )


def _crowded(key: np.ndarray, fp: np.ndarray, rest: np.ndarray, side: np.ndarray) -> pa.RecordBatch:
    arrays = [pa.array(fp, pa.int64()), pa.nulls(len(fp), pa.int64()), pa.array(key, pa.int64()), pa.array(rest, pa.int64())]
    return pa.RecordBatch.from_arrays([*arrays, pa.array(side, pa.int32())], names=_NAMES)


_NAMES = ["a", "b", "key", "rest", "side"]


def _level(rows: DataFrame, bits: int, segments: int, level: int, distance: int, rows_per_key: int | None) -> DataFrame:
    """One level of keys: the links (a, b) within keys, and as (a, key, rest, side) the rows of keys with more than ``rows_per_key``.

    Variants are made in all tasks, shuffled once and compared where they meet. A task holds the rows of one key at most, up to
    ``rows_per_key``; more of them are passed on one by one.
    """

    def run(batches):
        held = [np.zeros(0, t) for t in ("i8", "i8", "i8", "i4")]
        passed = None  # the key whose rows are passed on
        for batch in batches:
            new = [np.asarray(batch.column(i)) for i in range(4)]
            if passed is not None and len(new[0]):
                same = int(np.searchsorted(new[0] != passed, True))
                if same:
                    yield _crowded(*[c[:same] for c in new])
                    new = [c[same:] for c in new]
            if not len(new[0]):
                continue
            passed = None
            rows_now = [np.concatenate(pair) for pair in zip(held, new)]
            key = rows_now[0]
            starts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            done, held = [c[: starts[-1]] for c in rows_now], [c[starts[-1] :] for c in rows_now]
            yield from judged(done)
            if rows_per_key and len(held[0]) > rows_per_key:
                yield _crowded(*held)
                passed, held = held[0][0], [c[:0] for c in held]
        yield from judged(held)

    def judged(columns):
        key = columns[0]
        if not len(key):
            return
        starts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        sizes = np.diff(np.append(starts, len(key)))
        size = np.repeat(sizes, sizes)
        if rows_per_key:
            many = size > rows_per_key
            if many.any():
                yield _crowded(*[c[many] for c in columns])
                columns, size = [c[~many] for c in columns], size[~many]
        key, fp, _, side = columns
        yield _met(key, fp, side, size, level + 1, distance)

    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = _variants(F.col("key"), F.col("rest"), F.col("side"), bits, segments, level)
    # a row becomes many, so the rows are dealt out to all tasks first
    variants = rows.repartition(n, "fp").select("fp", F.inline(keys)).select("key", "fp", "rest", "side")
    return stored(variants.repartition(n, "key").sortWithinPartitions("key").mapInArrow(run, _FOUND), "level")


def links(distinct: DataFrame, distance: int = MAX_DISTANCE, rows_per_key: int = ROWS_PER_KEY) -> DataFrame:
    """Pairs (a, b) of the different fingerprints in column ``fp`` that differ in at most ``distance`` bits.

    A pair may be listed several times. One stored table per level of keys.
    """
    segments = distance // 2 + 1
    rows = distinct.select("fp", F.lit(0).cast("long").alias("key"), F.col("fp").alias("rest"), F.lit(0).alias("side"))
    bits, level, found = BITS, 0, []
    while True:
        fewer = bits - bits // segments
        last = segments == 1 or fewer <= FEWEST_BITS
        now = _level(rows, bits, segments, level, distance, None if last else rows_per_key)
        found.append(now.filter("b IS NOT NULL").select("a", "b"))
        rows = now.filter("b IS NULL").select(F.col("a").alias("fp"), "key", "rest", "side")
        if last or rows.isEmpty():
            return reduce(DataFrame.unionByName, found)
        bits, level = fewer, level + 1


def groups(prints: DataFrame, key: str = "doc_id", distance: int = MAX_DISTANCE, rows_per_key: int = ROWS_PER_KEY) -> DataFrame:
    """(fingerprint, group, component_id) for every different fingerprint: the smallest fingerprint and the smallest
    key reachable over links. Only ``group`` tells groups apart: keys may be NULL or repeated."""
    nodes = prints.groupBy(F.col("fingerprint").alias("fp")).agg(F.min(as_column(key)).alias("first"))
    nodes = stored(nodes, "fingerprints")
    linked = connected_components(links(nodes.select("fp"), distance, rows_per_key))
    nodes = nodes.join(linked, nodes["fp"] == linked["node"], "left")
    nodes = nodes.select("fp", "first", F.coalesce("component", "fp").alias("group"))
    least = nodes.groupBy("group").agg(F.min("first").alias("component_id"))
    return left_join_unique(nodes, [least], "group").select(F.col("fp").alias("fingerprint"), "group", "component_id")


def near_duplicates(
    df: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    shingle: int = SHINGLE,
    distance: int = MAX_DISTANCE,
    rows_per_key: int = ROWS_PER_KEY,
) -> DataFrame:
    """(key, fingerprint, component_id) for every row."""
    prints = stored(fingerprints(df, text, (key,), shingle), "prints")
    # a fingerprint may be that of a third of all rows
    found = left_join_unique(prints, [groups(prints, key, distance, rows_per_key)], "fingerprint")
    return found.select(as_column(key), "fingerprint", "component_id")


def one_of_each_group(
    df: DataFrame, text: str = "text", key: str = "doc_id", shingle: int = SHINGLE, distance: int = MAX_DISTANCE
) -> DataFrame:
    """The rows of ``df`` without near-duplicates: of each group the row with the smallest key stays.

    Of rows that share this key, too, one with the smallest fingerprint and text hash stays. Groups are those of
    linked fingerprints, so that texts of one key, or without one, that are not alike all stay.
    """
    named = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    key, text = (named.columns[df.columns.index(c)] for c in (key, text))
    rows = fingerprints(named, text, named.columns, shingle)
    # numbered and stored: texts are read once, and a row is known by its number from here on
    rows = stored(rows.select("*", F.xxhash64(text).alias("_hash"), F.monotonically_increasing_id().alias("_row")), "prints")
    prints = rows.select(key, "fingerprint", "_hash", "_row")
    best = left_join_unique(prints, [groups(prints, key, distance)], "fingerprint").groupBy("group")
    best = best.agg(F.min(F.struct(F.col(key).isNull(), key, "fingerprint", "_hash", "_row")).alias("best"))
    kept = rows.join(best.select("best._row"), "_row", "left_semi")
    return kept.select(*named.columns).toDF(*df.columns)
