"""Hierarchical multi-length packing of documents into training sequences.

A document's ids are cut into windows of the longest tier; what remains of it is
routed to the shortest tier that holds it. Tiers are packed from the longest
down: the largest remaining piece opens a window of its tier, and the gap is
filled with the largest pieces that fit, or, when none fits, with a part cut off
the shortest piece. So windows are full; the last pieces of a task, less than one
window, are cut into powers of two. Finally the sequences of a block are dealt
out to step groups with nearly the same number of sequences of each tier and the
same attention cost.

Every task packs its own rows, block by block, without a shuffle; it holds one
block of ids. Token ids come from a public tokenizer, followed by an end id.

NULL and empty texts are documents of the end id alone. Equal lengths are taken
in the order of the rows; repeated rows and repeated or NULL ids are packed like
any other row; an empty table gives no sequence; columns not asked for are not read.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql.types import StructField, StructType, _parse_datatype_string
from pyspark.sql.pandas.types import to_arrow_type

from ledgerloom.functions.columns import as_column
from ledgerloom.llm.common import giving_back, pieces, texts_of
from ledgerloom.llm.vocabulary import BYTE_BPE, REMEMBERED_WORDS, TEXTS_AT_ONCE, encoded

TIERS = (2048, 1024, 512, 256)
END_ID = 1
# Tokens packed at a time; bounds a task's memory and how far a piece may move.
BLOCK_TOKENS = 1 << 20
# Tokens of a training step, the unit that is balanced.
STEP_TOKENS = 16 * 2048
# Sequence and step numbers: partition number times this, plus a count.
NUMBERS_PER_TASK = 1 << 33

FIELDS = (
    "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
    "tier int, step_id long"
)

# A piece is (length, order, document, start); a window is (tier, pieces).
Piece = tuple[int, int, int, int]
Window = tuple[int, list[Piece]]


def pack_block(lengths: Sequence[tuple[int, int]], tiers: Sequence[int], carried: list[Piece]) -> tuple[list[Window], list[Piece]]:
    """Full windows of the documents (number, length), and the pieces of the window that could not be filled."""
    longest, shortest_first = max(tiers), sorted(tiers)
    windows: list[Window] = []
    pool = list(carried)
    for document, n in lengths:
        full = n - n % longest
        windows += [(longest, [(longest, 0, document, start)]) for start in range(0, full, longest)]
        if n > full:
            pool.append((n - full, -len(pool), document, full))
    pool.sort()
    while pool:
        seed = pool.pop()
        tier = next(t for t in shortest_first if t >= seed[0])
        held, gap = [seed], tier - seed[0]
        while gap and pool:
            at = bisect_right(pool, (gap, 1, 0, 0)) - 1
            if at >= 0:
                piece = pool.pop(at)
            else:
                length, order, document, start = pool.pop(0)
                piece = (gap, order, document, start)
                insort(pool, (length - gap, order, document, start + gap))
            held.append(piece)
            gap -= piece[0]
        if gap:
            return windows, held
        windows.append((tier, held))
    return windows, []


def in_powers_of_two(held: list[Piece]) -> list[Window]:
    """The last pieces of a task as sequences whose lengths are powers of two."""
    windows, left = [], sum(p[0] for p in held)
    held = list(held)
    while left:
        size = 1 << left.bit_length() - 1
        taken, need = [], size
        while need:
            length, order, document, start = held.pop(0)
            n = min(length, need)
            taken.append((n, order, document, start))
            if n < length:
                held.insert(0, (length - n, order, document, start + n))
            need -= n
        windows.append((size, taken))
        left -= size
    return windows


def step_groups(windows: list[Window], step_tokens: int) -> list[int]:
    """A group for each window: dealt out back and forth, longest tier and highest cost first."""
    groups = max(1, -(-sum(tier for tier, _ in windows) // step_tokens))
    cost = [(-tier, -sum(p[0] ** 2 for p in held)) for tier, held in windows]
    found = [0] * len(windows)
    for place, i in enumerate(sorted(range(len(windows)), key=cost.__getitem__)):
        lap, step = divmod(place, groups)
        found[i] = groups - 1 - step if lap % 2 else step
    return found


def pack(
    df: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    path: str = BYTE_BPE,
    end_id: int = END_ID,
    tiers: Sequence[int] = TIERS,
    step_tokens: int = STEP_TOKENS,
    with_ids: bool = False,
    words: int = REMEMBERED_WORDS,
) -> DataFrame:
    """One row per piece: where it lies in its document, in which sequence and where there.

    ``tier`` is the length of the sequence, ``step_id`` its step group. ``with_ids`` adds
    ``ids``, the piece's ids as little-endian unsigned 32-bit integers. ``words`` bounds the memory of words.
    """
    tiers = tuple(tiers)
    if any(t & (t - 1) or t < 1 for t in tiers):
        raise ValueError("tiers must be powers of two")
    added = _parse_datatype_string(FIELDS + (", ids binary" if with_ids else ""))
    key_type = df.schema[key].dataType
    schema = StructType([StructField("_key", key_type), *added.fields])
    arrow_schema = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in schema])
    end = np.array([end_id], "<u4").tobytes()

    def rows(windows: list[Window], keys: list, ids: dict[int, bytes], numbers: list[int]) -> pa.RecordBatch:
        out = []
        groups = step_groups(windows, step_tokens)
        for group, (tier, held) in zip(groups, windows):
            offset = 0
            for length, _, document, start in held:
                raw = ids[document][4 * start : 4 * (start + length)]
                row = (keys[document], start, length, zlib.crc32(raw), len(ids[document]) // 4)
                out.append((*row, numbers[0], offset, tier, numbers[1] + group, *([raw] if with_ids else [])))
                offset += length
            numbers[0] += 1
        numbers[1] += max(groups, default=-1) + 1
        columns = list(zip(*out)) or [()] * len(arrow_schema)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow_schema)], schema=arrow_schema)

    def run(batches) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() * NUMBERS_PER_TASK
        numbers = [first, first]
        keys: dict[int, object] = {}
        ids: dict[int, bytes] = {}
        waiting: list[tuple[int, int]] = []
        held: list[Piece] = []
        tokens = document = 0

        def emptied(last: bool) -> pa.RecordBatch:
            nonlocal tokens, held
            windows, held = pack_block(waiting, tiers, held)
            if last:
                windows, held = windows + in_powers_of_two(held), []
            out = rows(windows, keys, ids, numbers)
            waiting.clear()
            tokens = 0
            for done in ids.keys() - {p[2] for p in held}:
                del ids[done], keys[done]
            return out

        for part in pieces(batches, TEXTS_AT_ONCE):
            for one, raw in zip(part.column(0).to_pylist(), encoded(texts_of(part.column(1)), path, words)):
                keys[document], ids[document] = one, raw + end
                waiting.append((document, len(raw) // 4 + 1))
                tokens += len(raw) // 4 + 1
                document += 1
            if tokens >= BLOCK_TOKENS:
                yield emptied(last=False)
        yield emptied(last=True)

    chosen = df.select(as_column(key).alias("_key"), as_column(text).cast("string").alias("_text"))
    return chosen.mapInArrow(giving_back(run), schema).toDF(key, *added.names)
