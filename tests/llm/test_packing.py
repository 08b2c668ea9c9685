import random
import zlib

import brute
import numpy as np
import pandas as pd

from ledgerloom.llm import packing
from ledgerloom.llm.common import giving_back
from ledgerloom.llm.queries import QUERIES
from ledgerloom.llm.vocabulary import encoded

FOLDER = "/root/testdata/sf0.001"


def check(rows, ids):
    """Every id once, sequences without gaps, lengths as the tiers say."""
    for doc_id, group in rows.groupby("doc_id"):
        assert brute.consecutive(zip(group.start, group.length))
        assert group.length.sum() == len(ids[doc_id]) and (group.doc_tokens == len(ids[doc_id])).all()
    for r in rows.itertuples():
        assert r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes())
    for _, group in rows.groupby("sequence_id"):
        assert brute.consecutive(zip(group.offset, group.length)) and group.offset.min() == 0
        assert group.length.sum() == group.tier.iloc[0] and group.tier.nunique() == 1


def test_query(spark):
    rows = QUERIES["op6_hierarchical_packing"](spark, FOLDER).toPandas()
    documents = pd.read_parquet(f"{FOLDER}/documents.parquet")
    raw = [np.append(np.frombuffer(r, "<u4"), 1).astype("<u4") for r in encoded(documents.text.tolist())]
    check(rows, dict(zip(documents.doc_id, raw)))
    assert rows.tier.max() == 2048 and set(rows.doc_id) == set(documents.doc_id)


def test_blocks_are_full_whatever_the_lengths():
    draw = random.Random(2)
    for _ in range(100):
        lengths = [(i, draw.choice([1, 2, 7, 16, 17, 31, 32, 33, 100])) for i in range(draw.randint(0, 30))]
        windows, held = packing.pack_block(lengths, (32, 16, 8), [])
        assert all(sum(p[0] for p in pieces) == tier for tier, pieces in windows)
        tail = packing.in_powers_of_two(held)
        assert all(sum(p[0] for p in pieces) == size == 1 << size.bit_length() - 1 for size, pieces in tail)
        for document, n in lengths:
            own = [(p[3], p[0]) for _, pieces in windows + tail for p in pieces if p[2] == document]
            assert brute.consecutive(own) and sum(size for _, size in own) == n


def test_short_pieces_fill_long_windows():
    windows, held = packing.pack_block([(0, 30), (1, 2), (2, 9), (3, 7)], (32, 16), [])
    assert not held and [(tier, [p[2] for p in pieces]) for tier, pieces in windows] == [(32, [0, 1]), (16, [2, 3])]


def test_steps_are_balanced():
    draw = random.Random(4)
    windows = [(t, [(t, 0, 0, 0)]) for t in [draw.choice([2048, 1024]) for _ in range(400)]]
    groups = packing.step_groups(windows, 16 * 2048)
    tokens = np.bincount(groups, [t for t, _ in windows])
    assert tokens.max() - tokens.min() <= 2048


def test_hard_rows(spark):
    rows = packing.pack(brute.hard_rows(spark), with_ids=True).toPandas()
    assert rows.length.sum() == sum(len(r) // 4 + 1 for r in encoded([t or "" for t in brute.TEXTS] + ["The end.", "no id", ""]))
    assert rows.doc_id.isna().sum() == 2
    assert (rows.ids.map(len) == 4 * rows.length).all()
    assert packing.pack(brute.no_rows(spark)).count() == 0


def _held_mb() -> int:
    return next(int(line.split()[1]) for line in open("/proc/self/status") if line.startswith("RssAnon")) >> 10


def test_freed_memory_is_given_back():
    """128 MB in blocks that the allocator keeps when they are freed, because a later one stays."""
    stays = []

    def run(batches):
        blocks = [np.ones(8_000) for _ in range(2_000)]
        stays.append(np.ones(8_000))
        yield len(blocks)

    before = _held_mb()
    assert list(giving_back(run)([])) == [2_000]
    assert _held_mb() - before < 60


def test_packing_gives_memory_back(spark, monkeypatch):
    wrapped = []
    monkeypatch.setattr(packing, "giving_back", lambda run: wrapped.append(run) or run)
    assert packing.pack(spark.createDataFrame([(1, "some words")], "doc_id long, text string")).count() and len(wrapped) == 1
