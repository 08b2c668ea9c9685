import random
import re

import brute
import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import functions as F

from ledgerloom.llm import bpe, token_counts

COUNTS = token_counts.counts_of(bpe.RANKS, public_tokenizers.PATTERN)


def plain(text):
    return sum(COUNTS.codec.sizes(COUNTS.split(text)))


def test_edits_against_counting_anew():
    draw = random.Random(5)
    letters = "ab  \n\n'srte12!?é 🎉\t"
    for _ in range(500):
        text = "".join(draw.choice(letters) for _ in range(draw.randint(0, 300)))
        split = COUNTS.split(text)
        COUNTS.learn(split)
        sizes = np.array([len(p) for p in split], np.int64)
        tree = token_counts.Tree.build(sizes, COUNTS.of(split), draw.choice([1, 2, 16]))
        for _ in range(4):
            start = draw.randint(0, len(text))
            stop = min(len(text), start + draw.choice([0, 0, 1, 2, 10]))
            new = "".join(draw.choice(letters) for _ in range(draw.choice([0, 0, 1, 3, 40])))
            expected = text[:start] + new + text[stop:]
            text, _ = token_counts.edit(text, tree, start, stop, new, COUNTS)
            assert text == expected and tree.tokens == plain(text) and tree.characters == len(text)


def test_only_the_surroundings_are_encoded_again():
    text = "some words " * 5000
    split = COUNTS.split(text)
    COUNTS.learn(split)
    tree = token_counts.Tree.build(np.array([len(p) for p in split]), COUNTS.of(split))
    _, again = token_counts.edit(text, tree, 30_000, 30_004, "other", COUNTS)
    assert again < 500


def test_tidy():
    edits = [{"start": 5, "stop": 9, "replacement": None}, {"start": 2, "stop": 6, "replacement": "x"}, {"start": 50, "stop": 60, "replacement": "y"}, None]
    assert token_counts.tidy(edits, 10) == [(2, 6, "x"), (6, 9, ""), (10, 10, "y")]
    assert token_counts.tidy(None, 10) == []


def _applied(monkeypatch, texts, edits):
    """What ``apply_edits`` gives for a batch of rows, and how many times pre-tokens were handed to the encoder."""
    monkeypatch.setattr(token_counts, "map_rows", lambda df, inputs, keep, fields, run: run)
    trees = []
    for text in texts:
        split = COUNTS.split(text)
        COUNTS.learn(split)
        trees.append(token_counts.Tree.build(np.array([len(p) for p in split], np.int64), COUNTS.of(split)).dump())
    given = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("replacement", pa.string())]))
    rows = pa.RecordBatch.from_arrays([pa.array(texts), pa.array(trees, pa.binary()), pa.array(edits, given)], ["_0", "_1", "_2"])
    calls, sizes = [], COUNTS.codec.sizes
    monkeypatch.setattr(COUNTS.codec, "sizes", lambda new: calls.append(len(new)) or sizes(new))
    after = token_counts.apply_edits(None, F.lit(None))(rows)
    monkeypatch.undo()
    return after, len(calls)


def _many_edits(name):
    """Every number of every text is replaced by a word that no other edit has."""
    texts = [f"text {i} has some words, 10 or 20 of them, and ends {i}." * 5 for i in range(40)]
    return texts, [
        [{"start": m.start(), "stop": m.end(), "replacement": f"{name}{chr(97 + i % 26)}{i // 26 * 'x'}{chr(97 + k)}"} for k, m in enumerate(re.finditer("[0-9]+", text))]
        for i, text in enumerate(texts)
    ]


def _replaced(text, edits):
    for e in reversed(edits):
        text = text[: e["start"]] + e["replacement"] + text[e["stop"] :]
    return text


def test_the_edits_of_a_batch_are_counted_in_one_call(spark, monkeypatch):
    texts, edits = _many_edits("once")
    after, calls = _applied(monkeypatch, texts, edits)
    assert calls == 1
    assert list(after[0]) == [_replaced(*both) for both in zip(texts, edits)] and list(after[2]) == [plain(t) for t in after[0]]


def test_waiting_pre_tokens_are_bounded(spark, monkeypatch):
    texts, edits = _many_edits("bounded")
    monkeypatch.setattr(token_counts, "COUNTED_AT_ONCE", 300)
    after, calls = _applied(monkeypatch, texts, edits)
    assert 1 < calls < sum(map(len, edits))
    assert list(after[0]) == [_replaced(*both) for both in zip(texts, edits)] and list(after[2]) == [plain(t) for t in after[0]]


def test_hard_rows(spark):
    rows = brute.hard_rows(spark)
    state = token_counts.build(rows, keep=("doc_id", "n_ids"))
    edits = spark.createDataFrame(
        [(0, 0, 0, "new"), (5, 0, 3, "A"), (5, 4, 4, None), (7, 9, 14, "edited"), (99, 0, 0, "nobody")],
        "doc_id long, start int, stop int, replacement string",
    )
    after = token_counts.apply_edits(state.join(token_counts.gathered(edits), "doc_id", "left"), keep=("doc_id", "n_ids"))
    found = after.collect()
    assert len(found) == rows.count() and all(r["n_tokens"] == plain(r["text"]) for r in found)
    texts = {r["doc_id"]: r["text"] for r in found}
    assert texts[0] == "new" and texts[5] == "A end." and texts[7][:20] == "word word" + "edited" + brute.LONG[14:19]
    again = token_counts.apply_edits(after, F.lit(None)).collect()
    assert sorted(r["n_tokens"] for r in again) == sorted(r["n_tokens"] for r in found)
    assert token_counts.build(brute.no_rows(spark)).count() == 0


def test_query(spark):
    from ledgerloom.llm.queries import QUERIES
    import pandas as pd
    import re

    folder = "/root/testdata/sf0.001"
    rows = QUERIES["op3_edit_token_counts"](spark, folder).toPandas().set_index("doc_id")
    documents = pd.read_parquet(f"{folder}/documents.parquet")
    for r in documents.itertuples():
        edited = f"source: {r.source}\n" + re.sub("[0-9]+", "0", r.text) + "\n"
        assert tuple(rows.loc[r.doc_id][["n_tokens_before", "n_tokens", "n_chars"]]) == (plain(r.text), plain(edited), len(edited))
