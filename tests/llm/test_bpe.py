import hashlib
import random

import brute
import pandas as pd
import public_tokenizers
import pytest
import tiktoken

from ledgerloom.llm import bpe
from ledgerloom.llm.queries import QUERIES
from ledgerloom.llm.vocabulary import WordCache, encoded

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def reference():
    ranks = {token: rank for rank, token in enumerate(bpe.read_ranks(bpe.RANKS))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def odd_texts():
    draw = random.Random(1)
    return [t or "" for t in brute.TEXTS] + ["".join(draw.choice("ab  \n\t'sé🎉1!?\x1c　") for _ in range(40)) for _ in range(400)]


def test_ids_and_round_trip(reference):
    texts = odd_texts()
    found = bpe.codec().encode(texts)
    assert [ids.tolist() for ids in found] == [reference.encode_ordinary(t) for t in texts]
    assert [bpe.codec().decode(ids.tolist()).decode() for ids in found] == texts


def test_tokenizer_ids_are_the_same(reference):
    found = [list(memoryview(raw).cast("I")) for raw in encoded(odd_texts())]
    assert found == [reference.encode_ordinary(t) for t in odd_texts()]


def test_small_cache_changes_nothing(reference):
    codec = bpe.codec()
    cache = WordCache(codec._encode, codec.words.lengths, most=0)
    texts = ["one two one", "two three", "one"]
    expected = [bytes().join(i.to_bytes(4, "little") for i in reference.encode_ordinary(t)) for t in texts]
    assert cache.values_of(texts) == expected and cache.values_of(texts) == expected and not cache


def test_other_vocabulary():
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    codec = bpe.codec(path, public_tokenizers.PATTERN)
    ranks = {token: rank for rank, token in enumerate(codec.tokens)}
    other = tiktoken.Encoding("other", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = odd_texts()[:60]
    assert [ids.tolist() for ids in codec.encode(texts)] == [other.encode_ordinary(t) for t in texts]


def test_query(spark, reference):
    rows = QUERIES["op2_bpe_codec"](spark, FOLDER).toPandas().set_index("doc_id")
    documents = pd.read_parquet(f"{FOLDER}/documents.parquet").set_index("doc_id")
    assert len(rows) == len(documents)
    for doc_id, text in documents.text.items():
        ids, row = reference.encode_ordinary(text), rows.loc[doc_id]
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_hard_rows(spark):
    ids = bpe.encode(brute.hard_rows(spark), keep=("doc_id", "kept"))
    back = bpe.decode(ids, keep=("doc_id", "ids")).collect()
    assert sorted((bytes(r["decoded"]).decode() for r in back)) == sorted([t or "" for t in brute.TEXTS] + ["The end.", "no id", ""])
    assert bpe.decode(bpe.encode(brute.no_rows(spark))).count() == 0
