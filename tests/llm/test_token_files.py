import zlib

import brute
import numpy as np
import pandas as pd

from ledgerloom.llm import token_files
from ledgerloom.llm.queries import QUERIES
from ledgerloom.llm.vocabulary import encoded

FOLDER = "/root/testdata/sf0.001"


def test_query(spark):
    rows = QUERIES["op10_token_files"](spark, FOLDER).toPandas().sort_values("doc_id")
    documents = pd.read_parquet(f"{FOLDER}/documents.parquet").sort_values("doc_id")
    ids = [np.append(np.frombuffer(r, "<u4"), 2).astype("<u4") for r in encoded(documents.text.tolist())]
    assert rows.doc_id.tolist() == documents.doc_id.tolist()
    assert rows.n_tokens.tolist() == [len(i) for i in ids]
    assert rows.start.tolist() == [0, *np.cumsum([len(i) for i in ids])[:-1].tolist()]
    assert rows.ids_crc32.tolist() == [zlib.crc32(i.tobytes()) for i in ids]


def test_hash_is_minimal_and_perfect():
    for n in (0, 1, 2, 63, 5000):
        first, second = token_files._hashes(range(n)) if n else (np.zeros(0, "<u8"),) * 2
        hashed = token_files.PerfectHash.build(first, second)
        assert sorted(hashed.slots(first, second).tolist()) == list(range(n))


def test_keyed_access(spark, tmp_path):
    df = brute.hard_rows(spark)
    for id_bytes in (2, 4):
        manifest = token_files.write(df, str(tmp_path / str(id_bytes)), shards=3, id_bytes=id_bytes)
        store = token_files.Store(manifest)
        for key in [*range(len(brute.TEXTS)), None]:
            texts = [r["text"] or "" for r in df.collect() if r["doc_id"] == key]
            expected = sorted([*np.frombuffer(r, "<u4").tolist(), 2] for r in encoded(texts))
            assert sorted(found.tolist() for found in store.get(key)) == expected
        assert all(store.get(key) == [] for key in (-1, 77, 10**12))
        assert token_files.read(manifest).count() == df.count()


def test_unknown_keys_are_turned_away(spark, tmp_path):
    df = spark.range(2000).selectExpr("id * 2 AS doc_id", "concat('text ', id) AS text")
    row = token_files.write(df, str(tmp_path), shards=1).first()
    shard = token_files.Shard(row["payload"], row["index"])
    assert all(len(r) == 1 for r in shard.find(range(0, 4000, 2)))
    assert not any(len(r) for r in shard.find(range(1, 4000, 2)))


def test_no_rows(spark, tmp_path):
    manifest = token_files.write(brute.no_rows(spark), str(tmp_path), shards=2)
    assert manifest.count() == 0 and token_files.read(manifest).count() == 0 and token_files.Store(manifest).get(1) == []


def test_ids_that_do_not_fit(spark, tmp_path):
    from pyspark.errors import PySparkException
    import pytest

    with pytest.raises(PySparkException, match="does not fit"):
        token_files.write(brute.hard_rows(spark), str(tmp_path), shards=1, id_bytes=1).count()


def test_ranges_roll_over_to_further_shards(spark, tmp_path):
    df = spark.range(300).selectExpr("id % 290 AS doc_id", "concat('text ', id, ' of ', id % 7) AS text")
    whole = token_files.write(df, str(tmp_path / "one"), shards=2)
    rolled = token_files.write(df, str(tmp_path / "many"), shards=2, shard_ids=100)
    assert whole.count() == 2 and rolled.count() > 10
    rows = [sorted((r["doc_id"], r["start"], bytes(r["ids"])) for r in token_files.read(m).collect()) for m in (whole, rolled)]
    assert rows[0] == rows[1] and len(rows[0]) == 300
    assert [len(token_files.Store(rolled).get(k)) for k in (0, 9, 10, 289, 300)] == [2, 2, 1, 1, 0]


def test_side_by_side_records_are_read_together(spark, tmp_path, monkeypatch):
    df = spark.range(500).selectExpr("id AS doc_id", "repeat(concat('w', id, ' '), int(id % 5)) AS text")
    row = token_files.write(df, str(tmp_path), shards=1).first()
    shard = token_files.Shard(row["payload"], row["index"])
    plain = [shard.ids(i).tolist() for i in range(500)]
    for most in (1, 40, 1 << 20):
        monkeypatch.setattr(token_files, "READ_BYTES", most)
        some = [*range(0, 400), 450, 451, 7, 8, 9]
        assert [ids.tolist() for ids in shard.several(some)] == [plain[i] for i in some]
