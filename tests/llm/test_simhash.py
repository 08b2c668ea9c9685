import random

import brute
import numpy as np
import pandas as pd
import pytest
import xxhash
from pyspark.sql import functions as F

from ledgerloom.llm import simhash
from ledgerloom.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def plain_fingerprint(text):
    words = text.encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def close(prints, distance):
    a = np.array(prints, np.uint64)
    return [(i, int(j)) for i in range(len(a)) for j in np.nonzero(np.bitwise_count(a ^ a[i]) <= distance)[0]]


def test_query(spark):
    rows = QUERIES["op7_simhash_deletion_variants"](spark, FOLDER).toPandas().sort_values("doc_id")
    documents = pd.read_parquet(f"{FOLDER}/documents.parquet").sort_values("doc_id")
    prints = [plain_fingerprint(t) for t in documents.text]
    assert rows.fingerprint.tolist() == [f"{p:016x}" for p in prints]
    ids = documents.doc_id.tolist()
    assert rows.component_id.tolist() == [ids[i] for i in brute.components(len(ids), close(prints, 3))]


@pytest.mark.parametrize("distance,rows_per_key", [(3, 128), (3, 4), (2, 4), (1, 4), (0, 4), (5, 128)])
def test_links_against_all_pairs(spark, distance, rows_per_key):
    """Also with so few rows per key that keys are refined down to the last level."""
    draw = random.Random(distance)
    centres = [draw.getrandbits(64) for _ in range(4)]
    prints = {c ^ sum(1 << draw.randrange(64) for _ in range(draw.randint(0, 4))) & (1 << 64) - 1 for c in centres for _ in range(8)}
    signed = [p - (1 << 64) if p >> 63 else p for p in sorted(prints)]
    df = spark.createDataFrame([(p,) for p in signed], "fp long")
    found = {tuple(sorted(r)) for r in simhash.links(df, distance, rows_per_key).collect()}
    expected = {tuple(sorted((signed[i], signed[j]))) for i, j in close(sorted(prints), distance) if i != j}
    assert found == expected


def test_hard_rows(spark):
    rows = simhash.near_duplicates(brute.hard_rows(spark)).collect()
    groups = {}
    for r in rows:
        groups.setdefault(r["fingerprint"], set()).add(r["component_id"])
    assert len(rows) == brute.hard_rows(spark).count() and all(len(g) == 1 for g in groups.values())
    assert groups[0] == {0}
    assert simhash.near_duplicates(brute.no_rows(spark)).count() == 0


def test_one_row_of_each_group_stays(spark):
    df = brute.hard_rows(spark)
    kept = simhash.one_of_each_group(df)
    assert kept.columns == df.columns
    assert kept.count() == simhash.near_duplicates(df).select("component_id", "fingerprint").distinct().count()
    assert kept.filter(F.col("text") == "The end.").select("doc_id").collect() == [(5,)]


def test_groups_without_or_with_the_same_key_stay_apart(spark):
    """Unlike texts with NULL ids, or that share one id, are no near-duplicates."""
    apart = [" ".join(f"{word}{i}" for i in range(40)) for word in ("north", "vela", "quartz", "umbra", "piano")]
    rows = [(None, apart[0]), (None, apart[1]), (None, apart[2]), (None, apart[2]), (4, apart[3]), (4, apart[4]), (5, apart[4])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [(r["doc_id"], r["text"]) for r in simhash.one_of_each_group(df).collect()]
    assert sorted(kept, key=str) == sorted([(None, apart[0]), (None, apart[1]), (None, apart[2]), (4, apart[3]), (4, apart[4])], key=str)


def test_copies_cost_nothing(spark):
    """Fingerprints are indexed once, however many rows have them."""
    df = spark.range(3000).selectExpr("id AS doc_id", "if(id % 3 = 0, 'the very same text again', concat('text ', id)) AS text")
    rows = simhash.near_duplicates(df)
    assert rows.filter("component_id = 0").count() >= 1000 and rows.count() == 3000
