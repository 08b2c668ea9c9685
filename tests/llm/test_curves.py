import itertools

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import curves
from ledgerloom.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"


def nearest(ids, vectors, queries, k):
    """query id -> [(distance, id)] of the k nearest."""
    out = {}
    for q, v in zip(ids, vectors):
        if q in queries:
            apart = np.sqrt(((vectors - v) ** 2).sum(axis=1))
            out[q] = sorted((d, i) for d, i in zip(apart.tolist(), ids) if i != q)[:k]
    return out


def found_in(rows):
    found = {}
    for r in rows:
        found.setdefault(r["query_id"], []).append((r["rank"], r["score"], r["vec_id"]))
    return {q: sorted(v) for q, v in found.items()}


def test_query(spark):
    rows = QUERIES["op13_shifted_curves"](spark, FOLDER)
    assert rows.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "double")]
    table = pd.read_parquet(f"{FOLDER}/embeddings.parquet")
    vectors = np.stack(table.embedding).astype(float)
    true = nearest(table.vec_id.tolist(), vectors, set(range(0, 10**6, 100)), 10)
    found = found_in(rows.collect())
    assert found.keys() == true.keys()
    at = dict(zip(table.vec_id.tolist(), vectors))
    hits = 0
    for q, listed in found.items():
        assert [r for r, _, _ in listed] == list(range(1, 11))
        assert [(s, i) for _, s, i in listed] == sorted((s, i) for _, s, i in listed)
        for _, score, i in listed:
            assert score == pytest.approx(np.sqrt(((at[i] - at[q]) ** 2).sum()), rel=1e-12)
        hits += len({i for _, _, i in listed} & {i for _, i in true[q]})
    assert hits >= 0.9 * 10 * len(true)


def test_hilbert_visits_every_cell_by_neighbours():
    for dimensions, bits in ((1, 4), (2, 4), (3, 3), (4, 2)):
        cells = np.array(list(itertools.product(range(1 << bits), repeat=dimensions)))
        place = curves.hilbert(cells, bits)
        assert sorted(place.tolist()) == list(range(len(cells)))
        way = cells[np.argsort(place)]
        assert (np.abs(np.diff(way, axis=0)).sum(axis=1) == 1).all()


def test_recall_in_narrow_windows(spark):
    """Vectors near a surface of few dimensions need windows far smaller than the table; the audit is by 40 queries only."""
    draw = np.random.default_rng(3)
    plane = draw.normal(size=(3, 48))
    vectors = draw.normal(size=(6000, 3)) @ plane + 0.01 * draw.normal(size=(6000, 48))
    df = spark.createDataFrame(list(enumerate(vectors.tolist())), "vec_id long, embedding array<double>")
    points = curves.points_of(df, "embedding", "vec_id", curves.every("vec_id", 50), 10)
    places = curves.ranked(points, curves.ORDERS, curves.SAMPLE).cache()
    true = curves.by_brute_force(points, points.filter("query"), 10)
    assert curves.window_of(places, true, curves.AIM) < 300
    found = found_in(curves.search(df, curves.every("vec_id", 50), audited=40).collect())
    expected = nearest(list(range(6000)), vectors, set(range(0, 6000, 50)), 10)
    hits = [len({i for _, _, i in found[q]} & {i for _, i in e}) for q, e in expected.items()]
    assert sum(hits) >= 9 * len(expected)


def test_copies_and_ties(spark):
    """A third of all rows are copies: every query gets the smallest ids of them, and nothing else suffers."""
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(1000, 1400)] + [(i, [float(i), 0.0, 0.0]) for i in range(1, 60)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = found_in(curves.search(df, curves.every("vec_id", 100)).collect())
    assert {q: [i for _, _, i in v] for q, v in found.items()}[1000] == list(range(1001, 1011))
    assert all(s == 0 for _, s, _ in found[1300]) and [i for _, _, i in found[1300]] == list(range(1000, 1010))


def test_hard_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0], 1), (0, [1.0, 0.0], 1), (1, [2.0, 0.0], 1), (1, [2.0, 0.0], 2), (2, [0.0, 0.0], 1), (3, [nan, 1.0], 1), (4, [inf, 1.0], 1),
        (5, None, 1), (6, [None, 1.0], 1), (7, [], 1), (8, [1.0, 1.0, 1.0], 1), (None, [1.0, 1.0], 1), (10, [0.0, 5.0], 1), (20, [1.0, 1.0, 4.0], 1), (30, [7.0], 1),
        (11, [1e300, -1e300], 1), (10, [3.0, 0.0], 1),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, query_id int")
    found = curves.search(df.withColumn("rank", F.lit(1)), curves.every("vec_id", 10)).collect()
    listed = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in found if r["query_id"] != 10)
    far = 1e300 * 2**0.5
    assert [(q, r, i) for q, r, i, _ in listed] == [
        (0, 1, 1), (0, 2, None), (0, 3, 10), (0, 4, 10), (0, 5, 11), (20, 1, 8),
    ]
    assert [s for *_, s in listed] == pytest.approx([1, 1, 2, 26**0.5, far, 3])
    assert sorted(r["vec_id"] for r in found if r["query_id"] == 10 and r["vec_id"] is not None) == [0, 0, 1, 1, 11, 11]
    none = curves.search(df.filter("false"), curves.every("vec_id", 10))
    assert none.columns == ["query_id", "rank", "vec_id", "score"] and none.count() == 0
    assert curves.search(df.filter("vec_id = 1"), curves.every("vec_id", 10)).count() == 0
