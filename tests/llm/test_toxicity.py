import random

import brute
import pandas as pd
from pyspark.sql import functions as F

from ledgerloom.llm import toxicity
from ledgerloom.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"


def test_segments_against_definition():
    draw = random.Random(3)
    for _ in range(300):
        n = draw.randint(0, 25)
        hits = sorted((i, draw.uniform(-1, 3)) for i in draw.sample(range(n), draw.randint(0, n)))
        full = [-0.4] * n
        for i, s in hits:
            full[i] += s
        found = toxicity.maximal_segments(hits, 0.4)
        assert [(i, j) for i, j, _ in found] == brute.maximal_segments(full)
        assert all(abs(s - sum(full[i:j])) < 1e-9 for i, j, s in found)


def test_words_no_chance_puts_in_toxic_texts():
    counts = {"vile": (200, 1), "the": (1000, 5000), "odd": (1, 0), "": (10_000, 50_000)}
    found = dict(toxicity.word_scores(counts))
    assert found["vile"] > 3 and "odd" not in found and "" not in found


def test_held_out_accuracy(spark):
    rows = QUERIES["op8_max_segment_toxicity"](spark, FOLDER).toPandas()
    labels = pd.read_parquet(f"{FOLDER}/labels.parquet").merge(rows[rows.held_out], on="doc_id")
    assert len(rows) == len(pd.read_parquet(f"{FOLDER}/documents.parquet"))
    assert (labels.predicted == labels.toxic).mean() > 0.95
    assert rows.score.between(0, 1).all() and (rows.predicted == (rows.score >= 0.5)).all()


def test_hard_rows(spark):
    rows = brute.hard_rows(spark)
    labels = spark.createDataFrame([(5, 1), (5, 0), (4, 0), (None, 1), (7, None)], "doc_id long, toxic int")
    model = toxicity.train(rows, labels)
    assert toxicity.score(rows, model).count() == rows.count()
    assert toxicity.score(rows, toxicity.train(rows, labels.filter("false"))).agg(F.max("score")).first()[0] < 0.5
    assert toxicity.score(brute.no_rows(spark), toxicity.train(brute.no_rows(spark), labels)).count() == 0


def test_every_passage_is_found():
    """Two passages with the same words, and one at the end of a long text in which its words stand scattered before."""
    vile = [f"vile{c}" for c in "abcdefgh"]
    model = toxicity.Model(tuple((word, 3.0) for word in vile), decay=1.2, k=0.006)
    plain = [f"plain{i % 97}" for i in range(400)]
    twice = model.significant([*plain, *vile, *plain, *vile, *plain])
    assert [(start, stop) for start, stop, _ in twice] == [(400, 408), (808, 816)]
    scattered = [word for v in vile for word in (v, *plain)]
    late = model.significant([*scattered, *plain * 10, *vile])
    n = len(scattered) + 4000
    assert [(start, stop) for start, stop, _ in late] == [(n, n + 8)]
    # the same word over and over is no evidence
    assert model.significant([*plain, *["vilea"] * 40, *plain]) == []
