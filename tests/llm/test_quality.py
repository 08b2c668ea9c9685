import brute
import numpy as np
import pandas as pd

from ledgerloom.llm import quality
from ledgerloom.llm.common import small_batches
from ledgerloom.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"


def test_query(spark):
    rows = QUERIES["op1_quality_isolation_forest"](spark, FOLDER).toPandas().set_index("doc_id")
    documents = pd.read_parquet(f"{FOLDER}/documents.parquet").set_index("doc_id")
    columns = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    for doc_id, text in documents.text.items():
        row, expected = rows.loc[doc_id], brute.rule_statistics(text)
        assert tuple(row[columns]) == expected
        assert row.base_failed == (expected[0] < 50 or 100 * expected[4] > 50 * expected[0])
    assert not (rows.base_failed & rows.kept).any()
    marked = pd.read_parquet(f"{FOLDER}/labels.parquet").join(rows, on="doc_id")
    fine = marked[~marked.base_failed]
    assert fine[fine.quality == 1].kept.mean() >= 1 - quality.FALSE_REJECTS
    assert fine[fine.quality == 0].kept.mean() < 0.6


def test_statistics_of_odd_texts():
    for text in [t or "" for t in brute.TEXTS] + ["a b c a b c a b", "x\nx\n \n \nx y", "a a a", "a a a a", "é* é* é* é*\n<|>"]:
        assert quality.statistics(text)[:5] == brute.rule_statistics(text)


def test_forest_isolates_the_odd_one():
    sample = np.random.default_rng(0).normal(size=(2000, 3))
    forest = quality.Forest(sample, trees=50, rows=128)
    scores = forest.scores(np.array([[0, 0, 0], [6, 6, 6]]))
    assert scores[0] < 0.5 < scores[1]


def test_threshold_spares_good_rows(spark):
    scores = spark.createDataFrame([(i, i / 1000) for i in range(1000)], "doc_id long, score double")
    labels = spark.createDataFrame([(i, int(i < 950)) for i in range(1000)], "doc_id long, quality int")
    limit = quality.threshold(scores, labels, "doc_id", "quality", false_rejects=0.01)
    good = scores.filter(f"score >= {limit}").join(labels, "doc_id").filter("quality = 1").count()
    assert good <= 0.01 * 950 and 0.93 < limit < 0.96


def test_hard_rows(spark):
    rows = brute.hard_rows(spark)
    labels = spark.createDataFrame([(5, 1), (7, 0), (7, 1), (4, None), (None, 0)], "doc_id long, quality int")
    for some in (labels, labels.filter("false")):
        found = quality.judge(rows, some)
        assert found.count() == rows.count() and found.filter("kept").count() == 0
        kept = quality.keep_good(rows, some)
        assert kept.columns == rows.columns and kept.count() == 0
    assert quality.judge(brute.no_rows(spark), labels).count() == 0
    assert quality.keep_good(brute.no_rows(spark), labels).count() == 0


def test_rows_kept_are_the_rows_judged_good(spark):
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    judged = {r["doc_id"] for r in quality.judge(documents, labels).filter("kept").select("doc_id").collect()}
    assert {r["doc_id"] for r in quality.keep_good(documents, labels).select("doc_id").collect()} == judged


def with_menus(documents, labels):
    """Good documents with a menu, and with rows of numbers, behind their text; no fixed rule rejects them."""
    draw = np.random.default_rng(4)
    good = documents.merge(labels[labels.quality == 1], on="doc_id")
    good = good[good.text.str.split().str.len().between(200, 400)].head(10)
    every = sorted(set(" ".join(good.text).split()))
    made = []
    for i, text in enumerate(good.text):
        entries = [f"{a} {b}" for a, b in zip(draw.choice(every, 60), draw.choice(every, 60))]
        made.append((-1 - i, text + "\n" + "\n".join(draw.choice(entries, 300))))
    return made


def test_menus_go_and_labelled_bad_documents_too(spark):
    documents = pd.read_parquet(f"{FOLDER}/documents.parquet")
    labels = pd.read_parquet(f"{FOLDER}/labels.parquet")
    menus = with_menus(documents, labels)
    df = spark.createDataFrame([*zip(documents.doc_id.tolist(), documents.text.tolist()), *menus], "doc_id long, text string")
    rows = quality.judge(df, spark.read.parquet(f"{FOLDER}/labels.parquet")).toPandas().set_index("doc_id")
    made = rows.loc[[i for i, _ in menus]]
    assert not made.base_failed.any() and not made.kept.any()
    fine = labels.join(rows, on="doc_id")
    fine = fine[~fine.base_failed]
    assert (~fine[fine.quality == 0].kept).mean() >= 0.95
    assert fine[fine.quality == 1].kept.mean() >= 1 - quality.FALSE_REJECTS


def test_texts_are_not_shuffled_to_drop_rows(spark):
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet")
    kept = quality.keep_good(documents, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_texts_are_read_in_small_batches(spark):
    small_batches(spark)
    assert int(spark.conf.get("spark.sql.parquet.columnarReaderBatchSize")) <= 256
