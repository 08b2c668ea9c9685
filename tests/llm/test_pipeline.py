import os
import shutil
import subprocess
import sys
from pathlib import Path

import brute
import corpus_pipeline

from ledgerloom.llm import simhash
from ledgerloom.llm.common import ROWS_AT_ONCE

ROOT = Path(__file__).resolve().parents[2]
FOLDER = "/root/testdata/sf0.001"


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, stage(spark, docs, FOLDER).cache()
        assert docs.columns == columns and docs.schema == before.schema
        counts.append(docs.count())
    assert counts == sorted(counts, reverse=True) and counts[-1] > 0.6 * counts[0]
    texts = docs.toPandas()
    assert (texts.n_chars == texts.text.str.len()).all()
    assert not any(brute.personal_data(t) for t in texts.text)
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).toPandas()
    assert set(pieces.doc_id) == set(texts.doc_id)


def test_near_duplicates_go(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    kept = {r["doc_id"] for r in corpus_pipeline.drop_near_duplicates(spark, docs, FOLDER).select("doc_id").collect()}
    groups = {r["component_id"] for r in simhash.near_duplicates(docs).collect()}
    assert kept == groups


def test_hard_rows_pass_every_stage(spark):
    for rows in (brute.hard_rows(spark), brute.no_rows(spark)):
        for _, stage in corpus_pipeline.STAGES:
            stage(spark, rows, FOLDER).count()


def test_queries_without_the_subpackage(tmp_path):
    """The entry module works when the subpackage, its tests and the pipeline are deleted."""
    shutil.copytree(ROOT / "ledgerloom", tmp_path / "ledgerloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; print(len(e.queries()), len([q for q in e.queries() if q.startswith('op')]))"
    run = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=os.environ | {"PYTHONPATH": str(tmp_path)}, capture_output=True, text=True)
    n, ops = map(int, run.stdout.split())
    assert n > 100 and ops == 0


def test_all_queries_are_registered():
    import __spark_entry__

    names = __spark_entry__.queries()
    assert "pipeline" in names and all(sum(n.startswith(f"op{i}_") for n in names) == 1 for i in range(1, 11))


def test_personal_data_is_read_in_small_batches(spark):
    """Also when no stage before has set them."""
    names = ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.parquet.columnarReaderBatchSize")
    before = [spark.conf.get(n) for n in names]
    try:
        for n in names:
            spark.conf.set(n, 4096)
        docs = spark.createDataFrame([(1, "write to a@b.org")], "doc_id long, text string")
        out = corpus_pipeline.replace_personal_data(spark, docs, FOLDER).collect()
        assert [r["text"] for r in out] == ["write to [EMAIL]"]
        assert [int(spark.conf.get(n)) for n in names] == [ROWS_AT_ONCE] * 2
    finally:
        for n, v in zip(names, before):
            spark.conf.set(n, v)
