"""A training corpus from the documents table, stage by stage, each written and read again.

Language identification drops texts in none of the learned languages, quality rules drop what
they reject, near-duplicate detection keeps one document of each group, personal data is replaced, and
what is left is packed into training sequences.

``run`` has no SQL (``ORACLE_SQL`` is None): trained models and tokenizers have none.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import language, packing, pii, quality, simhash
from ledgerloom.llm.common import light_batches, small_batches, stored

ORACLE_SQL = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language; the languages and their limits are learned from all labels that ``docs`` carry."""
    small_batches(spark)
    training = language.training_texts(docs)
    return language.keep_identified(docs, training, limits=language.limits(docs, training))


def check_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return simhash.one_of_each_group(docs)


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The number of characters follows the text."""
    small_batches(spark)
    out = pii.redact(docs)
    if "n_chars" not in docs.columns:
        return out
    known = F.when(F.col("n_chars").isNotNull(), F.length("text"))
    return out.withColumn("n_chars", known.cast(docs.schema["n_chars"].dataType))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    light_batches(spark)
    # executors still hold what earlier stages have learned
    return packing.pack(docs, words=200_000)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify_language),
    ("quality_rules", check_quality),
    ("simhash_near_dedup", drop_near_duplicates),
    ("pii", replace_personal_data),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
