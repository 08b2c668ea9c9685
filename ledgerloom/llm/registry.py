"""The list of registered queries of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.llm.common import light_batches, small_batches

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _registered(function, batches: Callable[[SparkSession], None]):
    def with_batches(spark: SparkSession, folder: str) -> DataFrame:
        batches(spark)
        return function(spark, folder)

    QUERIES[function.__name__] = with_batches
    return function


def query(function):
    return _registered(function, small_batches)


def light_query(function):
    """For operators whose rows may be short: batches are limited by their bytes."""
    return _registered(function, light_batches)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
