"""The list of registered queries."""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query and, where there is one, the equivalent SQL."""

    def register(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def own_name(spark: SparkSession, name: str) -> str:
    """A database name that nothing else uses; the database is dropped when Python ends."""
    own = f"{name}_{uuid.uuid4().hex}"

    def drop() -> None:
        if spark.sparkContext._jsc is not None and not spark.sparkContext._jsc.sc().isStopped():
            spark.sql(f"DROP DATABASE IF EXISTS `{own}` CASCADE")

    atexit.register(drop)
    return own


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
