"""Grouping: deduplication, value lists, scalar lookups, key counts, samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.columns import as_column, as_condition


def deduplicate(
    df: DataFrame, partition_by: Sequence[str | Column], order_by: Sequence[str | Column]
) -> DataFrame:
    """The first row of every group. State a complete order for a repeatable result.

    Spark keeps the first row per group within each task before the shuffle, so
    a group holding most of the table is no burden. NULL is a group of its own.
    """
    order = [F.expr(c) if isinstance(c, str) else c for c in order_by] if order_by else [F.lit(1)]
    window = Window.partitionBy(*[as_column(c) for c in partition_by]).orderBy(*order)
    return df.withColumn("_row", F.row_number().over(window)).filter("_row = 1").drop("_row")


def first_columns(df: DataFrame, n: int) -> list[Column]:
    """The first ``n`` columns, to group by their position."""
    if not 0 < n <= len(df.columns):
        raise ValueError(f"n must be between 1 and {len(df.columns)}, got {n}")
    return [as_column(name) for name in df.columns[:n]]


def group_by_first(df: DataFrame, n: int, *aggregates: Column) -> DataFrame:
    """GROUP BY 1, 2, ..., n."""
    return df.groupBy(*first_columns(df, n)).agg(*aggregates)


def value_counts(
    df: DataFrame, column: str, max_records: int | None = None, where: str | Column | None = None
) -> DataFrame:
    """Distinct values with their row counts, most frequent first, then by value."""
    counts = (
        df.filter(as_condition(where))
        .groupBy(as_column(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("num_rows"))
        .orderBy(F.desc("num_rows"), F.asc_nulls_last("value"))
    )
    return counts if max_records is None else counts.limit(max_records)


def column_values(
    df: DataFrame | None,
    column: str,
    order_by: str | Column | None = None,
    max_records: int | None = None,
    default: list | None = None,
    where: str | Column | None = None,
    refuse_above: int | None = None,
) -> list:
    """Distinct values of a column as a list on the driver (starts a job).

    Ordered by falling frequency unless ``order_by`` says otherwise. The default
    is returned for a missing or empty table. ``value_counts`` keeps long lists
    distributed; with ``refuse_above`` a list with more values is an error, never cut.
    """
    if df is None:
        if default is None:
            raise ValueError("the table does not exist and no default was given")
        return default
    rows = df.filter(as_condition(where)).groupBy(as_column(column).alias("value"))
    counts = rows.agg(F.count(F.lit(1)).alias("num_rows"))
    if order_by is None:
        order = [F.desc("num_rows")]
    else:
        order = [F.expr(order_by) if isinstance(order_by, str) else order_by]
    counts = counts.orderBy(*order, F.asc_nulls_last("value"))
    if max_records is not None:
        counts = counts.limit(max_records)
    elif refuse_above is not None:
        counts = counts.limit(refuse_above + 1)
    values = [r["value"] for r in counts.select("value").collect()]
    if refuse_above is not None and len(values) > refuse_above:
        raise ValueError(f"{column} has more than {refuse_above} distinct values")
    return values or default


def scalar_value(df: DataFrame, default=None):
    """First column of the first row, the default when there is none (starts a job)."""
    row = df.select(as_column(df.columns[0])).first()
    return default if row is None else row[0]


def scalar_column(df: DataFrame, default=None) -> Column:
    """The same as a column: a scalar subquery inside the surrounding plan."""
    value = df.select(as_column(df.columns[0])).limit(1).scalar()
    return value if default is None else F.coalesce(value, F.lit(default))


def distribution(df: DataFrame, column: str) -> DataFrame:
    """Row count per value, ordered by value."""
    counts = df.groupBy(as_column(column)).agg(F.count(F.lit(1)).alias("num_rows"))
    return counts.orderBy(F.asc_nulls_last(as_column(column)))


def key_counts(df: DataFrame, key: str) -> DataFrame:
    """One row: row count, surplus rows per key (NULL keys count as surplus), NULL keys."""
    rows, keys = F.count(F.lit(1)), F.count_distinct(as_column(key))
    return df.agg(
        rows.alias("row_count"),
        (rows - keys).alias("duplicate_keys"),
        F.count_if(as_column(key).isNull()).alias("null_keys"),
    )


def sample_rows(df: DataFrame, n: int, order_by: Sequence[str | Column]) -> DataFrame:
    """The first ``n`` rows by key, so that a sample can be repeated."""
    return df.orderBy(*[as_column(c) for c in order_by]).limit(n)
