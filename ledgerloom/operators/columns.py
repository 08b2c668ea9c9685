"""Choosing and cleaning columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ledgerloom.functions.columns import as_column


def filtered_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Column names without the excluded ones; case does not matter."""
    dropped = {name.lower() for name in exclude}
    return [name for name in df.columns if name.lower() not in dropped]


def star(
    df: DataFrame,
    exclude: Sequence[str] = (),
    prefix: str = "",
    suffix: str = "",
    relation_alias: str | None = None,
) -> list[Column]:
    """``*`` with exclusions and renaming, for ``select`` or ``groupBy``; may be empty."""
    columns = []
    for name in filtered_columns(df, exclude):
        column = as_column(name) if relation_alias is None else F.col(f"{relation_alias}.`{name}`")
        columns.append(column.alias(f"{prefix}{name}{suffix}") if prefix or suffix else column)
    return columns


def renamed(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """The given columns only, under new names."""
    return df.select(*[as_column(old).alias(new) for old, new in names.items()])


def nullcheck(df: DataFrame, columns: Sequence[str] | None = None) -> list[Column]:
    """Columns with '' turned into NULL; columns that hold no text stay as they are."""
    strings = {f.name for f in df.schema.fields if isinstance(f.dataType, StringType)}
    return [
        F.nullif(as_column(name), F.lit("")).alias(name) if name in strings else as_column(name)
        for name in (df.columns if columns is None else columns)
    ]


def nullcheck_table(df: DataFrame) -> DataFrame:
    return df.select(*nullcheck(df))
