"""Turning the arguments of public functions into Columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_column(value: str | Column) -> Column:
    """A column by name; names with dots or blanks are quoted."""
    if isinstance(value, Column):
        return value
    return F.col("`" + value.replace("`", "``") + "`")


def as_expression(value) -> Column:
    """A Column as is, text as a SQL expression, anything else as a literal."""
    if isinstance(value, Column):
        return value
    return F.expr(value) if isinstance(value, str) else F.lit(value)


def as_condition(value: str | Column | None) -> Column:
    """An optional row filter; no filter keeps every row."""
    return F.lit(True) if value is None else as_expression(value)
