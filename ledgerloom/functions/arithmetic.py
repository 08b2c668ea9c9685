"""Null-safe arithmetic and histogram buckets."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add, sub

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.functions.columns import as_column


def _zero_filled(fields: Sequence[str | Column], function: str) -> list[Column]:
    if isinstance(fields, (str, Column)) or not fields:
        raise TypeError(f"{function} takes a non-empty list of fields")
    return [F.coalesce(as_column(field), F.lit(0)) for field in fields]


def safe_add(fields: Sequence[str | Column]) -> Column:
    """Sum of the fields, NULL counting as 0."""
    return reduce(add, _zero_filled(fields, "safe_add"))


def safe_subtract(fields: Sequence[str | Column]) -> Column:
    """First field minus all the others, NULL counting as 0."""
    return reduce(sub, _zero_filled(fields, "safe_subtract"))


def safe_divide(numerator: str | Column, denominator: str | Column) -> Column:
    """Quotient, NULL where the denominator is 0 or NULL."""
    return as_column(numerator) / F.nullif(as_column(denominator), F.lit(0))


def width_bucket(value: str | Column, min_value: float, max_value: float, num_buckets: int) -> Column:
    """Number of the equal-width bucket: 0 below the range, n + 1 from its end on."""
    return F.width_bucket(as_column(value), F.lit(min_value), F.lit(max_value), F.lit(num_buckets))
