"""Date arithmetic by date part, on timestamps without time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.functions.columns import as_column

DATE_PARTS = ("second", "minute", "hour", "day", "week", "month", "quarter", "year")
_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def check_date_part(part: str) -> str:
    part = part.lower()
    if part not in DATE_PARTS:
        raise ValueError(f"date part must be one of {DATE_PARTS}, got {part!r}")
    return part


def add_interval(part: str, amount: int | Column, value: str | Column) -> Column:
    """``value`` plus ``amount`` date parts; month ends are clipped (31 Jan + 1 month = 28 Feb)."""
    amount = amount if isinstance(amount, Column) else F.lit(amount)
    return F.timestamp_add(check_date_part(part).upper(), amount, as_column(value).cast("timestamp_ntz"))


def boundaries_between(part: str, start: str | Column, end: str | Column) -> Column:
    """Number of date-part boundaries crossed from ``start`` to ``end``.

    31 Jan to 1 Feb is one month, weeks start on Sunday.
    """
    part = check_date_part(part)
    start, end = (as_column(c).cast("timestamp_ntz") for c in (start, end))
    return (_ordinal(part, end) - _ordinal(part, start)).cast("bigint")


def _ordinal(part: str, value: Column) -> Column:
    """Consecutive number of the period ``value`` lies in."""
    if part == "year":
        return F.year(value)
    if part == "quarter":
        return F.year(value) * 4 + F.quarter(value)
    if part == "month":
        return F.year(value) * 12 + F.month(value)
    days = F.unix_date(value.cast("date")).cast("bigint")
    if part == "week":
        # day 0 (1 Jan 1970) was a Thursday, so Sundays are the days 3 mod 7
        return F.floor((days + 4) / 7)
    of_day = F.hour(value) * 3600 + F.minute(value) * 60 + F.floor(F.second(value))
    return F.floor((days * 86400 + of_day) / _SECONDS[part])
