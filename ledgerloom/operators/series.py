"""Generated numbers and dates."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.dates import add_interval, check_date_part

_WHOLE_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 7 * 86400}
_WHOLE_MONTHS = {"month": 1, "quarter": 3, "year": 12}


def generate_series(spark: SparkSession, upper_bound: int) -> DataFrame:
    """The whole numbers 1 to ``upper_bound``, made by all tasks in parallel."""
    if upper_bound <= 0:
        raise ValueError("upper bound must be positive")
    return spark.range(1, upper_bound + 1).withColumnRenamed("id", "generated_number")


def periods_between(part: str, start: datetime, end: datetime) -> int:
    """Number of period boundaries between two times (31 Jan to 1 Feb is one month)."""
    if part in _WHOLE_MONTHS:
        size = _WHOLE_MONTHS[part]
        return (end.year * 12 + end.month - 1) // size - (start.year * 12 + start.month - 1) // size
    # counted from a Sunday, so that weeks start on Sundays
    origin = datetime(1970, 1, 4)
    size = timedelta(seconds=_WHOLE_SECONDS[part])
    return (end - origin) // size - (start - origin) // size


def date_spine(
    spark: SparkSession, part: str, start: date | datetime | str, end: date | datetime | str
) -> DataFrame:
    """One row per date part from ``start`` up to but without ``end``."""
    part = check_date_part(part)
    start, end = (_as_datetime(value) for value in (start, end))
    first = F.lit(start.isoformat(sep=" ")).cast("timestamp_ntz")
    last = F.lit(end.isoformat(sep=" ")).cast("timestamp_ntz")
    name = f"date_{part}"
    numbers = generate_series(spark, periods_between(part, start, end))
    step = F.col("generated_number") - 1
    return numbers.select(add_interval(part, step, first).alias(name)).filter(F.col(name) <= last)


def _as_datetime(value: date | datetime | str) -> datetime:
    if isinstance(value, str):
        return datetime.fromisoformat(value)
    return value if isinstance(value, datetime) else datetime(value.year, value.month, value.day)
