"""Casts that give NULL for text that is no number.

Text is matched against a pattern before it is converted. ``try_cast`` alone
gives the same result but raises and catches an exception inside the JVM for
every bad value, which makes a dirty table some twenty times slower to check
than a clean one. Columns that are numbers already skip all of this.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ByteType,
    DataType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    NumericType,
    ShortType,
    StringType,
)

from ledgerloom.functions.columns import as_column

# White space and control characters around a number do not count.
_AROUND = r"[\x00-\x20\x7F]*"
# Integer text may carry a fraction, which is cut off: "12.7" counts as 12, ".5" and "." as 0.
INTEGER_TEXT = rf"^{_AROUND}([+-]?)(?:([0-9]+)(?:[.][0-9]*)?|[.][0-9]*){_AROUND}$"
DOUBLE_TEXT = (
    r"(?i)^[\x00-\x20]*[+-]?(?:(?:[0-9]+[.]?[0-9]*|[.][0-9]+)(?:e[+-]?[0-9]+)?[fd]?"
    r"|0x(?:[0-9a-f]+[.]?|[0-9a-f]*[.][0-9a-f]+)p[+-]?[0-9]+[fd]?|inf|infinity|nan)[\x00-\x20]*$"
)
INT_MIN, INT_MAX = -(2**31), 2**31 - 1


def as_integer(value: str | Column, data_type: DataType | None = None) -> Column:
    """As int; NULL for anything that is no whole number or does not fit.

    ``data_type`` is the type of the value, text unless given.
    """
    value = as_column(value)
    if isinstance(data_type, (ByteType, ShortType, IntegerType)):
        return value.cast("int")
    if isinstance(data_type, (LongType, FloatType, DoubleType, DecimalType)):
        return F.when(value.between(INT_MIN, INT_MAX), value.cast("int"))
    if data_type is not None and not isinstance(data_type, StringType):
        return value.try_cast("int")
    # a sign, and a zero in front so that a fraction alone is zero; no match gives no element
    digits = F.regexp_extract_all(F.regexp_replace(value.cast("string"), INTEGER_TEXT, "$10$2"), F.lit(r"^[+-]?[0-9]+$"), F.lit(0))
    return F.get(digits, F.lit(0)).try_cast("int")


def as_double(value: str | Column, data_type: DataType | None = None) -> Column:
    """As double; NULL for text that is no number."""
    value = as_column(value)
    if isinstance(data_type, NumericType):
        return value.cast("double")
    if data_type is not None and not isinstance(data_type, StringType):
        return value.try_cast("double")
    return F.when(value.cast("string").rlike(DOUBLE_TEXT), value.try_cast("double"))
