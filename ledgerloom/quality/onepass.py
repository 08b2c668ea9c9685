"""Many checks of a table from one scan and one grouping.

Checks that look at single rows are counters: for every row an expression says how much it adds. Checks that
compare rows by a value (uniqueness, accepted values, references) are keys. One scan turns a row into
one row of counters and one row for each key, stacked under the number of the check; one grouping by number and
key counts them. Counters collapse to a row per task before the shuffle, and so do frequent keys. Tables that are
compared with each other are stacked together, so that a reference meets its target in the same grouping.

Keys keep their type: there is one column for every type that is compared, NULL for checks of other types.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, DataType, DoubleType, IntegerType, LongType, NumericType, ShortType, StringType

_INTEGERS = (ByteType, ShortType, IntegerType, LongType)
# The number of the row that holds a table's counters is -1 - its number.
NUMBER, ROWS, OTHERS = "_check", "_rows", "_others"


@dataclass(frozen=True)
class Key:
    """Rows of a table to be counted by a value: those where ``where`` holds, on the side of the referred table if ``other``."""

    check: int
    value: Column
    type: DataType
    where: Column
    other: bool = False


@dataclass
class Scan:
    """What one scan of a table is to answer."""

    df: DataFrame
    counters: list[Column] = field(default_factory=list)
    keys: list[Key] = field(default_factory=list)

    def count(self, adds: Column) -> int:
        """Add a counter and return its place."""
        self.counters.append(adds)
        return len(self.counters) - 1


def common_type(one: DataType, other: DataType) -> DataType:
    """The type in which values of both are compared."""
    if one == other:
        return one
    if isinstance(one, _INTEGERS) and isinstance(other, _INTEGERS):
        return LongType()
    if isinstance(one, NumericType) and isinstance(other, NumericType):
        return DoubleType()
    return StringType()


def _stacked(number: int, scan: Scan, counters: int, types: Sequence[str]) -> DataFrame:
    def row(check: Column, key: Key | None, adds: Sequence[Column]) -> Column:
        found = [check.cast("int").alias(NUMBER), F.lit(int(key is not None and key.other)).cast("bigint").alias("_other")]
        for i, name in enumerate(types):
            mine = key is not None and key.type.simpleString() == name
            found.append((key.value.cast(key.type) if mine else F.lit(None).cast(name)).alias(f"_key_{i}"))
        for i in range(counters):
            found.append((adds[i] if i < len(adds) else F.lit(None)).cast("bigint").alias(f"_add_{i}"))
        return F.struct(*found)

    rows = [row(F.lit(-1 - number), None, scan.counters)]
    # rows that a check does not look at have no number
    rows += [row(F.when(key.where, F.lit(key.check)), key, ()) for key in scan.keys]
    stacked = scan.df.select(F.inline(F.array(*rows)) if len(rows) > 1 else rows[0].alias("_row"))
    stacked = stacked if len(rows) > 1 else stacked.select("_row.*")
    return stacked.filter(F.col(NUMBER).isNotNull())


def stacked(scans: Sequence[Scan]) -> tuple[DataFrame, int, int]:
    """The rows of all scans, and how many counter and key columns they have."""
    types = list(dict.fromkeys(key.type.simpleString() for scan in scans for key in scan.keys))
    counters = max((len(scan.counters) for scan in scans), default=0)
    rows = [_stacked(i, scan, counters, types) for i, scan in enumerate(scans)]
    return reduce(DataFrame.unionByName, rows), counters, len(types)


def grouped(scans: Sequence[Scan]) -> DataFrame:
    """One row per number and key: ``_rows`` of the table, ``_others`` of the referred one, and the sums ``_add_0``, ...

    Every table is scanned once and there is one shuffle.
    """
    rows, counters, keys = stacked(scans)
    sums = [F.sum(f"_add_{i}").alias(f"_add_{i}") for i in range(counters)]
    other = F.col("_other")
    return rows.groupBy(NUMBER, *[f"_key_{i}" for i in range(keys)]).agg(
        F.sum(1 - other).alias(ROWS), F.sum(other).alias(OTHERS), *sums
    )


def counted(scan: int, place: int) -> Column:
    """The total of a counter, as an aggregate over ``grouped``; 0 for an empty table."""
    return F.coalesce(F.sum(F.when(F.col(NUMBER) == -1 - scan, F.col(f"_add_{place}"))), F.lit(0))


def over_keys(check: int, value: Column) -> Column:
    """The sum of ``value`` over the keys of a check, as an aggregate over ``grouped``."""
    return F.coalesce(F.sum(F.when(F.col(NUMBER) == check, value)), F.lit(0))


def keys_of(check: int, table: DataFrame, value: Column, where: Column, other: bool = False, to: DataType | None = None) -> Key:
    return Key(check, value, to or table.select(value).schema[0].dataType, where, other)


def results(scans: Sequence[Scan], rows: Sequence[Column]) -> DataFrame:
    """One row for each struct of aggregates over ``grouped``; counters alone need no grouping."""
    found = grouped(scans) if any(scan.keys for scan in scans) else stacked(scans)[0]
    return found.agg(F.array(*rows).alias("_results")).select(F.inline("_results"))


def as_flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it does not or is NULL."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))
