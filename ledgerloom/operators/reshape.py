"""Pivot, unpivot, and unions of tables with different columns."""

from __future__ import annotations

import operator
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
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

from ledgerloom.functions.columns import as_column, as_condition, as_expression
from ledgerloom.functions.names import slugify

COMPARISONS: dict[str, Callable[[Column, Column], Column]] = {
    "=": operator.eq,
    "!=": operator.ne,
    "<>": operator.ne,
    "<": operator.lt,
    "<=": operator.le,
    ">": operator.gt,
    ">=": operator.ge,
    "like": lambda column, value: F.like(column, value),
    "ilike": lambda column, value: F.ilike(column, value),
}

AGGREGATES = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max, "avg": F.avg}
DISTINCT_AGGREGATES = {
    "sum": F.sum_distinct,
    "count": F.count_distinct,
    "min": F.min,
    "max": F.max,
    "avg": lambda c: F.sum_distinct(c) / F.nullif(F.count_distinct(c), F.lit(0)),
}

# Values up to which a pivot evaluates each of them for every row.
FEW_VALUES = 32
# Digits a decimal can have.
MOST_DIGITS = 38

# Fixed value: readers of existing unions look for this column.
SOURCE_COLUMN = "_dbt_source_relation"


def _comparison(column: str, cmp: str | Callable[[Column, Column], Column], value) -> Column:
    """Any operator of SQL, or a function of two Columns, between a column and a literal."""
    known = cmp if callable(cmp) else COMPARISONS.get(cmp.lower())
    if known:
        return known(as_column(column), F.lit(value))
    if not isinstance(value, (str, int, float)):
        raise ValueError(f"{cmp!r} takes texts and numbers, got {value!r}")
    literal = "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'" if isinstance(value, str) else repr(value)
    return F.expr(f"`{column.replace('`', '``')}` {cmp} {literal}")


def _aggregate(agg: str | Callable[[Column], Column], distinct: bool) -> Callable[[Column], Column]:
    if callable(agg):
        return agg
    known = (DISTINCT_AGGREGATES if distinct else AGGREGATES).get(agg.lower())
    if known is None and distinct:
        raise ValueError(f"over distinct values agg is a function or one of {sorted(DISTINCT_AGGREGATES)}, got {agg!r}")
    return known or (lambda case: F.call_function(agg, case))


def pivot_columns(
    column: str,
    values: Sequence,
    alias: bool = True,
    agg: str | Callable[[Column], Column] = "sum",
    cmp: str | Callable[[Column, Column], Column] = "=",
    prefix: str = "",
    suffix: str = "",
    then_value=1,
    else_value=0,
    quote_identifiers: bool = True,
    distinct: bool = False,
) -> list[Column]:
    """One conditional aggregate per value, for use inside ``agg``.

    ``agg`` is the name of any SQL aggregate or a function of a Column, ``cmp`` an
    operator of SQL or a function of two Columns. ``then_value`` and ``else_value``
    are literals, Columns or SQL text. A value that does not occur gives ``else_value``, never NULL. Without
    ``quote_identifiers`` the new names are slugs.
    """
    aggregated = _aggregate(agg, distinct)
    then_value, else_value = as_expression(then_value), as_expression(else_value)
    result = []
    for value in values:
        case = F.when(_comparison(column, cmp, value), then_value).otherwise(else_value)
        aggregate = aggregated(case)
        if alias:
            name = f"{prefix}{value}{suffix}"
            aggregate = aggregate.alias(name if quote_identifiers else slugify(name))
        result.append(aggregate)
    return result


def _literal_of(data_type: DataType, value) -> bool:
    """Whether a value is one of the type, so that comparing needs no conversion."""
    if isinstance(data_type, StringType):
        return isinstance(value, str)
    return isinstance(data_type, (ByteType, ShortType, IntegerType, LongType)) and isinstance(value, int) and not isinstance(value, bool)


def _in_two_phases(df: DataFrame, column: str, values: Sequence, options: Mapping) -> bool:
    """Whether results can be put together from those of each (group, value)."""
    if len(values) <= FEW_VALUES or options.get("distinct") or options.get("cmp", "=") != "=" or not options.get("alias", True):
        return False
    agg, else_value = options.get("agg", "sum"), options.get("else_value", 0)
    plain = else_value is None or (isinstance(else_value, (int, float)) and not isinstance(else_value, bool))
    known = isinstance(agg, str) and agg.lower() in AGGREGATES
    types = df.schema[column].dataType if column in df.columns else None
    return known and plain and len(set(values)) == len(values) and all(_literal_of(types, v) for v in values)


def _pivot_in_two_phases(df: DataFrame, group_by: Sequence[str], column: str, values: Sequence, options: Mapping) -> DataFrame:
    """Aggregates of each (group, value) first, then one row per group, each partial result put in the place of its value.

    What rows of other values add follows from their number: each of them counts as ``else_value``.
    """
    agg, else_value = options.get("agg", "sum").lower(), options.get("else_value", 0)
    then_value = as_expression(options.get("then_value", 1))
    case = F.when(_comparison(column, "=", values[0]), then_value).otherwise(F.lit(else_value))
    # both branches have the type of the whole
    to = df.select(case.alias("case")).schema["case"].dataType
    result_type = df.agg(AGGREGATES[agg](case).alias("case")).schema["case"].dataType
    groups = [as_column(name).alias(f"g{i}") for i, name in enumerate(group_by)]
    keys = [f"g{i}" for i in range(len(group_by))]
    rows = df.select(*groups, as_column(column).alias("value"), then_value.cast(to).alias("then"))
    main = AGGREGATES["sum" if agg == "avg" else agg]
    parts = rows.groupBy(*keys, "value").agg(F.count(F.lit(1)).alias("n"), F.count("then").alias("filled"), main("then").alias("part"))
    total = F.sum("n").over(Window.partitionBy(*keys)).alias("total")
    placed = parts.select(*keys, "value", "n", "filled", "part", total).groupBy(*keys, "total").pivot("value", list(values))
    wide = placed.agg(F.first("n"), F.first("filled"), F.first("part"))
    names = [f"{kind}{i}" for i in range(len(values)) for kind in ("n", "filled", "part")]
    wide = wide.toDF(*keys, "total", *names)

    other = F.lit(else_value).cast(to)
    has_other = F.lit(else_value is not None)

    def whole(i: int) -> Column:
        others = F.col("total") - F.coalesce(f"n{i}", F.lit(0))
        part, filled = F.col(f"part{i}"), F.coalesce(f"filled{i}", F.lit(0))
        counts = has_other & (others > 0)
        if agg == "count":
            return filled + F.when(counts, others).otherwise(F.lit(0))
        if agg in ("min", "max"):
            nearest = F.least if agg == "min" else F.greatest  # both skip NULLs
            return nearest(part, F.when(counts, other))
        added = F.when(counts, F.coalesce(part, F.lit(0)) + other * others).otherwise(part)
        return added if agg == "sum" else added / F.nullif(filled + F.when(counts, others).otherwise(F.lit(0)), F.lit(0))

    prefix, suffix = options.get("prefix", ""), options.get("suffix", "")
    shown = [f"{prefix}{v}{suffix}" for v in values]
    shown = shown if options.get("quote_identifiers", True) else [slugify(name) for name in shown]
    results = [whole(i).cast(result_type).alias(name) for i, name in enumerate(shown)]
    return wide.select(*[F.col(key).alias(name) for key, name in zip(keys, group_by)], *results)


def pivot(df: DataFrame, group_by: Sequence[str], column: str, values: Sequence, **options) -> DataFrame:
    """Rows per group, one column per value; ``options`` as for ``pivot_columns``.

    Aggregates over distinct values depend only on the distinct combinations of
    group, column and value, so those are formed first: Spark expands its input
    once per distinct aggregate, and this way the input is small. Where a value
    is compared for equality and the others count as NULL, the combinations are
    all there is to aggregate, and nothing is expanded.

    More than ``FEW_VALUES`` values compared for equality under an aggregate that can be put together from parts are not
    evaluated for every row: groups and values are aggregated first and then reshaped.
    """
    if group_by and _in_two_phases(df, column, values, options):
        return _pivot_in_two_phases(df, group_by, column, values, options)
    if options.get("distinct"):
        if options.get("cmp", "=") == "=" and "else_value" in options and options["else_value"] is None:
            options["distinct"] = False
        df = df.withColumns(
            {
                "_then": as_expression(options.pop("then_value", 1)),
                "_else": as_expression(options.pop("else_value", 0)),
            }
        )
        names = list(dict.fromkeys([*group_by, column, "_then", "_else"]))
        df = df.select(*[as_column(name) for name in names]).distinct()
        options = {**options, "then_value": F.col("_then"), "else_value": F.col("_else")}
    return df.groupBy(*[as_column(name) for name in group_by]).agg(*pivot_columns(column, values, **options))


def unpivot(
    df: DataFrame,
    cast_to: str = "string",
    exclude: Sequence[str] = (),
    remove: Sequence[str] = (),
    field_name: str = "field_name",
    value_name: str = "value",
) -> DataFrame:
    """One row per remaining column and input row, NULL values included.

    ``exclude`` columns are repeated on every row, ``remove`` columns dropped.
    The input is read once whatever the number of columns.
    """
    kept, dropped = ({name.lower() for name in names} for names in (exclude, remove))
    melted = [f for f in df.schema.fields if f.name.lower() not in kept | dropped]
    if not melted:
        raise ValueError("no column left to unpivot")

    def converted(name: str, data_type: DataType) -> Column:
        value = as_column(name)
        if isinstance(data_type, BooleanType):
            value = value.cast("string")
        return value.cast(cast_to).alias(name)

    ids = [as_column(name) for name in exclude]
    wide = df.select(*ids, *[converted(f.name, f.dataType) for f in melted])
    return wide.unpivot(ids, [as_column(f.name) for f in melted], field_name, value_name)


def common_type(first: DataType, second: DataType) -> DataType:
    """Text if either is text, the number type that loses nothing of either, else the first."""
    if isinstance(second, StringType):
        return second
    if first == second or not (isinstance(first, NumericType) and isinstance(second, NumericType)):
        return first
    if any(isinstance(t, (FloatType, DoubleType)) for t in (first, second)):
        return DoubleType()
    # whole numbers are decimals without a fraction
    (whole_1, scale_1), (whole_2, scale_2) = ((t.precision - t.scale, t.scale) for t in map(_as_decimal, (first, second)))
    if not any(isinstance(t, DecimalType) for t in (first, second)):
        return first if whole_1 >= whole_2 else second
    whole, scale = max(whole_1, whole_2), max(scale_1, scale_2)
    return DecimalType(whole + scale, scale) if whole + scale <= MOST_DIGITS else DoubleType()


def _as_decimal(number: DataType) -> DecimalType:
    digits = {ByteType: 3, ShortType: 5, IntegerType: 10, LongType: 20}
    return number if isinstance(number, DecimalType) else DecimalType(digits[type(number)], 0)


def union_relations(
    relations: Mapping[str, DataFrame] | Sequence[tuple[str, DataFrame]],
    column_override: Mapping[str, str] | None = None,
    include: Sequence[str] = (),
    exclude: Sequence[str] = (),
    source_column: str | None = SOURCE_COLUMN,
    where: str | Column | None = None,
) -> DataFrame:
    """UNION ALL of named tables by column name.

    Columns appear in the order first seen; a table lacking one contributes
    NULLs. The type of a column is the override, else string if any table has
    text there, else the number type that holds all its numbers, else the type
    first seen. ``where`` filters every table.
    """
    if include and exclude:
        raise ValueError("give include or exclude, not both")
    named = list(relations.items() if isinstance(relations, Mapping) else relations)
    included, excluded = ({name.lower() for name in names} for names in (include, exclude))
    overrides = {name.lower(): to for name, to in (column_override or {}).items()}

    columns: dict[str, tuple[str, DataType | str]] = {}
    for _, df in named:
        for f in df.schema.fields:
            key = f.name.lower()
            if key in excluded or (included and key not in included):
                continue
            if key not in columns:
                columns[key] = (f.name, overrides.get(key, f.dataType))
            elif key not in overrides:
                label, seen = columns[key]
                columns[key] = (label, common_type(seen, f.dataType))
    if not columns:
        raise ValueError(f"no columns left to union for {[name for name, _ in named]}")

    def aligned(name: str, df: DataFrame) -> DataFrame:
        present = {c.lower(): c for c in df.columns}
        selected = [] if source_column is None else [F.lit(name).alias(source_column)]
        for key, (label, data_type) in columns.items():
            value = as_column(present[key]) if key in present else F.lit(None)
            selected.append(value.cast(data_type).alias(label))
        return df.filter(as_condition(where)).select(*selected)

    return reduce(DataFrame.unionByName, [aligned(name, df) for name, df in named])
