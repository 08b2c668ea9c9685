"""Table checks. Each returns the rows (or groups) that fail; no rows means passed.

All checks take an optional row filter ``where``. Frequent values are counted
inside each task before any shuffle, so no check sends one value's rows to a
single task.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.columns import as_column, as_condition, as_expression
from ledgerloom.functions.dates import add_interval, check_date_part
from ledgerloom.functions.names import slugify
from ledgerloom.operators.grouping import key_counts
from ledgerloom.operators.neighbours import adjacent
from ledgerloom.operators.setops import counts_on_both_sides, except_both_ways
from ledgerloom.operators.skew import repeat_rows

Condition = str | Column | None

# name of the result column of grouped counts
COUNT = "filler_column"


def _columns(names: Sequence[str]) -> list[Column]:
    return [as_column(name) for name in names]


def not_null(df: DataFrame, column: str, where: Condition = None) -> DataFrame:
    """Rows without a value."""
    return df.filter(as_condition(where)).filter(as_column(column).isNull())


def unique(df: DataFrame, column: str, where: Condition = None) -> DataFrame:
    """Values found more than once, with their counts; NULL is not a value."""
    present = df.filter(as_condition(where)).filter(as_column(column).isNotNull())
    counts = present.groupBy(as_column(column).alias("unique_field")).agg(F.count(F.lit(1)).alias("n_records"))
    return counts.filter("n_records > 1")


def accepted_values(df: DataFrame, column: str, values: Sequence, where: Condition = None) -> DataFrame:
    """Values outside the list, with their counts."""
    strange = df.filter(as_condition(where)).filter(~as_column(column).isin(*values))
    return strange.groupBy(as_column(column).alias("value_field")).agg(F.count(F.lit(1)).alias("n_records"))


def not_accepted_values(df: DataFrame, column: str, values: Sequence, where: Condition = None) -> DataFrame:
    """Forbidden values that occur."""
    found = df.filter(as_condition(where)).filter(as_column(column).isin(*values))
    return found.select(as_column(column).alias("value_field")).distinct()


def accepted_range(
    df: DataFrame,
    column: str,
    min_value=None,
    max_value=None,
    inclusive: bool = True,
    where: Condition = None,
) -> DataFrame:
    """Rows outside the range; bounds are literals, Columns or SQL text."""
    value, failing = as_column(column), F.lit(False)
    if min_value is not None:
        low = as_expression(min_value)
        failing = failing | ~(value >= low if inclusive else value > low)
    if max_value is not None:
        high = as_expression(max_value)
        failing = failing | ~(value <= high if inclusive else value < high)
    return df.filter(as_condition(where)).filter(failing)


def at_least_one(
    df: DataFrame, column: str, group_by: Sequence[str] = (), where: Condition = None
) -> DataFrame:
    """Groups without a single value."""
    counts = df.filter(as_condition(where)).groupBy(*_columns(group_by)).agg(F.count(as_column(column)).alias(COUNT))
    return counts.filter(F.col(COUNT) == 0)


def not_constant(
    df: DataFrame, column: str, group_by: Sequence[str] = (), where: Condition = None
) -> DataFrame:
    """Groups with exactly one distinct value: smallest and largest are equal."""
    value = as_column(column)
    ends = df.filter(as_condition(where)).groupBy(*_columns(group_by)).agg(
        F.min(value).alias("_low"), F.max(value).alias("_high")
    )
    one = F.lit(1).cast("bigint").alias(COUNT)
    return ends.filter("_low = _high").select(*_columns(group_by), one)


def not_empty_string(
    df: DataFrame, column: str, trim_whitespace: bool = True, where: Condition = None
) -> DataFrame:
    """Empty values, one row each; blanks count as empty unless trimming is off."""
    value = as_column(column)
    values = df.filter(as_condition(where)).select((F.trim(value) if trim_whitespace else value).alias(column))
    return values.filter(as_column(column) == "")


def not_null_proportion(
    df: DataFrame,
    column: str,
    at_least: float,
    at_most: float = 1.0,
    group_by: Sequence[str] = (),
    where: Condition = None,
) -> DataFrame:
    """Groups whose share of filled values is out of bounds."""
    share = F.count(as_column(column)) / F.count(F.lit(1))
    shares = df.filter(as_condition(where)).groupBy(*_columns(group_by)).agg(share.alias("not_null_proportion"))
    proportion = F.col("not_null_proportion")
    return shares.filter((proportion < at_least) | (proportion > at_most))


def unique_combination_of_columns(
    df: DataFrame, columns: Sequence[str], where: Condition = None
) -> DataFrame:
    """Combinations found more than once; NULLs are equal here."""
    counts = df.filter(as_condition(where)).groupBy(*_columns(columns)).agg(F.count(F.lit(1)).alias("_rows"))
    return counts.filter("_rows > 1").drop("_rows")


def expression_is_true(
    df: DataFrame, expression: str, column: str | None = None, where: Condition = None
) -> DataFrame:
    """Rows for which the expression is false; with a column it starts with that column."""
    text = expression if column is None else f"`{column}` {expression}"
    return df.filter(as_condition(where)).filter(~F.expr(text))


def assert_equal(
    df: DataFrame, actual: str, expected: str, null_safe: bool = False, where: Condition = None
) -> DataFrame:
    """Rows whose two columns differ; NULLs only count with ``null_safe``."""
    a, b = as_column(actual), as_column(expected)
    return df.filter(as_condition(where)).filter(~a.eqNullSafe(b) if null_safe else a != b)


def relationships(
    df: DataFrame, column: str, to: DataFrame, field: str, where: Condition = None
) -> DataFrame:
    """References that do not exist in the other table, one row per referring row."""
    return _dangling(df.filter(as_condition(where)), column, to, field).select(F.col("id").alias("from_field"))


def relationships_where(
    df: DataFrame,
    column: str,
    to: DataFrame,
    field: str,
    from_condition: Condition = None,
    to_condition: Condition = None,
    where: Condition = None,
) -> DataFrame:
    """The same with a row filter on either side."""
    rows = df.filter(as_condition(where)).filter(as_condition(from_condition))
    dangling = _dangling(rows, column, to.filter(as_condition(to_condition)), field)
    return dangling.select("id", F.lit(None).cast(dangling.schema["id"].dataType).alias("right_id"))


def _dangling(df: DataFrame, column: str, to: DataFrame, field: str) -> DataFrame:
    """Each reference is looked up once, however many rows make it."""
    references = df.filter(as_column(column).isNotNull()).groupBy(as_column(column).alias("id"))
    counted = references.agg(F.count(F.lit(1)).alias("_rows"))
    known = to.filter(as_column(field).isNotNull()).select(as_column(field).alias("id")).distinct()
    return repeat_rows(counted.join(known, "id", "left_anti"), "_rows")


def cardinality_equality(
    df: DataFrame, column: str, to: DataFrame, field: str, where: Condition = None
) -> DataFrame:
    """Values that occur a different number of times, with the count of either side."""
    left = df.filter(as_condition(where)).select(as_column(column))
    counts = counts_on_both_sides(left, to.select(as_column(field)), [column])
    both = F.explode(F.array("left_rows", "right_rows")).alias("num_rows")
    return counts.filter("left_rows <> right_rows").select(as_column(column), both).filter("num_rows > 0")


def _grouped_counts(
    df: DataFrame, compare: DataFrame, group_by: Sequence[str], names: tuple[str, str]
) -> DataFrame:
    """Row counts per group, full outer joined: NULL keys never meet their like."""
    left, right = names
    counts = counts_on_both_sides(df.select(*_columns(group_by)), compare.select(*_columns(group_by)), group_by)

    def side(has_left: bool, has_right: bool) -> Column:
        fields = []
        for name in group_by:
            key = as_column(name)
            fields.append((key if has_left else F.nullif(key, key)).alias(f"{name}_a"))
            fields.append((key if has_right else F.nullif(key, key)).alias(f"{name}_b"))
        fields.append(F.when(F.lit(has_left), F.col("left_rows")).alias(left))
        fields.append(F.when(F.lit(has_right), F.col("right_rows")).alias(right))
        return F.struct(*fields)

    both, only_left, only_right = side(True, True), side(True, False), side(False, True)
    if not group_by:
        return counts.select(F.coalesce("left_rows", F.lit(0)).alias(left), F.coalesce("right_rows", F.lit(0)).alias(right))
    comparable = reduce(and_, [as_column(name).isNotNull() for name in group_by])
    rows = (
        F.when((F.col("left_rows") > 0) & (F.col("right_rows") > 0) & comparable, F.array(both))
        .when(F.col("right_rows") == 0, F.array(only_left))
        .when(F.col("left_rows") == 0, F.array(only_right))
        .otherwise(F.array(only_left, only_right))
    )
    return counts.select(F.inline(rows))


def equal_rowcount(
    df: DataFrame,
    compare: DataFrame,
    group_by: Sequence[str] = (),
    strict: bool = False,
    where: Condition = None,
) -> DataFrame:
    """Row counts of two tables by group, with their difference.

    The check fails if ``total_difference`` of the result is not 0. A group
    missing in one table has no difference and passes, unless ``strict``.
    """
    counts = _grouped_counts(df.filter(as_condition(where)), compare, group_by, ("count_a", "count_b"))
    a, b = F.col("count_a"), F.col("count_b")
    if strict:
        a, b = F.coalesce(a, F.lit(0)), F.coalesce(b, F.lit(0))
    return counts.withColumn("diff_count", F.abs(a - b))


def fewer_rows_than(
    df: DataFrame, compare: DataFrame, group_by: Sequence[str] = (), where: Condition = None
) -> DataFrame:
    """Row counts by group; the delta is the surplus, 1 for equal counts, 0 if there are fewer."""
    names = ("count_our_model", "count_comparison_model")
    counts = _grouped_counts(df.filter(as_condition(where)), compare, group_by, names)
    ours, theirs = F.col(names[0]), F.col(names[1])
    delta = F.when(ours > theirs, ours - theirs).when(ours == theirs, 1).otherwise(0)
    return counts.withColumn("row_count_delta", delta.cast("bigint"))


def equality(
    df: DataFrame,
    compare: DataFrame,
    columns: Sequence[str] | None = None,
    multiset: bool = False,
    where: Condition = None,
) -> DataFrame:
    """Rows of one table missing in the other; copies only count with ``multiset``."""
    return except_both_ways(df.filter(as_condition(where)), compare, columns, multiset)


def columns_match_set(df: DataFrame, column_list: Sequence[str], transform: str = "upper") -> DataFrame:
    """Column names of the table missing in the list and the other way round."""
    change = {"upper": str.upper, "lower": str.lower, "none": str}[transform]
    actual, wanted = ({change(name) for name in names} for names in (df.columns, column_list))
    rows = [(name, None) for name in sorted(actual - wanted)] + [(None, name) for name in sorted(wanted - actual)]
    return df.sparkSession.createDataFrame(rows, "relation_column string, input_column string")


def recency(
    df: DataFrame,
    field: str,
    datepart: str,
    interval: int,
    ignore_time_component: bool = False,
    group_by: Sequence[str] = (),
    as_of: str | Column | None = None,
    where: Condition = None,
) -> DataFrame:
    """Groups whose latest time is older than ``interval`` date parts before ``as_of`` (default: now)."""
    now = F.localtimestamp() if as_of is None else F.lit(as_of).cast("timestamp_ntz")
    kind = "date" if ignore_time_component else "timestamp_ntz"
    threshold = add_interval(datepart, -interval, now).cast(kind)
    latest = F.max(as_column(field)).cast(kind).alias("most_recent")
    groups = df.filter(as_condition(where)).groupBy(*_columns(group_by)).agg(latest)
    return groups.withColumn("threshold", threshold).filter("most_recent < threshold")


def sequential_values(
    df: DataFrame,
    column: str,
    interval: int = 1,
    datepart: str | None = None,
    group_by: Sequence[str] = (),
    where: Condition = None,
    ranges: int | None = None,
) -> DataFrame:
    """Rows whose value is not the previous one plus the interval; the first passes.

    NULLs neither fail nor have a successor.
    """
    previous = f"previous_{slugify(column)}"
    if datepart is not None:
        check_date_part(datepart)
    rows = df.filter(as_condition(where)).filter(as_column(column).isNotNull())
    groups = {f"group_{i}": as_column(name) for i, name in enumerate(group_by)}
    near = adjacent(rows, groups, {"value": as_column(column)}, following=False, ranges=ranges)

    # the first of equal rows follows the previous value, the others follow their like
    value = F.col("value")
    copies = F.array(
        F.struct(F.col("neighbour.value").alias("previous"), F.lit(1).cast("bigint").alias("rows")),
        F.struct(value.alias("previous"), (F.col("copies") - 1).alias("rows")),
    )
    pairs = near.select(*groups, "value", F.inline(copies)).filter("rows > 0")
    if datepart is None:
        expected, actual = F.col("previous") + F.lit(interval), value
    else:
        expected, actual = add_interval(datepart, interval, "previous"), value.cast("timestamp_ntz")
    failing = repeat_rows(pairs.filter(actual != expected), "rows")
    return failing.select(
        *[F.col(g).alias(name) for g, name in zip(groups, group_by)],
        value.alias(column),
        F.col("previous").alias(previous),
    )


# How the upper bound relates to the next lower bound, and how the result names it.
_GAPS = {
    "not_allowed": ("equal_to", lambda upper, following: upper == following),
    "allowed": ("less_than_or_equal_to", lambda upper, following: upper <= following),
    "required": ("less_than", lambda upper, following: upper < following),
}


def mutually_exclusive_ranges(
    df: DataFrame,
    lower_bound: str,
    upper_bound: str,
    partition_by: str | None = None,
    gaps: str = "allowed",
    zero_length_range_allowed: bool = False,
    where: Condition = None,
    ranges: int | None = None,
) -> DataFrame:
    """Ranges that are empty or run into the next one. Bounds and partition are SQL text.

    ``gaps``: 'allowed', 'required' or 'not_allowed' between neighbouring ranges.
    """
    if gaps not in _GAPS:
        raise ValueError(f"gaps must be one of {sorted(_GAPS)}, got {gaps!r}")
    gap_words, meets = _GAPS[gaps]
    length_words = "less_than_or_equal_to" if zero_length_range_allowed else "less_than"
    group = {} if partition_by is None else {"partition_by_col": F.expr(partition_by)}
    order = {"lower_bound": F.expr(lower_bound), "upper_bound": F.expr(upper_bound)}
    near = adjacent(df.filter(as_condition(where)), group, order, following=True, ranges=ranges)

    # all but one of equal ranges are followed by their like
    lower, upper = F.col("lower_bound"), F.col("upper_bound")
    copies = F.array(
        F.struct(
            F.col("neighbour.lower_bound").alias("next_lower_bound"),
            F.col("neighbour").isNull().alias("is_last_record"),
            F.lit(1).cast("bigint").alias("_rows"),
        ),
        F.struct(
            lower.alias("next_lower_bound"),
            F.lit(False).alias("is_last_record"),
            (F.col("copies") - 1).alias("_rows"),
        ),
    )
    ranges = near.select(*group, "lower_bound", "upper_bound", F.inline(copies)).filter("_rows > 0")
    long_enough = lower <= upper if zero_length_range_allowed else lower < upper
    fits, clear = f"lower_bound_{length_words}_upper_bound", f"upper_bound_{gap_words}_next_lower_bound"
    judged = ranges.withColumns(
        {
            fits: F.coalesce(long_enough, F.lit(False)),
            clear: F.coalesce(meets(upper, F.col("next_lower_bound")), F.col("is_last_record"), F.lit(False)),
        }
    )
    return repeat_rows(judged.filter(~(F.col(fits) & F.col(clear))), "_rows")


class CheckFailed(AssertionError):
    """A check or gate found more failures than allowed."""


@dataclass(frozen=True)
class Outcome:
    failures: int
    status: str  # "pass", "warn" or "error"


_THRESHOLD = re.compile(r"\s*(!=|<>|>=|<=|>|<|==?)\s*(-?[0-9]+)\s*")
_REACHED = {
    "!=": lambda n, limit: n != limit,
    "<>": lambda n, limit: n != limit,
    "=": lambda n, limit: n == limit,
    "==": lambda n, limit: n == limit,
    ">": lambda n, limit: n > limit,
    "<": lambda n, limit: n < limit,
    ">=": lambda n, limit: n >= limit,
    "<=": lambda n, limit: n <= limit,
}

# What to compute over the result of a check whose rows are not failures themselves.
ROW_COUNT = "count(*)"
FAIL_CALCULATIONS = {
    "equal_rowcount": "sum(coalesce(diff_count, 0))",
    "fewer_rows_than": "sum(coalesce(row_count_delta, 0))",
    "equality": (
        "count(*) + coalesce(abs(sum(if(which_diff = 'a_minus_b', 1, 0))"
        " - sum(if(which_diff = 'b_minus_a', 1, 0))), 0)"
    ),
}


def reaches(failures: int | Column, threshold: str) -> bool | Column:
    """Whether a number of failures meets a threshold such as '> 10'."""
    match = _THRESHOLD.fullmatch(threshold)
    if not match:
        raise ValueError(f"a threshold looks like '> 10', got {threshold!r}")
    return _REACHED[match[1]](failures, int(match[2]))


def outcome(
    failing: DataFrame,
    fail_calc: str = ROW_COUNT,
    error_if: str = "!= 0",
    warn_if: str = "!= 0",
    severity: str = "error",
) -> Outcome:
    """Evaluate a check (starts a job, returns one number) against its thresholds."""
    failures = int(failing.agg(F.expr(fail_calc).alias("failures")).first()["failures"] or 0)
    if severity == "error" and reaches(failures, error_if):
        return Outcome(failures, "error")
    return Outcome(failures, "warn" if reaches(failures, warn_if) else "pass")


def staging_gate(df: DataFrame, key: str) -> None:
    """Raise if the key has duplicates or NULLs (starts one job)."""
    found = key_counts(df, key).first()
    if found["duplicate_keys"] or found["null_keys"]:
        raise CheckFailed(f"{key}: {found['duplicate_keys']} duplicates, {found['null_keys']} NULLs")
