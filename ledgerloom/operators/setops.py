"""Differences between two tables, each found with a single shuffle.

Both tables are stacked with a mark of their side and grouped once. Equal rows
meet inside each task already, so neither many copies of one row nor a frequent
value puts load on a single task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.columns import as_column
from ledgerloom.operators.skew import repeat_rows


def counts_on_both_sides(left: DataFrame, right: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows per key on either side, as ``left_rows`` and ``right_rows`` (0 where missing).

    The columns of both sides are matched by position, NULL keys are one key.
    """

    def marked(df: DataFrame, in_left: int) -> DataFrame:
        return df.select("*", F.lit(in_left).alias("_left"), F.lit(1 - in_left).alias("_right"))

    stacked = marked(left, 1).union(marked(right, 0))
    return stacked.groupBy(*[as_column(name) for name in by]).agg(
        F.sum("_left").alias("left_rows"), F.sum("_right").alias("right_rows")
    )


def except_both_ways(
    a: DataFrame, b: DataFrame, columns: Sequence[str] | None = None, multiset: bool = False
) -> DataFrame:
    """Rows of one table missing in the other, labelled in ``which_diff``.

    Works on distinct rows; with ``multiset`` copies count as well.
    """
    names = list(a.columns if columns is None else columns)
    a, b = (df.select(*[as_column(name) for name in names]) for df in (a, b))
    counts = counts_on_both_sides(a, b, names)
    copies = F.col("left_rows") - F.col("right_rows")
    side: Column = F.when(copies > 0, "a_minus_b").otherwise("b_minus_a")
    kept = [as_column(name) for name in names]
    if not multiset:
        one_sided = counts.filter("left_rows = 0 OR right_rows = 0")
        return one_sided.select(side.alias("which_diff"), *kept)
    labelled = counts.filter(copies != 0).select(side.alias("which_diff"), *kept, F.abs(copies).alias("_copies"))
    return repeat_rows(labelled, "_copies")
