"""Previous and next value in sorted order, for groups of any size.

A window without (or with few) partitions sorts whole groups in single tasks.
Here the distinct (group, value) combinations are cut into ranges of the overall
sort order instead; each range is one window partition, and the last (or first)
combination of the neighbouring range is carried over. Equal rows are counted
before the shuffle, so a value held by a third of all rows is one combination.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.session import scratch_folder


def adjacent(
    df: DataFrame,
    group: dict[str, Column],
    order: dict[str, Column],
    following: bool,
    ranges: int | None = None,
) -> DataFrame:
    """One row per distinct combination of ``group`` and ``order`` values.

    Columns: the values, ``copies`` (rows of ``df`` having them) and ``neighbour``,
    a struct of the next (``following``) or previous combination's ``order``
    values in the same group, NULL at the end of the group. NULLs sort last.

    Starts a job that writes the combinations to the scratch folder, each with the
    number of its range. There are as many ranges as shuffle partitions unless
    ``ranges`` says otherwise; any number gives the same result.
    """
    distinct = _in_ranges(df.select(_sort_key(list(group.values()), list(order.values())).alias("_key")), ranges)
    step, back = (F.lead, F.lag) if following else (F.lag, F.lead)
    in_range = Window.partitionBy("_range").orderBy("_key")
    found = distinct.select(
        "*", step("_key").over(in_range).alias("_near"), back("_key").over(in_range).isNull().alias("_faces")
    )
    # one row per range: the key that faces the neighbouring range
    edges = found.filter("_faces").select("_range", F.col("_key").alias("_edge"))
    edges = edges.select("_range", step("_edge").over(Window.orderBy("_range")).alias("_carried"))
    found = found.join(edges, "_range", "left").withColumn("_near", F.coalesce("_near", "_carried"))

    near, groups, orders = F.col("_near"), range(len(group)), range(len(order))
    same_group = reduce(
        and_, [near[f"g{i}"].eqNullSafe(F.col("_key")[f"g{i}"]) for i in groups], near.isNotNull()
    )
    neighbour = F.struct(*[near[f"o{i}"].alias(name) for i, name in zip(orders, order)])
    return found.select(
        *[F.col("_key")[f"g{i}"].alias(name) for i, name in zip(groups, group)],
        *[F.col("_key")[f"o{i}"].alias(name) for i, name in zip(orders, order)],
        "copies",
        F.when(same_group, neighbour).alias("neighbour"),
    )


def _sort_key(group: list[Column], order: list[Column]) -> Column:
    parts = [c.alias(f"g{i}") for i, c in enumerate(group)]
    for i, c in enumerate(order):
        parts += [c.isNull().alias(f"n{i}"), c.alias(f"o{i}")]
    return F.struct(*parts)


def _in_ranges(keys: DataFrame, ranges: int | None) -> DataFrame:
    """Distinct keys with their ``copies`` and the number of the range of the sort order they lie in.

    Written once, so that the numbers stay what they are.
    """
    spark = keys.sparkSession
    distinct = keys.groupBy("_key").agg(F.count(F.lit(1)).alias("copies"))
    n = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = distinct.repartitionByRange(n, "_key").withColumn("_range", F.spark_partition_id())
    folder = scratch_folder(spark, "ranges")
    placed.write.parquet(folder)
    return spark.read.schema(placed.schema).parquet(folder)
