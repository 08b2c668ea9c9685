"""Joins and row copies that stay parallel when a few keys hold most rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.columns import as_column

# Rows of one key a single join task can take without trouble.
HOT_KEY_ROWS = 1_000_000
# Portions that rows without a key are dealt out to.
NULL_PORTIONS = 1024
# Copies of one row a single task writes at most.
COPIES_PER_TASK = 1_000_000


def hot_keys(df: DataFrame, key: str, rows: int = HOT_KEY_ROWS) -> DataFrame:
    """Keys with more than ``rows`` rows and ``parts``, the portions of that size they make.

    There are fewer of them than row count / ``rows``, so that one task can hold the list and Spark,
    which sees its size at run time, decides whether to broadcast it.
    """
    counts = df.filter(as_column(key).isNotNull()).groupBy(as_column(key)).agg(F.count(F.lit(1)).alias("_rows"))
    parts = F.ceil(F.col("_rows") / rows).cast("int").alias("_parts")
    return counts.filter(F.col("_rows") > rows).select(as_column(key), parts).repartition(1)


def left_join_unique(
    base: DataFrame, lookups: Sequence[DataFrame], key: str, hot_key_rows: int = HOT_KEY_ROWS
) -> DataFrame:
    """Left joins of ``base`` with tables that hold one row per key, as one plan without a job.

    Rows of a hot key are dealt out over its portions by a hash of the row, and the key's one row of each
    lookup is repeated for every portion. Rows with a NULL key match nothing and are dealt out as well.
    """
    if not lookups:
        return base
    hot = hot_keys(base, key, hot_key_rows)
    portion = F.when(as_column(key).isNull(), F.lit(NULL_PORTIONS)).otherwise(F.coalesce("_parts", F.lit(1)))
    row = F.xxhash64(*[as_column(c) for c in base.columns])
    joined = base.join(hot, key, "left").withColumn("_part", F.pmod(row, portion).cast("int")).drop("_parts")
    for lookup in lookups:
        copies = F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1)).alias("_part")
        dealt = lookup.filter(as_column(key).isNotNull()).join(hot, key, "left").select(*map(as_column, lookup.columns), copies)
        joined = joined.join(dealt, [key, "_part"], "left")
    added = [as_column(c) for lookup in lookups for c in lookup.columns if c != key]
    return joined.select(*map(as_column, base.columns), *added)


def repeat_rows(df: DataFrame, copies: str, per_task: int = COPIES_PER_TASK) -> DataFrame:
    """Each row as often as its column ``copies`` says, without that column.

    A row with very many copies becomes several smaller portions first, which
    are then dealt out over all tasks.
    """
    spark = df.sparkSession
    columns = [as_column(name) for name in df.columns if name != copies]
    n = as_column(copies).cast("bigint")
    portions = df.filter(n > 0).select(
        *columns, n.alias("_n"), F.explode(F.sequence(F.lit(1), F.ceil(n / per_task))).alias("_portion")
    )
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = portions.repartition(tasks, F.xxhash64(*columns, F.col("_portion")))
    size = F.least(F.lit(per_task).cast("bigint"), F.col("_n") - (F.col("_portion") - 1) * per_task)
    return dealt.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), size))).select(*columns)
