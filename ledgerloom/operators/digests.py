"""Differences between two large tables that are mostly equal.

Each side is reduced to digests first: rows are dealt into buckets by a hash, and the digest of a bucket is a sum over its
rows, so that neither order nor partitioning matters. Only buckets whose digests differ are looked at row by
row; for equal tables nothing but digests is shuffled. The price is a second scan of both tables.

A digest is the number of rows and four sums of 32 bits each of two independent 64-bit hashes: 128 bits that all rows
enter, copies included. NULLs are part of the hash, so that values that change places with a NULL show.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType

from ledgerloom.functions.columns import as_column
from ledgerloom.operators.setops import except_both_ways

# Digests of either side. Sums of 32-bit parts stay below 64 bits for 2 ** 31 rows of a bucket.
BUCKETS = 1 << 16
_HALF = (1 << 32) - 1


def _hashable(name: str, data_type: DataType) -> Column:
    """Nested values as text with their NULLs; a hash alone skips them."""
    value = as_column(name)
    if isinstance(data_type, MapType):
        return F.to_json(F.sort_array(F.map_entries(value)), {"ignoreNullFields": "false"})
    if isinstance(data_type, (ArrayType, StructType)):
        return F.to_json(value, {"ignoreNullFields": "false"})
    return value


def row_hashes(df: DataFrame) -> tuple[Column, Column]:
    """Two independent hashes of all columns and of which of them are NULL."""
    values = [_hashable(f.name, f.dataType) for f in df.schema.fields]
    nulls = F.concat(F.lit(""), *[F.when(as_column(name).isNull(), "1").otherwise("0") for name in df.columns])
    return F.xxhash64(nulls, *values), F.xxhash64(F.lit("second"), *reversed(values), nulls)


def digests(df: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, rows, d0, d1, d2, d3) for every bucket that has rows; summed up within each task first."""
    first, second = row_hashes(df)
    hashed = df.select(F.pmod(first, F.lit(buckets)).cast("int").alias("bucket"), first.alias("_h0"), second.alias("_h1"))
    parts = [F.shiftrightunsigned(f"_h{i}", by).bitwiseAND(F.lit(_HALF)) for i in (0, 1) for by in (0, 32)]
    sums = [F.sum(part).alias(f"d{i}") for i, part in enumerate(parts)]
    return hashed.groupBy("bucket").agg(F.count(F.lit(1)).alias("rows"), *sums)


def differing_buckets(a: DataFrame, b: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """The buckets whose digests differ, at most ``buckets`` rows."""
    one, other = digests(a, buckets), digests(b, buckets)
    kinds = ["rows", "d0", "d1", "d2", "d3"]
    # both sides stacked: a bucket is equal if all its sums cancel out
    signed = [one.select("bucket", *kinds), other.select("bucket", *[(-F.col(k)).alias(k) for k in kinds])]
    sums = signed[0].unionByName(signed[1]).groupBy("bucket").agg(*[F.sum(k).alias(k) for k in kinds])
    return sums.filter(" OR ".join(f"{k} <> 0" for k in kinds)).select("bucket")


def suspects(a: DataFrame, b: DataFrame, buckets: int = BUCKETS) -> tuple[DataFrame, DataFrame]:
    """The rows of both tables that lie in differing buckets."""
    # no more rows than buckets, an int each
    differing = F.broadcast(differing_buckets(a, b, buckets).withColumnRenamed("bucket", "_bucket"))

    def of(df: DataFrame) -> DataFrame:
        bucket = F.pmod(row_hashes(df)[0], F.lit(buckets)).cast("int")
        return df.withColumn("_bucket", bucket).join(differing, "_bucket", "left_semi").drop("_bucket")

    return of(a), of(b)


def except_by_digests(
    a: DataFrame, b: DataFrame, columns: Sequence[str] | None = None, multiset: bool = False, buckets: int = BUCKETS
) -> DataFrame:
    """The rows of ``except_both_ways``; of equal tables only digests are shuffled.

    Columns of unlike types are compared in the type their union has.
    """
    names = list(a.columns if columns is None else columns)
    a, b = (df.select(*[as_column(name) for name in names]) for df in (a, b))
    types = a.limit(0).union(b.limit(0)).schema
    a, b = (df.select(*[as_column(n).cast(f.dataType).alias(n) for n, f in zip(names, types.fields)]) for df in (a, b))
    return except_both_ways(*suspects(a, b, buckets), names, multiset)
