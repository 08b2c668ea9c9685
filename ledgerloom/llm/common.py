"""Helpers of the operators: per-row Arrow work, stored tables, connected components."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructField, StructType, _parse_datatype_string

from ledgerloom.functions.columns import as_column
from ledgerloom.operators.skew import HOT_KEY_ROWS, left_join_unique
from ledgerloom.session import scratch_folder

# Rows a Python task works on at a time; the rest of an Arrow batch waits in Arrow's form.
ROWS_AT_ONCE = 256
# Bytes of an Arrow batch where rows are of any length.
BATCH_BYTES = 4 << 20


def small_batches(spark: SparkSession) -> None:
    """Let Spark read and hand over texts in batches of few rows: by default one holds 4,096 or 10,000 texts, several times over.

    Settings of the session, so that queries and pipelines set them, not operators.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ROWS_AT_ONCE)
    spark.conf.set("spark.sql.parquet.columnarReaderBatchSize", ROWS_AT_ONCE)


def light_batches(spark: SparkSession) -> None:
    """Batches of at most ``BATCH_BYTES``, however many rows that are; a setting of the session as well."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 10_000)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def pieces(batches: Iterable[pa.RecordBatch], rows: int = ROWS_AT_ONCE) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def giving_back(run: Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """``run``, with the memory that a task has freed handed back to the system at its end.

    Python processes outlive their tasks and wait beside those of later stages; allocators keep what was freed, here as much
    again as is in use.
    """

    def held_no_longer(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        # only glibc has it
        if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
            trim(0)

    return held_no_longer


def texts_of(column: pa.Array) -> list[str]:
    """The texts of a column, NULL as the empty text."""
    return [t or "" for t in column.to_pylist()]


def map_rows(
    df: DataFrame,
    inputs: Sequence[str | Column],
    keep: Sequence[str],
    fields: str,
    compute: Callable[[pa.RecordBatch], Sequence[Sequence]],
    rows: int = ROWS_AT_ONCE,
) -> DataFrame:
    """Columns ``keep`` and those that ``compute`` derives from the ``inputs`` of some rows.

    ``compute`` finds the inputs as columns ``_0``, ``_1``, ... and returns one list for each
    of ``fields``. No shuffle; a task holds one Arrow batch at a time. Only the columns asked
    for are read, so other columns of any name do no harm.
    """
    added = _parse_datatype_string(fields)
    kept = [as_column(c).alias(f"k_{i}") for i, c in enumerate(keep)]
    given = [(as_column(c) if isinstance(c, str) else c).alias(f"_{i}") for i, c in enumerate(inputs)]
    inner = [StructField(f"k_{i}", df.schema[c].dataType) for i, c in enumerate(keep)]
    schema = StructType(inner + [StructField(f"n_{f.name}", f.dataType) for f in added])
    types, names, first = [to_arrow_type(f.dataType) for f in added], schema.names, len(kept)

    def run(batches):
        for part in pieces(batches, rows):
            arrays = [pa.array(v, t) for v, t in zip(compute(part), types)]
            yield pa.RecordBatch.from_arrays([*part.columns[:first], *arrays], names=names)

    return df.select(*kept, *given).mapInArrow(run, schema).toDF(*keep, *added.names)


def add_to_rows(
    df: DataFrame,
    text: str,
    keep: Sequence[str],
    fields: str,
    compute: Callable[[list[str]], Sequence[Sequence]],
    rows: int = ROWS_AT_ONCE,
) -> DataFrame:
    """``map_rows`` over the texts alone: ``compute`` takes a list of them."""
    return map_rows(df, [text], keep, fields, lambda part: compute(texts_of(part.column("_0"))), rows)


def keep_rows(df: DataFrame, text: str, decide: Callable[[list[str]], Sequence[bool]]) -> DataFrame:
    """The rows of ``df`` whose text ``decide`` accepts, all columns as they are."""
    names = [f"_{i}" for i in range(len(df.columns))]
    at = df.columns.index(text)

    def run(batches):
        for part in pieces(batches):
            yield part.filter(pa.array(decide(texts_of(part.column(at))), pa.bool_()))

    schema = StructType([StructField(n, f.dataType) for n, f in zip(names, df.schema)])
    return df.toDF(*names).mapInArrow(run, schema).toDF(*df.columns)


def below_share(hashed: Column, share: float) -> Column:
    """True for this share of all hashes, always the same ones."""
    largest = (1 << 63) - 1
    return F.shiftrightunsigned(hashed, 1) <= F.lit(min(largest, int(share * largest)))


def chosen_by_hash(df: DataFrame, columns: Sequence[str], rows: int) -> DataFrame:
    """The ``rows`` rows with the smallest hashes of ``columns`` (starts a counting job).

    Only about twice as many rows leave their tasks to be sorted, however many tasks there are.
    """
    hashed = F.xxhash64(*columns)
    few = df.filter(below_share(hashed, 2 * rows / max(1, df.count())))
    return few.orderBy(F.shiftrightunsigned(hashed, 1), *columns).limit(rows)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back: later stages, and tasks
    that are run again after an executor is lost, start from the files."""
    folder = scratch_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def in_groups(df: DataFrame, *keys: str) -> DataFrame:
    """Rows with equal keys side by side in one task, for ``groups_of``."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, *keys).sortWithinPartitions(*keys)


def groups_of(batches: Iterable[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """The rows of one value of the first ``keys`` columns at a time; equal values lie side by side."""
    open_parts: list[pa.RecordBatch] = []
    open_key = None
    for batch in batches:
        columns = [np.asarray(batch.column(i)) for i in range(keys)]
        change = np.zeros(batch.num_rows, bool)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        starts = [0, *np.nonzero(change)[0].tolist(), batch.num_rows]
        for start, stop in zip(starts, starts[1:]):
            if start == stop:
                continue
            key = tuple(c[start] for c in columns)
            if open_parts and key != open_key:
                yield pa.Table.from_batches(open_parts)
                open_parts = []
            open_key = key
            open_parts.append(batch.slice(start, stop - start))
    if open_parts:
        yield pa.Table.from_batches(open_parts)


def _with_least(rows: DataFrame) -> DataFrame:
    """``rows`` (a, b) with ``m``, the smallest b of each a.

    The smallest are found within each task first and stored; rows of a node that has very many are dealt out to meet them.
    """
    least = stored(rows.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("n")), "least")
    if least.filter(F.col("n") > HOT_KEY_ROWS).isEmpty():
        return rows.join(least.select("a", "m"), "a")
    return left_join_unique(rows, [least.select("a", "m")], "a")


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable over ``edges`` (a, b); only nodes with edges.

    Alternates large-star and small-star steps, which need a number of rounds
    logarithmic in the number of nodes. Every step is a table in the shared scratch folder, so that plans stay small.
    """
    a, b = F.col("a"), F.col("b")
    now = stored(edges.filter(a != b).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct(), "edges")
    mark = None
    while True:
        both = now.unionByName(now.select(b.alias("a"), a.alias("b")))
        large = _with_least(both).filter(b > a).select(b.alias("a"), F.least(a, F.col("m")).alias("b")).distinct()
        small = _with_least(stored(large, "edges"))
        small = small.select(a, F.col("m").alias("b")).unionByName(small.filter(b != F.col("m")).select(b.alias("a"), F.col("m").alias("b")))
        now = stored(small.distinct(), "edges")
        seen = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if seen == mark:
            break
        mark = seen
    roots = now.select(b.alias("node"), b.alias("component"))
    return now.select(a.alias("node"), b.alias("component")).unionByName(roots).distinct()
