"""Nearest neighbours by shifted space-filling curves.

Vectors are projected onto a few random directions and placed on a Hilbert curve, several times with other
directions and shifts of the grid. Spark sorts each ordering by ranges; neighbours in space mostly lie close in one of the
orderings. A query is compared with all vectors in the windows of ranks around its places, block by block
of every ordering; the best of all windows are merged by their distance in double precision.

How wide the windows must be depends on the vectors. It is measured: for a bounded number of queries the nearest vectors are
found by brute force, and the window is the rank distance within which ``AIM`` of these lie in at least one ordering.
Vectors without structure need wide windows, up to the whole ordering; the recall stays.

Directions are drawn from a bounded sample of vectors, so that they lean towards where these spread; every vector
is placed in every ordering. Of equal vectors only as many are placed, the smallest ids first, as a query
can ask for, so that copies crowd nothing out.

Vectors that are NULL, zero, or hold NULL or non-finite components take no part, and vectors are compared with those of their length only.
Rows with equal ids and vectors count once; other rows with a query's id are not its neighbours, and an id
with several vectors is searched for each. Ties are in the order of ids, NULL ids last. An empty table, or one without
queries, gives an empty result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.columns import as_column
from ledgerloom.llm.common import chosen_by_hash, groups_of, in_groups, stored
from ledgerloom.llm.embeddings import _usable

NEIGHBOURS = 10
ORDERS = 6
# Directions of an ordering, and bits of the grid along each: a place has at most 56 bits.
DIRECTIONS = 8
GRID_BITS = 7
# Vectors that directions are drawn from, and queries that are compared with all vectors to set the window.
SAMPLE = 4096
AUDITED = 256
# Share of the audited neighbours that lie within the window.
AIM = 0.96
# Ranks of a block, at least and at most, and rows of queries compared with it at a time.
LEAST_BLOCK = 256
MOST_BLOCK = 4096
_AT_ONCE = 256


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """The places on the Hilbert curve of grid cells, one row each of unsigned coordinates below 2 ** bits."""
    x = cells.astype(np.int64).T.copy()
    dimensions = len(x)
    for level in range(bits - 1, 0, -1):
        low = (1 << level) - 1
        for axis in range(dimensions):
            high = x[axis] >> level & 1 == 1
            swapped = np.where(high, 0, (x[0] ^ x[axis]) & low)
            x[0] ^= np.where(high, low, swapped)
            if axis:
                x[axis] ^= swapped
    # the bits of all axes, read as a Gray code
    place = np.zeros(x.shape[1], np.int64)
    parity = np.zeros(x.shape[1], np.int64)
    for level in range(bits - 1, -1, -1):
        for axis in range(dimensions):
            parity ^= x[axis] >> level & 1
            place = place << 1 | parity
    return place


class Orderings:
    """Directions, scale and shift of every ordering for vectors of one length."""

    def __init__(self, sample: np.ndarray, size: int, orders: int):
        some = len(sample) > 1
        self.centre = sample.mean(axis=0) if some else np.zeros(size)
        self.made = []
        for order in range(orders):
            draw = np.random.default_rng([order, size])
            wide = min(DIRECTIONS, size)
            spread = (sample - self.centre).T @ draw.normal(size=(len(sample), wide)) if some else np.zeros((size, wide))
            # a little of every direction, should the sample span fewer
            spread = spread + draw.normal(size=(size, wide)) * (1e-3 * np.abs(spread).max() + 1e-12)
            directions = np.linalg.qr(spread)[0]
            reach = 4 * float(((sample - self.centre) @ directions).std(axis=0).max()) if some else 1.0
            self.made.append((directions, reach or 1.0, draw.random(wide)))

    def places(self, order: int, vectors: np.ndarray) -> np.ndarray:
        directions, reach, shift = self.made[order]
        with np.errstate(all="ignore"):
            along = np.nan_to_num((vectors - self.centre) @ directions / (2 * reach) + 0.5)
        cells = (np.clip(along, 0, 1) + shift) / 2 * (1 << GRID_BITS)
        return hilbert(np.minimum(cells.astype(np.int64), (1 << GRID_BITS) - 1), GRID_BITS)


def _vectors(column) -> np.ndarray:
    """The vectors of a column as rows; all have one length."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def points_of(df: DataFrame, vector: str, key: str, queries: Column, neighbours: int) -> DataFrame:
    """(number, id, query, size, vector): the vectors to be found, and those to search for, as rows of their own."""
    named = df.select(as_column(key).alias("id"), as_column(vector).cast("array<double>").alias("vector"), queries.alias("query"))
    rows = named.filter(_usable(F.col("vector"))).dropDuplicates(["id", "vector"])
    # a query asks for no more copies than this, one may be itself
    place = F.row_number().over(Window.partitionBy("vector").orderBy(F.asc_nulls_last("id")))
    found = rows.withColumn("_place", place).filter(F.col("_place") <= neighbours + 1).drop("_place").withColumn("query", F.lit(False))
    both = found.unionByName(rows.filter("query"))
    numbered = both.select(F.monotonically_increasing_id().alias("number"), "id", "query", F.size("vector").alias("size"), "vector")
    return stored(numbered, "points")


def _orderings(points: DataFrame, orders: int, sample: int) -> dict[int, Orderings]:
    """One for every length of vectors in a sample of bounded size."""
    rows = chosen_by_hash(points.filter("NOT query").select("number", "vector"), ["number"], sample).toArrow().column("vector")
    vectors = [np.array(v) for v in rows.to_pylist()]
    sizes = sorted({len(v) for v in vectors})
    return {size: Orderings(np.stack([v for v in vectors if len(v) == size]), size, orders) for size in sizes}


def ranked(points: DataFrame, orders: int, sample: int) -> DataFrame:
    """(ordering, rank, number): the rank of every point among all places of an ordering."""
    known = _orderings(points, orders, sample)

    def run(batches):
        for batch in batches:
            sizes = batch.column(1).to_numpy()
            for size in np.unique(sizes).tolist():
                some = batch.filter(pa.array(sizes == size))
                vectors = _vectors(some.column(2))
                ordering = known.get(size) or known.setdefault(size, Orderings(np.zeros((0, size)), size, orders))
                for order in range(orders):
                    arrays = [pa.array(np.full(len(vectors), v), pa.int32()) for v in (size, order)]
                    arrays += [pa.array(ordering.places(order, vectors)), some.column(0)]
                    yield pa.RecordBatch.from_arrays(arrays, names=["size", "ordering", "place", "number"])

    n = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = points.select("number", "size", "vector").mapInArrow(run, "size int, ordering int, place long, number long")
    order = ["size", "ordering", "place", "number"]
    placed = placed.repartitionByRange(n, *order).sortWithinPartitions(*order)
    # the upper bits number the range, the lower ones the rows in it
    placed = stored(placed.select(*order, F.monotonically_increasing_id().alias("row")), "places")
    part = F.shiftright("row", 33)
    counts = placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("rows"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    starts = counts.select("part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("first"))
    placed = placed.withColumn("part", part).join(F.broadcast(starts), "part")
    rank = F.col("first") + F.col("row").bitwiseAND(F.lit((1 << 33) - 1))
    # ranks of different lengths and orderings do not overlap
    return placed.select("size", "ordering", rank.alias("rank"), "number")


def _best(found: DataFrame, neighbours: int) -> DataFrame:
    """The nearest of all that were found for a query, each once."""
    once = found.dropDuplicates(["query_number", "number"])
    order = Window.partitionBy("query_number").orderBy("score", F.asc_nulls_last("id"), "number")
    return once.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= neighbours)


def _distances(query: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        found = np.sqrt(((vectors - query) ** 2).sum(axis=-1))
        wide = np.isinf(found)
        if wide.any():  # squares beyond the largest double
            scale = max(float(np.abs(vectors).max()), float(np.abs(query).max()))
            found[wide] = scale * np.sqrt(((vectors[wide] / scale - query / scale) ** 2).sum(axis=-1))
    return found


def _nearest(queries: np.ndarray, vectors: np.ndarray, own: np.ndarray, neighbours: int):
    """For every query the indexes of its nearest vectors with their distances, ties included; ``own`` is True for what does not count.

    Products of matrices rule out most; what is left is measured exactly.
    """
    with np.errstate(all="ignore"):
        lengths, squares = (queries**2).sum(axis=1), (vectors**2).sum(axis=1)
        rough = lengths[:, None] + squares[None, :] - 2 * (queries @ vectors.T)
        slack = 1e-9 * (lengths + squares.max(initial=0.0))
    for i, query in enumerate(queries):
        if np.isfinite(rough[i]).all() and np.isfinite(slack[i]):
            row = np.where(own[i], np.inf, rough[i])
            limit = np.partition(row, neighbours - 1)[neighbours - 1] if neighbours <= len(row) else np.inf
            some = np.nonzero((row <= limit + 2 * slack[i]) & ~own[i])[0]
        else:
            some = np.nonzero(~own[i])[0]
        distances = _distances(query, vectors[some])
        if len(some) > neighbours:
            near = distances <= np.partition(distances, neighbours - 1)[neighbours - 1]
            some, distances = some[near], distances[near]
        yield some, distances


def _compared(rows: DataFrame, keys: list[str], id_type: str, neighbours: int) -> DataFrame:
    """(query_number, number, id, score) of the nearest in each group; rows have ``keys``, number, id, query and vector."""

    def run(batches):
        for group in groups_of(batches, len(keys)):
            at = {name: group.column(len(keys) + i) for i, name in enumerate(("number", "id", "query", "vector"))}
            query = at["query"].to_numpy()
            if query.all() or not query.any():
                continue
            vectors, numbers, ids = _vectors(at["vector"]), at["number"].to_numpy(), at["id"].combine_chunks()
            others = np.nonzero(~query)[0]
            labels = np.array(ids.to_pylist(), object)
            for start in range(0, int(query.sum()), _AT_ONCE):
                asked = np.nonzero(query)[0][start : start + _AT_ONCE]
                own = labels[asked][:, None] == labels[others][None, :]
                found = list(_nearest(vectors[asked], vectors[others], own, neighbours))
                b = others[np.concatenate([some for some, _ in found])]
                a = np.repeat(numbers[asked], [len(some) for some, _ in found])
                arrays = [pa.array(a), pa.array(numbers[b]), ids.take(pa.array(b)), pa.array(np.concatenate([d for _, d in found]))]
                yield pa.RecordBatch.from_arrays(arrays, names=["query_number", "number", "id", "score"])

    schema = f"query_number long, number long, id {id_type}, score double"
    return in_groups(rows.select(*keys, "number", "id", "query", "vector"), *keys).mapInArrow(run, schema)


def by_brute_force(points: DataFrame, audited: DataFrame, neighbours: int) -> DataFrame:
    """``_best`` of some queries against all vectors: the queries, a bounded number, go to every block."""
    blocks = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    others = points.filter("NOT query").withColumn("block", F.pmod(F.xxhash64("number"), F.lit(blocks)).cast("int"))
    asked = audited.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    rows = others.unionByName(asked)
    found = _compared(rows, ["size", "block"], points.schema["id"].dataType.simpleString(), neighbours)
    return _best(found, neighbours)


def window_of(places: DataFrame, true: DataFrame, aim: float) -> int:
    """The rank distance within which the share ``aim`` of true neighbours lies in at least one ordering."""
    pairs = true.select("query_number", "number")
    near = pairs.join(places.select("number", "size", "ordering", "rank"), "number")
    query = places.select(F.col("number").alias("query_number"), "size", "ordering", F.col("rank").alias("query_rank"))
    apart = near.join(query, ["query_number", "size", "ordering"]).groupBy("query_number", "number")
    apart = apart.agg(F.min(F.abs(F.col("rank") - F.col("query_rank"))).alias("apart"))
    rows = sorted(r["apart"] for r in apart.collect())  # as many as audited neighbours
    return rows[min(len(rows) - 1, int(np.ceil(aim * len(rows))))] if rows else 1


def search(
    df: DataFrame,
    queries: Column,
    vector: str = "embedding",
    key: str = "vec_id",
    neighbours: int = NEIGHBOURS,
    orders: int = ORDERS,
    audited: int = AUDITED,
    aim: float = AIM,
    sample: int = SAMPLE,
) -> DataFrame:
    """(query_id, rank, vec_id, score) of the nearest vectors found for the rows where ``queries`` is true.

    Score is the Euclidean distance. The window is set by ``audited`` of the queries and the share ``aim``.
    """
    id_type = df.schema[key].dataType.simpleString()
    points = points_of(df, vector, key, F.coalesce(queries, F.lit(False)), neighbours)
    places = stored(ranked(points, orders, sample), "ranks")
    few = chosen_by_hash(points.filter("query"), ["number"], audited)
    true = by_brute_force(points, stored(few, "audited"), neighbours)
    window = window_of(places, true, aim)

    block = min(MOST_BLOCK, max(LEAST_BLOCK, window))
    first, last = (F.floor(r / block) for r in (F.greatest(F.col("rank") - window, F.lit(0)), F.col("rank") + window))
    # one shuffle of the vectors by number, another one to their blocks
    asked = F.when(F.col("query"), F.sequence(first, last)).otherwise(F.array(F.floor(F.col("rank") / block)))
    rows = places.drop("size").join(points, "number")
    rows = rows.withColumn("block", F.explode(asked)).select("size", "ordering", "block", "number", "id", "query", "vector")
    best = _best(_compared(rows, ["size", "ordering", "block"], id_type, neighbours), neighbours)
    names = points.filter("query").select(F.col("number").alias("query_number"), F.col("id").alias("query_id"))
    return best.join(names, "query_number").select("query_id", "rank", F.col("id").alias(key), "score")


def every(key: str, divisor: int) -> Column:
    """Rows whose id is divisible by ``divisor``, as queries."""
    return F.pmod(as_column(key), F.lit(divisor)) == 0
