"""Near-duplicate vectors by neighbour descent.

Equal vectors become one node with a weight. A first neighbour graph joins nodes that lie close in a few
random sort orders (signs of random projections). Then neighbours of neighbours are compared round by round:
around every node the vectors of its neighbours meet in one task, and each keeps the best it has seen. Rounds
end when they hardly find links any more.

A list full of links is saturated: there may be more than fit in. Nodes with such lists are compared with
those of all other components, block by block; only blocks whose centres and radii rule out a link are left
out. Then the members of every component are compared in blocks, in double precision; only counts leave a block. Finally recall is audited: samples of the nodes of every size of component, and of those
without links, are compared with all others. As long as one of them lacks too many links, lists are doubled, further sort orders
added and the descent goes on; if few or no links were found, all nodes without links are compared.

Vectors that are NULL, zero, or hold NULL or non-finite components link with nothing and are their own
component. Vectors are compared with those of their own length only, so that a faulty row says nothing about the others. Copies are linked, repeated rows too, and count each; vectors in the same direction are equal only if their
components are. NULL ids take part, but do not name a component unless all its ids are NULL. An empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.columns import as_column
from ledgerloom.llm.common import below_share, connected_components, groups_of, in_groups, pieces, stored
from ledgerloom.operators.skew import left_join_unique

THRESHOLD = 0.95
# Neighbours of a node to begin with.
NEIGHBOURS = 10
# Random sort orders, the projections each is made of, and how far apart in it nodes are compared.
ORDERS = 6
PROJECTIONS = 24
REACH = 12
# Rounds end when they add less than this share of links and of neighbours.
NEW_LINKS = 0.002
NEW_NEIGHBOURS = 0.01
# Nodes of each size of components whose links are counted by brute force, and the share of their links to be found.
AUDITED = 400
RECALL = 0.98
# Missed nodes that an audit may overlook by chance (95 % sure of fewer), and audited nodes the driver holds at a time.
ALLOWANCE = 3
AT_ONCE = 8192
# Vectors of a component that one side of a block holds.
BLOCK = 512
# Centres of blocks that one side of a group holds.
CHUNK = 2048
# Slack of single precision, in which the descent compares.
_SLACK = 1e-4


def _usable(vector: Column) -> Column:
    """Finite, not zero."""
    finite = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _matrix(column, kind: str) -> np.ndarray:
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), kind).reshape(len(rows), -1)


def _widths(column) -> Iterator[tuple[int, np.ndarray]]:
    """Every length in bytes among the vectors of a column and the rows that have it."""
    sizes = np.array([len(v) for v in column.to_pylist()], np.int64)
    for size in np.unique(sizes).tolist():
        yield size, np.nonzero(sizes == size)[0]


def nodes_of(df: DataFrame, vector: str, key: str) -> DataFrame:
    """Different usable vectors: node, first (smallest key), copies, vector, unit and small (binary, single precision)."""
    named = df.select(as_column(key).alias("id"), as_column(vector).cast("array<double>").alias("vector"))
    usable = named.filter(_usable(F.col("vector")))
    different = usable.groupBy("vector").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("copies"))

    def run(batches):
        for batch in batches:
            sizes = batch.column(0).value_lengths().to_numpy(zero_copy_only=False)
            for size in np.unique(sizes):
                some = batch.filter(pa.array(sizes == size))
                raw = some.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
                raw = raw / np.abs(raw).max(axis=1, keepdims=True)
                unit = raw / np.linalg.norm(raw, axis=1, keepdims=True)
                both = [pa.array([r.tobytes() for r in m], pa.binary()) for m in (unit, unit.astype("<f4"))]
                yield pa.RecordBatch.from_arrays([*some.columns, *both], names=["vector", "first", "copies", "unit", "small"])

    first = different.schema["first"].dataType.simpleString()
    made = different.mapInArrow(run, f"vector array<double>, first {first}, copies long, unit binary, small binary")
    return stored(made.withColumn("node", F.monotonically_increasing_id()), "nodes")


_EDGES = "a long, b long, sim float"
_EDGE_TYPES = (pa.int64(), pa.int64(), pa.float32())


def _edges(a: np.ndarray, b: np.ndarray, sim: np.ndarray) -> pa.RecordBatch:
    arrays = [pa.array(v, t) for v, t in zip((a, b, sim.astype(np.float32)), _EDGE_TYPES)]
    return pa.RecordBatch.from_arrays(arrays, names=["a", "b", "sim"])


def first_graph(nodes: DataFrame, orders: range, best: int, reach: int = REACH) -> DataFrame:
    """Edges to the ``best`` of the nodes at most ``reach`` places away in each random order."""

    def codes(batches):
        for batch in batches:
            for size, rows in _widths(batch.column(1)):
                some = batch.take(pa.array(rows))
                vectors = _matrix(some.column(1), "<f4")
                for order in orders:
                    planes = np.random.default_rng(order).normal(size=(vectors.shape[1], PROJECTIONS))
                    code = (vectors @ planes > 0) @ (1 << np.arange(PROJECTIONS)) + (order << PROJECTIONS)
                    arrays = [pa.array(np.full(len(rows), size), pa.int32()), pa.array(code, pa.int64()), *some.columns]
                    yield pa.RecordBatch.from_arrays(arrays, names=["size", "code", "node", "small"])

    def near(batches):
        ids, vectors = np.zeros(0, np.int64), None
        for batch in (batch.take(pa.array(rows)) for batch in batches for _, rows in _widths(batch.column(3))):
            own = _matrix(batch.column(3), "<f4")
            if vectors is not None and vectors.shape[1] != own.shape[1]:
                ids, vectors = np.zeros(0, np.int64), None
            old = len(ids)
            ids = np.concatenate([ids, np.asarray(batch.column(2))])
            vectors = own if vectors is None else np.concatenate([vectors, own])
            n = len(ids)
            sims, other = np.full((n, 2 * reach), -2.0, np.float32), np.zeros((n, 2 * reach), np.int64)
            for step in range(1, min(reach, n - 1) + 1):
                sim = np.einsum("ij,ij->i", vectors[:-step], vectors[step:])
                sim[ids[:-step] == ids[step:]] = -2
                sims[:-step, step - 1], other[:-step, step - 1] = sim, ids[step:]
                sims[step:, reach + step - 1], other[step:, reach + step - 1] = sim, ids[:-step]
            top = np.argsort(-sims, axis=1)[:, :best]
            rows = np.arange(n)[:, None]
            sim, b = sims[rows, top], other[rows, top]
            # rows carried over were listed before; now they also see what follows
            good = sim > -2
            if old or good.any():
                yield _edges(np.broadcast_to(ids[:, None], b.shape)[good], b[good], sim[good])
            ids, vectors = ids[-reach:], vectors[-reach:]

    n = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = nodes.select("node", "small").mapInArrow(codes, "size int, code long, node long, small binary")
    place = ["size", "code", "node"]
    return placed.repartitionByRange(n, *place).sortWithinPartitions(*place).mapInArrow(near, _EDGES)


def _best(edges: DataFrame, most: int) -> DataFrame:
    """The ``most`` nearest neighbours of every node; ``fresh`` is 1 for edges not seen before."""
    once = edges.groupBy("a", "b").agg(F.max("sim").alias("sim"), F.min("fresh").alias("fresh"))
    place = F.row_number().over(Window.partitionBy("a").orderBy(F.desc("sim"), "b"))
    return once.withColumn("_place", place).filter(F.col("_place") <= most).drop("_place")


def _round(graph: DataFrame, nodes: DataFrame, most: int) -> DataFrame:
    """Neighbours of a node become neighbours of each other where that is nearer than what they have."""
    back = graph.select(F.col("b").alias("a"), F.col("a").alias("b"), "sim", "fresh")
    around = _best(graph.unionByName(back), 2 * most)
    news = around.groupBy("a").agg(F.max("fresh").alias("any")).filter("any = 1").select("a")
    worst = graph.groupBy(F.col("a").alias("b")).agg(F.min("sim").alias("worst"), F.count(F.lit(1)).alias("have"))
    worst = worst.select("b", F.when(F.col("have") >= most, F.col("worst")).otherwise(F.lit(-1.0)).cast("float").alias("worst"))
    vectors = nodes.select(F.col("node").alias("b"), "small")
    met = around.select("a", "b", "fresh").join(news, "a", "left_semi").join(worst, "b", "left").join(vectors, "b")
    met = met.select("a", "b", "fresh", F.coalesce("worst", F.lit(-1.0)).cast("float").alias("worst"), "small")

    def join(batches):
        for group in groups_of(batches, 1):
            ids, fresh, least = (group.column(i).to_numpy() for i in (1, 2, 3))
            vectors = _matrix(group.column(4), "<f4")
            sims = vectors @ vectors.T
            new = (fresh[:, None] + fresh[None, :] > 0) & (ids[:, None] != ids[None, :])
            i, j = np.nonzero(new & (sims > least[:, None]))
            if len(i):
                yield _edges(ids[i], ids[j], sims[i, j])

    found = in_groups(met, "a").mapInArrow(join, _EDGES).withColumn("fresh", F.lit(1))
    return _best(graph.withColumn("fresh", F.lit(0)).unionByName(found), most)


def descend(graph: DataFrame, nodes: DataFrame, most: int, threshold: float) -> DataFrame:
    """Rounds until hardly any neighbours are new, and hardly any links in lists that hold others besides.

    Lists full of links are left out of the second count, so that those of a large group do not end the descent.
    """
    link, new = F.col("sim") >= threshold - _SLACK, F.col("fresh") == 1
    while True:
        graph = stored(_round(graph, nodes, most), "graph")
        lists = graph.groupBy("a").agg(
            F.count(F.lit(1)).alias("have"), F.count_if(new).alias("new"),
            F.count_if(link).alias("links"), F.count_if(link & new).alias("new_links"),
        )
        sums = [F.coalesce(F.sum(c), F.lit(0)) for c in ("have", "new")]
        sums += [F.coalesce(F.sum(F.when(F.col("links") < most, F.col(c))), F.lit(0)) for c in ("links", "new_links")]
        have, fresh, links, new_links = lists.agg(*[c.alias(f"s{i}") for i, c in enumerate(sums)]).first()
        if fresh <= NEW_NEIGHBOURS * have and new_links <= NEW_LINKS * links:
            return graph


def _exact(nodes: DataFrame, edges: DataFrame, threshold: float) -> DataFrame:
    """The edges (a, b) whose cosine in double precision reaches the threshold."""
    once = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    sides = [nodes.select(F.col("node").alias(n), F.col("unit").alias(f"{n}_unit")) for n in ("a", "b")]
    both = once.join(sides[0], "a").join(sides[1], "b").select("a", "b", "a_unit", "b_unit")

    def check(batches):
        for batch in batches:
            for _, rows in _widths(batch.column(2)):
                some = batch.take(pa.array(rows))
                left, right = (_matrix(some.column(i), "<f8") for i in (2, 3))
                good = np.einsum("ij,ij->i", left, right) >= threshold
                yield some.select([0, 1]).filter(pa.array(good))

    return both.mapInArrow(check, "a long, b long")


def count_links(nodes: DataFrame, members: DataFrame, threshold: float, block: int = BLOCK) -> DataFrame:
    """(node, links): for every node of a component the rows it is linked with, other than copies of itself.

    The members of a component are dealt into blocks; every pair of blocks is one group.
    """
    sizes = members.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    dealt = left_join_unique(members, [sizes], "component").withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select(
        "component", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "node", "own"
    )
    met = dealt.join(nodes.select("node", "copies", "unit"), "node")
    met = met.select("component", "i", "j", "node", "own", "copies", "unit")

    def run(batches):
        for group in groups_of(batches, 3):
            i, j, ids, own, copies = (group.column(k).to_numpy() for k in (1, 2, 3, 4, 5))
            vectors = _matrix(group.column(6), "<f8")
            linked = vectors @ vectors.T >= threshold
            if i[0] != j[0]:  # pairs within a block are counted in its own group
                linked &= own[:, None] != own[None, :]
            np.fill_diagonal(linked, False)
            arrays = [pa.array(ids, pa.int64()), pa.array(linked @ copies, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=["node", "links"])

    counts = in_groups(met, "component", "i", "j").mapInArrow(run, "node long, links long")
    return counts.groupBy("node").agg(F.sum("links").alias("links"))


def _saturated(graph: DataFrame, members: DataFrame, most: int, threshold: float, block: int) -> DataFrame:
    """(component, block, node) of the nodes whose lists hold nothing but links, dealt into blocks of a component."""
    near = graph.filter(F.col("sim") >= threshold - _SLACK).groupBy(F.col("a").alias("node")).agg(F.count(F.lit(1)).alias("n"))
    full = near.filter(F.col("n") >= most).select("node").join(members, "node", "left")
    full = full.select(F.coalesce("component", "node").alias("component"), "node")
    sizes = full.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    dealt = left_join_unique(full, [sizes], "component")
    return dealt.select("component", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("block"), "node")


def _centres(met: DataFrame) -> DataFrame:
    """(component, block, centre, radius): a unit vector and the largest angle between it and a vector of the block."""

    def run(batches):
        for group in groups_of(batches, 2):
            vectors = _matrix(group.column(3), "<f8")
            centre = vectors.mean(axis=0)
            length = np.linalg.norm(centre)
            centre = centre / length if length > 1e-6 else vectors[0]
            radius = float(np.arccos(np.clip(vectors @ centre, -1, 1)).max())
            key = [group.column(i).slice(0, 1).to_pylist() for i in (0, 1)]
            arrays = [pa.array(v, t) for v, t in zip((*key, [centre.tobytes()], [radius]), _CENTRE_TYPES)]
            yield pa.RecordBatch.from_arrays(arrays, names=["component", "block", "centre", "radius"])

    return in_groups(met, "component", "block").mapInArrow(run, "component long, block int, centre binary, radius double")


_CENTRE_TYPES = (pa.int64(), pa.int32(), pa.binary(), pa.float64())
_PAIR_TYPES = (pa.int64(), pa.int32(), pa.int64(), pa.int32())
_PAIRS = ["component", "block", "other", "other_block"]


def _pairs(centres: DataFrame, threshold: float, chunk: int) -> DataFrame:
    """The pairs of blocks of two components that may hold a link: (component, block, other, other_block).

    Two vectors are at least as far apart as the centres of their blocks less both radii.
    """
    chunks = -(-centres.count() // chunk)
    dealt = centres.withColumn("own", F.pmod(F.xxhash64("component", "block"), F.lit(chunks)).cast("int"))
    dealt = dealt.withColumn("with", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    dealt = dealt.select(F.least("own", "with").alias("i"), F.greatest("own", "with").alias("j"), "own", *centres.columns)
    widest = float(np.arccos(threshold)) + 1e-6

    def run(batches):
        for group in groups_of(batches, 2):
            for _, rows in _widths(group.column(5)):
                some = group.take(pa.array(rows))
                own, component, block, radius = (some.column(k).to_numpy() for k in (2, 3, 4, 6))
                centre = _matrix(some.column(5), "<f8")
                left, right = own == some.column(0)[0].as_py(), own == some.column(1)[0].as_py()
                angles = np.arccos(np.clip(centre[left] @ centre[right].T, -1, 1))
                near = angles <= widest + radius[left][:, None] + radius[right][None, :]
                one, two = component[left][:, None], component[right][None, :]
                # within a chunk every pair is met twice
                near &= one < two if (left == right).all() else one != two
                a, b = np.nonzero(near)
                columns = (component[left][a], block[left][a], component[right][b], block[right][b])
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(columns, _PAIR_TYPES)], names=_PAIRS)

    return in_groups(dealt, "i", "j").mapInArrow(run, "component long, block int, other long, other_block int")


def across(
    nodes: DataFrame, graph: DataFrame, members: DataFrame, most: int, threshold: float, block: int = BLOCK
) -> DataFrame:
    """``members`` with the components as one that links between saturated lists join."""
    full = stored(_saturated(graph, members, most, threshold, block), "saturated")
    met = full.join(nodes.select("node", "unit"), "node").select("component", "block", "node", "unit")
    centres = stored(_centres(met), "centres")
    if centres.isEmpty():
        return members
    pairs = stored(_pairs(centres, threshold, CHUNK), "pairs")
    sides = [
        pairs.join(met.select(*[F.col(c).alias(k) for c, k in zip(("component", "block"), keys)], "unit"), keys)
        .select(*_PAIRS, F.lit(side).alias("side"), "unit")
        for side, keys in enumerate((_PAIRS[:2], _PAIRS[2:]))
    ]

    def run(batches):
        for group in groups_of(batches, 4):
            side = group.column(4).to_numpy()
            vectors = _matrix(group.column(5), "<f8")
            if (vectors[side == 0] @ vectors[side == 1].T >= threshold).any():
                ends = [pa.array([group.column(k)[0].as_py()], pa.int64()) for k in (0, 2)]
                yield pa.RecordBatch.from_arrays(ends, names=["a", "b"])

    joined = connected_components(in_groups(sides[0].unionByName(sides[1]), *_PAIRS).mapInArrow(run, "a long, b long"))
    joined = joined.select(F.col("node").alias("component"), F.col("component").alias("whole"))
    alone = full.select("node").join(members, "node", "left_anti").select("node", F.col("node").alias("component"))
    every = left_join_unique(members.unionByName(alone), [joined], "component")
    return stored(every.select("node", F.coalesce("whole", "component").alias("component")), "members")


def _checked(nodes: DataFrame, sample: DataFrame, threshold: float) -> DataFrame:
    """(node, actual, b): for the nodes of a sample that have links, their links counted against all nodes and one of them."""
    spark = nodes.sparkSession
    rows = sample.select("node", "unit").collect()
    queries = {}
    for size in {len(r["unit"]) for r in rows}:
        some = [r for r in rows if len(r["unit"]) == size]
        unit = np.frombuffer(b"".join(bytes(r["unit"]) for r in some), "<f8").reshape(len(some), -1)
        queries[size] = (np.array([r["node"] for r in some]), unit)

    def run(batches):
        true = {size: np.zeros(len(ids), np.int64) for size, (ids, _) in queries.items()}
        other = {size: np.full(len(ids), -1, np.int64) for size, (ids, _) in queries.items()}
        for batch in pieces(batches, BLOCK):
            for size, rows in _widths(batch.column(1)):
                if size not in queries:
                    continue
                some = batch.take(pa.array(rows))
                ids, unit = queries[size]
                b = np.asarray(some.column(0))
                linked = unit @ _matrix(some.column(1), "<f8").T >= threshold
                linked &= ids[:, None] != b[None, :]
                true[size] += linked @ np.asarray(some.column(2))
                any_link = linked.any(axis=1)
                other[size][any_link] = b[linked.argmax(axis=1)][any_link]
        for size, (ids, _) in queries.items():
            found = true[size] > 0
            arrays = [pa.array(v[found], pa.int64()) for v in (ids, true[size], other[size])]
            yield pa.RecordBatch.from_arrays(arrays, names=["node", "actual", "b"])

    fields = "node long, actual long, b long"
    if not queries:
        return spark.createDataFrame([], fields)
    parts = nodes.select("node", "unit", "copies").mapInArrow(run, fields)
    return stored(parts.groupBy("node").agg(F.sum("actual").alias("actual"), F.min("b").alias("b")), "checked")


def audit(
    nodes: DataFrame, found: DataFrame, threshold: float, audited: int = AUDITED, salt: int = 0
) -> tuple[float, DataFrame]:
    """The recall of the worst size class of components, and an edge for every audited node that lacks links.

    Classes are powers of two; every one has its own sample, and a node counts as much as any other, so that large
    components hide nothing. Nodes without links are a class as well. Of these so many are audited that
    those missed, ALLOWANCE more than were seen, can be weighed against all nodes with links; all of them if few or no
    links were found, so that a sample without links proves nothing.
    """
    sizes = found.groupBy("component").agg(F.floor(F.log2(F.count(F.lit(1)))).cast("int").alias("class"))
    known = left_join_unique(found.filter("links > 0"), [sizes], "component").select("node", "links", "class")
    every = nodes.select("node", "unit").join(known, "node", "left").withColumn("class", F.coalesce("class", F.lit(0)))
    totals = {r["class"]: r["count"] for r in every.groupBy("class").count().collect()}
    alone, linked = totals.get(0, 0), sum(n for kind, n in totals.items() if kind)
    lost = (1 - RECALL) / RECALL * linked  # nodes without links that may have some
    wanted = {kind: audited for kind in totals}
    wanted[0] = min(alone, max(audited, int(np.ceil(2 * ALLOWANCE * alone / lost)))) if linked else alone
    hashed = F.xxhash64("node", F.lit(salt))
    few = [(F.col("class") == kind) & below_share(hashed, wanted[kind] / total) for kind, total in totals.items()]
    some = every.filter(reduce(or_, few, F.lit(False)))
    parts = max(1, -(-sum(wanted.values()) // AT_ONCE))
    checked = []
    for part in range(parts):
        sample = some.filter(F.pmod(F.xxhash64("node", F.lit(salt + 1)), F.lit(parts)) == part)
        checked.append(_checked(nodes, sample, threshold))
    checked = reduce(DataFrame.unionByName, checked).join(known, "node", "left").withColumn("class", F.coalesce("class", F.lit(0)))
    share = F.coalesce(F.col("links") / F.col("actual"), F.lit(0.0))
    sums = checked.groupBy("class").agg(F.count(F.lit(1)).alias("n"), F.sum(share).alias("share")).collect()
    sums = {r["class"]: (r["n"], r["share"]) for r in sums}
    missed = sums.pop(0, (0, 0.0))[0]
    if alone and wanted[0] < alone:
        missed = (missed + ALLOWANCE) * alone / wanted[0]
    recalls = [found_share / n for n, found_share in sums.values()]
    if missed:
        recalls.append(linked / (linked + missed))
    return min(recalls, default=1.0), checked.filter("links IS NULL OR links < actual").select(F.col("node").alias("a"), "b")


def links(nodes: DataFrame, threshold: float = THRESHOLD, neighbours: int = NEIGHBOURS) -> DataFrame:
    """(node, component, links) for every node that has links to other nodes."""
    most, orders, graph, known, salt = neighbours, range(ORDERS), None, None, 0
    while True:
        edges = first_graph(nodes, orders, most).withColumn("fresh", F.lit(1))
        edges = edges if graph is None else edges.unionByName(graph.withColumn("fresh", F.lit(0)))
        graph = descend(stored(_best(edges, most), "graph"), nodes, most, threshold)
        near = graph.filter(F.col("sim") >= threshold - _SLACK)
        counted = _counted(nodes, graph, near.select("a", "b"), known, most, threshold)
        recall, lacking = audit(nodes, counted, threshold, salt=salt)
        lacking = stored(lacking, "lacking")
        found_more = not lacking.isEmpty()
        if found_more:
            known = lacking if known is None else known.unionByName(lacking)
        if recall >= RECALL:
            return _counted(nodes, graph, near.select("a", "b"), known, most, threshold) if found_more else counted
        # the random orders were unlucky; what the audit found is kept, and the next one takes other nodes
        most, orders, salt = 2 * most, range(orders.stop, orders.stop + ORDERS), salt + 2


def _counted(
    nodes: DataFrame, graph: DataFrame, near: DataFrame, known: DataFrame | None, most: int, threshold: float
) -> DataFrame:
    """(node, component, links) from the links of the graph and others that are known."""
    members = connected_components(_exact(nodes, near if known is None else near.unionByName(known), threshold))
    members = across(nodes, graph, stored(members, "members"), most, threshold)
    return stored(members.join(count_links(nodes, members, threshold), "node"), "links")


def near_duplicates(
    df: DataFrame, vector: str = "embedding", key: str = "vec_id", threshold: float = THRESHOLD, neighbours: int = NEIGHBOURS
) -> DataFrame:
    """Key, n_links, component_id and kept for every row."""
    nodes = nodes_of(df, vector, key)
    found = nodes.join(links(nodes, threshold, neighbours), "node", "left")
    found = found.withColumn("component", F.coalesce("component", "node"))
    least = found.groupBy("component").agg(F.min("first").alias("component_id"))
    found = left_join_unique(found, [least], "component").select(
        "vector", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"
    )
    # rows without a node have vectors that link with nothing
    named = df.select(as_column(key).alias("id"), as_column(vector).cast("array<double>").alias("vector"))
    out = left_join_unique(named, [found], "vector")  # a vector may be that of a third of all rows
    component = F.when(F.col("n_links").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return out.select(
        F.col("id").alias(key),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )
