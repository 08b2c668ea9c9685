import brute
import duckdb
import numpy as np
import pandas as pd
from compare import duck_result, spark_result

from ledgerloom.llm import embeddings
from ledgerloom.llm.queries import ORACLES, QUERIES


def rows_of(spark, df, **options):
    return embeddings.near_duplicates(df, **options).toPandas().sort_values("vec_id").reset_index(drop=True)


def expected(vectors, threshold=0.95):
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    linked = unit @ unit.T >= threshold
    return linked.sum(axis=1) - 1, brute.components(len(vectors), list(zip(*np.nonzero(linked))))


def test_against_all_pairs(spark):
    """Groups larger than a list and than a block, copies, and many vectors alone."""
    draw = np.random.default_rng(5)
    centres = draw.normal(size=(12, 16))
    near = [c + 0.05 * draw.normal(size=(n, 16)) for c, n in zip(centres, [1, 2, 3, 5, 8, 13, 21, 34, 55, 60, 60, 120])]
    vectors = np.concatenate([*near, draw.normal(size=(300, 16)), np.repeat(centres[:1], 40, axis=0)])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    found = rows_of(spark, df)
    links, component = expected(vectors)
    assert found.component_id.tolist() == component
    assert found.n_links.sum() >= 0.98 * links.sum() and (found.n_links <= links).all()
    assert (found.kept == (found.vec_id == found.component_id)).all()


def test_blocks_count_every_pair_once(spark):
    draw = np.random.default_rng(6)
    vectors = draw.normal(size=8) + 0.2 * draw.normal(size=(90, 8))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    nodes = embeddings.nodes_of(df, "embedding", "vec_id")
    members = nodes.selectExpr("node", "0L AS component")
    counts = embeddings.count_links(nodes, members, 0.95, block=20).toPandas().set_index("node").links
    numbers = {r["node"]: r["first"] for r in nodes.collect()}
    links, _ = expected(vectors)
    assert all(counts[node] == links[i] for node, i in numbers.items())


def test_hard_rows(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [
        (0, None), (1, []), (2, [0.0, 0.0]), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [None, 1.0]), (6, [1.0]),
        (7, [1.0, 0.0]), (7, [1.0, 0.0]), (8, [2.0, 0.0]), (9, [1e300, 1e299]), (10, [-1.0, 0.0]), (None, [1.0, 0.0]), (None, None),
    ]
    df = spark.createDataFrame([(*r, 0, 0) for r in vectors], "vec_id long, embedding array<double>, node int, links int")
    found = {(r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in embeddings.near_duplicates(df).collect()}
    alone = {(i, 0, i, True) for i in (0, 1, 2, 3, 4, 5, 6, 10, None)}
    # 7 twice, 8, 9 and the vector without an id point the same way, 9 within the threshold
    linked = {(7, 4, 7, True), (8, 4, 7, False), (9, 4, 7, False), (None, 4, 7, True)}
    assert found == alone | linked
    assert embeddings.near_duplicates(df.filter("false")).count() == 0


def test_vectors_of_another_length_do_no_harm(spark):
    """One longer row, faulty or not, leaves the links of all others; equal lengths find each other."""
    draw = np.random.default_rng(7)
    vectors = [(draw.normal(size=8) + 10).tolist() for _ in range(30)]
    rows = [*enumerate(vectors), (30, [float("nan")] * 9), (31, [1.0] * 9), (32, [1.0] * 8 + [1.01]), (33, [1.0])]
    found = rows_of(spark, spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    links, component = expected(np.array(vectors))
    assert links.sum() > 0
    assert found.n_links.tolist() == [*links.tolist(), 0, 1, 1, 0]
    assert found.component_id.tolist() == [*component, 30, 31, 31, 33]


def test_links_between_saturated_lists(spark):
    """Two tight groups whose cross cosines are 0.96 fill all lists with their own members."""
    draw = np.random.default_rng(8)
    angle = np.arccos(0.96)
    centres = np.array([[1.0, 0, 0, 0, 0, 0], [np.cos(angle), np.sin(angle), 0, 0, 0, 0], [0, 0, 1.0, 0, 0, 0]])
    vectors = np.concatenate([c + 1e-4 * draw.normal(size=(14, 6)) for c in centres])
    nodes = embeddings.nodes_of(
        spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>"),
        "embedding", "vec_id",
    )
    number = {r["first"]: r["node"] for r in nodes.collect()}
    members = spark.createDataFrame([(number[i], min(number[j] for j in range(42) if j // 14 == i // 14)) for i in range(42)], "node long, component long")
    lists = [(number[i], number[j], 1.0) for i in range(42) for j in range(42) if i // 14 == j // 14 and 0 < (j - i) % 14 <= 10]
    graph = spark.createDataFrame(lists, "a long, b long, sim float")
    found = {r["node"]: r["component"] for r in embeddings.across(nodes, graph, members, 10, 0.95, block=5).collect()}
    assert len({found[number[i]] for i in range(28)}) == 1 and len({found[number[i]] for i in range(42)}) == 2
    counts = embeddings.count_links(nodes, spark.createDataFrame(list(found.items()), "node long, component long"), 0.95)
    links, _ = expected(vectors)
    assert {r["node"]: r["links"] for r in counts.collect()} == {number[i]: n for i, n in enumerate(links)}


def test_audit_sees_small_groups_beside_a_large_one(spark):
    """All links of the pairs are missing beside a hot group that has nearly all links, or beside nothing."""
    draw = np.random.default_rng(9)
    pairs = np.repeat(draw.normal(size=(15, 32)), 2, axis=0)
    pairs[::2] += 1e-3
    vectors = np.concatenate([draw.normal(size=32) + 1e-3 * draw.normal(size=(300, 32)), pairs])
    for rows, hot in ((vectors, 300), (pairs, 0)):
        df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rows)], "vec_id long, embedding array<double>")
        nodes = embeddings.nodes_of(df, "embedding", "vec_id")
        number = {r["first"]: r["node"] for r in nodes.collect()}
        found = spark.createDataFrame([(number[i], number[0], hot - 1) for i in range(hot)], "node long, component long, links long")
        recall, lacking = embeddings.audit(nodes, found, 0.95)
        assert recall < embeddings.RECALL
        assert {r["a"] for r in lacking.collect()} == {number[i] for i in range(hot, len(rows))}


def test_query_with_planted_links(spark, tmp_path):
    """The given vectors and planted groups, chains and faulty rows, against SQL over all pairs."""
    draw = np.random.default_rng(9)
    given = pd.read_parquet("/root/testdata/sf0.01/embeddings.parquet")
    vectors = np.stack(given.embedding).astype(float)
    planted = [v + 0.02 * draw.normal(size=v.shape) for v, n in zip(vectors, [1, 2, 3, 15, 40]) for _ in range(n)]
    chain = [vectors[50] * np.cos(a) + vectors[60] * np.sin(a) for a in np.arange(1, 6) * 0.25]
    odd = [None, [0.0] * 64, [float("nan")] * 64, [None] * 64]
    extra = [v.tolist() for v in [*planted, *chain, vectors[7], vectors[7] * 3]] + odd
    more = pd.DataFrame({"vec_id": range(10_000, 10_000 + len(extra)), "embedding": extra, "label": 0})
    folder = str(tmp_path)
    pd.concat([given, more]).astype({"label": "int32"}).to_parquet(f"{folder}/embeddings.parquet")
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{folder}/embeddings.parquet')")
    name = "op9_embedding_nn_descent"
    schema, rows = spark_result(QUERIES[name](spark, folder))
    expected_schema, wanted = duck_result(connection, ORACLES[name])
    assert schema == expected_schema and rows == wanted
    assert sum(r[2] for r in rows) > 1000 and sum(not r[1] for r in rows) > 60
