"""Hot keys: same results, and no task that gets a whole hot key."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import neighbours, skew
from ledgerloom.operators.neighbours import adjacent
from ledgerloom.quality import checks


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_repeat_rows(spark):
    df = spark.createDataFrame([("a", 3), ("b", 1), ("c", 0), (None, 2)], "k string, n bigint")
    for per_task in (1, 2, 100):
        assert rows(skew.repeat_rows(df, "n", per_task)) == [("a",)] * 3 + [("b",)] + [(None,)] * 2


def test_copies_of_one_row_are_dealt_out(spark):
    df = spark.createDataFrame([("a", 1000)], "k string, n bigint")
    spread = skew.repeat_rows(df, "n", 10).groupBy(F.spark_partition_id()).count().collect()
    assert len(spread) > 1


@pytest.mark.parametrize("hot_key_rows", [1, 5, 1000])
def test_left_join_unique(spark, hot_key_rows):
    base = spark.createDataFrame(
        [(1, i) for i in range(30)] + [(2, 0), (3, 0), (None, 1), (None, 2), (9, 0), (9, 1)], "k int, v int"
    )
    a = spark.createDataFrame([(1, "x"), (2, "y"), (None, "n")], "k int, a string")
    b = spark.createDataFrame([(1, 1.5), (3, 2.5)], "k int, b double")
    joined = skew.left_join_unique(base, [a, b], "k", hot_key_rows)
    assert joined.columns == ["k", "v", "a", "b"]
    assert rows(joined) == rows(base.join(a, "k", "left").join(b, "k", "left"))


def test_hot_keys_are_dealt_out(spark):
    """A third of the rows on one key, another third without a key: no task gets all of either."""
    base = spark.range(3000).selectExpr("CASE WHEN id % 3 = 0 THEN 7 WHEN id % 3 = 1 THEN id END AS k", "id AS v")
    lookup = spark.range(3000).selectExpr("id AS k", "id * 2 AS a")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = skew.left_join_unique(base, [lookup], "k", 50).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(r["count"] for r in sizes) == 3000 and max(r["count"] for r in sizes) < 1600


def brute_force(data, following):
    """Neighbour of every distinct combination, by sorting each group."""
    def order(v):
        return [(x is None, x) for x in v]

    counts = {}
    for group, *value in data:
        counts[group, tuple(value)] = counts.get((group, tuple(value)), 0) + 1
    expected = []
    for group in {g for g, _ in counts}:
        values = sorted((v for g, v in counts if g == group), key=lambda v: [(n, x or 0) for n, x in order(v)])
        ends = [*values[1:], None] if following else [None, *values[:-1]]
        expected += [(group, *v, counts[group, v], near) for v, near in zip(values, ends)]
    return sorted(expected, key=str)


@pytest.mark.parametrize("following", [True, False])
@pytest.mark.parametrize("ranges", [1, 3, 40])
@pytest.mark.parametrize("seed", [1, 2])
def test_adjacent_against_brute_force(spark, following, ranges, seed):
    rng = random.Random(seed)
    data = [
        (rng.choice(["a", "a", "a", "b", None]), rng.choice([None, *range(15)]), rng.choice([None, *range(4)]))
        for _ in range(300)
    ]
    data += [("a", 7, 1)] * 150  # a third of all rows
    df = spark.createDataFrame(data, "g string, x int, y int")
    near = adjacent(df, {"g": F.col("g")}, {"x": F.col("x"), "y": F.col("y")}, following, ranges)
    found = sorted(
        [(r["g"], r["x"], r["y"], r["copies"], None if r["neighbour"] is None else tuple(r["neighbour"])) for r in near.collect()],
        key=str,
    )
    assert found == brute_force(data, following)


def test_ranges_of_other_types(spark):
    """Boundaries survive the way through text for every kind of key."""
    df = spark.range(500).selectExpr(
        "CAST(id AS STRING) || '\"' AS s",
        "CAST(id / 7 AS DOUBLE) AS d",
        "timestamp_ntz'2024-01-01 00:00:00.000001' + make_interval(0, 0, 0, 0, 0, 0, id) AS t",
        "date_add(date'2024-01-01', CAST(id AS INT)) AS day",
        "CAST(id AS DECIMAL(20, 3)) AS n",
        "id % 2 = 0 AS b",
    )
    for name in df.columns:
        near = adjacent(df, {}, {name: F.col(name)}, True, ranges=25)
        values = sorted(r[0] for r in df.select(name).distinct().collect())
        found = {r[name]: r["neighbour"] and r["neighbour"][name] for r in near.collect()}
        assert found == dict(zip(values, [*values[1:], None]))


def test_many_ranges_are_used(spark):
    """One group holding everything is still cut into ranges."""
    df = spark.range(2000).selectExpr("1 AS g", "id AS v")
    keys = df.select(neighbours._sort_key([F.col("g")], [F.col("v")]).alias("_key"))
    sizes = neighbours._in_ranges(keys, 20).groupBy("_range").count().collect()
    assert len(sizes) >= 15
    assert max(r["count"] for r in sizes) <= 400


def test_hot_value_in_sequence(spark):
    df = spark.createDataFrame([(1,)] * 1000 + [(i,) for i in range(2, 500)], "v int")
    failing = checks.sequential_values(df, "v", ranges=30)
    assert rows(failing) == [(1, 1)] * 999
