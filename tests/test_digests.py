"""Differences by digests against the plain comparison."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators.digests import differing_buckets, except_by_digests, suspects
from ledgerloom.operators.setops import except_both_ways


def rows(df):
    return sorted(map(str, df.collect()))


def table(spark, data):
    return spark.createDataFrame(data, "k int, a string, v double, l array<int>, s struct<x:int,y:string>")


@pytest.mark.parametrize("multiset", [False, True])
@pytest.mark.parametrize("buckets", [1, 7, 1 << 16])
def test_against_the_plain_comparison(spark, multiset, buckets):
    draw = random.Random(buckets)

    def row():
        return (draw.choice([1, 2, None]), draw.choice(["x", "", None]), draw.choice([0.0, -0.0, 1.5, float("nan"), None]), draw.choice([[1, None], [None, 1], [], None]), draw.choice([(1, None), (None, "1"), None]))

    a = [row() for _ in range(60)]
    b = a[:40] + [row() for _ in range(15)]
    one, other = table(spark, a), table(spark, b)
    assert rows(except_by_digests(one, other, multiset=multiset, buckets=buckets)) == rows(except_both_ways(one, other, multiset=multiset))
    assert except_by_digests(one, one.orderBy(F.rand(1)), multiset=multiset, buckets=buckets).count() == 0


@pytest.mark.parametrize(
    "one,other",
    [
        ((1, "a", 1.0, [1], (1, "b")), (1, None, 1.0, [1], (1, "b"))),
        ((None, "a", None, [None, 1], (1, None)), (None, "a", None, [1, None], (1, None))),
        ((1, "a", 1.0, [], (None, "1")), (1, "a", 1.0, None, (None, "1"))),
        ((1, "", 1.0, [1], None), (1, None, 1.0, [1], None)),
    ],
)
def test_nulls_that_change_places(spark, one, other):
    assert differing_buckets(table(spark, [one]), table(spark, [other])).count() > 0
    assert except_by_digests(table(spark, [one]), table(spark, [other])).count() == 2


def test_copies_count_in_digests(spark):
    once, twice = spark.range(10).repartition(3), spark.range(10).unionAll(spark.range(4))
    assert except_by_digests(once, twice).count() == 0
    assert sorted(tuple(r) for r in except_by_digests(once, twice, multiset=True).collect()) == [("b_minus_a", i) for i in range(4)]


def test_only_differing_buckets_are_compared(spark):
    """Of a large table with one changed row, the rows of two buckets at most meet; of equal tables none."""
    one = spark.range(50_000).withColumn("v", F.col("id") * 3)
    other = one.withColumn("v", F.when(F.col("id") == 77, 0).otherwise(F.col("v")))
    left, right = suspects(one, other)
    assert 1 <= left.count() <= 20 and 1 <= right.count() <= 20
    assert [s.count() for s in suspects(one, one.repartition(5))] == [0, 0]
    assert sorted(map(tuple, except_by_digests(one, other).collect())) == [("a_minus_b", 77, 231), ("b_minus_a", 77, 0)]


def test_columns_and_types(spark):
    one = spark.createDataFrame([(1, "x", 1), (2, "y", 2)], "k int, t string, other int")
    other = spark.createDataFrame([(1, "x", 9), (3, "y", 9)], "k bigint, t string, other int")
    assert sorted(map(tuple, except_by_digests(one, other, ["k", "t"]).collect())) == [("a_minus_b", 2, "y"), ("b_minus_a", 3, "y")]
    assert except_by_digests(one.filter("false"), other.filter("false"), ["k", "t"]).count() == 0
