from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ledgerloom.quality import checks as C


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def frame(spark, schema, *data):
    return spark.createDataFrame([r if isinstance(r, tuple) else (r,) for r in data], schema)


def test_not_null_and_unique(spark):
    df = frame(spark, "k int, v string", (1, "a"), (1, "b"), (2, None), (None, "c"), (None, "d"))
    assert rows(C.not_null(df, "v")) == [(2, None)]
    assert rows(C.unique(df, "k")) == [(1, 2)]
    assert rows(C.unique(df, "k", where="v <> 'a'")) == []


def test_accepted_values(spark):
    df = frame(spark, "city string", "Barcelona", "London", "Paris", "Paris", None)
    assert rows(C.accepted_values(df, "city", ["London", "Barcelona"])) == [("Paris", 2)]
    assert rows(C.not_accepted_values(df, "city", ["Madrid", "Berlin"])) == []
    assert rows(C.not_accepted_values(df, "city", ["Paris", "Berlin"])) == [("Paris",)]


@pytest.mark.parametrize(
    "options, failing",
    [
        ({"min_value": -1, "max_value": 11}, []),
        ({"min_value": -1, "max_value": 11, "inclusive": False}, [(-1,), (11,)]),
        ({"min_value": -2, "max_value": 11.1, "inclusive": False}, []),
        ({"min_value": 0, "where": "id <> -1"}, []),
        ({"min_value": 0}, [(-1,)]),
        ({"max_value": "id - 1"}, [(-1,), (11,)]),
        ({}, []),
    ],
)
def test_accepted_range(spark, options, failing):
    df = frame(spark, "id int", -1, 11, None)
    assert rows(C.accepted_range(df, "id", **options)) == failing


def test_at_least_one(spark):
    df = frame(spark, "field string, g int", ("a", 1), (None, 1), (None, 2))
    assert rows(C.at_least_one(df, "field")) == []
    assert rows(C.at_least_one(df, "field", ["g"])) == [(2, 0)]
    assert rows(C.at_least_one(df.filter("g = 2"), "field")) == [(0,)]


def test_not_constant(spark):
    df = frame(spark, "col_a int, field int", (1, 1), (1, 1), (1, 2), (2, 5), (2, None), (3, None))
    assert rows(C.not_constant(df.filter("col_a = 1"), "field")) == []
    assert rows(C.not_constant(df, "field", ["col_a"])) == [(2, 1)]
    assert rows(C.not_constant(df, "col_a", where="col_a = 3")) == [(1,)]


def test_not_empty_string(spark):
    df = frame(spark, "s string", "a", "", " ", "  b ", None, "\t")
    assert rows(C.not_empty_string(df, "s")) == [("",), ("",)]
    assert rows(C.not_empty_string(df, "s", trim_whitespace=False)) == [("",)]


def test_not_null_proportion(spark):
    points = [(1, 1), (None, 2), (None, 3), (4, 4), (5, 5), (6, 6), (None, 7), (None, 8), (None, None), (10, 10)]
    df = frame(spark, "point_5 int, point_9 int", *points)
    assert rows(C.not_null_proportion(df, "point_5", 0.5, 0.5)) == []
    assert rows(C.not_null_proportion(df, "point_9", 0.9)) == []
    assert rows(C.not_null_proportion(df, "point_5", 0, group_by=["point_9"])) == []
    assert rows(C.not_null_proportion(df, "point_9", 0.95)) == [(0.9,)]
    assert rows(C.not_null_proportion(df, "point_5", 0.6, 0.9)) == [(0.5,)]


def test_unique_combination(spark):
    df = frame(spark, "month string, product string", ("01", "bread"), ("01", "cake"), ("02", "bread"))
    assert rows(C.unique_combination_of_columns(df, ["month", "product"])) == []
    assert rows(C.unique_combination_of_columns(df, ["product"])) == [("bread",)]
    nulls = frame(spark, "a int, b int", (None, 1), (None, 1))
    assert rows(C.unique_combination_of_columns(nulls, ["a", "b"])) == [(None, 1)]


def test_expression_is_true(spark):
    df = frame(spark, "col_a double, col_b double", (0.0, 1.0), (1.0, 0.0), (0.5, 0.5), (None, 1.0))
    assert rows(C.expression_is_true(df, "col_a + col_b = 1")) == []
    assert rows(C.expression_is_true(df, "col_a = 0.5", where="col_b = 0.5")) == []
    assert rows(C.expression_is_true(df, "+ col_b = 1", column="col_a")) == []
    assert rows(C.expression_is_true(df, "= 0.5", column="col_b")) == [(0.0, 1.0), (1.0, 0.0), (None, 1.0)]


def test_assert_equal(spark):
    df = frame(spark, "a int, e int", (1, 1), (1, 2), (None, 1), (None, None))
    assert rows(C.assert_equal(df, "a", "e")) == [(1, 2)]
    assert rows(C.assert_equal(df, "a", "e", null_safe=True)) == [(1, 2), (None, 1)]


def test_relationships(spark):
    child = frame(spark, "id int", 1, 2, 4, 4, None)
    parent = frame(spark, "id int", 1, 2, 2, 3, None)
    assert rows(C.relationships(child, "id", parent, "id")) == [(4,), (4,)]
    assert rows(C.relationships_where(child, "id", parent, "id", from_condition="id <> 4")) == []
    assert rows(C.relationships_where(child, "id", parent, "id", "id <> 4", "id > 1")) == [(1, None)]


def test_cardinality_equality(spark):
    a = frame(spark, "same_name int", 1, 2, 3)
    b = frame(spark, "same_name int, different_name int", (1, 2), (2, 3), (3, 1))
    assert rows(C.cardinality_equality(a, "same_name", b, "same_name")) == []
    assert rows(C.cardinality_equality(a, "same_name", b, "different_name")) == []
    c = frame(spark, "v int", 1, 1, 2, 4, None)
    assert rows(C.cardinality_equality(a, "same_name", c, "v")) == [(1, 1), (1, 2), (3, 1), (4, 1), (None, 1)]


def test_equal_rowcount(spark):
    df = frame(spark, "field int", 1, 1, 2)
    assert rows(C.equal_rowcount(df, df)) == [(3, 3, 0)]
    assert rows(C.equal_rowcount(df, df, ["field"])) == [(1, 1, 2, 2, 0), (2, 2, 1, 1, 0)]
    other = frame(spark, "field int", 1, 3, None)
    grouped = C.equal_rowcount(df, other, ["field"])
    assert rows(grouped) == [(1, 1, 2, 1, 1), (2, None, 1, None, None), (None, 3, None, 1, None), (None, None, None, 1, None)]
    assert C.outcome(grouped, C.FAIL_CALCULATIONS["equal_rowcount"]).failures == 1
    strict = C.equal_rowcount(df, other, ["field"], strict=True)
    assert C.outcome(strict, C.FAIL_CALCULATIONS["equal_rowcount"]).failures == 4
    assert rows(C.equal_rowcount(df.filter("false"), df)) == [(0, 3, 3)]


def test_null_groups_never_meet(spark):
    df = frame(spark, "g int, h int", (None, 1), (None, 1), (1, 1))
    assert rows(C.equal_rowcount(df, df, ["g", "h"])) == [
        (1, 1, 1, 1, 1, 1, 0),
        (None, None, 1, None, 2, None, None),
        (None, None, None, 1, None, 2, None),
    ]


def test_fewer_rows_than(spark):
    few = frame(spark, "col_a int, field int", (1, 1), (1, 2), (1, 3))
    many = frame(spark, "col_a int, field int", (1, 1), (1, 2), (1, 3), (1, 4))
    calculation = C.FAIL_CALCULATIONS["fewer_rows_than"]
    assert C.outcome(C.fewer_rows_than(few, many), calculation).status == "pass"
    assert C.outcome(C.fewer_rows_than(few, many, ["col_a"]), calculation).status == "pass"
    assert rows(C.fewer_rows_than(many, few)) == [(4, 3, 1)]
    assert rows(C.fewer_rows_than(few, few)) == [(3, 3, 1)]


def test_equality(spark):
    people = frame(spark, "id int, name string", (1, "a"), (2, "b"), (2, "b"))
    same = frame(spark, "id int, name string", (2, "b"), (1, "a"))
    assert C.outcome(C.equality(people, same), C.FAIL_CALCULATIONS["equality"]).status == "pass"
    assert rows(C.equality(people, same, multiset=True)) == [("a_minus_b", 2, "b")]
    other = frame(spark, "id int, name string", (1, "a"), (3, "b"), (4, "c"))
    assert rows(C.equality(people, other, ["name"])) == [("b_minus_a", "c")]
    # three differing rows, plus the imbalance of 2 against 1
    assert C.outcome(C.equality(people, other), C.FAIL_CALCULATIONS["equality"]).failures == 4


def test_columns_match_set(spark):
    df = frame(spark, "id int, name string", (1, "a"))
    assert rows(C.columns_match_set(df, ["ID", "Name"])) == []
    assert rows(C.columns_match_set(df, ["id", "color"])) == [("NAME", None), (None, "COLOR")]
    assert rows(C.columns_match_set(df, ["ID", "name"], transform="none")) == [("id", None), (None, "ID")]


NOW = datetime(2024, 5, 10, 12)


def test_recency(spark):
    fresh = frame(spark, "col1 int, created_at timestamp_ntz", (1, NOW - timedelta(hours=23)), (2, NOW - timedelta(days=9)))
    as_of = str(NOW)
    assert rows(C.recency(fresh, "created_at", "day", 1, as_of=as_of)) == []
    stale = C.recency(fresh, "created_at", "day", 1, group_by=["col1"], as_of=as_of)
    assert rows(stale) == [(2, NOW - timedelta(days=9), NOW - timedelta(days=1))]
    yesterday = frame(spark, "created_at timestamp_ntz", datetime(2024, 5, 9))
    assert rows(C.recency(yesterday, "created_at", "day", 1, ignore_time_component=True, as_of=as_of)) == []
    assert rows(C.recency(yesterday, "created_at", "day", 1, as_of=as_of)) == [(datetime(2024, 5, 9), NOW - timedelta(days=1))]
    assert rows(C.recency(fresh.filter("false"), "created_at", "day", 1)) == []
    assert C.recency(fresh, "created_at", "day", 1).count() == 1


def test_sequential_values(spark):
    df = frame(spark, "col_a int, my_even_sequence int", (1, 2), (1, 4), (1, 6), (2, 8), (2, 10))
    assert rows(C.sequential_values(df, "my_even_sequence", 2)) == []
    assert rows(C.sequential_values(df, "my_even_sequence", 2, group_by=["col_a"])) == []
    assert C.sequential_values(df, "my_even_sequence", 1).count() == 4
    copies = frame(spark, "v int", 1, 1, 1, 2, None, 5)
    failing = C.sequential_values(copies, "v")
    assert failing.columns == ["v", "previous_v"]
    assert rows(failing) == [(1, 1), (1, 1), (5, 2)]
    hours = frame(spark, "t timestamp_ntz", *[datetime(2021, 1, 1, h) for h in (0, 1, 2, 4)])
    assert rows(C.sequential_values(hours, "t", 1, datepart="hour")) == [(datetime(2021, 1, 1, 4), datetime(2021, 1, 1, 2))]


def test_ranges_without_gaps(spark):
    df = frame(spark, "lower_bound int, upper_bound int", (0, 1), (1, 2), (2, 4))
    assert rows(C.mutually_exclusive_ranges(df, "lower_bound", "upper_bound", gaps="not_allowed")) == []
    assert C.mutually_exclusive_ranges(df, "lower_bound", "upper_bound", gaps="required").count() == 2
    with pytest.raises(ValueError):
        C.mutually_exclusive_ranges(df, "lower_bound", "upper_bound", gaps="maybe")


def test_ranges_with_gaps(spark):
    df = frame(
        spark,
        "subscription_id int, valid_from date, valid_to date",
        (1, date(2019, 1, 1), date(2019, 2, 1)),
        (1, date(2019, 3, 3), date(2019, 4, 1)),
        (2, date(2019, 5, 6), date(2019, 7, 2)),
        (2, date(2019, 7, 3), None),
    )
    upper = "coalesce(valid_to, date '2099-01-01')"
    for gaps in ("allowed", "required"):
        assert rows(C.mutually_exclusive_ranges(df, "valid_from", upper, "subscription_id", gaps)) == []
    open_ended = C.mutually_exclusive_ranges(df, "valid_from", "valid_to", "subscription_id")
    assert rows(open_ended) == [(2, date(2019, 7, 3), None, None, True, False, True)]


def test_ranges_of_zero_length(spark):
    days = [(3, 6, 7), (3, 8, 10), (3, 8, 8), (3, 12, 15), (4, 6, 7), (4, 8, 8), (4, 9, 10)]
    df = frame(spark, "id int, a int, b int", *days)
    assert rows(C.mutually_exclusive_ranges(df, "a", "b", "id", zero_length_range_allowed=True)) == []
    strict = C.mutually_exclusive_ranges(df, "a", "b", "id")
    assert strict.columns[-2:] == ["lower_bound_less_than_upper_bound", "upper_bound_less_than_or_equal_to_next_lower_bound"]
    assert [r[:3] for r in rows(strict)] == [(3, 8, 8), (4, 8, 8)]


def test_null_bounds_fail(spark):
    df = frame(spark, "a int, b int", (1, 2), (None, 5))
    # the NULL sorts last, so (1, 2) has a successor it cannot be compared with
    assert C.mutually_exclusive_ranges(df, "a", "b").count() == 2


def test_outcome_thresholds(spark):
    two = spark.range(2)
    assert C.outcome(two) == C.Outcome(2, "error")
    assert C.outcome(two, error_if="> 5") == C.Outcome(2, "warn")
    assert C.outcome(two, severity="warn").status == "warn"
    assert C.outcome(two, error_if=">5", warn_if=">=3").status == "pass"
    assert C.outcome(two, error_if="<1", warn_if="<0").status == "pass"
    assert C.outcome(two.filter("false"), error_if="<1").status == "error"
    with pytest.raises(ValueError):
        C.outcome(two, error_if="many")


def test_staging_gate(spark):
    C.staging_gate(spark.range(3), "id")
    for bad in (spark.range(3).select(F.lit(1).alias("id")), spark.range(1).select(F.lit(None).cast("int").alias("id"))):
        with pytest.raises(C.CheckFailed):
            C.staging_gate(bad, "id")
