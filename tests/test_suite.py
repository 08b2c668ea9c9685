import pytest

from ledgerloom.quality import suite as S
from ledgerloom.quality.checks import CheckFailed


def evaluated(df, *expectations):
    results = S.evaluate(df, [S.Expectation(kind, arguments) for kind, arguments in expectations], "t")
    return {(r["expectation"], r["column_name"]): (r["total"], r["unexpected"], r["success"]) for r in results.collect()}


@pytest.fixture(scope="module")
def df(spark):
    data = [(1, "M", 5.0), (2, "F", -1.0), (2, "X", None), (None, None, 3.0), (3, "M", 0.0)]
    return spark.createDataFrame(data, "k int, g string, v double")


def test_expectations(df):
    assert evaluated(
        df,
        (S.NOT_NULL, {"column": "k"}),
        (S.UNIQUE, {"column": "k"}),
        (S.IN_SET, {"column": "g", "value_set": ["M", "F"]}),
        (S.BETWEEN, {"column": "v", "min_value": 0}),
        (S.ROW_COUNT, {"min_value": 1, "max_value": 3}),
        (S.EXISTS, {"column": "K"}),
    ) == {
        (S.NOT_NULL, "k"): (5, 1, False),
        (S.UNIQUE, "k"): (4, 2, False),
        (S.IN_SET, "g"): (4, 1, False),
        (S.BETWEEN, "v"): (4, 1, False),
        (S.ROW_COUNT, None): (5, 2, False),
        (S.EXISTS, "K"): (1, 0, True),
    }


def test_mostly(df):
    for mostly, success in ((0.75, True), (0.76, False)):
        found = evaluated(df, (S.BETWEEN, {"column": "v", "min_value": 0.0, "mostly": mostly}))
        assert found == {(S.BETWEEN, "v"): (4, 1, success)}
    assert evaluated(df, (S.UNIQUE, {"column": "k", "mostly": 0.5}))[S.UNIQUE, "k"][2]


def test_bounds(df):
    assert evaluated(df, (S.BETWEEN, {"column": "v", "max_value": 4.0}))[S.BETWEEN, "v"] == (4, 1, False)
    assert evaluated(df, (S.ROW_COUNT, {"min_value": 5, "max_value": None}))[S.ROW_COUNT, None] == (5, 0, True)
    assert evaluated(df, (S.ROW_COUNT, {"min_value": 9}))[S.ROW_COUNT, None] == (5, 4, False)


def test_missing_column(df):
    assert evaluated(df, (S.EXISTS, {"column": "zzz"})) == {(S.EXISTS, "zzz"): (1, 1, False)}


def test_empty_table(df):
    empty = df.filter("false")
    found = evaluated(empty, (S.NOT_NULL, {"column": "k"}), (S.UNIQUE, {"column": "k"}), (S.ROW_COUNT, {"min_value": 1}))
    assert found == {(S.NOT_NULL, "k"): (0, 0, True), (S.UNIQUE, "k"): (0, 0, True), (S.ROW_COUNT, None): (0, 1, False)}


def test_stored_form():
    stored = {
        "name": "s",
        "expectations": [
            {"type": S.BETWEEN, "kwargs": {"column": "v", "min_value": 0.0, "mostly": 0.95}, "severity": "warning"},
            {"type": S.ROW_COUNT, "kwargs": {"min_value": 1}},
        ],
    }
    first, second = S.suite_from_dict(stored)
    assert (first.column, first.severity, second.severity) == ("v", "warning", "critical")
    with pytest.raises(ValueError):
        S.Expectation("expect_miracles")


def test_all_suites(df):
    passing, failing = [S.Expectation(S.NOT_NULL, {"column": "v"})], [S.Expectation(S.UNIQUE, {"column": "g"})]
    results = S.evaluate_all({"a": df.filter("v IS NOT NULL"), "b": df}, {"a": passing, "b": failing})
    assert {tuple(r) for r in S.suite_success(results).collect()} == {("a", True), ("b", False)}
    S.require_success(results.filter("suite = 'a'"))
    with pytest.raises(CheckFailed, match="b: expect_column_values_to_be_unique"):
        S.require_success(results)


def test_suites_of_the_warehouse():
    assert {name: len(es) for name, es in S.WAREHOUSE_SUITES.items()} == {"dim_customer": 7, "fact_loans": 6, "dim_bureau": 2}


def test_one_pass_without_unique(df):
    """Simple expectations share one aggregation."""
    results = S.evaluate(df, [S.Expectation(S.NOT_NULL, {"column": c}) for c in ("k", "g", "v")], "t")
    plan = results._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1
