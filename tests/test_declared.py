"""Declared tests against the single checks, and the scans they need."""

import pytest
from pyspark.sql import functions as F

from ledgerloom.quality import checks, declared
from ledgerloom.quality import suite as S

MODELS = """
version: 2
models:
  - name: orders
    tests:
      - dbt_utils.unique_combination_of_columns: {combination_of_columns: [customer, day]}
      - dbt_utils.expression_is_true: {expression: amount > 0, where: "day > 1"}
      - dbt_utils.equal_rowcount: {compare_model: ref('customers')}
      - dbt_utils.recency: {field: at, datepart: day, interval: 100000}
    columns:
      - name: id
        description: no test
      - name: customer
        tests:
          - not_null
          - unique: {where: "day < 3"}
          - relationships:
              arguments: {to: ref('customers'), field: id}
              config: {severity: warn}
      - name: kind
        data_tests:
          - accepted_values: {values: [a, b], error_if: "> 1", warn_if: ">= 1"}
          - dbt_utils.not_empty_string
          - dbt_utils.at_least_one: {group_by_columns: [customer]}
      - name: amount
        tests:
          - dbt_utils.accepted_range: {min_value: 0, max_value: id * 10, inclusive: false}
          - dbt_utils.not_null_proportion: {at_least: 0.9}
  - name: customers
    columns:
      - name: id
        tests: [not_null, unique]
"""


@pytest.fixture(scope="module")
def tables(spark):
    rows = [
        (1, 7, 1, "a", 5.0), (2, 7, 1, "c", 30.0), (3, None, 2, "", -1.0), (4, 9, 3, None, None), (5, 8, 2, " ", 0.0), (6, 8, 4, "c", 1.0),
    ]
    orders = spark.createDataFrame(rows, "id int, customer int, day int, kind string, amount double")
    orders = orders.withColumn("at", F.lit("2020-01-01 00:00:00").cast("timestamp_ntz"))
    return {"orders": orders, "customers": spark.createDataFrame([(7,), (8,), (8,), (None,)], "id bigint")}


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_results(tables):
    found = {(r["test"].split(".")[-1], r["column_name"]): (r["failures"], r["status"]) for r in declared.evaluate(tables, declared.read_declarations(MODELS)).filter("model = 'orders'").collect()}
    orders, customers = tables["orders"], tables["customers"]
    assert found == {
        ("unique_combination_of_columns", None): (1, "error"),
        ("expression_is_true", None): (checks.expression_is_true(orders, "amount > 0", where="day > 1").count(), "error"),
        ("equal_rowcount", None): (2, "error"),
        ("recency", None): (0, "pass"),
        ("not_null", "customer"): (1, "error"),
        ("unique", "customer"): (checks.unique(orders, "customer", "day < 3").count(), "error"),
        ("relationships", "customer"): (checks.relationships(orders, "customer", customers, "id").count(), "warn"),
        ("accepted_values", "kind"): (checks.accepted_values(orders, "kind", ["a", "b"]).count(), "error"),
        ("not_empty_string", "kind"): (2, "error"),
        ("at_least_one", "kind"): (1, "error"),
        ("accepted_range", "amount"): (checks.accepted_range(orders, "amount", 0, "id * 10", inclusive=False).count(), "error"),
        ("not_null_proportion", "amount"): (1, "error"),
    }


def test_thresholds(tables):
    given = [declared.Declared("orders", "not_null", "kind", error_if=e, warn_if=w, severity=s) for e, w, s in (
        ("> 1", "!= 0", "error"), ("> 0", "!= 0", "error"), ("> 1", "> 1", "error"), ("> 0", "> 0", "warn"),
    )]
    assert [r["status"] for r in declared.evaluate(tables, given).collect()] == ["warn", "error", "pass", "warn"]
    with pytest.raises(checks.CheckFailed, match="not_null orders.kind: 1"):
        declared.require(declared.evaluate(tables, given))


def test_one_scan_of_each_table_and_one_shuffle(spark, tables, tmp_path):
    stored = {}
    for name, df in tables.items():
        df.write.parquet(str(tmp_path / name))
        stored[name] = spark.read.parquet(str(tmp_path / name))
    common = [d for d in declared.read_declarations(MODELS) if not d.arguments.get("group_by_columns") and d.name not in ("equal_rowcount", "recency", "not_null_proportion")]
    plan = physical(declared.evaluate(stored, common))
    assert plan.count("FileScan") == 2 and plan.count("Exchange hashpartitioning") == 1


def test_suites_of_several_tables_in_one_scan_each(spark, tables, tmp_path):
    stored = {}
    for name, df in tables.items():
        df.write.parquet(str(tmp_path / name))
        stored[name] = spark.read.parquet(str(tmp_path / name))
    suites = {
        "orders": [S.Expectation(S.UNIQUE, {"column": c}) for c in ("id", "customer", "kind", "amount")] + [S.Expectation(S.NOT_NULL, {"column": "kind"})],
        "customers": [S.Expectation(S.UNIQUE, {"column": "id"}), S.Expectation(S.ROW_COUNT, {"min_value": 4})],
    }
    results = S.evaluate_all(stored, suites)
    plan = physical(results)
    assert plan.count("FileScan") == 2 and plan.count("Exchange hashpartitioning") == 1
    found = [(r["suite"], r["column_name"], r["total"], r["unexpected"]) for r in results.collect()]
    assert found == [
        ("orders", "id", 6, 0), ("orders", "customer", 5, 4), ("orders", "kind", 5, 2), ("orders", "amount", 5, 0),
        ("orders", "kind", 6, 1), ("customers", "id", 3, 2), ("customers", None, 4, 0),
    ]


def test_keys_keep_their_type(spark):
    """Numbers that are equal are one key, also of different types; texts are not numbers."""
    left = spark.createDataFrame([(0.0, "1", 1), (-0.0, "01", 2), (float("nan"), None, 3), (float("nan"), "1", 9)], "d double, t string, k int")
    right = spark.range(1, 4).selectExpr("CAST(id AS DECIMAL(10, 0)) AS k")
    given = [declared.Declared("l", "unique", "d"), declared.Declared("l", "unique", "t"), declared.Declared("l", "relationships", "k", {"to": "r", "field": "k"})]
    assert [r["failures"] for r in declared.evaluate({"l": left, "r": right}, given).collect()] == [2, 1, 1]


def test_empty_tables_and_unknown_tests(spark, tables):
    empty = {name: df.filter("false") for name, df in tables.items()}
    common = [d for d in declared.read_declarations(MODELS) if d.name not in ("not_null_proportion",)]
    assert {r["failures"] for r in declared.evaluate(empty, common).collect()} == {0}
    for wrong in (declared.Declared("orders", "be_nice"), declared.Declared("nowhere", "not_null", "x")):
        with pytest.raises((ValueError, KeyError)):
            declared.evaluate(tables, [wrong])
