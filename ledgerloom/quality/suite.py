"""Expectation suites: all expectations of all tables from one scan of each."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.columns import as_column
from ledgerloom.quality.checks import CheckFailed
from ledgerloom.quality.onepass import ROWS, Scan, as_flag, counted, keys_of, over_keys, results

NOT_NULL = "expect_column_values_to_not_be_null"
UNIQUE = "expect_column_values_to_be_unique"
IN_SET = "expect_column_values_to_be_in_set"
BETWEEN = "expect_column_values_to_be_between"
ROW_COUNT = "expect_table_row_count_to_be_between"
EXISTS = "expect_column_to_exist"
KINDS = (NOT_NULL, UNIQUE, IN_SET, BETWEEN, ROW_COUNT, EXISTS)


@dataclass(frozen=True)
class Expectation:
    kind: str
    arguments: Mapping = field(default_factory=dict)
    severity: str = "critical"

    def __post_init__(self):
        if self.kind not in KINDS:
            raise ValueError(f"unknown expectation {self.kind!r}")

    @property
    def column(self) -> str | None:
        return self.arguments.get("column")


def suite_from_dict(suite: Mapping) -> list[Expectation]:
    """Read a suite in its stored JSON form."""
    return [
        Expectation(e["type"], dict(e["kwargs"]), e.get("severity", "critical")) for e in suite["expectations"]
    ]


Bounds = tuple[float | None, float | None]

# The row counts shipped for the full data set. Those of fact_loans contradict it, which has 307,511 loans.
SHIPPED_ROW_COUNTS: dict[str, Bounds] = {
    "dim_customer": (300_000, 320_000),
    "fact_loans": (1_400_000, 1_500_000),
    "dim_bureau": (1_700_000, 1_750_000),
}

# Kinds, columns and limits of the warehouse suites, without their row counts.
_VALUES: dict[str, list[Expectation]] = {
    "dim_customer": [
        Expectation(NOT_NULL, {"column": "customer_key"}),
        Expectation(UNIQUE, {"column": "customer_key"}),
        Expectation(IN_SET, {"column": "code_gender", "value_set": ["M", "F", "XNA"]}),
        Expectation(BETWEEN, {"column": "amt_income_total", "min_value": 0.0}),
        Expectation(BETWEEN, {"column": "amt_credit", "min_value": 0.0}),
        Expectation(IN_SET, {"column": "target", "value_set": [0, 1]}),
    ],
    "fact_loans": [
        Expectation(NOT_NULL, {"column": "customer_key"}),
        Expectation(BETWEEN, {"column": "avg_credit_amount", "min_value": 0.0}),
        Expectation(BETWEEN, {"column": "avg_income", "min_value": 0.0}),
        Expectation(BETWEEN, {"column": "loan_application_count", "min_value": 1.0}),
        Expectation(BETWEEN, {"column": "total_bureau_credit", "min_value": 0.0, "mostly": 0.95}),
    ],
    "dim_bureau": [
        Expectation(NOT_NULL, {"column": "bureau_id"}),
    ],
}


def warehouse_suites(row_counts: Mapping[str, Bounds] | None = None) -> dict[str, list[Expectation]]:
    """The suites of the warehouse tables; a table is expected to have a row unless ``row_counts`` says more."""
    bounds = {name: (1, None) for name in _VALUES} | dict(row_counts or {})
    return {
        name: [*values, Expectation(ROW_COUNT, dict(zip(("min_value", "max_value"), bounds[name])))]
        for name, values in _VALUES.items()
    }


WAREHOUSE_SUITES = warehouse_suites()


def _in_range(value: Column, arguments: Mapping) -> Column:
    low, high = arguments.get("min_value"), arguments.get("max_value")
    inside = F.lit(True)
    if low is not None:
        inside = inside & (value >= F.lit(low))
    if high is not None:
        inside = inside & (value <= F.lit(high))
    return inside


def _result(expectation: Expectation, total: Column, unexpected: Column, success: Column | None = None) -> Column:
    mostly = float(expectation.arguments.get("mostly", 1.0))
    enough = (total - unexpected) >= F.lit(mostly) * total
    return F.struct(
        F.lit(expectation.kind).alias("expectation"),
        F.lit(expectation.column).cast("string").alias("column_name"),
        F.lit(expectation.severity).alias("severity"),
        total.cast("bigint").alias("total"),
        unexpected.cast("bigint").alias("unexpected"),
        (enough if success is None else success).alias("success"),
    )


def _places(scan: Scan, expectation: Expectation, check: int) -> Callable[[int], Column]:
    """Add what an expectation asks of the scan; the function returned makes its result, given the number of the scan."""
    df, arguments = scan.df, expectation.arguments
    if expectation.kind == EXISTS:
        found = expectation.column.lower() in {name.lower() for name in df.columns}
        return lambda _: _result(expectation, F.lit(1), F.lit(0 if found else 1), F.lit(found))
    if expectation.kind == ROW_COUNT:
        place = scan.count(F.lit(1))

        def row_count(number: int) -> Column:
            rows, low, high = counted(number, place), arguments.get("min_value"), arguments.get("max_value")
            missing = F.lit(0) if low is None else F.greatest(F.lit(low) - rows, F.lit(0))
            surplus = F.lit(0) if high is None else F.greatest(rows - F.lit(high), F.lit(0))
            return _result(expectation, rows, missing + surplus, _in_range(rows, arguments))

        return row_count
    value = as_column(expectation.column)
    if expectation.kind == UNIQUE:
        # all rows sharing their value with another row are unexpected
        scan.keys.append(keys_of(check, df, value, value.isNotNull()))
        rows = F.col(ROWS)
        return lambda _: _result(expectation, over_keys(check, rows), over_keys(check, F.when(rows > 1, rows)))
    if expectation.kind == NOT_NULL:
        seen, wrong = F.lit(1), value.isNull()
    elif expectation.kind == IN_SET:
        seen, wrong = as_flag(value.isNotNull()), ~value.isin(*arguments["value_set"])
    else:
        seen, wrong = as_flag(value.isNotNull()), ~_in_range(value, arguments)
    places = scan.count(seen), scan.count(as_flag(wrong))
    return lambda number: _result(expectation, *[counted(number, place) for place in places])


def evaluate_all(tables: Mapping[str, DataFrame], suites: Mapping[str, Sequence[Expectation]]) -> DataFrame:
    """One row per expectation of every suite, over whole tables: one scan of each table and one shuffle for all."""
    scans, made, check = [], [], 0
    for name, expectations in suites.items():
        scan, number = Scan(tables[name]), len(scans)
        for expectation in expectations:
            result = _places(scan, expectation, check)
            made.append((name, number, result))
            check += 1
        scans.append(scan)
    rows = [F.struct(F.lit(name).alias("suite"), result(number).alias("_r")) for name, number, result in made]
    return results(scans, rows).select("suite", "_r.*")


def evaluate(df: DataFrame, expectations: Sequence[Expectation], suite: str) -> DataFrame:
    """One row per expectation, in one scan of the table."""
    return evaluate_all({suite: df}, {suite: expectations})


def suite_success(results: DataFrame) -> DataFrame:
    """One row per suite."""
    return results.groupBy("suite").agg(F.bool_and("success").alias("success"))


def require_success(results: DataFrame) -> None:
    """Raise if any expectation failed (starts a job; one row per expectation)."""
    failed = results.filter(~F.col("success")).collect()
    if failed:
        names = [f"{r['suite']}: {r['expectation']}({r['column_name'] or ''})" for r in failed]
        raise CheckFailed("; ".join(names))
