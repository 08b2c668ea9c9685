"""Declared tests of models, planned together.

Declarations come in the form of model files: models with tests of their own and of their columns, by name or
as a mapping of the name to its arguments, with ``where``, ``severity``, ``warn_if`` and ``error_if`` beside them or under ``config``.
The planner sorts the tests of all models: those that look at single rows become counters of their table, those
that count by a value become keys, and references are keys of both tables. All of these are
answered by one scan of each table and one grouping (``onepass.py``). Tests that need an order, other groups or whole rows
run as checks of their own (``checks.py``) and are added to the result.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.columns import as_column, as_condition, as_expression
from ledgerloom.quality import checks
from ledgerloom.quality.onepass import OTHERS, ROWS, Scan, as_flag, common_type, counted, keys_of, over_keys, results

_SETTINGS = ("where", "severity", "warn_if", "error_if")


@dataclass(frozen=True)
class Declared:
    """A test of a model, of one of its columns if ``column`` is set."""

    model: str
    test: str
    column: str | None = None
    arguments: Mapping = field(default_factory=dict)
    where: str | None = None
    severity: str = "error"
    warn_if: str = "!= 0"
    error_if: str = "!= 0"

    @property
    def name(self) -> str:
        return self.test.rpartition(".")[2]


def _declared(model: str, column: str | None, test) -> Declared:
    name, given = (test, {}) if isinstance(test, str) else next(iter(test.items()))
    given = dict(given or {})
    settings = {**given.pop("config", {}), **{k: given.pop(k) for k in _SETTINGS if k in given}}
    given |= given.pop("arguments", {})  # newer files keep them apart
    given.pop("name", None)
    return Declared(model, name, column, given, **{k: str(v) for k, v in settings.items() if k in _SETTINGS})


def declarations(models: Mapping) -> list[Declared]:
    """The tests of a model file that has been parsed, in its order."""

    def tests(entry: Mapping) -> Sequence:
        return [*(entry.get("tests") or ()), *(entry.get("data_tests") or ())]

    found = []
    for model in models.get("models") or ():
        found += [_declared(model["name"], None, test) for test in tests(model)]
        for column in model.get("columns") or ():
            found += [_declared(model["name"], column["name"], test) for test in tests(column)]
    return found


def read_declarations(text: str) -> list[Declared]:
    """The tests of a model file, as YAML text (needs the yaml package)."""
    import yaml

    return declarations(yaml.safe_load(text) or {})


def model_name(reference: str) -> str:
    """The model that ``ref('name')`` means; other text is the name itself."""
    found = re.fullmatch(r"\s*ref\(\s*['\"](.+?)['\"]\s*\)\s*", reference)
    return found[1] if found else reference.strip()


# Makes the number of failures, an aggregate over the grouped rows.
Failures = Callable[[], Column]


class _Plan:
    """The scans of all tables, filled test by test."""

    def __init__(self, tables: Mapping[str, DataFrame]):
        self.tables, self.scans, self.numbers = tables, [], {}

    def scan(self, model: str) -> tuple[int, Scan]:
        if model not in self.numbers:
            if model not in self.tables:
                raise ValueError(f"no table for model {model!r}")
            self.numbers[model] = len(self.scans)
            self.scans.append(Scan(self.tables[model]))
        return self.numbers[model], self.scans[self.numbers[model]]

    def rows(self, declared: Declared, failing: Column) -> Failures:
        """Rows of the model for which ``failing`` holds."""
        number, scan = self.scan(declared.model)
        place = scan.count(as_flag(as_condition(declared.where) & failing))
        return lambda: counted(number, place)

    def keys(self, declared: Declared, check: int, value: Column, where: Column, failing: Column) -> Failures:
        """Values of the model, counted, for which ``failing`` holds."""
        _, scan = self.scan(declared.model)
        scan.keys.append(keys_of(check, scan.df, value, as_condition(declared.where) & where))
        return lambda: over_keys(check, as_flag(failing))

    def references(self, declared: Declared, check: int, value: Column, to: str, field: str, here: Column, there: Column) -> Failures:
        """Rows of the model whose value no row of the model ``to`` has."""
        _, scan = self.scan(declared.model)
        _, target = self.scan(model_name(to))
        sides = [keys_of(check, scan.df, value, here), keys_of(check, target.df, as_column(field), there, other=True)]
        common = common_type(sides[0].type, sides[1].type)
        scan.keys.append(keys_of(check, scan.df, value, as_condition(declared.where) & here & value.isNotNull(), False, common))
        target.keys.append(keys_of(check, target.df, as_column(field), there & as_column(field).isNotNull(), True, common))
        return lambda: over_keys(check, F.when(F.col(OTHERS) == 0, F.col(ROWS)))


def _outside(value: Column, arguments: Mapping) -> Column:
    inclusive, failing = arguments.get("inclusive", True), F.lit(False)
    if (low := arguments.get("min_value")) is not None:
        failing = failing | ~(value >= as_expression(low) if inclusive else value > as_expression(low))
    if (high := arguments.get("max_value")) is not None:
        failing = failing | ~(value <= as_expression(high) if inclusive else value < as_expression(high))
    return failing


def _planned(plan: _Plan, declared: Declared, check: int) -> Failures | None:
    """The test in the common scan, or None if it needs one of its own."""
    given = declared.arguments
    value = None if declared.column is None else as_column(declared.column)
    if given.get("group_by_columns"):
        return None
    if declared.name == "not_null":
        return plan.rows(declared, value.isNull())
    if declared.name == "accepted_range":
        return plan.rows(declared, _outside(value, given))
    if declared.name == "expression_is_true":
        text = given["expression"] if declared.column is None else f"`{declared.column}` {given['expression']}"
        return plan.rows(declared, ~F.expr(text))
    if declared.name == "not_empty_string":
        return plan.rows(declared, (F.trim(value) if given.get("trim_whitespace", True) else value) == "")
    if declared.name == "assert_equal":
        a, b = as_column(given["actual"]), as_column(given["expected"])
        return plan.rows(declared, a != b)
    if declared.name == "unique":
        return plan.keys(declared, check, value, value.isNotNull(), F.col(ROWS) > 1)
    if declared.name == "accepted_values":
        return plan.keys(declared, check, value, ~value.isin(*given["values"]), F.lit(True))
    if declared.name == "not_accepted_values":
        return plan.keys(declared, check, value, value.isin(*given["values"]), F.lit(True))
    if declared.name == "unique_combination_of_columns":
        combination = F.struct(*[as_column(c) for c in given["combination_of_columns"]])
        return plan.keys(declared, check, combination, F.lit(True), F.col(ROWS) > 1)
    if declared.name in ("relationships", "relationships_where"):
        here, there = (as_condition(given.get(side)) for side in ("from_condition", "to_condition"))
        return plan.references(declared, check, value, given["to"], given["field"], here, there)
    return None


def _names(values) -> list[str]:
    return [values] if isinstance(values, str) else list(values or ())


def _alone(tables: Mapping[str, DataFrame], declared: Declared) -> DataFrame:
    """The failing rows of a test that runs on its own."""
    df, column, given, where = tables[declared.model], declared.column, dict(declared.arguments), declared.where
    groups = _names(given.get("group_by_columns"))

    def other(name: str) -> DataFrame:
        return tables[model_name(given[name])]

    kinds: dict[str, Callable[[], DataFrame]] = {
        "at_least_one": lambda: checks.at_least_one(df, column, groups, where),
        "not_constant": lambda: checks.not_constant(df, column, groups, where),
        "not_null_proportion": lambda: checks.not_null_proportion(df, column, given["at_least"], given.get("at_most", 1.0), groups, where),
        "cardinality_equality": lambda: checks.cardinality_equality(df, column, other("to"), given["field"], where),
        "equal_rowcount": lambda: checks.equal_rowcount(df, other("compare_model"), groups, where=where),
        "fewer_rows_than": lambda: checks.fewer_rows_than(df, other("compare_model"), groups, where=where),
        "equality": lambda: checks.equality(df, other("compare_model"), given.get("compare_columns"), where=where),
        "recency": lambda: checks.recency(
            df, given["field"], given["datepart"], given["interval"], given.get("ignore_time_component", False), groups, where=where
        ),
        "sequential_values": lambda: checks.sequential_values(df, column, given.get("interval", 1), given.get("datepart"), groups, where),
        "mutually_exclusive_ranges": lambda: checks.mutually_exclusive_ranges(
            df, given["lower_bound_column"], given["upper_bound_column"], given.get("partition_by"),
            given.get("gaps", "allowed"), given.get("zero_length_range_allowed", False), where,
        ),
    }
    if declared.name not in kinds:
        raise ValueError(f"unknown test {declared.test!r} of model {declared.model!r}")
    return kinds[declared.name]()


def _status(declared: Declared, failures: Column) -> Column:
    error = checks.reaches(failures, declared.error_if) if declared.severity == "error" else F.lit(False)
    return F.when(error, "error").when(checks.reaches(failures, declared.warn_if), "warn").otherwise("pass")


def _row(declared: Declared, failures: Column) -> list[Column]:
    return [
        F.lit(declared.model).alias("model"),
        F.lit(declared.test).alias("test"),
        F.lit(declared.column).cast("string").alias("column_name"),
        failures.cast("bigint").alias("failures"),
        _status(declared, failures.cast("bigint")).alias("status"),
    ]


def evaluate(tables: Mapping[str, DataFrame], declared: Sequence[Declared]) -> DataFrame:
    """(model, test, column_name, failures, status), one row per test; status is pass, warn or error.

    One plan without a job, except for tests that read a sort order. Tables that only tests of their own read are not in the common scan.
    """
    plan, planned, alone = _Plan(tables), [], []
    for check, one in enumerate(declared):
        failures = _planned(plan, one, check)
        if failures is None:
            alone.append(one)
        else:
            planned.append((one, failures))
    found = [results(plan.scans, [F.struct(*_row(one, failures())) for one, failures in planned])] if planned else []
    for one in alone:
        failing = _alone(tables, one)
        calculation = F.expr(checks.FAIL_CALCULATIONS.get(one.name, checks.ROW_COUNT))
        counted_once = failing.agg(F.coalesce(calculation, F.lit(0)).alias("_failures"))
        found.append(counted_once.select(*_row(one, F.col("_failures"))))
    if not found:
        raise ValueError("no tests are declared")
    return reduce(DataFrame.unionByName, found)


def require(results: DataFrame) -> None:
    """Raise if a test ended in an error (starts a job; one row per test)."""
    failed = results.filter("status = 'error'").collect()
    if failed:
        names = [f"{r['test']} {r['model']}{'.' + r['column_name'] if r['column_name'] else ''}: {r['failures']}" for r in failed]
        raise checks.CheckFailed("; ".join(names))
