"""Row rules as data: a code and the condition under which a row breaks it."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ledgerloom.functions.casts import as_double, as_integer
from ledgerloom.functions.columns import as_column

REASON = "reject_reason"

# Gives a column of the table under test, converted to "int" or "double".
Typed = Callable[[str, str], Column]


@dataclass(frozen=True)
class Rule:
    code: str
    broken: Callable[[Typed], Column]


def not_null(column: str) -> Rule:
    return Rule(f"NULL_{column}", lambda typed: as_column(column).isNull())


def castable(column: str, to: str) -> Rule:
    """Anything but NULL must convert to the type."""
    return Rule(
        f"INVALID_{column}_TYPE", lambda typed: as_column(column).isNotNull() & typed(column, to).isNull()
    )


def in_set(column: str, values: Sequence, code: str, to: str | None = None) -> Rule:
    """NULL passes."""
    return Rule(code, lambda typed: ~(typed(column, to) if to else as_column(column)).isin(*values))


def positive(column: str) -> Rule:
    return Rule(f"NON_POSITIVE_{column}", lambda typed: typed(column, "double") <= 0)


def non_negative(column: str) -> Rule:
    return Rule(f"NEGATIVE_{column}", lambda typed: typed(column, "double") < 0)


@dataclass(frozen=True)
class Tagged:
    """Rows with the code of the first rule they break, or NULL, in ``reject_reason``."""

    rows: DataFrame
    columns: list[str]
    numbers: dict[str, Column]

    def shown(self, retyped: bool) -> list[Column]:
        """The original columns; if ``retyped``, the converted ones follow in place of their text."""
        if not retyped:
            return [as_column(name) for name in self.columns]
        untouched = [as_column(name) for name in self.columns if name not in self.numbers]
        return [*untouched, *[number.alias(name) for name, number in self.numbers.items()]]

    def valid(self, retyped: bool = False) -> DataFrame:
        return self.rows.filter(F.col(REASON).isNull()).select(*self.shown(retyped))

    def rejects(self) -> DataFrame:
        return self.rows.filter(F.col(REASON).isNotNull()).select(*self.shown(False), REASON)


def with_numbers(df: DataFrame, types: Mapping[str, str]) -> tuple[DataFrame, dict[str, Column]]:
    """``df`` with helper columns for text that should be a number, and where each number is.

    The helpers come out of a generator with one row. Filters are not pushed
    through it, so each text is converted once, however often rules and results
    use the number. Columns that are numbers already need no helper.
    """
    casts = {"int": as_integer, "double": as_double}
    found = {f.name: f.dataType for f in df.schema.fields}
    helpers, numbers = [], {}
    for name, to in types.items():
        if isinstance(found[name], StringType):
            helpers.append(casts[to](name).alias(f"_{name}"))
            numbers[name] = as_column(f"_{name}")
        else:
            numbers[name] = casts[to](name, found[name])
    if helpers:
        df = df.select("*", F.inline(F.array(F.struct(*helpers))))
    return df, numbers


def tag(df: DataFrame, rules: Sequence[Rule], types: Mapping[str, str]) -> Tagged:
    """Apply the rules in order; ``types`` names the columns they see as numbers."""
    rows, numbers = with_numbers(df, types)

    def typed(column: str, to: str) -> Column:
        if types[column] != to:
            raise ValueError(f"{column} is checked as {types[column]}, not as {to}")
        return numbers[column]

    reason = F.coalesce(*[F.when(rule.broken(typed), F.lit(rule.code)) for rule in rules])
    return Tagged(rows.withColumn(REASON, reason), list(df.columns), numbers)
