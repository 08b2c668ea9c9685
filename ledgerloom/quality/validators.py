"""The rules of the seven raw tables and of the staging table, in evaluation order."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ledgerloom.functions.columns import as_column
from ledgerloom.quality.rules import (
    REASON,
    Rule,
    Tagged,
    castable,
    in_set,
    non_negative,
    not_null,
    positive,
    tag,
    with_numbers,
)
from ledgerloom.sources.tables import CHECKED, SIDE, Lake, side_columns


def required(column: str, to: str) -> list[Rule]:
    return [not_null(column), castable(column, to)]


def optional_amount(column: str) -> list[Rule]:
    return [castable(column, "double"), non_negative(column)]


RULES: dict[str, list[Rule]] = {
    "application_train": [
        *required("SK_ID_CURR", "int"),
        *required("TARGET", "int"),
        in_set("TARGET", (0, 1), "INVALID_TARGET_VALUE", to="int"),
        *required("AMT_CREDIT", "double"),
        positive("AMT_CREDIT"),
        *required("AMT_INCOME_TOTAL", "double"),
        positive("AMT_INCOME_TOTAL"),
        castable("AMT_ANNUITY", "double"),
        castable("AMT_GOODS_PRICE", "double"),
        in_set("CODE_GENDER", ("M", "F", "XNA"), "INVALID_CODE_GENDER"),
    ],
    "bureau": [
        *required("SK_ID_CURR", "int"),
        *required("SK_ID_BUREAU", "int"),
        castable("AMT_CREDIT_SUM", "double"),
        *optional_amount("CREDIT_DAY_OVERDUE"),
    ],
    "bureau_balance": [
        *required("SK_ID_BUREAU", "int"),
        *required("MONTHS_BALANCE", "int"),
        not_null("STATUS"),
    ],
    "previous_application": [
        *required("SK_ID_CURR", "int"),
        *required("SK_ID_PREV", "int"),
        *optional_amount("AMT_APPLICATION"),
        *optional_amount("AMT_CREDIT"),
    ],
    "pos_cash_balance": [
        *required("SK_ID_CURR", "int"),
        *required("SK_ID_PREV", "int"),
        *required("MONTHS_BALANCE", "int"),
        *optional_amount("SK_DPD"),
    ],
    "installments_payments": [
        *required("SK_ID_CURR", "int"),
        *required("SK_ID_PREV", "int"),
        *optional_amount("AMT_PAYMENT"),
        *optional_amount("AMT_INSTALMENT"),
    ],
    "credit_card_balance": [
        *required("SK_ID_CURR", "int"),
        *required("SK_ID_PREV", "int"),
        *required("MONTHS_BALANCE", "int"),
        castable("AMT_BALANCE", "double"),  # balances may be negative
    ],
}

# Columns each rule set converts while checking.
TYPES: dict[str, dict[str, str]] = {
    "application_train": {
        "SK_ID_CURR": "int",
        "TARGET": "int",
        "AMT_CREDIT": "double",
        "AMT_INCOME_TOTAL": "double",
        "AMT_ANNUITY": "double",
        "AMT_GOODS_PRICE": "double",
    },
    "bureau": {
        "SK_ID_CURR": "int",
        "SK_ID_BUREAU": "int",
        "AMT_CREDIT_SUM": "double",
        "CREDIT_DAY_OVERDUE": "double",
    },
    "bureau_balance": {"SK_ID_BUREAU": "int", "MONTHS_BALANCE": "int"},
    "previous_application": {
        "SK_ID_CURR": "int",
        "SK_ID_PREV": "int",
        "AMT_APPLICATION": "double",
        "AMT_CREDIT": "double",
    },
    "pos_cash_balance": {
        "SK_ID_CURR": "int",
        "SK_ID_PREV": "int",
        "MONTHS_BALANCE": "int",
        "SK_DPD": "double",
    },
    "installments_payments": {
        "SK_ID_CURR": "int",
        "SK_ID_PREV": "int",
        "AMT_PAYMENT": "double",
        "AMT_INSTALMENT": "double",
    },
    "credit_card_balance": {
        "SK_ID_CURR": "int",
        "SK_ID_PREV": "int",
        "MONTHS_BALANCE": "int",
        "AMT_BALANCE": "double",
    },
}

# Only this table is stored with its converted columns by default.
RETYPED = ("application_train",)

STAGING_RULES: list[Rule] = [
    not_null("SK_ID_CURR"),
    not_null("TARGET"),
    in_set("TARGET", (0, 1), "INVALID_TARGET"),
    not_null("AMT_CREDIT"),
    not_null("AMT_INCOME_TOTAL"),
]

TABLES = tuple(RULES)


@dataclass(frozen=True)
class Checked:
    """Both sides of a table; ``numbers`` are stored valid rows with all checked columns converted."""

    valid: DataFrame
    rejects: DataFrame
    numbers: DataFrame | None = None


def validate(df: DataFrame, table: str, retype_all: bool = False) -> Checked:
    """Valid and rejected rows of a raw table; every row is in exactly one of them."""
    tagged = tag(df, RULES[table], TYPES[table])
    return Checked(tagged.valid(retype_all or table in RETYPED), tagged.rejects())


def validate_staging(df: DataFrame) -> Checked:
    tagged = tag(df, STAGING_RULES, {})
    return Checked(tagged.valid(), tagged.rejects())


def reason_counts(rejects: DataFrame) -> DataFrame:
    return rejects.groupBy(REASON).agg(F.count(F.lit(1)).alias("num_rows"))


def numbers_from_text(df: DataFrame, table: str) -> DataFrame:
    """A validated table with its checked columns as numbers where they are still text.

    Keys such as ' 7' and '7.0' are the same number only then.
    """
    texts = {f.name for f in df.schema.fields if isinstance(f.dataType, StringType)}
    types = {name: to for name, to in TYPES[table].items() if name in texts}
    rows, numbers = with_numbers(df, types)
    return rows.select(*[numbers[n].alias(n) if n in numbers else as_column(n) for n in df.columns])


def validate_and_store(lake: Lake, df: DataFrame, table: str, retype_all: bool = False) -> Checked:
    """Store both sides of a raw table with one scan of it (starts a write).

    The rows go to ``checked/<table>`` with a partition for either side, so that
    reading one side touches only its own files; the rejects of an earlier run
    are always replaced. Lakes with a catalog get the views ``silver.<table>``
    and ``quarantine.<table>_rejects``.
    """
    tagged = tag(df, RULES[table], TYPES[table])
    return _store(lake, tagged, table, "silver", retype_all or table in RETYPED)


def store_staging(lake: Lake, df: DataFrame, table: str = "stg_loan_application_enriched") -> Checked:
    """The same for the staging table, under ``staging.<table>``."""
    return _store(lake, tag(df, STAGING_RULES, {}), table, "staging", False)


def _store(lake: Lake, tagged: Tagged, table: str, layer: str, retyped: bool) -> Checked:
    # text is converted here once; later steps read the numbers
    typed = {name: f"_{name}" if retyped else f"__{name}" for name in tagged.numbers}
    rows = tagged.rows.select(
        *tagged.shown(False),
        *[tagged.numbers[name].alias(stored) for name, stored in typed.items()],
        REASON,
        F.col(REASON).isNotNull().alias(SIDE),
    )
    lake.write(rows, CHECKED, table, partition_by=[SIDE])

    valid, rejects = (side_columns(rows.columns, rejected) for rejected in (False, True))
    if lake.catalog:
        source = (CHECKED, table)
        lake.create_view(layer, table, source, valid, f"NOT {SIDE}")
        lake.create_view("quarantine", f"{table}_rejects", source, rejects, SIDE)
    # the schema is given because an empty side has no files to take it from
    stored = lake.spark.read.schema(rows.schema).parquet(lake.location(CHECKED, table))

    def shown(condition: Column, names: list[tuple[str, str]]) -> DataFrame:
        return stored.filter(condition).select(*[as_column(old).alias(new) for old, new in names])

    numbers = [(typed.get(name, name), name) for name in tagged.columns]
    return Checked(shown(~F.col(SIDE), valid), shown(F.col(SIDE), rejects), shown(~F.col(SIDE), numbers))
