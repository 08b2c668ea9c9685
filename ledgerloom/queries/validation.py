"""Row validation of the seven raw tables: valid rows, rejects, reasons."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.quality.validators import reason_counts, validate, validate_and_store
from ledgerloom.queries.registry import Query, query
from ledgerloom.queries.standins import DIRTY, dirty, dirty_sql
from ledgerloom.session import scratch_folder
from ledgerloom.sources.tables import Lake


def whole(column: str) -> str:
    return f"TRY_CAST(regexp_extract(trim({column}), '^([+-]?[0-9]+)([.][0-9]*)?$', 1) AS INTEGER)"


def number(column: str) -> str:
    return f"TRY_CAST({column} AS DOUBLE)"


# The rules once more as CASE branches, for the comparison.
KEY_CURR = f"""
    WHEN SK_ID_CURR IS NULL THEN 'NULL_SK_ID_CURR'
    WHEN {whole('SK_ID_CURR')} IS NULL THEN 'INVALID_SK_ID_CURR_TYPE'"""
KEY_PREV = f"""
    WHEN SK_ID_PREV IS NULL THEN 'NULL_SK_ID_PREV'
    WHEN {whole('SK_ID_PREV')} IS NULL THEN 'INVALID_SK_ID_PREV_TYPE'"""
KEY_BUREAU = f"""
    WHEN SK_ID_BUREAU IS NULL THEN 'NULL_SK_ID_BUREAU'
    WHEN {whole('SK_ID_BUREAU')} IS NULL THEN 'INVALID_SK_ID_BUREAU_TYPE'"""
MONTHS = f"""
    WHEN MONTHS_BALANCE IS NULL THEN 'NULL_MONTHS_BALANCE'
    WHEN {whole('MONTHS_BALANCE')} IS NULL THEN 'INVALID_MONTHS_BALANCE_TYPE'"""


def bad_type(column: str) -> str:
    return f"""
    WHEN {column} IS NOT NULL AND {number(column)} IS NULL THEN 'INVALID_{column}_TYPE'"""


def below_zero(column: str) -> str:
    return bad_type(column) + f"""
    WHEN {number(column)} < 0 THEN 'NEGATIVE_{column}'"""


REASONS = {
    "application_train": KEY_CURR
    + f"""
    WHEN TARGET IS NULL THEN 'NULL_TARGET'
    WHEN {whole('TARGET')} IS NULL THEN 'INVALID_TARGET_TYPE'
    WHEN {whole('TARGET')} NOT IN (0, 1) THEN 'INVALID_TARGET_VALUE'
    WHEN AMT_CREDIT IS NULL THEN 'NULL_AMT_CREDIT'
    WHEN {number('AMT_CREDIT')} IS NULL THEN 'INVALID_AMT_CREDIT_TYPE'
    WHEN {number('AMT_CREDIT')} <= 0 THEN 'NON_POSITIVE_AMT_CREDIT'
    WHEN AMT_INCOME_TOTAL IS NULL THEN 'NULL_AMT_INCOME_TOTAL'
    WHEN {number('AMT_INCOME_TOTAL')} IS NULL THEN 'INVALID_AMT_INCOME_TOTAL_TYPE'
    WHEN {number('AMT_INCOME_TOTAL')} <= 0 THEN 'NON_POSITIVE_AMT_INCOME_TOTAL'"""
    + bad_type("AMT_ANNUITY")
    + bad_type("AMT_GOODS_PRICE")
    + """
    WHEN CODE_GENDER NOT IN ('M', 'F', 'XNA') THEN 'INVALID_CODE_GENDER'""",
    "bureau": KEY_CURR + KEY_BUREAU + bad_type("AMT_CREDIT_SUM") + below_zero("CREDIT_DAY_OVERDUE"),
    "bureau_balance": KEY_BUREAU
    + MONTHS
    + """
    WHEN STATUS IS NULL THEN 'NULL_STATUS'""",
    "previous_application": KEY_CURR + KEY_PREV + below_zero("AMT_APPLICATION") + below_zero("AMT_CREDIT"),
    "pos_cash_balance": KEY_CURR + KEY_PREV + MONTHS + below_zero("SK_DPD"),
    "installments_payments": KEY_CURR + KEY_PREV + below_zero("AMT_PAYMENT") + below_zero("AMT_INSTALMENT"),
    "credit_card_balance": KEY_CURR + KEY_PREV + MONTHS + bad_type("AMT_BALANCE"),
}

RETYPED_APPLICATION = f"""
    NAME_CONTRACT_TYPE, CODE_GENDER, {whole('SK_ID_CURR')} AS SK_ID_CURR, {whole('TARGET')} AS TARGET,
    {number('AMT_CREDIT')} AS AMT_CREDIT, {number('AMT_INCOME_TOTAL')} AS AMT_INCOME_TOTAL,
    {number('AMT_ANNUITY')} AS AMT_ANNUITY, {number('AMT_GOODS_PRICE')} AS AMT_GOODS_PRICE"""


def tagged_sql(name: str) -> str:
    return f"{dirty_sql(name)}, tagged AS (SELECT *, CASE {REASONS[name]} END AS reject_reason FROM {name})"


def _validation(name: str, result: Callable) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return result(validate(dirty(spark, folder, name), name))

    return run


for _name in DIRTY:
    _tagged = tagged_sql(_name)
    _valid = RETYPED_APPLICATION if _name == "application_train" else "* EXCLUDE (reject_reason)"
    query(f"valid_{_name}", f"{_tagged} SELECT {_valid} FROM tagged WHERE reject_reason IS NULL")(
        _validation(_name, lambda checked: checked.valid)
    )
    query(f"rejects_{_name}", f"{_tagged} SELECT * FROM tagged WHERE reject_reason IS NOT NULL")(
        _validation(_name, lambda checked: checked.rejects)
    )
    query(
        f"reject_reasons_{_name}",
        f"{_tagged} SELECT reject_reason, count(*) AS num_rows FROM tagged "
        "WHERE reject_reason IS NOT NULL GROUP BY reject_reason",
    )(_validation(_name, lambda checked: reason_counts(checked.rejects)))


@query(
    "stored_validation",
    tagged_sql("bureau")
    + " SELECT SK_ID_CURR, SK_ID_BUREAU, CREDIT_ACTIVE, AMT_CREDIT_SUM, CREDIT_DAY_OVERDUE, reject_reason FROM tagged",
)
def stored_validation(spark: SparkSession, folder: str) -> DataFrame:
    """Both sides of a table, stored with one scan and read back."""
    lake = Lake(spark, scratch_folder(spark, "checked"))
    validate_and_store(lake, dirty(spark, folder, "bureau"), "bureau")
    valid, rejects = lake.read("silver", "bureau"), lake.read("quarantine", "bureau_rejects")
    return valid.unionByName(rejects, allowMissingColumns=True)
