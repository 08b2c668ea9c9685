"""The enriched staging table: one row per applicant with features of five child tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.columns import as_column
from ledgerloom.operators.skew import HOT_KEY_ROWS, left_join_unique
from ledgerloom.sources.tables import existing_columns

KEY = "SK_ID_CURR"

BASE_COLUMNS = (
    "SK_ID_CURR",
    "TARGET",
    "NAME_CONTRACT_TYPE",
    "CODE_GENDER",
    "FLAG_OWN_CAR",
    "FLAG_OWN_REALTY",
    "CNT_CHILDREN",
    "AMT_INCOME_TOTAL",
    "AMT_CREDIT",
    "AMT_ANNUITY",
    "AMT_GOODS_PRICE",
)

Aggregate = Callable[[Column], Column]

# Child table: feature name -> aggregate and column; no column means rows are counted.
FEATURES: dict[str, dict[str, tuple[Aggregate, str | None]]] = {
    "bureau": {
        "bureau_records_cnt": (F.count, None),
        "bureau_avg_credit_sum": (F.avg, "AMT_CREDIT_SUM"),
        "bureau_max_credit_sum": (F.max, "AMT_CREDIT_SUM"),
        "bureau_avg_days_overdue": (F.avg, "CREDIT_DAY_OVERDUE"),
        "bureau_max_days_overdue": (F.max, "CREDIT_DAY_OVERDUE"),
    },
    "previous_application": {
        "prev_app_cnt": (F.count, None),
        "prev_avg_amt_application": (F.avg, "AMT_APPLICATION"),
        "prev_avg_amt_credit": (F.avg, "AMT_CREDIT"),
    },
    "pos_cash_balance": {
        "pos_records_cnt": (F.count, None),
        "pos_avg_dpd": (F.avg, "SK_DPD"),
        "pos_max_dpd": (F.max, "SK_DPD"),
    },
    "installments_payments": {
        "inst_records_cnt": (F.count, None),
        "inst_total_amt_paid": (F.sum, "AMT_PAYMENT"),
        "inst_avg_amt_paid": (F.avg, "AMT_PAYMENT"),
    },
    "credit_card_balance": {
        "cc_records_cnt": (F.count, None),
        "cc_avg_balance": (F.avg, "AMT_BALANCE"),
        "cc_max_balance": (F.max, "AMT_BALANCE"),
    },
}

CHILDREN = tuple(FEATURES)


def child_features(table: str, df: DataFrame) -> DataFrame:
    """One row per applicant; only the aggregated columns are read."""
    features = [
        (aggregate(F.lit(1)) if column is None else aggregate(as_column(column))).alias(name)
        for name, (aggregate, column) in FEATURES[table].items()
    ]
    return df.groupBy(KEY).agg(*features)


def enrich(
    applications: DataFrame, children: dict[str, DataFrame], hot_key_rows: int = HOT_KEY_ROWS
) -> DataFrame:
    """Applicants with the features of the given child tables, in the order of ``FEATURES``.

    Children are aggregated before the joins, by the join key: each of them is
    shuffled once, already reduced. Applicants without rows in a child table
    get NULL features. Every applicant row is kept, as often as it occurs.
    """
    base = existing_columns(applications, BASE_COLUMNS)
    lookups = [child_features(table, children[table]) for table in CHILDREN if table in children]
    added = [name for lookup in lookups for name in lookup.columns if name != KEY]
    return left_join_unique(base, lookups, KEY, hot_key_rows).select(*base.columns, *added)
