"""Staging views, dimensions and the fact table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.columns import renamed

APPLICATION_NAMES = {
    "SK_ID_CURR": "customer_id",
    "AMT_CREDIT": "loan_amount",
    "AMT_INCOME_TOTAL": "income",
    "AMT_ANNUITY": "annuity",
    "TARGET": "default_flag",
    "CODE_GENDER": "gender",
    "NAME_EDUCATION_TYPE": "education_type",
    "OCCUPATION_TYPE": "OCCUPATION_TYPE",
    "ORGANIZATION_TYPE": "ORGANIZATION_TYPE",
}

BUREAU_NAMES = {
    "SK_ID_BUREAU": "bureau_id",
    "SK_ID_CURR": "customer_id",
    "CREDIT_ACTIVE": "CREDIT_ACTIVE",
    "DAYS_CREDIT": "DAYS_CREDIT",
    "DAYS_CREDIT_ENDDATE": "DAYS_CREDIT_ENDDATE",
    "AMT_CREDIT_SUM": "AMT_CREDIT_SUM",
}

# Columns of the credit-record dimension; all but the two keys are just lower-cased.
DIM_BUREAU_COLUMNS = (
    "SK_ID_BUREAU",
    "SK_ID_CURR",
    "CREDIT_ACTIVE",
    "CREDIT_CURRENCY",
    "DAYS_CREDIT",
    "CREDIT_DAY_OVERDUE",
    "DAYS_CREDIT_ENDDATE",
    "DAYS_ENDDATE_FACT",
    "AMT_CREDIT_MAX_OVERDUE",
    "CNT_CREDIT_PROLONG",
    "AMT_CREDIT_SUM",
    "AMT_CREDIT_SUM_DEBT",
    "AMT_CREDIT_SUM_LIMIT",
    "AMT_CREDIT_SUM_OVERDUE",
    "CREDIT_TYPE",
    "DAYS_CREDIT_UPDATE",
    "AMT_ANNUITY",
)


def stg_applications(application_train: DataFrame) -> DataFrame:
    return renamed(application_train, APPLICATION_NAMES)


def stg_bureau(bureau: DataFrame) -> DataFrame:
    return renamed(bureau, BUREAU_NAMES)


def stg_loans(stg_applications: DataFrame) -> DataFrame:
    return stg_applications.select("customer_id", "loan_amount", "income", "annuity", "default_flag")


def dim_customer(stg_applications: DataFrame) -> DataFrame:
    """Distinct applicants with a key."""
    named = renamed(
        stg_applications,
        {
            "customer_id": "customer_key",
            "default_flag": "target",
            "gender": "code_gender",
            "income": "amt_income_total",
            "loan_amount": "amt_credit",
        },
    )
    return named.filter(F.col("customer_key").isNotNull()).distinct()


def dim_bureau(bureau: DataFrame) -> DataFrame:
    names = {name: name.lower() for name in DIM_BUREAU_COLUMNS}
    return renamed(bureau, {**names, "SK_ID_BUREAU": "bureau_id", "SK_ID_CURR": "customer_id"})


def fact_loans(stg_applications: DataFrame, stg_bureau: DataFrame) -> DataFrame:
    """One row per customer; customers without credit records get zeros.

    Both sides are grouped by the join key first, so the join needs no further
    shuffle and meets one row per key on either side.
    """
    records = stg_bureau.groupBy("customer_id").agg(
        F.count_distinct("bureau_id").alias("records"), F.sum("AMT_CREDIT_SUM").alias("credit")
    )
    applications = stg_applications.groupBy(F.col("customer_id").alias("customer_key")).agg(
        F.avg("loan_amount").alias("avg_credit_amount"),
        F.avg("income").alias("avg_income"),
        F.count(F.lit(1)).alias("loan_application_count"),
    )
    joined = applications.join(records, applications["customer_key"] == records["customer_id"], "left")
    return joined.select(
        *applications.columns,
        F.coalesce("records", F.lit(0)).alias("bureau_record_count"),
        F.coalesce("credit", F.lit(0)).alias("total_bureau_credit"),
    )
