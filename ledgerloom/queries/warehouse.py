"""Features, dimensions, facts and suites."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.plans import warehouse
from ledgerloom.plans.features import CHILDREN, enrich
from ledgerloom.plans.run import product_counts, run
from ledgerloom.quality.declared import declarations
from ledgerloom.quality.declared import evaluate as evaluate_declared
from ledgerloom.quality.suite import (
    BETWEEN,
    EXISTS,
    IN_SET,
    NOT_NULL,
    ROW_COUNT,
    UNIQUE,
    Expectation,
    evaluate_all,
    suite_success,
)
from ledgerloom.quality.validators import TABLES, validate_staging
from ledgerloom.queries.registry import own_name, query
from ledgerloom.queries.standins import clean, clean_sql, dirty
from ledgerloom.queries.validation import tagged_sql, whole
from ledgerloom.session import scratch_folder
from ledgerloom.sources.tables import Lake

FACT_LOANS = """
    SELECT a.customer_key, a.avg_credit_amount, a.avg_income, a.loan_application_count,
           coalesce(b.records, 0) AS bureau_record_count,
           CAST(coalesce(b.credit, 0) AS BIGINT) AS total_bureau_credit
    FROM (SELECT SK_ID_CURR AS customer_key, avg(AMT_CREDIT) AS avg_credit_amount,
                 avg(AMT_INCOME_TOTAL) AS avg_income, count(*) AS loan_application_count
          FROM application_train GROUP BY SK_ID_CURR) a
    LEFT JOIN (SELECT SK_ID_CURR, count(DISTINCT SK_ID_BUREAU) AS records, sum(AMT_CREDIT_SUM) AS credit
               FROM bureau GROUP BY SK_ID_CURR) b
    ON a.customer_key = b.SK_ID_CURR
"""
DIM_CUSTOMER = """
    SELECT DISTINCT SK_ID_CURR AS customer_key, TARGET AS target, CODE_GENDER AS code_gender,
           AMT_INCOME_TOTAL AS amt_income_total, AMT_CREDIT AS amt_credit
    FROM application_train WHERE SK_ID_CURR IS NOT NULL
"""


def _applications(spark: SparkSession, folder: str) -> DataFrame:
    return warehouse.stg_applications(clean(spark, folder, "application_train"))


@query("fact_loans", clean_sql("application_train", "bureau") + FACT_LOANS)
def fact_loans(spark: SparkSession, folder: str) -> DataFrame:
    bureau = warehouse.stg_bureau(clean(spark, folder, "bureau"))
    return warehouse.fact_loans(_applications(spark, folder), bureau)


@query("dim_customer", clean_sql("application_train") + DIM_CUSTOMER)
def dim_customer(spark: SparkSession, folder: str) -> DataFrame:
    return warehouse.dim_customer(_applications(spark, folder))


@query(
    "dim_bureau",
    clean_sql("bureau")
    + """
    SELECT SK_ID_BUREAU AS bureau_id, SK_ID_CURR AS customer_id, CREDIT_ACTIVE AS credit_active,
           CREDIT_CURRENCY AS credit_currency, DAYS_CREDIT AS days_credit,
           CREDIT_DAY_OVERDUE AS credit_day_overdue, DAYS_CREDIT_ENDDATE AS days_credit_enddate,
           DAYS_ENDDATE_FACT AS days_enddate_fact, AMT_CREDIT_MAX_OVERDUE AS amt_credit_max_overdue,
           CNT_CREDIT_PROLONG AS cnt_credit_prolong, AMT_CREDIT_SUM AS amt_credit_sum,
           AMT_CREDIT_SUM_DEBT AS amt_credit_sum_debt, AMT_CREDIT_SUM_LIMIT AS amt_credit_sum_limit,
           AMT_CREDIT_SUM_OVERDUE AS amt_credit_sum_overdue, CREDIT_TYPE AS credit_type,
           DAYS_CREDIT_UPDATE AS days_credit_update, AMT_ANNUITY AS amt_annuity
    FROM bureau""",
)
def dim_bureau(spark: SparkSession, folder: str) -> DataFrame:
    return warehouse.dim_bureau(clean(spark, folder, "bureau"))


@query(
    "stg_applications",
    clean_sql("application_train")
    + """
    SELECT SK_ID_CURR AS customer_id, AMT_CREDIT AS loan_amount, AMT_INCOME_TOTAL AS income,
           AMT_ANNUITY AS annuity, TARGET AS default_flag, CODE_GENDER AS gender,
           NAME_EDUCATION_TYPE AS education_type, OCCUPATION_TYPE, ORGANIZATION_TYPE
    FROM application_train""",
)
def stg_applications(spark: SparkSession, folder: str) -> DataFrame:
    return _applications(spark, folder)


@query(
    "stg_bureau",
    clean_sql("bureau")
    + """
    SELECT SK_ID_BUREAU AS bureau_id, SK_ID_CURR AS customer_id, CREDIT_ACTIVE, DAYS_CREDIT,
           DAYS_CREDIT_ENDDATE, AMT_CREDIT_SUM
    FROM bureau""",
)
def stg_bureau(spark: SparkSession, folder: str) -> DataFrame:
    return warehouse.stg_bureau(clean(spark, folder, "bureau"))


@query(
    "stg_loans",
    clean_sql("application_train")
    + """
    SELECT SK_ID_CURR AS customer_id, AMT_CREDIT AS loan_amount, AMT_INCOME_TOTAL AS income,
           AMT_ANNUITY AS annuity, TARGET AS default_flag
    FROM application_train""",
)
def stg_loans(spark: SparkSession, folder: str) -> DataFrame:
    return warehouse.stg_loans(_applications(spark, folder))


ENRICHED = (
    clean_sql("application_train", *CHILDREN)
    + """,
    b AS (SELECT SK_ID_CURR, count(*) AS bureau_records_cnt, avg(AMT_CREDIT_SUM) AS bureau_avg_credit_sum,
                 max(AMT_CREDIT_SUM) AS bureau_max_credit_sum,
                 avg(CREDIT_DAY_OVERDUE) AS bureau_avg_days_overdue,
                 max(CREDIT_DAY_OVERDUE) AS bureau_max_days_overdue FROM bureau GROUP BY SK_ID_CURR),
    p AS (SELECT SK_ID_CURR, count(*) AS prev_app_cnt, avg(AMT_APPLICATION) AS prev_avg_amt_application,
                 avg(AMT_CREDIT) AS prev_avg_amt_credit FROM previous_application GROUP BY SK_ID_CURR),
    c AS (SELECT SK_ID_CURR, count(*) AS pos_records_cnt, avg(SK_DPD) AS pos_avg_dpd,
                 max(SK_DPD) AS pos_max_dpd FROM pos_cash_balance GROUP BY SK_ID_CURR),
    i AS (SELECT SK_ID_CURR, count(*) AS inst_records_cnt,
                 CAST(sum(AMT_PAYMENT) AS BIGINT) AS inst_total_amt_paid,
                 avg(AMT_PAYMENT) AS inst_avg_amt_paid FROM installments_payments GROUP BY SK_ID_CURR),
    d AS (SELECT SK_ID_CURR, count(*) AS cc_records_cnt, avg(AMT_BALANCE) AS cc_avg_balance,
                 max(AMT_BALANCE) AS cc_max_balance FROM credit_card_balance GROUP BY SK_ID_CURR),
    enriched AS (
        SELECT a.SK_ID_CURR, a.TARGET, a.NAME_CONTRACT_TYPE, a.CODE_GENDER, a.FLAG_OWN_CAR,
               a.FLAG_OWN_REALTY, a.CNT_CHILDREN, a.AMT_INCOME_TOTAL, a.AMT_CREDIT, a.AMT_ANNUITY,
               a.AMT_GOODS_PRICE, b.* EXCLUDE (SK_ID_CURR), p.* EXCLUDE (SK_ID_CURR),
               c.* EXCLUDE (SK_ID_CURR), i.* EXCLUDE (SK_ID_CURR), d.* EXCLUDE (SK_ID_CURR)
        FROM application_train a
        LEFT JOIN b ON a.SK_ID_CURR = b.SK_ID_CURR LEFT JOIN p ON a.SK_ID_CURR = p.SK_ID_CURR
        LEFT JOIN c ON a.SK_ID_CURR = c.SK_ID_CURR LEFT JOIN i ON a.SK_ID_CURR = i.SK_ID_CURR
        LEFT JOIN d ON a.SK_ID_CURR = d.SK_ID_CURR),
    tagged AS (
        SELECT *, CASE WHEN SK_ID_CURR IS NULL THEN 'NULL_SK_ID_CURR' WHEN TARGET IS NULL THEN 'NULL_TARGET'
                       WHEN TARGET NOT IN (0, 1) THEN 'INVALID_TARGET'
                       WHEN AMT_CREDIT IS NULL THEN 'NULL_AMT_CREDIT'
                       WHEN AMT_INCOME_TOTAL IS NULL THEN 'NULL_AMT_INCOME_TOTAL' END AS reject_reason
        FROM enriched)"""
)


def _enriched(spark: SparkSession, folder: str) -> DataFrame:
    children = {name: clean(spark, folder, name) for name in CHILDREN}
    return enrich(clean(spark, folder, "application_train"), children)


@query("stg_enriched", ENRICHED + " SELECT * EXCLUDE (reject_reason) FROM tagged WHERE reject_reason IS NULL")
def stg_enriched(spark: SparkSession, folder: str) -> DataFrame:
    return validate_staging(_enriched(spark, folder)).valid


@query("stg_enriched_rejects", ENRICHED + " SELECT * FROM tagged WHERE reject_reason IS NOT NULL")
def stg_enriched_rejects(spark: SparkSession, folder: str) -> DataFrame:
    return validate_staging(_enriched(spark, folder)).rejects


SUITES = {
    "dim_customer": [
        Expectation(NOT_NULL, {"column": "customer_key"}),
        Expectation(UNIQUE, {"column": "customer_key"}),
        Expectation(UNIQUE, {"column": "amt_income_total"}),
        Expectation(IN_SET, {"column": "code_gender", "value_set": ["M", "F", "XNA"]}),
        Expectation(BETWEEN, {"column": "amt_credit", "min_value": 0}),
        Expectation(IN_SET, {"column": "target", "value_set": [0, 1]}),
        Expectation(ROW_COUNT, {"min_value": 1, "max_value": 100}),
        Expectation(EXISTS, {"column": "customer_key"}),
    ],
    "fact_loans": [
        Expectation(NOT_NULL, {"column": "avg_credit_amount"}),
        Expectation(BETWEEN, {"column": "loan_application_count", "min_value": 1}),
        Expectation(BETWEEN, {"column": "total_bureau_credit", "min_value": 1, "mostly": 0.9}),
    ],
    "dim_bureau": [
        Expectation(NOT_NULL, {"column": "bureau_id"}),
        Expectation(ROW_COUNT, {"min_value": 1_000_000_000, "max_value": None}),
    ],
}

_LINE = """
    SELECT '{suite}' AS suite, 'expect_{kind}' AS expectation, {column} AS column_name, 'critical' AS severity,
           CAST({total} AS BIGINT) AS total, CAST({unexpected} AS BIGINT) AS unexpected,
           {success} AS success FROM {source}"""


def _line(suite: str, kind: str, column: str | None, total: str, unexpected: str, success: str, source: str = "") -> str:
    quoted = "CAST(NULL AS VARCHAR)" if column is None else f"'{column}'"
    return _LINE.format(
        suite=suite, kind=kind, column=quoted, total=total, unexpected=unexpected, success=success, source=source or suite
    )


def _values(suite: str, kind: str, column: str, wrong: str, counted: str = "*", mostly: str = "1.0") -> str:
    total, unexpected = f"count({counted})", f"count(*) FILTER (WHERE {wrong})"
    success = f"({total} - {unexpected}) >= {mostly} * {total}"
    return _line(suite, f"column_values_to_{kind}", column, total, unexpected, success)


def _unique(suite: str, column: str) -> str:
    grouped = f"(SELECT {column}, count(*) AS n FROM {suite} WHERE {column} IS NOT NULL GROUP BY {column})"
    shared = "coalesce(sum(n) FILTER (WHERE n > 1), 0)"
    return _line(
        suite, "column_values_to_be_unique", column, "coalesce(sum(n), 0)", shared, f"{shared} = 0", grouped
    )


SUITE_RESULTS = (
    clean_sql("application_train", "bureau")
    + f", dim_customer AS ({DIM_CUSTOMER}), fact_loans AS ({FACT_LOANS}), "
    + "dim_bureau AS (SELECT SK_ID_BUREAU AS bureau_id FROM bureau)"
    + " UNION ALL ".join(
        [
            _values("dim_customer", "not_be_null", "customer_key", "customer_key IS NULL"),
            _unique("dim_customer", "customer_key"),
            _unique("dim_customer", "amt_income_total"),
            _values("dim_customer", "be_in_set", "code_gender", "code_gender NOT IN ('M', 'F', 'XNA')", "code_gender"),
            _values("dim_customer", "be_between", "amt_credit", "amt_credit < 0", "amt_credit"),
            _values("dim_customer", "be_in_set", "target", "target NOT IN (0, 1)", "target"),
            _line(
                "dim_customer",
                "table_row_count_to_be_between",
                None,
                "count(*)",
                "greatest(count(*) - 100, 0)",
                "count(*) BETWEEN 1 AND 100",
            ),
            _line("dim_customer", "column_to_exist", "customer_key", "1", "0", "true", "(SELECT 1)"),
            _values("fact_loans", "not_be_null", "avg_credit_amount", "avg_credit_amount IS NULL"),
            _values(
                "fact_loans",
                "be_between",
                "loan_application_count",
                "loan_application_count < 1",
                "loan_application_count",
            ),
            _values(
                "fact_loans",
                "be_between",
                "total_bureau_credit",
                "total_bureau_credit < 1",
                "total_bureau_credit",
                "0.9",
            ),
            _values("dim_bureau", "not_be_null", "bureau_id", "bureau_id IS NULL"),
            _line(
                "dim_bureau",
                "table_row_count_to_be_between",
                None,
                "count(*)",
                "greatest(1000000000 - count(*), 0)",
                "count(*) >= 1000000000",
            ),
        ]
    )
)


def _warehouse(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {name: function(spark, folder) for name, function in (
        ("dim_customer", dim_customer), ("fact_loans", fact_loans), ("dim_bureau", dim_bureau)
    )}


@query("suite_results", SUITE_RESULTS)
def suite_results(spark: SparkSession, folder: str) -> DataFrame:
    return evaluate_all(_warehouse(spark, folder), SUITES)


@query(
    "suite_success",
    f"SELECT suite, bool_and(success) AS success FROM ({SUITE_RESULTS}) GROUP BY suite",
)
def suites_passed(spark: SparkSession, folder: str) -> DataFrame:
    return suite_success(evaluate_all(_warehouse(spark, folder), SUITES))


def _counts_sql() -> str:
    """Every raw row is valid or rejected; later products follow from the valid ones."""
    tagged = [f"{name}_tagged AS ({tagged_sql(name)} SELECT * FROM tagged)" for name in TABLES]
    counts = []
    for name in TABLES:
        counts.append(("silver." + name, f"{name}_tagged WHERE reject_reason IS NULL"))
        counts.append((f"quarantine.{name}_rejects", f"{name}_tagged WHERE reject_reason IS NOT NULL"))
    applications = "application_train_tagged WHERE reject_reason IS NULL"
    customers = f"(SELECT DISTINCT {whole('SK_ID_CURR')} FROM {applications})"
    counts += [
        ("staging.stg_loan_application_enriched", applications),
        ("quarantine.stg_loan_application_enriched_rejects", f"{applications} AND TARGET IS NULL"),
        ("warehouse.dim_customer", customers),
        ("warehouse.fact_loans", customers),
        ("warehouse.dim_bureau", "bureau_tagged WHERE reject_reason IS NULL"),
        ("warehouse.suite_results", f"range({sum(map(len, SUITES.values()))})"),
    ]
    lines = [f"SELECT '{product}' AS product, count(*) AS num_rows FROM {rows}" for product, rows in counts]
    return f"WITH {', '.join(tagged)} {' UNION ALL '.join(lines)}"


# Validation drops applications without a valid target or amounts; validated amounts are doubles, and so are their sums.
_VALID = ", valid AS (SELECT * FROM application_train WHERE TARGET IN (0, 1) AND AMT_CREDIT > 0 AND AMT_INCOME_TOTAL > 0) "
_LANDED = FACT_LOANS.replace("FROM application_train", "FROM valid")


@query(
    "strict_run",
    f"""{clean_sql("application_train", "bureau")}{_VALID}
    SELECT * REPLACE (CAST(total_bureau_credit AS DOUBLE) AS total_bureau_credit) FROM ({_LANDED})""",
)
def strict_run(spark: SparkSession, folder: str) -> DataFrame:
    """The default run on clean input, gates on, landed, and the landed fact table read back."""
    raw = {name: clean(spark, folder, name) for name in TABLES}
    lake, namespace = Lake(spark, scratch_folder(spark, "run")), own_name(spark, "landed")
    products = run(lake, raw, land_as=namespace, land_format="parquet")
    return spark.table(f"{namespace}.fact_loans").select(*products["warehouse.fact_loans"].columns)


@query("product_counts", _counts_sql())
def all_products(spark: SparkSession, folder: str) -> DataFrame:
    """The whole run on dirty input, one row per product with its row count."""
    raw = {name: dirty(spark, folder, name) for name in TABLES}
    # columns the dirty stand-ins leave out
    for name in ("application_train", "bureau"):
        present = set(raw[name].columns)
        missing = [column for column in clean(spark, folder, name).columns if column not in present]
        raw[name] = raw[name].selectExpr("*", *[f"CAST(NULL AS STRING) AS {column}" for column in missing])
    lake = Lake(spark, scratch_folder(spark, "products"))
    return product_counts(run(lake, raw, SUITES, strict=False))


# The tests of the warehouse as a model file declares them, with a few that fail on the stand-ins.
DECLARED = {
    "models": [
        {
            "name": "dim_customer",
            "tests": [{"dbt_utils.unique_combination_of_columns": {"combination_of_columns": ["code_gender", "amt_credit"], "warn_if": "> 3", "severity": "warn"}}],
            "columns": [
                {"name": "customer_key", "tests": ["not_null", "unique"]},
                {"name": "target", "tests": [{"not_null": {"config": {"error_if": "> 1000000", "warn_if": "> 0"}}}, {"accepted_values": {"values": [0, 1]}}]},
                {"name": "amt_credit", "tests": [{"dbt_utils.accepted_range": {"min_value": 0, "where": "target = 1"}}]},
            ],
        },
        {
            "name": "dim_bureau",
            "columns": [
                {"name": "bureau_id", "tests": ["not_null", "unique"]},
                {"name": "customer_id", "tests": [{"relationships": {"to": "ref('dim_customer')", "field": "customer_key"}}]},
                {"name": "credit_active", "tests": [{"dbt_utils.not_constant": {"group_by_columns": ["customer_id"], "error_if": "> 5"}}]},
            ],
        },
        {
            "name": "fact_loans",
            "tests": [{"dbt_utils.expression_is_true": {"expression": "total_bureau_credit >= avg_credit_amount"}}],
            "columns": [
                {"name": "customer_key", "tests": ["not_null", {"relationships": {"to": "ref('dim_customer')", "field": "customer_key"}}]},
                {"name": "avg_credit_amount", "tests": ["not_null"]},
            ],
        },
    ]
}


def _failures(model: str, test: str, column: str | None, count: str, error: str = "<> 0", warn: str = "<> 0") -> str:
    name = "CAST(NULL AS VARCHAR)" if column is None else f"'{column}'"
    status = f"CASE WHEN failures {error} THEN 'error' WHEN failures {warn} THEN 'warn' ELSE 'pass' END"
    return f"SELECT '{model}' AS model, '{test}' AS test, {name} AS column_name, failures, {status} AS status FROM ({count})"


def _where(model: str, condition: str) -> str:
    return f"SELECT count(*) AS failures FROM {model} WHERE {condition}"


def _twice(model: str, columns: str, where: str = "true") -> str:
    return f"SELECT count(*) AS failures FROM (SELECT {columns} FROM {model} WHERE {where} GROUP BY {columns} HAVING count(*) > 1)"


_UNKNOWN = "NOT EXISTS (SELECT 1 FROM dim_customer d WHERE d.customer_key = {0}) AND {0} IS NOT NULL"
DECLARED_TESTS = (
    clean_sql("application_train", "bureau")
    + f", dim_customer AS ({DIM_CUSTOMER}), fact_loans AS ({FACT_LOANS}), "
    + "dim_bureau AS (SELECT SK_ID_BUREAU AS bureau_id, SK_ID_CURR AS customer_id, CREDIT_ACTIVE AS credit_active FROM bureau)"
    + " UNION ALL ".join(
        [
            _failures("dim_customer", "dbt_utils.unique_combination_of_columns", None, _twice("dim_customer", "code_gender, amt_credit"), "IS NULL", "> 3"),
            _failures("dim_customer", "not_null", "customer_key", _where("dim_customer", "customer_key IS NULL")),
            _failures("dim_customer", "unique", "customer_key", _twice("dim_customer", "customer_key", "customer_key IS NOT NULL")),
            _failures("dim_customer", "not_null", "target", _where("dim_customer", "target IS NULL"), "> 1000000", "> 0"),
            _failures("dim_customer", "accepted_values", "target", "SELECT count(DISTINCT target) AS failures FROM dim_customer WHERE target NOT IN (0, 1)"),
            _failures("dim_customer", "dbt_utils.accepted_range", "amt_credit", _where("dim_customer", "target = 1 AND NOT amt_credit >= 0")),
            _failures("dim_bureau", "not_null", "bureau_id", _where("dim_bureau", "bureau_id IS NULL")),
            _failures("dim_bureau", "unique", "bureau_id", _twice("dim_bureau", "bureau_id", "bureau_id IS NOT NULL")),
            _failures("dim_bureau", "relationships", "customer_id", _where("dim_bureau", _UNKNOWN.format("customer_id"))),
            _failures(
                "dim_bureau", "dbt_utils.not_constant", "credit_active",
                "SELECT count(*) AS failures FROM (SELECT customer_id FROM dim_bureau GROUP BY 1 HAVING count(DISTINCT credit_active) = 1)", "> 5",
            ),
            _failures("fact_loans", "dbt_utils.expression_is_true", None, _where("fact_loans", "NOT total_bureau_credit >= avg_credit_amount")),
            _failures("fact_loans", "not_null", "customer_key", _where("fact_loans", "customer_key IS NULL")),
            _failures("fact_loans", "relationships", "customer_key", _where("fact_loans", _UNKNOWN.format("customer_key"))),
            _failures("fact_loans", "not_null", "avg_credit_amount", _where("fact_loans", "avg_credit_amount IS NULL")),
        ]
    )
)


@query("declared_tests", DECLARED_TESTS)
def declared_tests(spark: SparkSession, folder: str) -> DataFrame:
    """All declared tests of three models, planned together."""
    return evaluate_declared(_warehouse(spark, folder), declarations(DECLARED))
