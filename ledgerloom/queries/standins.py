"""The credit tables, derived from the test tables.

Each stand-in is a projection of one test table, written as SQL text both
engines understand. Amounts are whole cents, so that sums do not depend on the
order of addition. ``DIRTY`` holds the same tables as text with NULLs, words and
negative numbers mixed in by key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.queries.registry import table


def cents(column: str) -> str:
    return f"CAST(round({column} * 100) AS BIGINT)"


def whole(column: str) -> str:
    return f"CAST(floor({column}) AS BIGINT)"


def as_int(expression: str) -> str:
    return f"CAST({expression} AS INT)"


# stand-in: test table and projection
CLEAN: dict[str, tuple[str, dict[str, str]]] = {
    "application_train": (
        "customer",
        {
            "SK_ID_CURR": as_int("c_custkey"),
            "TARGET": as_int(
                "CASE WHEN c_custkey % 97 = 0 THEN NULL WHEN c_custkey % 89 = 0 THEN 2 ELSE c_custkey % 2 END"
            ),
            "NAME_CONTRACT_TYPE": "c_mktsegment",
            "CODE_GENDER": "CASE WHEN c_custkey % 3 = 0 THEN 'M' WHEN c_custkey % 3 = 1 THEN 'F' ELSE 'XNA' END",
            "FLAG_OWN_CAR": "CASE WHEN c_custkey % 2 = 0 THEN 'Y' ELSE 'N' END",
            "FLAG_OWN_REALTY": "CASE WHEN c_custkey % 5 = 0 THEN 'N' ELSE 'Y' END",
            "CNT_CHILDREN": as_int("c_custkey % 4"),
            "AMT_INCOME_TOTAL": f"{cents('c_acctbal')} + 100000",
            "AMT_CREDIT": f"CASE WHEN c_custkey % 83 = 0 THEN NULL ELSE {cents('c_acctbal')} END",
            "AMT_ANNUITY": "c_custkey % 1000 * 10",
            "AMT_GOODS_PRICE": f"{cents('c_acctbal')} * 2",
            "NAME_EDUCATION_TYPE": "c_mktsegment",
            "OCCUPATION_TYPE": "c_name",
            "ORGANIZATION_TYPE": "CAST(c_nationkey AS STRING)",
        },
    ),
    "bureau": (
        "orders",
        {
            "SK_ID_BUREAU": as_int("o_orderkey"),
            # the first ten applicants have no credit record
            "SK_ID_CURR": as_int("o_custkey + 10"),
            "CREDIT_ACTIVE": "o_orderstatus",
            "CREDIT_CURRENCY": "CASE WHEN o_orderkey % 50 = 0 THEN 'currency 2' ELSE 'currency 1' END",
            "DAYS_CREDIT": as_int("0 - o_orderkey % 3000"),
            "CREDIT_DAY_OVERDUE": as_int("o_orderkey % 50"),
            "DAYS_CREDIT_ENDDATE": "CAST(o_orderkey % 700 AS DOUBLE)",
            "DAYS_ENDDATE_FACT": "CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE CAST(o_orderkey % 900 AS DOUBLE) END",
            "AMT_CREDIT_MAX_OVERDUE": "CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_orderkey % 100 END",
            "CNT_CREDIT_PROLONG": as_int("o_orderkey % 3"),
            "AMT_CREDIT_SUM": cents("o_totalprice"),
            "AMT_CREDIT_SUM_DEBT": f"{cents('o_totalprice')} * 2",
            "AMT_CREDIT_SUM_LIMIT": f"{cents('o_totalprice')} * 3",
            "AMT_CREDIT_SUM_OVERDUE": "o_orderkey % 1000",
            "CREDIT_TYPE": "o_orderpriority",
            "DAYS_CREDIT_UPDATE": as_int("0 - o_orderkey % 400"),
            "AMT_ANNUITY": "o_orderkey % 5000",
        },
    ),
    "bureau_balance": (
        "lineitem",
        {
            "SK_ID_BUREAU": as_int("l_orderkey"),
            "MONTHS_BALANCE": as_int("0 - l_linenumber"),
            "STATUS": "l_linestatus",
        },
    ),
    "previous_application": (
        "orders",
        {
            "SK_ID_PREV": as_int("o_orderkey"),
            "SK_ID_CURR": as_int("o_custkey"),
            "AMT_APPLICATION": cents("o_totalprice"),
            "AMT_CREDIT": f"{cents('o_totalprice')} * 9",
        },
    ),
    "pos_cash_balance": (
        "events",
        {
            "SK_ID_PREV": as_int("event_id"),
            "SK_ID_CURR": as_int("user_id"),
            "MONTHS_BALANCE": as_int("0 - event_id % 12"),
            "SK_DPD": cents("value"),
        },
    ),
    "installments_payments": (
        "lineitem",
        {
            "SK_ID_PREV": as_int("l_orderkey"),
            "SK_ID_CURR": as_int("l_partkey"),
            "AMT_PAYMENT": cents("l_extendedprice"),
            "AMT_INSTALMENT": f"{cents('l_extendedprice')} + 100",
        },
    ),
    "credit_card_balance": (
        "events",
        {
            "SK_ID_PREV": as_int("event_id"),
            "SK_ID_CURR": as_int("user_id"),
            "MONTHS_BALANCE": as_int("0 - event_id % 24"),
            "AMT_BALANCE": f"{cents('value')} - 2000",
        },
    ),
}


def dirty_int(key: str, value: str, null: int, word: int) -> str:
    """Whole numbers as text: some NULL, some words, some with a fraction or blanks."""
    text = f"CAST({value} AS STRING)"
    return (
        f"CASE WHEN {key} % {null} = 0 THEN NULL WHEN {key} % {word} = 0 THEN 'abc' "
        f"WHEN {key} % 11 = 0 THEN concat({text}, '.7') WHEN {key} % 7 = 0 THEN concat(' ', {text}, ' ') "
        f"ELSE {text} END"
    )


def dirty_amount(key: str, value: str, null: int, word: int, negative: int) -> str:
    """Amounts as text: some NULL, some words, some negative, some in scientific notation."""
    return (
        f"CASE WHEN {key} % {null} = 0 THEN NULL WHEN {key} % {word} = 0 THEN 'n/a' "
        f"WHEN {key} % {negative} = 0 THEN '-5.25' WHEN {key} % 31 = 0 THEN '1e3' "
        f"ELSE CAST({value} AS STRING) END"
    )


DIRTY: dict[str, tuple[str, dict[str, str]]] = {
    "application_train": (
        "customer",
        {
            "SK_ID_CURR": dirty_int("c_custkey", "c_custkey", 37, 41),
            "TARGET": (
                "CASE WHEN c_custkey % 43 = 0 THEN NULL WHEN c_custkey % 47 = 0 THEN 'yes' "
                "WHEN c_custkey % 53 = 0 THEN '2' WHEN c_custkey % 11 = 0 THEN '1.0' "
                "ELSE CAST(c_custkey % 2 AS STRING) END"
            ),
            "NAME_CONTRACT_TYPE": "c_mktsegment",
            "CODE_GENDER": (
                "CASE WHEN c_custkey % 59 = 0 THEN NULL WHEN c_custkey % 61 = 0 THEN 'X' "
                "WHEN c_custkey % 3 = 0 THEN 'M' WHEN c_custkey % 3 = 1 THEN 'F' ELSE 'XNA' END"
            ),
            "AMT_INCOME_TOTAL": dirty_amount("c_custkey", f"{whole('c_acctbal')} + 1000", 67, 71, 73),
            "AMT_CREDIT": dirty_amount("c_custkey", whole("c_acctbal"), 79, 83, 89),
            "AMT_ANNUITY": dirty_amount("c_custkey", "c_custkey % 1000", 97, 29, 101),
            "AMT_GOODS_PRICE": dirty_amount("c_custkey", "c_custkey % 777", 103, 23, 107),
        },
    ),
    "bureau": (
        "orders",
        {
            "SK_ID_CURR": dirty_int("o_orderkey", "o_custkey", 37, 41),
            "SK_ID_BUREAU": dirty_int("o_orderkey", "o_orderkey", 43, 47),
            "CREDIT_ACTIVE": "o_orderstatus",
            "AMT_CREDIT_SUM": dirty_amount("o_orderkey", whole("o_totalprice"), 53, 59, 61),
            "CREDIT_DAY_OVERDUE": dirty_amount("o_orderkey", "o_orderkey % 50", 67, 71, 73),
        },
    ),
    "bureau_balance": (
        "lineitem",
        {
            "SK_ID_BUREAU": dirty_int("l_orderkey", "l_orderkey", 37, 41),
            "MONTHS_BALANCE": dirty_int("l_partkey", "(0 - l_linenumber)", 43, 47),
            "STATUS": "CASE WHEN l_suppkey % 19 = 0 THEN NULL ELSE l_linestatus END",
        },
    ),
    "previous_application": (
        "orders",
        {
            "SK_ID_PREV": dirty_int("o_orderkey", "o_orderkey", 37, 41),
            "SK_ID_CURR": dirty_int("o_custkey", "o_custkey", 43, 47),
            "AMT_APPLICATION": dirty_amount("o_orderkey", whole("o_totalprice"), 53, 59, 61),
            "AMT_CREDIT": dirty_amount("o_orderkey", f"{whole('o_totalprice')} * 9", 67, 71, 73),
        },
    ),
    "pos_cash_balance": (
        "events",
        {
            "SK_ID_PREV": dirty_int("event_id", "event_id", 37, 41),
            "SK_ID_CURR": dirty_int("user_id", "user_id", 43, 47),
            "MONTHS_BALANCE": dirty_int("event_id", "(0 - event_id % 12)", 53, 59),
            "SK_DPD": dirty_amount("event_id", whole("value"), 61, 67, 71),
        },
    ),
    "installments_payments": (
        "lineitem",
        {
            "SK_ID_PREV": dirty_int("l_orderkey", "l_orderkey", 37, 41),
            "SK_ID_CURR": dirty_int("l_partkey", "l_partkey", 43, 47),
            "AMT_PAYMENT": dirty_amount("l_orderkey", whole("l_extendedprice"), 53, 59, 61),
            "AMT_INSTALMENT": dirty_amount("l_partkey", f"{whole('l_extendedprice')} + 100", 67, 71, 73),
        },
    ),
    "credit_card_balance": (
        "events",
        {
            "SK_ID_PREV": dirty_int("event_id", "event_id", 37, 41),
            "SK_ID_CURR": dirty_int("user_id", "user_id", 43, 47),
            "MONTHS_BALANCE": dirty_int("event_id", "(0 - event_id % 24)", 53, 59),
            "AMT_BALANCE": dirty_amount("event_id", whole("value"), 61, 67, 71),
        },
    ),
}


def _frame(spark: SparkSession, folder: str, standin: tuple[str, dict[str, str]]) -> DataFrame:
    source, projection = standin
    return table(spark, folder, source).selectExpr(*[f"{e} AS {name}" for name, e in projection.items()])


def clean(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return _frame(spark, folder, CLEAN[name])


def dirty(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return _frame(spark, folder, DIRTY[name])


def _select(standin: tuple[str, dict[str, str]]) -> str:
    source, projection = standin
    return f"SELECT {', '.join(f'{e} AS {name}' for name, e in projection.items())} FROM {source}"


def clean_sql(*names: str) -> str:
    """``WITH`` clause defining the named stand-ins."""
    return "WITH " + ", ".join(f"{name} AS ({_select(CLEAN[name])})" for name in names)


def dirty_sql(*names: str) -> str:
    return "WITH " + ", ".join(f"{name} AS ({_select(DIRTY[name])})" for name in names)
