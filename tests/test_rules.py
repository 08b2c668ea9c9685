import pytest
from pyspark.sql import functions as F

from ledgerloom.quality.rules import REASON
from ledgerloom.quality.validators import (
    RULES,
    STAGING_RULES,
    TABLES,
    numbers_from_text,
    validate,
    validate_and_store,
    validate_staging,
)
from ledgerloom.sources.tables import Lake

GOOD = {
    "application_train": {
        "SK_ID_CURR": "1",
        "TARGET": "0",
        "AMT_CREDIT": "10.5",
        "AMT_INCOME_TOTAL": "20",
        "AMT_ANNUITY": None,
        "AMT_GOODS_PRICE": "3",
        "CODE_GENDER": None,
        "EXTRA": "kept",
    },
    "bureau": {"SK_ID_CURR": "1", "SK_ID_BUREAU": "2", "AMT_CREDIT_SUM": None, "CREDIT_DAY_OVERDUE": "0"},
    "bureau_balance": {"SK_ID_BUREAU": "2", "MONTHS_BALANCE": "-3", "STATUS": "C"},
    "previous_application": {"SK_ID_CURR": "1", "SK_ID_PREV": "2", "AMT_APPLICATION": "0", "AMT_CREDIT": None},
    "pos_cash_balance": {"SK_ID_CURR": "1", "SK_ID_PREV": "2", "MONTHS_BALANCE": "-1", "SK_DPD": "0"},
    "installments_payments": {"SK_ID_CURR": "1", "SK_ID_PREV": "2", "AMT_PAYMENT": "1e2", "AMT_INSTALMENT": None},
    "credit_card_balance": {"SK_ID_CURR": "1", "SK_ID_PREV": "2", "MONTHS_BALANCE": "0", "AMT_BALANCE": "-7"},
}

BAD_NUMBERS = {"TYPE": "abc", "VALUE": "2", "POSITIVE": "0", "NEGATIVE": "-0.5"}


def breaking(code):
    """Column and value that break the rule with this code."""
    if code.startswith("NULL_"):
        return code.removeprefix("NULL_"), None
    if code == "INVALID_CODE_GENDER":
        return "CODE_GENDER", "X"
    if code == "INVALID_TARGET_VALUE":
        return "TARGET", "2"
    if code.startswith("INVALID_"):
        return code.removeprefix("INVALID_").removesuffix("_TYPE"), "abc"
    if code.startswith("NON_POSITIVE_"):
        return code.removeprefix("NON_POSITIVE_"), "0"
    return code.removeprefix("NEGATIVE_"), "-0.5"


def frame(spark, table, rows):
    schema = ", ".join(f"{name} string" for name in GOOD[table])
    return spark.createDataFrame([tuple(row.values()) for row in rows], schema)


def test_there_are_62_rules():
    assert sum(map(len, RULES.values())) + len(STAGING_RULES) == 62


@pytest.mark.parametrize("table", TABLES)
def test_every_code(spark, table):
    codes = [rule.code for rule in RULES[table]]
    bad = [GOOD[table] | dict([breaking(code)]) for code in codes]
    checked = validate(frame(spark, table, [GOOD[table], *bad]), table)
    assert sorted(r[REASON] for r in checked.rejects.collect()) == sorted(codes)
    assert checked.rejects.columns == [*GOOD[table], REASON]
    assert checked.valid.count() == 1


@pytest.mark.parametrize("table", TABLES)
def test_first_broken_rule_wins(spark, table):
    """A row that breaks two rules shows the one evaluated first."""
    codes = [rule.code for rule in RULES[table]]
    pairs, rows = [], []
    for i, first in enumerate(codes):
        for second in codes[i + 1 :]:
            (a, _), (b, _) = breaking(first), breaking(second)
            if a != b:
                pairs.append(first)
                rows.append(GOOD[table] | dict([breaking(first), breaking(second)]))
    rejects = validate(frame(spark, table, rows), table).rejects
    assert sorted(r[REASON] for r in rejects.collect()) == sorted(pairs)


def test_only_applications_are_retyped(spark):
    valid = validate(frame(spark, "application_train", [GOOD["application_train"]]), "application_train").valid
    assert valid.dtypes == [
        ("CODE_GENDER", "string"),
        ("EXTRA", "string"),
        ("SK_ID_CURR", "int"),
        ("TARGET", "int"),
        ("AMT_CREDIT", "double"),
        ("AMT_INCOME_TOTAL", "double"),
        ("AMT_ANNUITY", "double"),
        ("AMT_GOODS_PRICE", "double"),
    ]
    assert tuple(valid.first()) == (None, "kept", 1, 0, 10.5, 20.0, None, 3.0)
    bureau = frame(spark, "bureau", [GOOD["bureau"]])
    assert validate(bureau, "bureau").valid.dtypes == bureau.dtypes
    assert dict(validate(bureau, "bureau", retype_all=True).valid.dtypes)["SK_ID_BUREAU"] == "int"


def test_numeric_columns(spark):
    """Inferred types instead of text: nothing to convert, the other rules hold."""
    df = spark.createDataFrame([(1, 2, 3.0, -1), (1, 2, None, None), (None, 2, 1.0, 1)], "SK_ID_CURR int, SK_ID_BUREAU bigint, AMT_CREDIT_SUM double, CREDIT_DAY_OVERDUE int")
    checked = validate(df, "bureau")
    assert sorted(r[REASON] for r in checked.rejects.collect()) == ["NEGATIVE_CREDIT_DAY_OVERDUE", "NULL_SK_ID_CURR"]
    assert numbers_from_text(df, "bureau").dtypes == df.dtypes


def test_numbers_from_text(spark):
    df = spark.createDataFrame([(" 7", "8.0", "x", "1e1")], "SK_ID_CURR string, SK_ID_BUREAU string, AMT_CREDIT_SUM string, CREDIT_DAY_OVERDUE string")
    assert tuple(numbers_from_text(df, "bureau").first()) == (7, 8, None, 10.0)


def test_staging_rules(spark):
    rows = [(1, 0, 1.0, 1.0), (None, 0, 1.0, 1.0), (1, None, 1.0, 1.0), (1, 2, 1.0, 1.0), (1, 1, None, 1.0), (1, 1, 1.0, None), (None, 7, None, None)]
    df = spark.createDataFrame(rows, "SK_ID_CURR int, TARGET int, AMT_CREDIT double, AMT_INCOME_TOTAL double")
    checked = validate_staging(df)
    assert checked.valid.count() == 1
    assert sorted(r[REASON] for r in checked.rejects.collect()) == sorted(
        [rule.code for rule in STAGING_RULES] + ["NULL_SK_ID_CURR"]
    )


@pytest.mark.parametrize("table", ["application_train", "bureau"])
@pytest.mark.parametrize("catalog", [False, True])
def test_stored_sides(spark, tmp_path, table, catalog):
    codes = [rule.code for rule in RULES[table]]
    df = frame(spark, table, [GOOD[table]] * 3 + [GOOD[table] | dict([breaking(code)]) for code in codes])
    lake = Lake(spark, str(tmp_path), catalog)
    stored, lazy = validate_and_store(lake, df, table), validate(df, table)
    for side in ("valid", "rejects"):
        written, expected = getattr(stored, side), getattr(lazy, side)
        assert written.dtypes == expected.dtypes
        assert sorted(map(str, written.collect())) == sorted(map(str, expected.collect()))
    if catalog:
        assert spark.table(f"silver.{table}").dtypes == lazy.valid.dtypes
        assert spark.table(f"quarantine.{table}_rejects").count() == len(codes)
    # a clean run replaces the rejects of the run before
    again = validate_and_store(lake, df.limit(3), table)
    assert (again.valid.count(), again.rejects.count()) == (3, 0)
    nothing = validate_and_store(lake, df.filter(F.lit(False)), table)
    assert (nothing.valid.count(), nothing.rejects.count()) == (0, 0)
