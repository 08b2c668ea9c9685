"""Features, models and the end-to-end run."""

import pytest

from ledgerloom.plans import warehouse
from ledgerloom.plans.features import BASE_COLUMNS, FEATURES, child_features, enrich
from ledgerloom.plans.run import product_counts, run
from ledgerloom.quality.checks import CheckFailed
from ledgerloom.quality.suite import SHIPPED_ROW_COUNTS, warehouse_suites
from ledgerloom.quality.validators import TABLES
from ledgerloom.sources.tables import Lake


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_bureau_features(spark):
    """Amounts that are missing count in no average; records without an applicant are a group of their own."""
    records = [(7, 70, 12.5, 3), (7, 71, None, 1), (7, 72, 7.5, None), (8, 80, None, None), (None, 90, 4.0, 2), (9, 91, -2.0, 0)]
    bureau = spark.createDataFrame(records, "SK_ID_CURR int, SK_ID_BUREAU int, AMT_CREDIT_SUM double, CREDIT_DAY_OVERDUE int")
    features = child_features("bureau", bureau)
    assert features.columns == ["SK_ID_CURR", *FEATURES["bureau"]]
    assert rows(features.filter("SK_ID_CURR IS NOT NULL")) == [
        (7, 3, 10.0, 12.5, 2.0, 3),
        (8, 1, None, None, None, None),
        (9, 1, -2.0, -2.0, 0.0, 0),
    ]


def test_every_application_keeps_its_row(spark):
    """An applicant twice, one without a key, one without children, and children without an applicant."""
    applications = [(7, 0, 900.0), (7, 1, 300.0), (None, 0, 50.0), (8, None, None), (9, 1, 10.0)]
    app = spark.createDataFrame(applications, "SK_ID_CURR int, TARGET int, AMT_CREDIT double")
    previous = [(7, 1, 40.0, 10.0), (7, 2, None, 30.0), (9, 3, 6.0, 2.0), (None, 4, 1.0, 1.0), (55, 5, 1.0, 1.0)]
    prev = spark.createDataFrame(previous, "SK_ID_CURR int, SK_ID_PREV int, AMT_APPLICATION double, AMT_CREDIT double")
    paid = [(9, 3, 1.5), (9, 3, None), (7, 1, 8.0), (None, 4, 99.0)]
    inst = spark.createDataFrame(paid, "SK_ID_CURR int, SK_ID_PREV int, AMT_PAYMENT double")
    enriched = enrich(app, {"installments_payments": inst, "previous_application": prev})
    assert enriched.columns == ["SK_ID_CURR", "TARGET", "AMT_CREDIT", *FEATURES["previous_application"], *FEATURES["installments_payments"]]
    of_7 = (2, 40.0, 20.0, 1, 8.0, 8.0)
    assert rows(enriched) == sorted(
        [
            (7, 0, 900.0, *of_7), (7, 1, 300.0, *of_7), (None, 0, 50.0, *[None] * 6),
            (8, None, None, *[None] * 6), (9, 1, 10.0, 1, 6.0, 2.0, 2, 1.5, 1.5),
        ],
        key=str,
    )


def test_all_features():
    assert len(BASE_COLUMNS) == 11
    assert sum(map(len, FEATURES.values())) == 17


APPLICATION = {
    "SK_ID_CURR": "1",
    "TARGET": "0",
    "NAME_CONTRACT_TYPE": "Cash loans",
    "CODE_GENDER": "M",
    "FLAG_OWN_CAR": "N",
    "FLAG_OWN_REALTY": "Y",
    "CNT_CHILDREN": "0",
    "AMT_INCOME_TOTAL": "1000",
    "AMT_CREDIT": "500",
    "AMT_ANNUITY": "10",
    "AMT_GOODS_PRICE": "400",
    "NAME_EDUCATION_TYPE": "Higher",
    "OCCUPATION_TYPE": None,
    "ORGANIZATION_TYPE": "School",
}
BUREAU = {name: "1" for name in warehouse.DIM_BUREAU_COLUMNS}
CHILD = {"SK_ID_PREV": "5", "SK_ID_CURR": "1", "MONTHS_BALANCE": "-1"}


@pytest.fixture
def raw(spark):
    def frame(*records):
        schema = ", ".join(f"{name} string" for name in records[0])
        return spark.createDataFrame([tuple(r.values()) for r in records], schema)

    return {
        "application_train": frame(
            APPLICATION,
            APPLICATION | {"SK_ID_CURR": "2", "TARGET": "1", "CODE_GENDER": "F"},
            APPLICATION | {"SK_ID_CURR": "bad"},
            APPLICATION | {"SK_ID_CURR": "3", "AMT_CREDIT": "-1"},
        ),
        "bureau": frame(
            BUREAU | {"AMT_CREDIT_SUM": "100.5"},
            BUREAU | {"SK_ID_BUREAU": "2", "SK_ID_CURR": " 1.0", "AMT_CREDIT_SUM": "200"},
            BUREAU | {"SK_ID_BUREAU": "3", "CREDIT_DAY_OVERDUE": "-4"},
        ),
        "bureau_balance": frame({"SK_ID_BUREAU": "1", "MONTHS_BALANCE": "-1", "STATUS": "C"}),
        "previous_application": frame({"SK_ID_PREV": "5", "SK_ID_CURR": "1", "AMT_APPLICATION": "10", "AMT_CREDIT": "20"}),
        "pos_cash_balance": frame(CHILD | {"SK_DPD": "3"}, CHILD | {"SK_DPD": "5"}),
        "installments_payments": frame({"SK_ID_PREV": "5", "SK_ID_CURR": "1", "AMT_PAYMENT": "7", "AMT_INSTALMENT": "7"}),
        "credit_card_balance": frame(CHILD | {"AMT_BALANCE": "-3"}),
    }


def test_run(spark, tmp_path, raw):
    products = run(Lake(spark, str(tmp_path)), raw, land_as="landed_warehouse", land_format="parquet")
    counts = {r["product"]: r["num_rows"] for r in product_counts(products).collect()}
    for table in TABLES:
        assert counts[f"silver.{table}"] + counts[f"quarantine.{table}_rejects"] == raw[table].count()
    assert counts["quarantine.application_train_rejects"] == 2
    enriched = {r["SK_ID_CURR"]: r.asDict() for r in products["staging.stg_loan_application_enriched"].collect()}
    assert set(enriched) == {1, 2}
    assert enriched[1]["bureau_records_cnt"] == 2 and enriched[1]["bureau_avg_credit_sum"] == 150.25
    assert enriched[1]["pos_max_dpd"] == 5.0 and enriched[2]["pos_max_dpd"] is None
    assert rows(products["warehouse.fact_loans"]) == [(1, 500.0, 1000.0, 1, 2, 300.5), (2, 500.0, 1000.0, 1, 0, 0.0)]
    assert counts["warehouse.dim_customer"] == 2 and counts["warehouse.dim_bureau"] == 2
    assert spark.table("landed_warehouse.fact_loans").count() == 2


def test_run_stops_at_failures(spark, tmp_path, raw):
    duplicated = raw | {"application_train": raw["application_train"].union(raw["application_train"])}
    with pytest.raises(CheckFailed, match="SK_ID_CURR"):
        run(Lake(spark, str(tmp_path / "a")), duplicated)
    with pytest.raises(CheckFailed, match="expect_table_row_count"):
        run(Lake(spark, str(tmp_path / "b")), raw, warehouse_suites(SHIPPED_ROW_COUNTS))
    unchecked = run(Lake(spark, str(tmp_path / "c")), duplicated, strict=False)
    assert unchecked["staging.stg_loan_application_enriched"].count() == 4


def test_models(spark):
    app = spark.createDataFrame([(1, 0, 10.0), (1, 0, 10.0), (1, 0, 30.0), (None, 1, 5.0)], "SK_ID_CURR int, TARGET int, AMT_CREDIT double")
    for name in warehouse.APPLICATION_NAMES:
        if name not in app.columns:
            app = app.selectExpr("*", f"CAST(NULL AS DOUBLE) AS {name}")
    applications = warehouse.stg_applications(app)
    assert warehouse.stg_loans(applications).columns == ["customer_id", "loan_amount", "income", "annuity", "default_flag"]
    assert warehouse.dim_customer(applications).count() == 2
    bureau = spark.createDataFrame([(1, 7, 1.0), (1, 7, 2.0), (1, 8, None), (None, 9, 4.0)], "customer_id int, bureau_id int, AMT_CREDIT_SUM double")
    facts = warehouse.fact_loans(applications, bureau)
    # a NULL customer keeps its row and matches nothing
    assert rows(facts) == [(1, 50 / 3, None, 3, 2, 3.0), (None, 5.0, None, 1, 0, 0.0)]
