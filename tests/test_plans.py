"""Plans that hold at scale, for every registered query."""

import re

import pytest
from pyspark.sql import functions as F

from ledgerloom.queries import QUERIES
from ledgerloom.queries.standins import clean, dirty
from ledgerloom.plans.features import CHILDREN, child_features, enrich
from ledgerloom.quality.validators import validate, validate_and_store
from ledgerloom.sources.tables import Lake

FOLDER = "/root/testdata/sf0.001"
# These only read back what they have written.
WRITING = {"product_counts", "stored_validation"}


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def operator_lines(plan):
    return [re.sub(r"^[\s:+\-*]*(\*?\(\d+\)\s*)?", "", line) for line in plan.splitlines()]


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITING))
def test_plan(spark, name):
    plan = physical(QUERIES[name](spark, FOLDER))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert not re.search("Python|ArrowEval|MapInPandas", plan)
    lines = operator_lines(plan)
    for line, below in zip(lines, lines[1:]):
        if line.startswith("Exchange SinglePartition"):
            # only partial results go to one task: aggregates, the head of a limit, one row per range, hot keys
            assert re.match(r"(Hash|Sort|ObjectHash)Aggregate|LocalLimit|Project \[_range|Project .* AS _parts", below), below


def test_features_read_only_their_columns(spark):
    plan = physical(child_features("previous_application", clean(spark, FOLDER, "previous_application")))
    assert "ReadSchema: struct<o_custkey:bigint,o_totalprice:double>" in plan


def _enriched(spark, **options):
    children = {name: clean(spark, FOLDER, name) for name in CHILDREN}
    return enrich(clean(spark, FOLDER, "application_train"), children, **options)


def test_enriching_starts_no_job(spark):
    """The plan does not depend on the data: rows that cannot be read are no obstacle to building it."""
    applications = clean(spark, FOLDER, "application_train")
    broken = applications.withColumn("SK_ID_CURR", F.raise_error(F.lit("read")).cast("int"))
    children = {name: clean(spark, FOLDER, name) for name in CHILDREN}
    enrich(broken, children)


def test_nothing_is_broadcast_by_force(spark):
    assert "ResolvedHint" not in _enriched(spark)._jdf.queryExecution().analyzed().toString()


def test_features_of_stored_text_read_only_their_numbers(spark, tmp_path):
    stored = validate_and_store(Lake(spark, str(tmp_path)), dirty(spark, FOLDER, "pos_cash_balance"), "pos_cash_balance")
    plan = physical(child_features("pos_cash_balance", stored.numbers))
    assert "ReadSchema: struct<__SK_ID_CURR:int,__SK_DPD:double>" in plan and "regexp" not in plan


def test_text_is_converted_once(spark):
    plan = physical(validate(dirty(spark, FOLDER, "bureau"), "bureau").rejects)
    assert plan.count("regexp_extract_all") == 2  # one per integer column


def test_latest_row_is_found_before_the_shuffle(spark):
    plan = physical(QUERIES["dedup_latest"](spark, FOLDER))
    assert plan.index("WindowGroupLimit") < plan.index("Exchange hashpartitioning") < plan.rindex("WindowGroupLimit")


def test_set_difference_is_one_shuffle(spark):
    plan = physical(QUERIES["check_equality"](spark, FOLDER))
    assert len([line for line in operator_lines(plan) if line.startswith("Exchange")]) == 1


def test_filters_reach_the_files(spark):
    assert "PushedFilters: [In(event_type, [click,error,none])]" in physical(QUERIES["check_not_accepted_values"](spark, FOLDER))
    assert re.search(r"PushedFilters: \[.*GreaterThan\(value,5.0\)", physical(QUERIES["column_values"](spark, FOLDER)))
