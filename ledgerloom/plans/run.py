"""The end-to-end run: validate, enrich, gate, model, check, land."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import partial, reduce
from typing import TypeVar

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.plans import warehouse
from ledgerloom.plans.features import CHILDREN, KEY, enrich
from ledgerloom.quality import checks
from ledgerloom.quality.suite import WAREHOUSE_SUITES, Expectation, evaluate_all, require_success
from ledgerloom.quality.validators import TABLES, store_staging, validate_and_store
from ledgerloom.sources.tables import Lake, land


Result = TypeVar("Result")

# Jobs started side by side. Large ones share the cluster anyway; small ones fill idle cores.
CONCURRENT_JOBS = 4


def side_by_side(steps: Mapping[str, Callable[[], Result]]) -> dict[str, Result]:
    """Run steps that do not depend on each other; the first error is raised."""
    with ThreadPoolExecutor(CONCURRENT_JOBS) as pool:
        started = {name: pool.submit(step) for name, step in steps.items()}
        return {name: future.result() for name, future in started.items()}


def warehouse_tests(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The key tests of the warehouse tables; each must return no rows."""
    return {
        "not_null dim_customer.customer_key": checks.not_null(tables["dim_customer"], "customer_key"),
        "unique dim_customer.customer_key": checks.unique(tables["dim_customer"], "customer_key"),
        "not_null dim_bureau.bureau_id": checks.not_null(tables["dim_bureau"], "bureau_id"),
        "unique dim_bureau.bureau_id": checks.unique(tables["dim_bureau"], "bureau_id"),
        "not_null fact_loans.avg_credit_amount": checks.not_null(tables["fact_loans"], "avg_credit_amount"),
        "relationships fact_loans.customer_key": checks.relationships(
            tables["fact_loans"], "customer_key", tables["dim_customer"], "customer_key"
        ),
    }


def run(
    lake: Lake,
    raw: Mapping[str, DataFrame],
    suites: Mapping[str, Sequence[Expectation]] = WAREHOUSE_SUITES,
    from_raw: bool = False,
    strict: bool = True,
    land_as: str | None = None,
    land_format: str = "iceberg",
) -> dict[str, DataFrame]:
    """Build every product of the seven raw tables in ``lake`` and return them by name.

    Steps, in order: silver and quarantine, enriched staging, staging gate,
    dimensions and fact, expectation suites, key tests, landing in the namespace
    ``land_as`` as ``land_format``. Each step reads what the step before has written. ``from_raw``
    builds the warehouse from unvalidated rows instead of silver. A failed gate,
    suite or test raises ``CheckFailed`` if ``strict``.
    """
    products: dict[str, DataFrame] = {}
    checked = side_by_side({name: partial(validate_and_store, lake, raw[name], name) for name in TABLES})
    for name, sides in checked.items():
        products[f"silver.{name}"] = sides.valid
        products[f"quarantine.{name}_rejects"] = sides.rejects

    numeric = {name: sides.numbers for name, sides in checked.items()}
    enriched = enrich(numeric["application_train"], {name: numeric[name] for name in CHILDREN})
    staged = store_staging(lake, enriched)
    products["staging.stg_loan_application_enriched"] = staged.valid
    products["quarantine.stg_loan_application_enriched_rejects"] = staged.rejects
    if strict:
        checks.staging_gate(staged.valid, KEY)

    source = raw if from_raw else numeric
    applications = warehouse.stg_applications(source["application_train"])
    bureau = warehouse.stg_bureau(source["bureau"])
    models = {
        "dim_customer": warehouse.dim_customer(applications),
        "dim_bureau": warehouse.dim_bureau(source["bureau"]),
        "fact_loans": warehouse.fact_loans(applications, bureau),
    }
    side_by_side({name: partial(lake.write, model, "warehouse", name) for name, model in models.items()})
    tables = {name: lake.read("warehouse", name) for name in models}
    products |= {f"warehouse.{name}": table for name, table in tables.items()}

    results = evaluate_all(tables, suites)
    lake.write(results, "warehouse", "suite_results")
    products["warehouse.suite_results"] = lake.read("warehouse", "suite_results")
    if strict:
        require_success(products["warehouse.suite_results"])
        for name, failing in warehouse_tests(tables).items():
            if (found := checks.outcome(failing)).status == "error":
                raise checks.CheckFailed(f"{name}: {found.failures} failures")
    if land_as:
        for name, table in tables.items():
            products[land(table, land_as, name, land_format)] = table
    return products


def product_counts(products: Mapping[str, DataFrame]) -> DataFrame:
    """One row per product with its row count."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("num_rows")).select(F.lit(name).alias("product"), "num_rows")
        for name, df in products.items()
    ]
    return reduce(DataFrame.unionByName, counts)
