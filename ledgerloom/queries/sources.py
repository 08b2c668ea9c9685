"""Landing, layered tables, discovery and scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators.grouping import column_values
from ledgerloom.queries.registry import own_name, query, table
from ledgerloom.session import scratch_folder
from ledgerloom.sources import csv_files, tables
from ledgerloom.sources.discovery import union_folders, union_tables_like
from ledgerloom.sources.tables import Lake

CUSTOMER = "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING"


@query("csv_round_trip", "SELECT * FROM customer")
def csv_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """A CSV file with padded headers, landed with a given schema."""
    lake = Lake(spark, scratch_folder(spark, "csv"))
    customer = table(spark, folder, "customer")
    padded = customer.toDF(*[f" {name} " for name in customer.columns])
    padded.write.option("header", True).option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False
    ).csv(f"{lake.root}/files/customer.csv")
    csv_files.ingest(lake, f"{lake.root}/files", {"customer.csv": "customer"}, {"customer": CUSTOMER})
    return lake.read("raw", "customer")


@query(
    "csv_inferred",
    "SELECT CAST(o_orderkey AS INTEGER) AS o_orderkey, CAST(o_custkey AS INTEGER) AS o_custkey, o_orderstatus, "
    "o_totalprice, o_orderpriority FROM orders",
)
def csv_inferred(spark: SparkSession, folder: str) -> DataFrame:
    lake = Lake(spark, scratch_folder(spark, "csv"))
    table(spark, folder, "orders").drop("o_orderdate").write.option("header", True).csv(f"{lake.root}/files/orders.csv")
    csv_files.ingest(lake, f"{lake.root}/files", {"orders.csv": "orders"})
    return lake.read("raw", "orders")


@query(
    "csv_observed_types",
    """SELECT CAST(o_orderkey AS INTEGER) AS o_orderkey, lpad(CAST(o_custkey AS VARCHAR), 9, '0') AS code,
              CAST(o_orderkey AS BIGINT) * 10000000000 AS wide, o_totalprice, o_orderpriority FROM orders""",
)
def csv_observed_types(spark: SparkSession, folder: str) -> DataFrame:
    """A CSV file landed as text in one pass, read back in the types its values have."""
    lake = Lake(spark, scratch_folder(spark, "csv"))
    orders = table(spark, folder, "orders").selectExpr(
        "o_orderkey", "lpad(CAST(o_custkey AS STRING), 9, '0') AS code", "o_orderkey * 10000000000 AS wide", "o_totalprice", "o_orderpriority"
    )
    orders.write.option("header", True).csv(f"{lake.root}/files/orders.csv")
    csv_files.ingest_as_text(lake, f"{lake.root}/files", {"orders.csv": "orders"})
    return csv_files.read_typed(lake, "raw", "orders")


@query(
    "landed_tables",
    """
    SELECT 'raw.customer' AS name, count(*) AS rows_counted, 5 AS columns_counted FROM customer
    UNION ALL SELECT 'raw.orders', count(*), 6 FROM orders
    UNION ALL SELECT 'raw.supplier', count(*), 4 FROM supplier""",
)
def landed_tables(spark: SparkSession, folder: str) -> DataFrame:
    """Row counts as seen during the write."""
    lake = Lake(spark, scratch_folder(spark, "landed"))
    files = {}
    for name in ("customer", "orders", "supplier"):
        table(spark, folder, name).write.option("header", True).csv(f"{lake.root}/files/{name}.csv")
        files[f"{name}.csv"] = name
    landed = csv_files.ingest(lake, f"{lake.root}/files", files)
    rows = [(entry.table, entry.rows, entry.columns) for entry in landed]
    return spark.createDataFrame(rows, "name string, rows_counted bigint, columns_counted int")


def _accounts(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    customer = table(spark, folder, "customer").selectExpr("c_custkey AS id", "c_acctbal AS balance", "c_mktsegment AS segment")
    supplier = table(spark, folder, "supplier").selectExpr("s_suppkey AS id", "s_acctbal AS balance")
    return customer, supplier


UNION_ACCOUNTS = """
    SELECT c_custkey AS id, c_acctbal AS balance, c_mktsegment AS segment FROM customer
    UNION ALL SELECT s_suppkey, s_acctbal, NULL FROM supplier"""


@query("union_tables_like", UNION_ACCOUNTS)
def union_like(spark: SparkSession, folder: str) -> DataFrame:
    """Catalog tables found by pattern, one of them excluded."""
    lake = Lake(spark, scratch_folder(spark, "accounts"), catalog=True)
    customer, supplier = _accounts(spark, folder)
    accounts = own_name(spark, "accounts")
    lake.write(customer, accounts, "acct_customer")
    lake.write(supplier, accounts, "acct_supplier")
    lake.write(supplier, accounts, "acct_supplier_old")
    return union_tables_like(spark, accounts, "ACCT_%", exclude="%_old", source_column=None)


@query("union_folders", UNION_ACCOUNTS)
def union_of_folders(spark: SparkSession, folder: str) -> DataFrame:
    lake = Lake(spark, scratch_folder(spark, "accounts"))
    customer, supplier = _accounts(spark, folder)
    lake.write(customer, "accounts", "customer")
    lake.write(supplier, "accounts", "supplier")
    return union_folders(spark, [lake.path("accounts", name) for name in ("customer", "supplier")], source_column=None)


@query("union_many_folders", "SELECT o_orderpriority AS _dbt_source_relation, o_orderkey, o_custkey FROM orders WHERE o_custkey > 10")
def union_many_folders(spark: SparkSession, folder: str) -> DataFrame:
    """One versioned folder for each priority, read as one scan that labels rows by their file."""
    lake = Lake(spark, scratch_folder(spark, "priorities"))
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    names = column_values(orders, "o_orderpriority")
    for name in names:
        lake.write(orders.filter(F.col("o_orderpriority") == name).drop("o_orderpriority"), "by_priority", name)
    return union_folders(spark, [lake.path("by_priority", name) for name in names], where="o_custkey > 10")


@query("layer_tables", "SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey")
def layer_tables(spark: SparkSession, folder: str) -> DataFrame:
    """Tables of two layers, written and read through the catalog."""
    lake = Lake(spark, scratch_folder(spark, "layers"), catalog=True)
    raw, staging = own_name(spark, "raw"), own_name(spark, "staging")
    lake.write(table(spark, folder, "nation"), raw, "nation")
    lake.write(table(spark, folder, "region"), staging, "region")
    nation, region = spark.table(f"{raw}.nation"), spark.table(f"{staging}.region")
    joined = nation.join(region, nation["n_regionkey"] == region["r_regionkey"])
    return joined.select("n_nationkey", "n_name", "r_name")


@query("key_bounds", "SELECT min(o_orderkey) AS lo, max(o_orderkey) AS hi FROM orders")
def bounds(spark: SparkSession, folder: str) -> DataFrame:
    return tables.bounds_frame(table(spark, folder, "orders"), "o_orderkey")


@query("tolerant_scan", "SELECT c_custkey, c_acctbal FROM customer")
def tolerant_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Wanted columns that exist; the others are not an error."""
    return tables.existing_columns(table(spark, folder, "customer"), ["c_custkey", "c_phone", "c_acctbal", "c_custkey"])


@query("materialized_view", "SELECT l_suppkey, count(*) AS num_rows FROM lineitem GROUP BY l_suppkey")
def materialized_view(spark: SparkSession, folder: str) -> DataFrame:
    """A model kept as a view and grouped through it."""
    view = tables.materialize(table(spark, folder, "lineitem").select("l_suppkey"), "lineitem_suppliers")
    return view.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("num_rows"))


REFRESHED = "SELECT c_custkey AS id, c_acctbal AS balance, c_mktsegment AS segment FROM customer"


@query("refreshed_table", REFRESHED)
def refreshed_table(spark: SparkSession, folder: str) -> DataFrame:
    """A table refreshed twice with more columns the second time, read by path."""
    lake = Lake(spark, scratch_folder(spark, "refreshed"))
    customer, supplier = _accounts(spark, folder)
    lake.write(supplier, "raw", "account")
    lake.write(customer, "raw", "account")
    return lake.read("raw", "account")


@query("landed_twice", REFRESHED)
def landed_twice(spark: SparkSession, folder: str) -> DataFrame:
    """A catalog table that moves to the files of its second landing."""
    landed = own_name(spark, "landed")
    customer, supplier = _accounts(spark, folder)
    tables.land(supplier, landed, "account", "parquet")
    return spark.table(tables.land(customer, landed, "account", "parquet"))
