"""Columns, grouping, reshaping, set operations and series."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators import columns, digests, grouping, reshape, series, setops
from ledgerloom.queries.registry import query, table
from ledgerloom.queries.standins import cents
from ledgerloom.sources.tables import key_bounds


@query("nullcheck", "SELECT p_partkey, nullif(p_name, '') AS p_name, nullif(kind, '') AS kind, p_size "
    "FROM (SELECT p_partkey, p_name, CASE WHEN p_size > 25 THEN '' ELSE p_type END AS kind, p_size FROM part)")
def nullcheck(spark: SparkSession, folder: str) -> DataFrame:
    parts = table(spark, folder, "part").selectExpr(
        "p_partkey", "p_name", "CASE WHEN p_size > 25 THEN '' ELSE p_type END AS kind", "p_size"
    )
    return columns.nullcheck_table(parts)


@query("star_prefixed", "SELECT c_custkey AS old_c_custkey_x, c_name AS old_c_name_x, c_acctbal AS old_c_acctbal_x, "
    "c_mktsegment AS old_c_mktsegment_x FROM customer")
def star_prefixed(spark: SparkSession, folder: str) -> DataFrame:
    customer = table(spark, folder, "customer")
    return customer.select(*columns.star(customer, exclude=["C_NATIONKEY"], prefix="old_", suffix="_x"))


@query("star_aggregated", "SELECT l_returnflag, l_linestatus, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL")
def star_aggregated(spark: SparkSession, folder: str) -> DataFrame:
    keys = table(spark, folder, "lineitem").select("l_returnflag", "l_linestatus", "l_linenumber", "l_quantity")
    return keys.groupBy(*columns.star(keys, exclude=["l_quantity"])).agg(F.count(F.lit(1)).alias("n"))


@query("filtered_columns", "SELECT max(o_orderstatus) AS o_orderstatus, max(o_orderpriority) AS o_orderpriority FROM orders")
def filtered_columns(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    names = columns.filtered_columns(orders, exclude=["o_orderkey", "O_CUSTKEY", "o_totalprice", "o_orderdate"])
    return orders.agg(*[F.max(name).alias(name) for name in names])


@query("distinct_rows", "SELECT DISTINCT l_suppkey, l_returnflag, l_linestatus FROM lineitem WHERE l_suppkey IS NOT NULL")
def distinct_rows(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "lineitem").select("l_suppkey", "l_returnflag", "l_linestatus")
    return rows.filter(F.col("l_suppkey").isNotNull()).distinct()


@query("dedup_latest", "SELECT event_id, user_id, event_type, value FROM events "
    "QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1")
def dedup_latest(spark: SparkSession, folder: str) -> DataFrame:
    latest = grouping.deduplicate(
        table(spark, folder, "events"), ["user_id"], [F.col("ts").desc(), F.col("event_id").desc()]
    )
    return latest.select("event_id", "user_id", "event_type", "value")


@query("dedup_few_groups", "SELECT l_returnflag, l_linestatus, l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem "
    "QUALIFY row_number() OVER (PARTITION BY l_returnflag, l_linestatus "
    "ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) = 1")
def dedup_few_groups(spark: SparkSession, folder: str) -> DataFrame:
    names = ["l_returnflag", "l_linestatus", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return grouping.deduplicate(table(spark, folder, "lineitem").select(*names), names[:2], names[2:])


@query("group_by_ordinals", "SELECT o_orderstatus, o_orderpriority, count(*) AS n, CAST(sum(o_custkey) AS BIGINT) AS keys "
    "FROM orders GROUP BY 1, 2")
def group_by_ordinals(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderstatus", "o_orderpriority", "o_custkey")
    return grouping.group_by_first(orders, 2, F.count(F.lit(1)).alias("n"), F.sum("o_custkey").alias("keys"))


@query("column_values", "SELECT event_type AS value, count(*) AS num_rows FROM events WHERE value > 5 GROUP BY 1")
def column_values(spark: SparkSession, folder: str) -> DataFrame:
    return grouping.value_counts(table(spark, folder, "events"), "event_type", where="value > 5")


@query("top_column_values", "SELECT o_custkey AS value, count(*) AS num_rows FROM orders GROUP BY 1 "
    "ORDER BY num_rows DESC, value LIMIT 25")
def top_column_values(spark: SparkSession, folder: str) -> DataFrame:
    return grouping.value_counts(table(spark, folder, "orders"), "o_custkey", max_records=25)


@query("scalar_value", """
    SELECT c_custkey, (SELECT max(o_orderkey) FROM orders) AS last_order,
           coalesce((SELECT s_suppkey FROM supplier WHERE s_acctbal > 1e9), -1) AS rich_supplier FROM customer""")
def scalar_value(spark: SparkSession, folder: str) -> DataFrame:
    last = table(spark, folder, "orders").agg(F.max("o_orderkey"))
    rich = table(spark, folder, "supplier").filter("s_acctbal > 1e9").select("s_suppkey")
    return table(spark, folder, "customer").select(
        "c_custkey",
        grouping.scalar_column(last).alias("last_order"),
        grouping.scalar_column(rich, -1).alias("rich_supplier"),
    )


@query("target_distribution", "SELECT o_custkey % 2 AS target, count(*) AS num_rows FROM orders GROUP BY 1 ORDER BY 1")
def target_distribution(spark: SparkSession, folder: str) -> DataFrame:
    return grouping.distribution(table(spark, folder, "orders").selectExpr("o_custkey % 2 AS target"), "target")


@query("dup_key_count", "SELECT count(*) - count(DISTINCT l_orderkey) AS duplicate_keys FROM lineitem")
def dup_key_count(spark: SparkSession, folder: str) -> DataFrame:
    return grouping.key_counts(table(spark, folder, "lineitem"), "l_orderkey").select("duplicate_keys")


@query("null_key_count", "SELECT count(*) FILTER (WHERE nullif(o_orderstatus, 'P') IS NULL) AS null_keys FROM orders")
def null_key_count(spark: SparkSession, folder: str) -> DataFrame:
    keys = table(spark, folder, "orders").selectExpr("nullif(o_orderstatus, 'P') AS status")
    return grouping.key_counts(keys, "status").select("null_keys")


@query("sample_topk", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 20")
def sample_topk(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    return grouping.sample_rows(orders, 20, ["o_orderkey"])


@query("pivot_sum", f"""
    SELECT l_linestatus, CAST(sum(CASE WHEN l_returnflag = 'A' THEN {cents('l_extendedprice')} ELSE 0 END) AS BIGINT) AS flag_A,
           CAST(sum(CASE WHEN l_returnflag = 'N' THEN {cents('l_extendedprice')} ELSE 0 END) AS BIGINT) AS flag_N,
           CAST(sum(CASE WHEN l_returnflag = 'R' THEN {cents('l_extendedprice')} ELSE 0 END) AS BIGINT) AS flag_R,
           CAST(sum(CASE WHEN l_returnflag = 'Z' THEN {cents('l_extendedprice')} ELSE 0 END) AS BIGINT) AS flag_Z
    FROM lineitem GROUP BY l_linestatus""")
def pivot_sum(spark: SparkSession, folder: str) -> DataFrame:
    return reshape.pivot(
        table(spark, folder, "lineitem"),
        ["l_linestatus"],
        "l_returnflag",
        ["A", "N", "R", "Z"],
        prefix="flag_",
        then_value=cents("l_extendedprice"),
    )


@query("pivot_distinct", """
    SELECT l_suppkey, count(DISTINCT CASE WHEN l_returnflag = 'A' THEN l_partkey END) AS a,
           count(DISTINCT CASE WHEN l_returnflag = 'N' THEN l_partkey END) AS n,
           count(DISTINCT CASE WHEN l_returnflag = 'R' THEN l_partkey END) AS r
    FROM lineitem GROUP BY l_suppkey""")
def pivot_distinct(spark: SparkSession, folder: str) -> DataFrame:
    return reshape.pivot(
        table(spark, folder, "lineitem"),
        ["l_suppkey"],
        "l_returnflag",
        ["A", "N", "R"],
        agg="count",
        then_value="l_partkey",
        else_value=None,
        distinct=True,
        quote_identifiers=False,
    )


@query("pivot_from_values", """
    SELECT o_orderstatus, CAST(sum(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) AS BIGINT) AS _1_urgent,
           CAST(sum(CASE WHEN o_orderpriority = '2-HIGH' THEN 1 ELSE 0 END) AS BIGINT) AS _2_high,
           CAST(sum(CASE WHEN o_orderpriority = '3-MEDIUM' THEN 1 ELSE 0 END) AS BIGINT) AS _3_medium,
           CAST(sum(CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 1 ELSE 0 END) AS BIGINT) AS _4_not_specified,
           CAST(sum(CASE WHEN o_orderpriority = '5-LOW' THEN 1 ELSE 0 END) AS BIGINT) AS _5_low
    FROM orders GROUP BY o_orderstatus""")
def pivot_from_values(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    values = grouping.column_values(orders, "o_orderpriority")
    return reshape.pivot(orders, ["o_orderstatus"], "o_orderpriority", values, quote_identifiers=False)


@query("unpivot", """
    SELECT o_orderkey, 'o_custkey' AS field_name, CAST(o_custkey AS VARCHAR) AS value FROM orders
    UNION ALL SELECT o_orderkey, 'status', nullif(o_orderstatus, 'P') FROM orders
    UNION ALL SELECT o_orderkey, 'urgent', CAST(o_orderpriority = '1-URGENT' AS VARCHAR) FROM orders""")
def unpivot(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").selectExpr(
        "o_orderkey",
        "o_custkey",
        "nullif(o_orderstatus, 'P') AS status",
        "o_orderpriority = '1-URGENT' AS urgent",
        "o_totalprice",
    )
    return reshape.unpivot(orders, exclude=["o_orderkey"], remove=["O_TOTALPRICE"])


@query("union_relations", """
    SELECT 'supplier' AS _dbt_source_relation, s_suppkey AS id, CAST(s_nationkey AS VARCHAR) AS nation,
           s_acctbal AS balance, CAST(NULL AS VARCHAR) AS segment FROM supplier WHERE s_acctbal > 0
    UNION ALL SELECT 'customer', c_custkey, CAST(c_nationkey AS VARCHAR), c_acctbal, c_mktsegment
    FROM customer WHERE c_acctbal > 0""")
def union_relations(spark: SparkSession, folder: str) -> DataFrame:
    supplier = table(spark, folder, "supplier").selectExpr(
        "s_suppkey AS id", "s_nationkey AS nation", "s_acctbal AS balance", "s_name AS name"
    )
    customer = table(spark, folder, "customer").selectExpr(
        "c_custkey AS id", "CAST(c_nationkey AS STRING) AS nation", "c_name AS name", "c_mktsegment AS segment",
        "c_acctbal AS balance",
    )
    return reshape.union_relations(
        {"supplier": supplier, "customer": customer}, exclude=["NAME"], where="balance > 0"
    )


@query("union_included", """
    SELECT s_suppkey AS id, CAST(s_nationkey AS VARCHAR) AS nation FROM supplier
    UNION ALL SELECT c_custkey, CAST(c_nationkey AS VARCHAR) FROM customer""")
def union_included(spark: SparkSession, folder: str) -> DataFrame:
    supplier = table(spark, folder, "supplier").withColumnsRenamed({"s_suppkey": "id", "s_nationkey": "nation"})
    customer = table(spark, folder, "customer").withColumnsRenamed({"c_custkey": "id", "c_nationkey": "nation"})
    return reshape.union_relations(
        [("supplier", supplier), ("customer", customer)],
        include=["id", "nation"],
        column_override={"nation": "string"},
        source_column=None,
    )


@query("union_widened", """
    SELECT 'order' AS source, o_orderkey AS id, CAST(o_custkey AS DOUBLE) AS amount FROM orders
    UNION ALL SELECT 'line', l_orderkey, l_extendedprice FROM lineitem
    UNION ALL SELECT 'nation', CAST(n_nationkey AS BIGINT), CAST(n_regionkey AS DOUBLE) FROM nation""")
def union_widened(spark: SparkSession, folder: str) -> DataFrame:
    """Whole and fractional numbers, short and long ones, in either order."""
    nation = table(spark, folder, "nation").selectExpr("CAST(n_nationkey AS INT) AS id", "CAST(n_regionkey AS INT) AS amount")
    orders = table(spark, folder, "orders").selectExpr("o_orderkey AS id", "o_custkey AS amount")
    lines = table(spark, folder, "lineitem").selectExpr("CAST(l_orderkey AS INT) AS id", "l_extendedprice AS amount")
    return reshape.union_relations([("nation", nation), ("order", orders), ("line", lines)], source_column="source")


@query("pivot_any_aggregate", """
    SELECT o_orderstatus, bool_or(o_orderpriority = '1-URGENT') AS "1-URGENT", bool_or(o_orderpriority = '5-LOW') AS "5-LOW"
    FROM orders GROUP BY o_orderstatus""")
def pivot_any_aggregate(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    return reshape.pivot(
        orders, ["o_orderstatus"], "o_orderpriority", ["1-URGENT", "5-LOW"], agg="bool_or", then_value=F.lit(True), else_value=F.lit(False)
    )


@query("pivot_any_comparison", """
    SELECT o_orderstatus, max(CASE WHEN regexp_matches(o_orderpriority, '^[12]') THEN o_totalprice ELSE 0 END) AS "^[12]"
    FROM orders GROUP BY o_orderstatus""")
def pivot_any_comparison(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    return reshape.pivot(orders, ["o_orderstatus"], "o_orderpriority", ["^[12]"], agg=F.max, cmp="RLIKE", then_value="o_totalprice")


@query("except_both_ways", """
    SELECT 'a_minus_b' AS which_diff, * FROM (SELECT o_custkey AS k FROM orders EXCEPT SELECT user_id FROM events)
    UNION ALL SELECT 'b_minus_a', * FROM (SELECT user_id AS k FROM events EXCEPT SELECT o_custkey FROM orders)""")
def except_both_ways(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").selectExpr("o_custkey AS k")
    events = table(spark, folder, "events").selectExpr("user_id AS k")
    return setops.except_both_ways(orders, events)


def _changed(orders: DataFrame) -> DataFrame:
    """Some orders with another status, some twice, some gone."""
    changed = orders.filter("k % 800 <> 3").withColumn("status", F.expr("CASE WHEN k % 500 = 7 THEN NULL ELSE status END"))
    return changed.unionAll(changed.filter("k % 900 = 11"))


_ORDERS = "SELECT o_orderkey AS k, o_custkey AS customer, o_orderstatus AS status FROM orders"
_CHANGED = f"""
    SELECT k, customer, CASE WHEN k % 500 = 7 THEN NULL ELSE status END AS status
    FROM (SELECT * FROM ({_ORDERS}) UNION ALL SELECT * FROM ({_ORDERS}) WHERE k % 900 = 11) WHERE k % 800 <> 3"""


def _orders(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").selectExpr("o_orderkey AS k", "o_custkey AS customer", "o_orderstatus AS status")


@query("except_by_digests", f"""
    SELECT 'a_minus_b' AS which_diff, * FROM ({_ORDERS} EXCEPT {_CHANGED})
    UNION ALL SELECT 'b_minus_a', * FROM ({_CHANGED} EXCEPT {_ORDERS})""")
def except_by_digests(spark: SparkSession, folder: str) -> DataFrame:
    orders = _orders(spark, folder)
    return digests.except_by_digests(orders, _changed(orders))


@query("except_all_by_digests", f"""
    SELECT 'a_minus_b' AS which_diff, * FROM ({_ORDERS} EXCEPT ALL {_CHANGED})
    UNION ALL SELECT 'b_minus_a', * FROM ({_CHANGED} EXCEPT ALL {_ORDERS})""")
def except_all_by_digests(spark: SparkSession, folder: str) -> DataFrame:
    orders = _orders(spark, folder)
    return digests.except_by_digests(orders, _changed(orders), multiset=True)


def _sizes(aggregate: str) -> str:
    return ", ".join(f"{aggregate.format(n)} AS size_{n}" for n in range(1, 51))


@query("pivot_many_values", f"""
    SELECT p_type, {_sizes("max(CASE WHEN p_size = {0} THEN " + cents("p_retailprice") + " ELSE 0 END)")} FROM part GROUP BY p_type""")
def pivot_many_values(spark: SparkSession, folder: str) -> DataFrame:
    """More values than are evaluated for every row."""
    parts = table(spark, folder, "part")
    return reshape.pivot(parts, ["p_type"], "p_size", list(range(1, 51)), agg="max", prefix="size_", then_value=cents("p_retailprice"))


@query("pivot_many_counts", f"""
    SELECT p_type, {_sizes("count(CASE WHEN p_size = {0} THEN nullif(p_name, '') END)")} FROM part GROUP BY p_type""")
def pivot_many_counts(spark: SparkSession, folder: str) -> DataFrame:
    return reshape.pivot(
        table(spark, folder, "part"), ["p_type"], "p_size", list(range(1, 51)),
        agg="count", prefix="size_", then_value="nullif(p_name, '')", else_value=None,
    )


@query("generate_series", """
    SELECT CAST(generated_number AS BIGINT) AS generated_number, count(l_orderkey) AS num_rows
    FROM (SELECT unnest(range(1, (SELECT max(o_orderkey) FROM orders) + 1)) AS generated_number)
    LEFT JOIN lineitem ON l_orderkey = generated_number GROUP BY 1""")
def generate_series(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of every possible order number, also of numbers without any."""
    _, last = key_bounds(table(spark, folder, "orders"), "o_orderkey")
    lines = table(spark, folder, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))
    numbers = series.generate_series(spark, last)
    joined = numbers.join(lines, numbers["generated_number"] == lines["l_orderkey"], "left")
    return joined.select("generated_number", F.coalesce("n", F.lit(0).cast("bigint")).alias("num_rows"))


SPINE = """
    WITH spine AS (SELECT unnest(range((SELECT min({by}) FROM {table}), (SELECT max({by}) FROM {table}),
                                       INTERVAL 1 {part})) AS period)
    SELECT strftime(period, '{shown}') AS period, count({by}) AS num_rows
    FROM spine LEFT JOIN (SELECT {by} FROM {table}) ON {by} = period GROUP BY 1"""


def _spine(spark: SparkSession, rows: DataFrame, part: str, shown: str) -> DataFrame:
    """Rows per period from the first to before the last one, also of empty periods."""
    first, last = rows.agg(F.min("period"), F.max("period")).first()
    spine = series.date_spine(spark, part, first, last).withColumnRenamed(f"date_{part}", "period")
    counts = rows.groupBy("period").agg(F.count(F.lit(1)).alias("n"))
    joined = spine.join(counts, "period", "left")
    return joined.select(
        F.date_format("period", shown).alias("period"), F.coalesce("n", F.lit(0).cast("bigint")).alias("num_rows")
    )


@query("date_spine_day", """
    WITH days AS (SELECT date_trunc('day', ts) AS day FROM events), """
    + SPINE.format(by="day", table="days", part="DAY", shown="%Y-%m-%d").replace("WITH spine", "spine").lstrip())
def date_spine_day(spark: SparkSession, folder: str) -> DataFrame:
    days = table(spark, folder, "events").select(F.date_trunc("day", "ts").alias("period"))
    return _spine(spark, days, "day", "yyyy-MM-dd")


@query("date_spine_month", """
    WITH months AS (SELECT date_trunc('month', o_orderdate) AS month FROM orders), """
    + SPINE.format(by="month", table="months", part="MONTH", shown="%Y-%m").replace("WITH spine", "spine").lstrip())
def date_spine_month(spark: SparkSession, folder: str) -> DataFrame:
    months = table(spark, folder, "orders").select(F.date_trunc("month", "o_orderdate").alias("period"))
    return _spine(spark, months, "month", "yyyy-MM")


@query("date_spine_hour", """
    WITH hours AS (SELECT date_trunc('hour', ts) AS hour FROM events), """
    + SPINE.format(by="hour", table="hours", part="HOUR", shown="%Y-%m-%d %H").replace("WITH spine", "spine").lstrip())
def date_spine_hour(spark: SparkSession, folder: str) -> DataFrame:
    hours = table(spark, folder, "events").select(F.date_trunc("hour", "ts").alias("period"))
    return _spine(spark, hours, "hour", "yyyy-MM-dd HH")
