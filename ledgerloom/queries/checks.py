"""Table checks, with parameters under which some rows fail."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators.grouping import key_counts
from ledgerloom.quality import checks
from ledgerloom.queries.registry import query, table
from ledgerloom.queries.standins import clean, clean_sql


@query("check_not_null", clean_sql("application_train") + " SELECT * FROM application_train WHERE TARGET IS NULL")
def check_not_null(spark: SparkSession, folder: str) -> DataFrame:
    return checks.not_null(clean(spark, folder, "application_train"), "TARGET")


@query(
    "check_unique",
    "SELECT l_orderkey AS unique_field, count(*) AS n_records FROM lineitem GROUP BY 1 HAVING count(*) > 1",
)
def check_unique(spark: SparkSession, folder: str) -> DataFrame:
    return checks.unique(table(spark, folder, "lineitem"), "l_orderkey")


@query(
    "check_accepted_values",
    "SELECT o_orderstatus AS value_field, count(*) AS n_records FROM orders "
    "WHERE o_orderstatus NOT IN ('F', 'O') GROUP BY 1",
)
def check_accepted_values(spark: SparkSession, folder: str) -> DataFrame:
    return checks.accepted_values(table(spark, folder, "orders"), "o_orderstatus", ["F", "O"])


@query(
    "check_not_accepted_values",
    "SELECT DISTINCT event_type AS value_field FROM events WHERE event_type IN ('error', 'click', 'none')",
)
def check_not_accepted_values(spark: SparkSession, folder: str) -> DataFrame:
    return checks.not_accepted_values(table(spark, folder, "events"), "event_type", ["error", "click", "none"])


@query(
    "check_relationships",
    "SELECT l_partkey AS from_field FROM lineitem WHERE l_partkey IS NOT NULL "
    "AND NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = l_partkey)",
)
def check_relationships(spark: SparkSession, folder: str) -> DataFrame:
    return checks.relationships(
        table(spark, folder, "lineitem"), "l_partkey", table(spark, folder, "customer"), "c_custkey"
    )


@query(
    "check_relationships_where",
    "SELECT o_custkey AS id, CAST(NULL AS BIGINT) AS right_id FROM orders WHERE o_orderstatus <> 'P' "
    "AND NOT EXISTS (SELECT 1 FROM events WHERE user_id = o_custkey AND event_type = 'purchase')",
)
def check_relationships_where(spark: SparkSession, folder: str) -> DataFrame:
    return checks.relationships_where(
        table(spark, folder, "orders"),
        "o_custkey",
        table(spark, folder, "events"),
        "user_id",
        from_condition="o_orderstatus <> 'P'",
        to_condition="event_type = 'purchase'",
    )


@query(
    "check_accepted_range",
    "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE NOT l_quantity >= 3 OR NOT l_quantity <= 49",
)
def check_accepted_range(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return checks.accepted_range(rows, "l_quantity", 3, 49)


@query(
    "check_accepted_range_exclusive",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE NOT o_totalprice > o_orderkey * 10 AND o_orderstatus = 'F'",
)
def check_accepted_range_exclusive(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    failing = checks.accepted_range(
        rows, "o_totalprice", min_value="o_orderkey * 10", inclusive=False, where="o_orderstatus = 'F'"
    )
    return failing.drop("o_orderstatus")


@query(
    "check_at_least_one",
    "SELECT c_mktsegment, count(nullif(c_mktsegment, 'BUILDING')) AS filler_column FROM customer "
    "GROUP BY c_mktsegment HAVING count(nullif(c_mktsegment, 'BUILDING')) = 0",
)
def check_at_least_one(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "customer").selectExpr("c_mktsegment", "nullif(c_mktsegment, 'BUILDING') AS segment")
    return checks.at_least_one(rows, "segment", ["c_mktsegment"])


@query(
    "check_not_constant",
    "SELECT l_orderkey, count(DISTINCT l_returnflag) AS filler_column FROM lineitem "
    "GROUP BY l_orderkey HAVING count(DISTINCT l_returnflag) = 1",
)
def check_not_constant(spark: SparkSession, folder: str) -> DataFrame:
    return checks.not_constant(table(spark, folder, "lineitem"), "l_returnflag", ["l_orderkey"])


@query(
    "check_not_empty_string",
    "SELECT trim(CASE WHEN p_size > 40 THEN '  ' ELSE p_name END) AS label FROM part "
    "WHERE trim(CASE WHEN p_size > 40 THEN '  ' ELSE p_name END) = ''",
)
def check_not_empty_string(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "part").selectExpr("CASE WHEN p_size > 40 THEN '  ' ELSE p_name END AS label")
    return checks.not_empty_string(rows, "label")


@query(
    "check_not_null_proportion",
    "SELECT p_brand, count(nullif(p_type, 'ECONOMY')) / count(*) AS not_null_proportion FROM part GROUP BY p_brand "
    "HAVING count(nullif(p_type, 'ECONOMY')) / count(*) < 0.8 OR count(nullif(p_type, 'ECONOMY')) / count(*) > 0.85",
)
def check_not_null_proportion(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "part").selectExpr("p_brand", "nullif(p_type, 'ECONOMY') AS kind")
    return checks.not_null_proportion(rows, "kind", 0.8, 0.85, ["p_brand"])


@query(
    "check_unique_combination_of_columns",
    "SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY ALL HAVING count(*) > 1",
)
def check_unique_combination(spark: SparkSession, folder: str) -> DataFrame:
    return checks.unique_combination_of_columns(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "check_expression_is_true",
    "SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice FROM lineitem "
    "WHERE NOT (l_extendedprice > l_quantity * 1000)",
)
def check_expression_is_true(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    return checks.expression_is_true(rows, "l_extendedprice > l_quantity * 1000")


@query("check_column_expression", "SELECT c_custkey, c_acctbal FROM customer WHERE NOT (c_acctbal + 500 >= 0)")
def check_column_expression(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "customer").select("c_custkey", "c_acctbal")
    return checks.expression_is_true(rows, "+ 500 >= 0", column="c_acctbal")


@query(
    "check_assert_equal",
    "SELECT l_orderkey, l_linenumber, l_returnflag, l_linestatus FROM lineitem WHERE l_returnflag <> l_linestatus",
)
def check_assert_equal(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus")
    return checks.assert_equal(rows, "l_returnflag", "l_linestatus")


@query(
    "check_cardinality_equality",
    """
    WITH a AS (SELECT o_custkey, count(*) AS num_rows FROM orders GROUP BY 1),
         b AS (SELECT user_id, count(*) AS num_rows FROM events GROUP BY 1)
    SELECT * FROM (SELECT * FROM a EXCEPT SELECT * FROM b)
    UNION ALL SELECT * FROM (SELECT * FROM b EXCEPT SELECT * FROM a)""",
)
def check_cardinality_equality(spark: SparkSession, folder: str) -> DataFrame:
    return checks.cardinality_equality(
        table(spark, folder, "orders"), "o_custkey", table(spark, folder, "events"), "user_id"
    )


def _statuses(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    ours = table(spark, folder, "orders").selectExpr("nullif(o_orderstatus, 'P') AS status")
    theirs = table(spark, folder, "lineitem").selectExpr("nullif(l_linestatus, 'F') AS status")
    return ours, theirs


STATUS_COUNTS = """
    WITH a AS (SELECT nullif(o_orderstatus, 'P') AS status, count(*) AS n FROM orders GROUP BY 1),
         b AS (SELECT nullif(l_linestatus, 'F') AS status, count(*) AS n FROM lineitem GROUP BY 1)
    SELECT a.status AS status_a, b.status AS status_b, a.n AS {a}, b.n AS {b}, {delta}
    FROM a FULL JOIN b ON a.status = b.status"""
DELTA = "CASE WHEN a.n > b.n THEN a.n - b.n WHEN a.n = b.n THEN 1 ELSE 0 END AS row_count_delta"


@query(
    "check_equal_rowcount",
    STATUS_COUNTS.format(a="count_a", b="count_b", delta="abs(a.n - b.n) AS diff_count"),
)
def check_equal_rowcount(spark: SparkSession, folder: str) -> DataFrame:
    return checks.equal_rowcount(*_statuses(spark, folder), ["status"])


@query(
    "check_equal_rowcount_total",
    "SELECT count_a, count_b, abs(count_a - count_b) AS diff_count "
    "FROM (SELECT (SELECT count(*) FROM orders) AS count_a, (SELECT count(*) FROM lineitem) AS count_b)",
)
def check_equal_rowcount_total(spark: SparkSession, folder: str) -> DataFrame:
    return checks.equal_rowcount(table(spark, folder, "orders"), table(spark, folder, "lineitem"))


@query(
    "check_fewer_rows_than",
    STATUS_COUNTS.format(a="count_our_model", b="count_comparison_model", delta=DELTA),
)
def check_fewer_rows_than(spark: SparkSession, folder: str) -> DataFrame:
    return checks.fewer_rows_than(*_statuses(spark, folder), ["status"])


def _keys_and_days(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    ours = table(spark, folder, "orders").selectExpr("o_custkey AS customer", "o_orderstatus AS status")
    theirs = table(spark, folder, "lineitem").selectExpr("l_partkey AS customer", "l_linestatus AS status")
    return ours, theirs


@query(
    "check_equality",
    """
    WITH a AS (SELECT o_custkey AS customer, o_orderstatus AS status FROM orders),
         b AS (SELECT l_partkey AS customer, l_linestatus AS status FROM lineitem)
    SELECT 'a_minus_b' AS which_diff, * FROM (SELECT * FROM a EXCEPT SELECT * FROM b)
    UNION ALL SELECT 'b_minus_a' AS which_diff, * FROM (SELECT * FROM b EXCEPT SELECT * FROM a)""",
)
def check_equality(spark: SparkSession, folder: str) -> DataFrame:
    return checks.equality(*_keys_and_days(spark, folder))


@query(
    "check_equality_with_copies",
    """
    WITH a AS (SELECT o_custkey AS customer, o_orderstatus AS status FROM orders),
         b AS (SELECT l_partkey AS customer, l_linestatus AS status FROM lineitem)
    SELECT 'a_minus_b' AS which_diff, * FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b)
    UNION ALL SELECT 'b_minus_a' AS which_diff, * FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)""",
)
def check_equality_with_copies(spark: SparkSession, folder: str) -> DataFrame:
    return checks.equality(*_keys_and_days(spark, folder), multiset=True)


AS_OF = "2024-01-30 12:00:00"


@query(
    "check_recency",
    f"""
    SELECT user_id, strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS most_recent,
           strftime(TIMESTAMP '{AS_OF}' - INTERVAL 36 HOUR, '%Y-%m-%d %H:%M:%S') AS threshold
    FROM events GROUP BY user_id HAVING max(ts) < TIMESTAMP '{AS_OF}' - INTERVAL 36 HOUR""",
)
def check_recency(spark: SparkSession, folder: str) -> DataFrame:
    stale = checks.recency(table(spark, folder, "events"), "ts", "hour", 36, group_by=["user_id"], as_of=AS_OF)
    return stale.select(
        "user_id",
        F.date_format("most_recent", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("most_recent"),
        F.date_format("threshold", "yyyy-MM-dd HH:mm:ss").alias("threshold"),
    )


@query(
    "check_recency_by_date",
    f"""
    SELECT event_type, user_id, CAST(CAST(max(ts) AS DATE) AS VARCHAR) AS most_recent,
           CAST(CAST(TIMESTAMP '{AS_OF}' - INTERVAL 2 DAY AS DATE) AS VARCHAR) AS threshold
    FROM events GROUP BY event_type, user_id
    HAVING CAST(max(ts) AS DATE) < CAST(TIMESTAMP '{AS_OF}' - INTERVAL 2 DAY AS DATE)""",
)
def check_recency_by_date(spark: SparkSession, folder: str) -> DataFrame:
    stale = checks.recency(
        table(spark, folder, "events"),
        "ts",
        "day",
        2,
        ignore_time_component=True,
        group_by=["event_type", "user_id"],
        as_of=AS_OF,
    )
    dates = [F.col(name).cast("string").alias(name) for name in ("most_recent", "threshold")]
    return stale.select("event_type", "user_id", *dates)


@query(
    "check_sequential_values",
    """
    SELECT l_orderkey, previous_l_orderkey FROM (
        SELECT l_orderkey, lag(l_orderkey) OVER (ORDER BY l_orderkey) AS previous_l_orderkey FROM lineitem)
    WHERE NOT (l_orderkey = previous_l_orderkey + 1)""",
)
def check_sequential_values(spark: SparkSession, folder: str) -> DataFrame:
    return checks.sequential_values(table(spark, folder, "lineitem"), "l_orderkey")


@query(
    "check_sequential_values_grouped",
    """
    SELECT event_type, user_id, previous_user_id FROM (
        SELECT event_type, user_id, lag(user_id) OVER (PARTITION BY event_type ORDER BY user_id) AS previous_user_id
        FROM events)
    WHERE NOT (user_id = previous_user_id + 2)""",
)
def check_sequential_values_grouped(spark: SparkSession, folder: str) -> DataFrame:
    return checks.sequential_values(
        table(spark, folder, "events"), "user_id", 2, group_by=["event_type"]
    )


@query(
    "check_sequential_hours",
    """
    SELECT event_type, strftime(hour, '%Y-%m-%d %H') AS hour, strftime(previous, '%Y-%m-%d %H') AS previous_hour
    FROM (SELECT event_type, hour, lag(hour) OVER (PARTITION BY event_type ORDER BY hour) AS previous
          FROM (SELECT event_type, date_trunc('hour', ts) AS hour FROM events))
    WHERE NOT (hour = previous + INTERVAL 1 HOUR)""",
)
def check_sequential_hours(spark: SparkSession, folder: str) -> DataFrame:
    hours = table(spark, folder, "events").select("event_type", F.date_trunc("hour", "ts").alias("hour"))
    failing = checks.sequential_values(
        hours, "hour", 1, datepart="hour", group_by=["event_type"]
    )
    texts = [F.date_format(name, "yyyy-MM-dd HH").alias(name) for name in ("hour", "previous_hour")]
    return failing.select("event_type", *texts)


# An order opens a range of 20 to 59 days; some ranges have no length, some no end.
RANGES = """
    SELECT o_custkey, day AS first_day,
           CASE WHEN o_orderkey % 50 = 0 THEN NULL WHEN o_orderkey % 10 = 0 THEN day
                ELSE day + CAST(o_orderkey % 40 + 20 AS INT) END AS last_day
    FROM (SELECT o_custkey, o_orderkey, {day} AS day FROM {orders})"""

# The window functions need a unique order for a repeatable result, so equal ranges are numbered.
RANGE_CHECK = """
    WITH ranges AS ({ranges}),
    numbered AS (
        SELECT *, row_number() OVER (PARTITION BY {by} ORDER BY first_day, last_day) AS place,
               count(*) OVER (PARTITION BY {by}) AS places FROM ranges),
    windowed AS (
        SELECT {shown} first_day AS lower_bound, last_day AS upper_bound,
               lead(first_day) OVER (PARTITION BY {by} ORDER BY place) AS next_lower_bound,
               place = places AS is_last_record FROM numbered),
    judged AS (
        SELECT *, coalesce(lower_bound {length} upper_bound, false) AS lower_bound_{length_words}_upper_bound,
               coalesce(upper_bound {gap} next_lower_bound, is_last_record, false)
                   AS upper_bound_{gap_words}_next_lower_bound
        FROM windowed)
    SELECT * FROM judged
    WHERE NOT (lower_bound_{length_words}_upper_bound AND upper_bound_{gap_words}_next_lower_bound)"""


def range_check_sql(by: str | None, gap: str, length: str) -> str:
    words = {"<": "less_than", "<=": "less_than_or_equal_to", "=": "equal_to"}
    day = "CAST(date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS INTEGER)"
    return RANGE_CHECK.format(
        ranges=RANGES.format(day=day, orders="orders"),
        by=by or "1",
        shown=f"{by} AS partition_by_col," if by else "",
        gap=gap,
        gap_words=words[gap],
        length=length,
        length_words=words[length],
    )


def _ranges(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").withColumn("day", F.unix_date(F.col("o_orderdate").cast("date")))
    end = (
        F.when(F.expr("o_orderkey % 50 = 0"), None)
        .when(F.expr("o_orderkey % 10 = 0"), F.col("day"))
        .otherwise(F.expr("day + CAST(o_orderkey % 40 + 20 AS INT)"))
    )
    return orders.select("o_custkey", F.col("day").alias("first_day"), end.alias("last_day"))


def _range_check(by: str | None, gaps: str, zero_length: bool):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return checks.mutually_exclusive_ranges(
            _ranges(spark, folder),
            "first_day",
            "last_day",
            partition_by=by,
            gaps=gaps,
            zero_length_range_allowed=zero_length,
        )

    return run


query("check_mutually_exclusive_ranges", range_check_sql("o_custkey", "<=", "<"))(
    _range_check("o_custkey", "allowed", False)
)
query("check_ranges_gaps_required", range_check_sql("o_custkey", "<", "<="))(
    _range_check("o_custkey", "required", True)
)
query("check_ranges_gaps_not_allowed", range_check_sql("o_custkey", "=", "<"))(
    _range_check("o_custkey", "not_allowed", False)
)
query("check_ranges_whole_table", range_check_sql(None, "<=", "<="))(_range_check(None, "allowed", True))


@query(
    "check_staging_keys",
    "SELECT count(*) AS row_count, count(*) - count(DISTINCT k) AS duplicate_keys, "
    "count(*) FILTER (WHERE k IS NULL) AS null_keys FROM (SELECT nullif(l_orderkey, 7) AS k FROM lineitem)",
)
def check_staging_keys(spark: SparkSession, folder: str) -> DataFrame:
    keys = table(spark, folder, "lineitem").selectExpr("nullif(l_orderkey, 7) AS k")
    return key_counts(keys, "k")


@query("check_columns_match_set", """
    SELECT upper(c) AS relation_column, CAST(NULL AS VARCHAR) AS input_column FROM (DESCRIBE customer) AS t(c)
    WHERE lower(c) NOT IN ('c_custkey', 'c_name', 'c_phone')
    UNION ALL SELECT NULL, 'C_PHONE'""")
def check_columns_match_set(spark: SparkSession, folder: str) -> DataFrame:
    return checks.columns_match_set(table(spark, folder, "customer"), ["c_custkey", "C_NAME", "c_phone"])
