"""Scalar functions over whole columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom import functions as L
from ledgerloom.queries.registry import query, table

NULL_TOKEN = "_dbt_utils_surrogate_key_null_"


@query(
    "surrogate_key",
    f"""
    SELECT l_orderkey, l_linenumber, l_partkey,
           md5(coalesce(CAST(l_orderkey AS VARCHAR), '{NULL_TOKEN}') || '-' ||
               coalesce(CAST(l_linenumber AS VARCHAR), '{NULL_TOKEN}') || '-' ||
               coalesce(nullif(l_returnflag, 'N'), '{NULL_TOKEN}')) AS row_key,
           md5(CAST(l_partkey AS VARCHAR) || '-' || coalesce(nullif(l_returnflag, 'N'), '')) AS empty_key
    FROM lineitem""",
)
def surrogate_key(spark: SparkSession, folder: str) -> DataFrame:
    flag = F.expr("nullif(l_returnflag, 'N')")
    return table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        L.surrogate_key(["l_orderkey", "l_linenumber", flag]).alias("row_key"),
        L.surrogate_key(["l_partkey", flag], nulls_as_empty=True).alias("empty_key"),
    )


ARITHMETIC = """
    SELECT o_orderkey, nullif(o_orderkey % 7, 3) AS a, nullif(o_orderkey % 5, 2) AS b, o_custkey % 3 AS c FROM orders"""


def _numbers(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").selectExpr(
        "o_orderkey", "nullif(o_orderkey % 7, 3) AS a", "nullif(o_orderkey % 5, 2) AS b", "o_custkey % 3 AS c"
    )


@query("safe_add", f"SELECT o_orderkey, coalesce(a, 0) + coalesce(b, 0) + coalesce(c, 0) AS total FROM ({ARITHMETIC})")
def safe_add(spark: SparkSession, folder: str) -> DataFrame:
    return _numbers(spark, folder).select("o_orderkey", L.safe_add(["a", "b", "c"]).alias("total"))


@query(
    "safe_subtract",
    f"SELECT o_orderkey, coalesce(a, 0) - coalesce(b, 0) - coalesce(c, 0) AS difference FROM ({ARITHMETIC})",
)
def safe_subtract(spark: SparkSession, folder: str) -> DataFrame:
    return _numbers(spark, folder).select("o_orderkey", L.safe_subtract(["a", "b", "c"]).alias("difference"))


@query("safe_divide", f"SELECT o_orderkey, a / nullif(c, 0) AS quotient FROM ({ARITHMETIC})")
def safe_divide(spark: SparkSession, folder: str) -> DataFrame:
    return _numbers(spark, folder).select("o_orderkey", L.safe_divide("a", "c").alias("quotient"))


@query(
    "width_bucket",
    """
    SELECT o_orderkey, CAST(CASE WHEN o_totalprice < 50000 THEN 0 WHEN o_totalprice >= 450000 THEN 11
        ELSE floor((o_totalprice - 50000) / 40000) + 1 END AS BIGINT) AS bucket FROM orders""",
)
def width_bucket(spark: SparkSession, folder: str) -> DataFrame:
    bucket = L.width_bucket("o_totalprice", 50_000.0, 450_000.0, 10)
    return table(spark, folder, "orders").select("o_orderkey", bucket.alias("bucket"))


HAVERSINE = """
    SELECT c_custkey, round(2 * 3961 * {factor} * asin(sqrt(
        power(sin(radians((lat2 - lat1) / 2)), 2) +
        cos(radians(lat1)) * cos(radians(lat2)) * power(sin(radians((lon2 - lon1) / 2)), 2))), 6) AS distance
    FROM (SELECT c_custkey, c_nationkey * 3.5 - 40 AS lat1, c_custkey % 360 - 180.0 AS lon1,
                 c_custkey % 120 - 60.25 AS lat2, c_nationkey * 7 - 90.5 AS lon2 FROM customer)"""


def _points(spark: SparkSession, folder: str) -> DataFrame:
    points = {
        "lat1": "c_nationkey * 3.5 - 40",
        "lon1": "c_custkey % 360 - 180.0",
        "lat2": "c_custkey % 120 - 60.25",
        "lon2": "c_nationkey * 7 - 90.5",
    }
    return table(spark, folder, "customer").selectExpr(
        "c_custkey", *[f"CAST({text} AS DOUBLE) AS {name}" for name, text in points.items()]
    )


def _distance(unit: str):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        distance = L.haversine_distance("lat1", "lon1", "lat2", "lon2", unit)
        return _points(spark, folder).select("c_custkey", F.round(distance, 6).alias("distance"))

    return run


query("haversine_mi", HAVERSINE.format(factor="1.0"))(_distance("mi"))
query("haversine_km", HAVERSINE.format(factor="1.60934"))(_distance("km"))

HOST = (
    "split_part(split_part(replace(replace(replace(url, 'android-app://', ''), 'http://', ''), 'https://', ''), "
    "'/', 1), '?', 1)"
)
STRIPPED = "replace(replace(url, 'http://', ''), 'https://', '')"


@query("url_host", f"SELECT page_id, {HOST} AS host FROM pages")
def url_host(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "pages").select("page_id", L.url_host("url").alias("host"))


@query(
    "url_path",
    f"""
    SELECT page_id, split_part(right(u, length(u) - coalesce(nullif(position('/' IN u), 0), position('?' IN u) - 1)),
                               '?', 1) AS path
    FROM (SELECT page_id, {STRIPPED} AS u FROM pages)""",
)
def url_path(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "pages").select("page_id", L.url_path("url").alias("path"))


@query(
    "url_parameter",
    """
    SELECT page_id, nullif(split_part(split_part(url, 'page=', 2), '&', 1), '') AS page,
           nullif(split_part(split_part(url, 'utm_source=', 2), '&', 1), '') AS source FROM pages""",
)
def url_parameter(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "pages").select(
        "page_id", L.url_parameter("url", "page").alias("page"), L.url_parameter("url", "utm_source").alias("source")
    )


@query(
    "slug_values",
    """
    SELECT p_partkey, regexp_replace(regexp_replace(regexp_replace(lower(label),
        '[ -]+', '_', 'g'), '[^a-z0-9_]+', '', 'g'), '^([0-9])', '_\\1') AS slug
    FROM (SELECT p_partkey, CAST(p_size AS VARCHAR) || ' - ' || p_name || ' (' || p_brand || ')' AS label FROM part)""",
)
def slug_values(spark: SparkSession, folder: str) -> DataFrame:
    label = F.expr("CAST(p_size AS STRING) || ' - ' || p_name || ' (' || p_brand || ')'")
    return table(spark, folder, "part").select("p_partkey", L.slug(label).alias("slug"))


DATE_TEXT = "'%Y-%m-%d %H:%M:%S'"


@query(
    "date_arithmetic",
    f"""
    SELECT o_orderkey, strftime(o_orderdate + INTERVAL 5 MONTH, {DATE_TEXT}) AS plus_months,
           strftime(o_orderdate - INTERVAL 3 DAY, {DATE_TEXT}) AS minus_days,
           strftime(o_orderdate + INTERVAL 90 MINUTE, {DATE_TEXT}) AS plus_minutes,
           strftime(date_trunc('month', o_orderdate), {DATE_TEXT}) AS month_start,
           date_diff('day', TIMESTAMP '1998-03-31 00:00:00', o_orderdate) AS days,
           date_diff('month', TIMESTAMP '1998-03-31 00:00:00', o_orderdate) AS months,
           date_diff('quarter', TIMESTAMP '1998-03-31 00:00:00', o_orderdate) AS quarters,
           date_diff('year', TIMESTAMP '1998-03-31 00:00:00', o_orderdate) AS years,
           date_diff('hour', TIMESTAMP '1998-03-31 00:00:00', o_orderdate) AS hours
    FROM orders""",
)
def date_arithmetic(spark: SparkSession, folder: str) -> DataFrame:
    start = F.lit("1998-03-31 00:00:00").cast("timestamp_ntz")

    def text(value):
        return F.date_format(value, "yyyy-MM-dd HH:mm:ss")

    return table(spark, folder, "orders").select(
        "o_orderkey",
        text(L.add_interval("month", 5, "o_orderdate")).alias("plus_months"),
        text(L.add_interval("day", -3, "o_orderdate")).alias("minus_days"),
        text(L.add_interval("minute", 90, "o_orderdate")).alias("plus_minutes"),
        text(F.date_trunc("month", "o_orderdate")).alias("month_start"),
        *[
            L.boundaries_between(part, start, "o_orderdate").alias(f"{part}s")
            for part in ("day", "month", "quarter", "year", "hour")
        ],
    )
