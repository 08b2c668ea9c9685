"""Comparing a Spark result with the same query in DuckDB."""

import math
from datetime import date, datetime
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()

SPARK_TO_DUCK = {
    "string": "VARCHAR",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def connect(folder):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else value
    if isinstance(value, (Decimal, date, datetime)):
        return str(value)
    return value


def _rows(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i].lower())
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(plain, key=lambda row: [(v is not None, str(type(v)), v) for v in row])


def spark_result(df):
    schema = sorted((f.name.lower(), SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())) for f in df.schema)
    return schema, _rows(df.collect(), df.columns)


def duck_result(connection, sql):
    cursor = connection.execute(sql)
    names = [column[0] for column in cursor.description]
    schema = sorted((column[0].lower(), str(column[1])) for column in cursor.description)
    return schema, _rows(cursor.fetchall(), names)
