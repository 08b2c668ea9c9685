"""Finding tables by name, and reading the ones found as one union."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.columns import as_column, as_condition
from ledgerloom.operators.reshape import SOURCE_COLUMN, union_relations
from ledgerloom.sources.versions import current

# Labels of the catalog's table types.
TABLE_TYPES = {"MANAGED": "table", "EXTERNAL": "external", "VIEW": "view", "TEMPORARY": "view"}


@dataclass(frozen=True)
class Relation:
    schema: str
    name: str
    type: str

    @property
    def qualified(self) -> str:
        return f"`{self.schema}`.`{self.name}`" if self.schema else f"`{self.name}`"


def like_pattern(pattern: str) -> re.Pattern[str]:
    """SQL LIKE without regard to case: % any text, _ one character."""
    wildcards = {"%": ".*", "_": "."}
    return re.compile("".join(wildcards.get(c, re.escape(c)) for c in pattern), re.IGNORECASE | re.DOTALL)


def tables_like(
    spark: SparkSession, schema_pattern: str, table_pattern: str, exclude: str = ""
) -> list[Relation]:
    """Tables and views whose database and name match the patterns, by name.

    Session views belong to no database; ask for them with an empty schema pattern.
    """
    schema_like, name_like, exclude_like = map(like_pattern, (schema_pattern, table_pattern, exclude))
    found = set()
    databases = [d.name for d in spark.catalog.listDatabases() if schema_like.fullmatch(d.name)]
    for database in databases or ["default"]:
        for table in spark.catalog.listTables(database):
            schema = "" if table.isTemporary else database
            matches = schema_like.fullmatch(schema) and name_like.fullmatch(table.name)
            if matches and not exclude_like.fullmatch(table.name):
                kind = TABLE_TYPES.get(table.tableType, table.tableType.lower())
                found.add(Relation(schema, table.name, kind))
    return sorted(found, key=lambda r: (r.schema, r.name))


def tables_with_prefix(spark: SparkSession, schema: str, prefix: str, exclude: str = "") -> list[Relation]:
    return tables_like(spark, schema, f"{prefix}%", exclude)


def union_tables_like(
    spark: SparkSession,
    schema_pattern: str,
    table_pattern: str,
    exclude: str = "",
    where: str | Column | None = None,
    source_column: str | None = SOURCE_COLUMN,
) -> DataFrame:
    """Union of all matching tables, see ``union_relations``."""
    relations = tables_like(spark, schema_pattern, table_pattern, exclude)
    if not relations:
        raise ValueError(f"no table like {schema_pattern}.{table_pattern}")
    return union_relations(
        [(r.qualified, spark.table(r.qualified)) for r in relations], where=where, source_column=source_column
    )


def _qualified(spark: SparkSession, path: str) -> str:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(place).toString()


def _file_path() -> Column:
    """The path of a row's file, written as Hadoop writes paths: without escapes, one slash after the scheme of local files."""
    escaped = F.regexp_replace(F.col("_metadata.file_path"), r"\+", "%2B")  # a plus is a plus
    return F.regexp_replace(F.url_decode(escaped), "^file:/+", "file:/")


def _one_scan(spark: SparkSession, paths: Sequence[str], source_column: str | None) -> DataFrame | None:
    """All folders as one scan with the union of their columns, or None if their types differ or a name says nothing.

    One job reads the footers. The label is the part of a file's path below the folder that all have in common.
    """
    roots = [path.rstrip("/") for path in paths]
    parents = {_qualified(spark, root.rpartition("/")[0] or "/") for root in roots}
    if source_column is not None and (len(parents) > 1 or len(set(roots)) < len(roots)):
        return None
    versions = [current(spark, root) for root in roots]
    try:
        df = spark.read.option("mergeSchema", True).parquet(*versions)
    except (PySparkException, Py4JJavaError):
        return None
    if source_column is None:
        return df
    below = F.substr(_file_path(), F.lit(len(parents.pop().rstrip("/")) + 2))
    return df.select(F.split_part(below, F.lit("/"), F.lit(1)).alias(source_column), *[as_column(c) for c in df.columns])


def union_folders(
    spark: SparkSession,
    paths: Sequence[str],
    where: str | Column | None = None,
    source_column: str | None = SOURCE_COLUMN,
) -> DataFrame:
    """The same for Parquet folders, versioned or not; the last part of the path names the source.

    Folders whose columns have the same types wherever they share a name are one scan, however many there are; a folder
    that lacks a column has NULL there. Others are a union, one branch for each.
    """
    if not paths:
        raise ValueError("no folders")
    df = _one_scan(spark, paths, source_column)
    if df is not None:
        return df.filter(as_condition(where))
    named = [(path.rstrip("/").rpartition("/")[2], spark.read.parquet(current(spark, path))) for path in paths]
    return union_relations(named, where=where, source_column=source_column)
