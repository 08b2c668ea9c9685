"""Landing CSV files as raw tables: every row, no checks, trimmed headers."""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ledgerloom.functions.columns import as_column
from ledgerloom.sources import versions
from ledgerloom.sources.tables import Lake

# File names of the data set and the raw tables they become.
RAW_FILES = {
    "application_train.csv": "application_train",
    "bureau.csv": "bureau",
    "bureau_balance.csv": "bureau_balance",
    "previous_application.csv": "previous_application",
    "POS_CASH_balance.csv": "pos_cash_balance",
    "installments_payments.csv": "installments_payments",
    "credit_card_balance.csv": "credit_card_balance",
}


@dataclass(frozen=True)
class Landed:
    table: str
    rows: int
    columns: int


def trim_column_names(df: DataFrame) -> DataFrame:
    """Strip blanks around column names; names that become equal are an error."""
    names = [name.strip() for name in df.columns]
    doubled = [name for name, n in Counter(name.lower() for name in names).items() if n > 1]
    if doubled:
        raise ValueError(f"column names collide after trimming: {doubled}")
    return df.toDF(*names)


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """CSV with a header line. Without a schema the types are inferred, at the
    price of one more pass over the file; give a schema for large files."""
    reader = spark.read.option("header", True)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return trim_column_names(reader.csv(path))


# What a text can be read as without loss, narrowest first. Numbers with leading zeros or plus signs are texts, and so
# are decimals with more digits than a double keeps.
_TYPES = ("int", "bigint", "double", "string")
_WHOLE = r"^(0|-?[1-9][0-9]{0,18})$"
_DECIMAL = r"^-?(0|[1-9][0-9]*)\.[0-9]+$"
_DIGITS = 15
BROKEN = "_broken_line"
_TYPES_FILE = "_types.json"


@dataclass(frozen=True)
class LandedText(Landed):
    """``types`` by column, and how many lines did not fit the header."""

    types: Mapping[str, str]
    broken: int


def _kind(text: Column) -> Column:
    """The place in ``_TYPES`` of the narrowest type of one value; NULL for none."""
    whole = F.rlike(text, F.lit(_WHOLE))
    number = F.when(whole, text.try_cast("bigint"))
    fits = F.rlike(text, F.lit(_DECIMAL)) & (F.length(F.regexp_replace(text, "[-.]", "")) <= _DIGITS)
    return F.when(text.isNull(), None).when(number.between(-(1 << 31), (1 << 31) - 1), 0).when(number.isNotNull(), 1).when(fits, 2).otherwise(3)


def _column_facts(column: str) -> Column:
    """The widest kind of a column's values in lines that fit, and whether whole numbers beyond a double's digits are among them."""
    text = F.when(as_column(BROKEN).isNull(), as_column(column))
    long = F.rlike(text, F.lit(rf"^-?[0-9]{{{_DIGITS + 1},}}$"))
    return F.struct(F.max(_kind(text)).alias("kind"), F.coalesce(F.bool_or(long), F.lit(False)).alias("long"))


def read_csv_text(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header line, every column as text; lines that do not fit it are whole in ``BROKEN``.

    Only the header is read to build the plan.
    """
    header = spark.read.option("header", True).csv(path).columns
    fields = [StructField(name, StringType()) for name in [*header, BROKEN]]
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", BROKEN)
    return trim_column_names(reader.schema(StructType(fields)).csv(path))


def ingest_as_text(lake: Lake, folder: str, files: Mapping[str, str] = RAW_FILES, layer: str = "raw") -> list[LandedText]:
    """Land each file as text and observe in the same write which type each column has (one write per file, no other pass).

    The narrowest type that keeps every value is stored beside the data: "007" stays text. ``read_typed`` reads the
    table in these types. Lines with too few or too many fields are kept in ``BROKEN`` and counted.
    """
    landed = []
    for file_name, table in files.items():
        df = read_csv_text(lake.spark, f"{folder.rstrip('/')}/{file_name}")
        columns = [c for c in df.columns if c != BROKEN]
        seen = Observation(f"landed {table}")
        facts = [_column_facts(c).alias(f"f{i}") for i, c in enumerate(columns)]
        broken = as_column(BROKEN).isNotNull()
        counts = [F.count(F.lit(1)).alias("rows"), F.count_if(broken).alias("broken")]
        found: dict[str, str] = {}

        def typed(seen=seen, columns=columns, found=found) -> dict[str, str]:
            for i, name in enumerate(columns):
                kind, long = seen.get[f"f{i}"]
                # a fraction among whole numbers that a double would round
                found[name] = "string" if kind is None or (kind == 2 and long) else _TYPES[kind]
            return {_TYPES_FILE: json.dumps(found)}

        lake.write(df.observe(seen, *counts, *facts), layer, table, beside=typed)
        landed.append(LandedText(f"{layer}.{table}", seen.get["rows"], len(columns), dict(found), seen.get["broken"]))
    return landed


def read_typed(lake: Lake, layer: str, table: str) -> DataFrame:
    """A table landed as text in the types that were observed, without ``BROKEN`` lines."""
    types = json.loads(versions.read_text(lake.spark, f"{lake.location(layer, table)}/{_TYPES_FILE}"))
    rows = lake.read(layer, table).filter(as_column(BROKEN).isNull())
    return rows.select(*[as_column(name).cast(to).alias(name) for name, to in types.items()])


def ingest(
    lake: Lake,
    folder: str,
    files: Mapping[str, str] = RAW_FILES,
    schemas: Mapping[str, StructType | str] | None = None,
    layer: str = "raw",
) -> list[Landed]:
    """Land each file as a table of ``layer``, replacing it (starts one write per file).

    Rows are counted while they are written, not by a second scan.
    """
    schemas = schemas or {}
    landed = []
    for file_name, table in files.items():
        df = read_csv(lake.spark, f"{folder.rstrip('/')}/{file_name}", schemas.get(table))
        seen = Observation(f"landed {table}")
        lake.write(df.observe(seen, F.count(F.lit(1)).alias("rows")), layer, table)
        landed.append(Landed(f"{layer}.{table}", seen.get["rows"], len(df.columns)))
    return landed
