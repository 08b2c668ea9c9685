"""Tables in named layers, as versioned Parquet folders and as catalog entries."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.columns import as_column
from ledgerloom.sources import versions

LAYERS = ("raw", "silver", "quarantine", "staging", "warehouse")

# The layer that holds valid and rejected rows together, its partition column (true for rejected
# rows), and the column with the first rule a row broke.
CHECKED, SIDE, REASON = "checked", "_rejected", "reject_reason"


@dataclass(frozen=True)
class Lake:
    """One folder per layer, one folder per table with its versions (``versions.py``).

    With ``catalog=True`` every layer is also a database and every table is
    registered there, so that ``spark.table("silver.bureau")`` works.
    """

    spark: SparkSession
    root: str
    catalog: bool = False

    def path(self, layer: str, table: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{table}"

    def create_layers(self, layers: Sequence[str] = LAYERS) -> None:
        for layer in layers:
            self.spark.sql(
                f"CREATE DATABASE IF NOT EXISTS `{layer}` LOCATION '{self.root.rstrip('/')}/{layer}'"
            )

    def write(
        self, df: DataFrame, layer: str, table: str, partition_by: Sequence[str] = (), beside: versions.Beside | None = None
    ) -> None:
        """Replace the table (starts a job); readers see the old one until the new one is complete.

        ``beside`` gives the names and texts of small files to be kept with the version, once its rows are written.
        """
        if self.catalog:
            self.create_layers([layer])
            versions.publish(df, f"`{layer}`.`{table}`", self.path(layer, table), partition_by, beside=beside)
        else:
            versions.refresh(df, self.path(layer, table), partition_by, beside=beside)

    def location(self, layer: str, table: str) -> str:
        """The folder of the table's newest version."""
        return versions.current(self.spark, self.path(layer, table))

    def create_view(
        self, layer: str, view: str, source: tuple[str, str], names: Sequence[tuple[str, str]], where: str
    ) -> None:
        """Name a selection of a catalog table; ``names`` pairs stored and shown column names."""
        self.create_layers([layer])
        shown = ", ".join(f"`{stored}` AS `{name}`" for stored, name in names)
        source_layer, source_table = source
        self.spark.sql(
            f"CREATE OR REPLACE VIEW `{layer}`.`{view}` AS "
            f"SELECT {shown} FROM `{source_layer}`.`{source_table}` WHERE {where}"
        )

    def read(self, layer: str, table: str, columns: Sequence[str] | None = None) -> DataFrame:
        """The table, or those of ``columns`` it has; only these are read from the files.

        Valid and rejected rows lie in one table of the layer ``checked``; their names in other
        layers are resolved to their side of it.
        """
        if versions.exists(self.spark, self.path(layer, table)):
            df = self.spark.read.parquet(self.location(layer, table))
        else:
            df = self._side(layer, table)
        return df if columns is None else existing_columns(df, columns)

    def _side(self, layer: str, table: str) -> DataFrame:
        rejected = layer == "quarantine"
        stored = self.spark.read.parquet(self.location(CHECKED, table.removesuffix("_rejects") if rejected else table))
        # read back without a schema, the folder names are text
        is_rejected = as_column(SIDE).cast("boolean")
        side = stored.filter(is_rejected if rejected else ~is_rejected)
        return side.select(*[as_column(old).alias(new) for old, new in side_columns(stored.columns, rejected)])


def side_columns(stored: Sequence[str], rejected: bool) -> list[tuple[str, str]]:
    """Stored and shown names of one side: rejects as they came, with the reason; valid rows with converted columns last.

    ``_x`` is column ``x`` converted and shown instead, ``__x`` the same for later steps only.
    """
    plain = [c for c in stored if c not in (REASON, SIDE) and not (c[:2] == "__" and c[2:] in stored)]
    typed = [c for c in plain if c[:1] == "_" and c[1:] in plain]
    if rejected:
        return [(c, c) for c in plain if c not in typed] + [(REASON, REASON)]
    return [(c, c) for c in plain if c not in typed and f"_{c}" not in typed] + [(c, c[1:]) for c in typed]


def table_columns(df: DataFrame) -> list[str]:
    return list(df.columns)


def existing_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The listed columns the DataFrame has, in the listed order."""
    present = {name.lower() for name in df.columns}
    return df.select(*[as_column(name) for name in dict.fromkeys(columns) if name.lower() in present])


def preferred_key(available: Sequence[str], preferred: Sequence[str]) -> str | None:
    """The first preferred column that exists."""
    return next((name for name in preferred if name in available), None)


def bounds_frame(df: DataFrame, key: str) -> DataFrame:
    """Smallest and largest key as one row; 0 and 1 for an empty table."""
    return df.agg(F.min(as_column(key)).alias("lo"), F.max(as_column(key)).alias("hi")).select(
        F.when(F.col("lo").isNull(), F.lit(0)).otherwise(F.col("lo")).cast("bigint").alias("lo"),
        F.when(F.col("lo").isNull(), F.lit(1)).otherwise(F.col("hi")).cast("bigint").alias("hi"),
    )


def key_bounds(df: DataFrame, key: str) -> tuple[int, int]:
    """Smallest and largest key (starts a job, returns one row)."""
    row = bounds_frame(df, key).first()
    return row["lo"], row["hi"]


def materialize(df: DataFrame, name: str, how: str = "view") -> DataFrame:
    """Keep a model as a view or as a table named exactly as given, e.g. ``warehouse.dim_customer``."""
    spark = df.sparkSession
    if how == "view":
        df.createOrReplaceTempView(name)
    elif how == "table":
        layer, _, table = name.rpartition(".")
        if layer:
            spark.sql(f"CREATE DATABASE IF NOT EXISTS `{layer}`")
        home = spark.catalog.getDatabase(layer or spark.catalog.currentDatabase()).locationUri
        versions.publish(df, name, f"{home.rstrip('/')}/{table}")
    else:
        raise ValueError(f"how must be 'view' or 'table', got {how!r}")
    return spark.table(name)


def land(df: DataFrame, namespace: str, table: str, format: str = "iceberg", catalog: str = "iceberg") -> str:
    """Create or replace a lakehouse table and return its name (starts a write); readers see the old rows or the new ones.

    ``format`` is "iceberg", for a table of the named Iceberg catalog, which the session must
    have, or "parquet", for a table of the session catalog.
    """
    spark = df.sparkSession
    if format not in ("iceberg", "parquet"):
        raise ValueError(f"format must be 'iceberg' or 'parquet', got {format!r}")
    if format == "iceberg":
        if not spark.conf.get(f"spark.sql.catalog.{catalog}", None):
            raise ValueError(f"the session has no catalog {catalog!r}; land as 'parquet' or set spark.sql.catalog.{catalog}")
        spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {catalog}.{namespace}")
        name = f"{catalog}.{namespace}.{table}"
        df.writeTo(name).using("iceberg").createOrReplace()
    else:
        name = f"{namespace}.{table}"
        materialize(df, name, "table")
    return name
