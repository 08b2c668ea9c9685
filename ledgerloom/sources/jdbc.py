"""Scans of and writes to a database over JDBC."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.functions.columns import as_column
from ledgerloom.sources.tables import preferred_key

ISOLATION_NONE = "NONE"


def quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


@dataclass(frozen=True)
class Database:
    """A database and how to log on: ``properties`` holds user, password, driver."""

    spark: SparkSession
    url: str
    properties: Mapping[str, str] = field(default_factory=dict, repr=False)

    def _load(self, options: Mapping[str, str]) -> DataFrame:
        return self.spark.read.format("jdbc").options(url=self.url, **self.properties, **options).load()

    def read(self, table: str) -> DataFrame:
        """Whole table through one connection; use ``read_partitioned`` for large ones."""
        return self._load({"dbtable": table})

    def columns(self, table: str) -> list[str]:
        return self.read(table).columns

    def bounds(self, table: str, key: str) -> tuple[int | None, int | None]:
        """Smallest and largest key, computed by the database (starts a job)."""
        row = self._load({"dbtable": bounds_query(table, key)}).first()
        return row["lo"], row["hi"]

    def read_partitioned(self, table: str, key: str, num_partitions: int = 8) -> DataFrame:
        """Table read by key ranges in parallel; plain scan when there is no range.

        Rows with a NULL key come with the first range, none is left out.
        """
        lo, hi = self.bounds(table, key)
        if lo is None or hi is None or lo == hi:
            return self.read(table)
        return self._load({"dbtable": table, **range_options(key, lo, hi, num_partitions)})

    def read_columns(
        self, table: str, preferred_keys: Sequence[str], columns: Sequence[str], num_partitions: int = 8
    ) -> DataFrame:
        """Those of ``columns`` the table has, read by ranges of the first preferred key it has.

        The key is read even if it is not listed. Without any preferred key the
        table comes through one connection.
        """
        available = self.columns(table)
        key = preferred_key(available, preferred_keys)
        if key is None:
            keep = [name for name in columns if name in available]
            return self.read(table).select(*[as_column(name) for name in keep])
        wanted = [name for name in dict.fromkeys([*columns, key]) if name in available]
        lo, hi = self.bounds(table, key)
        if lo is None or hi is None:
            lo, hi = 0, 1
        options = range_options(key, lo, hi, num_partitions)
        return self._load({"dbtable": projection_query(table, wanted), **options})

    def write(
        self,
        df: DataFrame,
        table: str,
        mode: str = "overwrite",
        batch_size: int = 5000,
        connections: int | None = None,
        isolation: str = ISOLATION_NONE,
    ) -> None:
        """Replace or extend a table; ``connections`` limits the parallel writers."""
        options = write_options(mode, batch_size, connections, isolation)
        writer = df.write.format("jdbc").mode(mode)
        writer.options(url=self.url, dbtable=table, **self.properties, **options).save()


def bounds_query(table: str, key: str) -> str:
    return f"(SELECT MIN({quoted(key)}) AS lo, MAX({quoted(key)}) AS hi FROM {table}) t"


def projection_query(table: str, columns: Sequence[str]) -> str:
    return f"(SELECT {', '.join(quoted(name) for name in columns)} FROM {table}) t"


def range_options(key: str, lo: int, hi: int, num_partitions: int) -> dict[str, str]:
    return {
        "partitionColumn": key,
        "lowerBound": str(int(lo)),
        "upperBound": str(int(hi)),
        "numPartitions": str(num_partitions),
    }


def write_options(mode: str, batch_size: int, connections: int | None, isolation: str) -> dict[str, str]:
    """Overwriting empties the table but keeps its definition."""
    options = {
        "truncate": "true" if mode == "overwrite" else "false",
        "batchsize": str(batch_size),
        "isolationLevel": isolation,
    }
    if connections is not None:
        options["numPartitions"] = str(connections)
    return options
