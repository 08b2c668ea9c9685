"""Tables as versioned folders: a refresh is complete before any reader sees it.

Below the folder of a table lie its versions, ``v-...``, and ``_commits``, which names them in order. A
refresh writes a new version, compares the rows it holds with those that went in, and only then adds a commit: an empty file
whose name has the number and the version, which any file system creates in one step. Readers take the newest
commit. A refresh that fails, or whose process ends, leaves a folder that no commit names; readers keep the version before.

The versions of earlier commits stay for readers that have begun with them, as many as ``KEPT`` says.
Catalog tables point to the folder of a version and are moved to the next by one catalog call.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

COMMITS = "_commits"
# Versions that stay readable, the newest included.
KEPT = 2

_COMMIT = re.compile(r"([0-9]+)\.(v-[0-9a-f]+)")


# Makes the names and texts of small files that lie beside the data of a version; names begin with _, so that they are no data.
Beside = Callable[[], Mapping[str, str]]


class IncompleteWrite(RuntimeError):
    """A new version does not hold the rows that went in; it was not committed."""


@dataclass(frozen=True)
class Version:
    folder: str
    rows: int


def _folder(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    system, place = _folder(spark, path)
    return system.exists(place)


def _commits(spark: SparkSession, root: str) -> list[tuple[int, str]]:
    """Numbers and versions, oldest first; of two with one number the later name counts, for every reader alike."""
    system, place = _folder(spark, f"{root}/{COMMITS}")
    if not system.exists(place):
        return []
    names = [_COMMIT.fullmatch(status.getPath().getName()) for status in system.listStatus(place)]
    return sorted((int(m[1]), m[2]) for m in names if m)


def _commit_file(root: str, number: int, version: str) -> str:
    return f"{root}/{COMMITS}/{number:012d}.{version}"


def current(spark: SparkSession, root: str) -> str:
    """The folder to read: the newest version, or ``root`` itself if it holds files without versions."""
    root = root.rstrip("/")
    commits = _commits(spark, root)
    return f"{root}/{commits[-1][1]}" if commits else root


def read_text(spark: SparkSession, path: str) -> str:
    """A small file that was kept beside a version."""
    system, place = _folder(spark, path)
    stream = system.open(place)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_version(df: DataFrame, root: str, partition_by: Sequence[str] = (), beside: Beside | None = None) -> Version:
    """Write ``df`` to a new version without committing it (starts the write and a count of the files' footers)."""
    folder = f"{root.rstrip('/')}/v-{uuid.uuid4().hex}"
    seen = Observation()
    writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("errorifexists")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(folder)
    went_in = seen.get["rows"]
    stored = df.sparkSession.read.schema(df.schema).parquet(folder).count()
    if stored != went_in:
        raise IncompleteWrite(f"{folder} holds {stored} of {went_in} rows")
    for name, text in (beside() if beside else {}).items():
        system, place = _folder(df.sparkSession, f"{folder}/{name}")
        out = system.create(place, False)
        out.write(bytearray(text.encode()))
        out.close()
    return Version(folder, stored)


def commit(spark: SparkSession, root: str, version: Version) -> None:
    """Make a version the current one."""
    root = root.rstrip("/")
    commits = _commits(spark, root)
    number = commits[-1][0] + 1 if commits else 1
    system, place = _folder(spark, _commit_file(root, number, version.folder.rpartition("/")[2]))
    system.create(place, False).close()


def forget(spark: SparkSession, root: str, keep: int = KEPT) -> None:
    """Delete all but the ``keep`` newest committed versions; folders without a commit may be of a refresh under way and stay."""
    root = root.rstrip("/")
    for number, version in _commits(spark, root)[: -max(1, keep)]:
        for path in (_commit_file(root, number, version), f"{root}/{version}"):
            system, place = _folder(spark, path)
            system.delete(place, True)


def refresh(
    df: DataFrame, root: str, partition_by: Sequence[str] = (), keep: int = KEPT, beside: Beside | None = None
) -> Version:
    """Replace the table in ``root``; readers see the old version until the new one is complete."""
    version = write_version(df, root, partition_by, beside)
    commit(df.sparkSession, root, version)
    forget(df.sparkSession, root, keep)
    return version


def _is_view(spark: SparkSession, name: str) -> bool:
    return spark.catalog.getTable(name).tableType == "VIEW"


def publish(
    df: DataFrame, name: str, root: str, partition_by: Sequence[str] = (), keep: int = KEPT, beside: Beside | None = None
) -> Version:
    """Create or replace the catalog table ``name`` (quoted as in SQL) with its files below ``root``.

    An existing table moves to the new version by one ``SET LOCATION``; columns it lacks are added just before. Only if
    columns go or change their type is the entry dropped and created again, which takes two catalog calls. A partitioned
    table is a view on the table of its version, since partitions are catalog entries of their own.
    """
    spark = df.sparkSession
    version = write_version(df, root, partition_by, beside)
    schema = spark.read.schema(df.schema).parquet(version.folder).schema  # as stored, with NULLs
    if partition_by:
        _publish_view(spark, name, schema, version, partition_by)
    else:
        _publish_table(spark, name, schema, version)
    commit(spark, root, version)
    forget(spark, root, keep)
    return version


def _publish_table(spark: SparkSession, name: str, schema, version: Version) -> None:
    if spark.catalog.tableExists(name):
        old = [] if _is_view(spark, name) else [(f.name, f.dataType) for f in spark.table(name).schema]
        new = [(f.name, f.dataType) for f in schema]
        if old and new[: len(old)] == old:
            if added := schema.fields[len(old) :]:
                columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in added)
                spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({columns})")
            spark.sql(f"ALTER TABLE {name} SET LOCATION '{version.folder}'")
            spark.catalog.refreshTable(name)
            return
        spark.sql(f"DROP {'TABLE' if old else 'VIEW'} {name}")
    spark.catalog.createTable(name, path=version.folder, source="parquet", schema=schema)


def _publish_view(spark: SparkSession, name: str, schema, version: Version, partition_by: Sequence[str]) -> None:
    own = f"{name.rstrip('`')}__{version.folder.rpartition('/')[2].replace('-', '')}" + ("`" if name.endswith("`") else "")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    keys = ", ".join(f"`{c}`" for c in partition_by)
    spark.sql(f"CREATE TABLE {own} ({columns}) USING parquet PARTITIONED BY ({keys}) LOCATION '{version.folder}'")
    spark.sql(f"ALTER TABLE {own} RECOVER PARTITIONS")
    if spark.catalog.tableExists(name) and not _is_view(spark, name):
        spark.sql(f"DROP TABLE {name}")
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {own}")
