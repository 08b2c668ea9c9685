"""Refreshes that fail leave the table as it was."""

import pytest
from pyspark.sql import functions as F

from ledgerloom.sources import tables, versions
from ledgerloom.sources.tables import Lake


def failing_halfway(spark, rows=1000):
    """Some tasks write their files before one fails."""
    return spark.range(0, rows, 1, 8).select(F.when(F.col("id") == rows - 1, F.raise_error(F.lit("broken"))).otherwise(F.col("id")).cast("long").alias("id"))


def ids(df):
    return sorted(r["id"] for r in df.collect())


def test_refresh_by_path(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    lake.write(spark.range(3), "raw", "t")
    before = lake.read("raw", "t")
    lake.write(spark.range(5), "raw", "t")
    assert ids(lake.read("raw", "t")) == [0, 1, 2, 3, 4]
    assert ids(before) == [0, 1, 2]  # a reader that began with the version before ends with it
    lake.write(spark.range(2).withColumn("x", F.lit("a")), "raw", "t")
    assert lake.read("raw", "t").columns == ["id", "x"]
    assert len([f for f in (tmp_path / "raw" / "t").iterdir() if f.name.startswith("v-")]) == versions.KEPT


def test_failed_refresh_leaves_the_old_version(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    lake.write(spark.range(3), "raw", "t")
    with pytest.raises(Exception, match="broken"):
        lake.write(failing_halfway(spark), "raw", "t")
    assert ids(lake.read("raw", "t")) == [0, 1, 2]
    lake.write(spark.range(4), "raw", "t")
    assert ids(lake.read("raw", "t")) == [0, 1, 2, 3]


def test_process_ends_before_the_commit(spark, tmp_path, monkeypatch):
    lake = Lake(spark, str(tmp_path))
    lake.write(spark.range(3), "raw", "t")
    with monkeypatch.context() as patched:
        patched.setattr(versions, "commit", lambda *_: (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            lake.write(spark.range(9), "raw", "t")
    assert ids(lake.read("raw", "t")) == [0, 1, 2]


def test_lost_rows_are_noticed(spark, tmp_path, monkeypatch):
    class Counted:
        get = {"rows": 7}

    versions.refresh(spark.range(3), str(tmp_path / "t"))
    monkeypatch.setattr(versions, "Observation", Counted)
    monkeypatch.setattr("pyspark.sql.DataFrame.observe", lambda df, *_: df, raising=False)
    monkeypatch.setattr("pyspark.sql.classic.dataframe.DataFrame.observe", lambda df, *_: df)
    with pytest.raises(versions.IncompleteWrite, match="3 of 7"):
        versions.refresh(spark.range(3), str(tmp_path / "t"))
    assert spark.read.parquet(versions.current(spark, str(tmp_path / "t"))).count() == 3


def test_two_writers_agree_on_the_newest(spark, tmp_path):
    root = str(tmp_path / "t")
    found = [versions.write_version(spark.range(n), root) for n in (1, 2)]
    for number, version in enumerate(found):  # both saw the same last commit
        system, place = versions._folder(spark, versions._commit_file(root, 1, version.folder.rpartition("/")[2]))
        system.create(place, False).close()
    assert versions.current(spark, root) == max(v.folder for v in found)
    versions.refresh(spark.range(6), root)
    assert spark.read.parquet(versions.current(spark, root)).count() == 6


def test_folders_without_versions(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "raw" / "t"))
    assert ids(Lake(spark, str(tmp_path)).read("raw", "t")) == [0, 1, 2]


def test_landing_that_fails_leaves_the_table(spark):
    name = tables.land(spark.range(3), "landing", "numbers", "parquet")
    with pytest.raises(Exception, match="broken"):
        tables.land(failing_halfway(spark), "landing", "numbers", "parquet")
    assert ids(spark.table(name)) == [0, 1, 2]
    first = spark.sql(f"DESCRIBE EXTENDED {name}").filter("col_name = 'Location'").first()["data_type"]
    tables.land(spark.range(4), "landing", "numbers", "parquet")
    moved = spark.sql(f"DESCRIBE EXTENDED {name}").filter("col_name = 'Location'").first()["data_type"]
    assert ids(spark.table(name)) == [0, 1, 2, 3] and moved != first


def test_an_existing_table_is_never_dropped_for_new_columns(spark, monkeypatch):
    """Readers find the entry at every moment: it is altered, not created again."""
    name = tables.land(spark.range(3), "landing", "wider", "parquet")
    statements = []
    monkeypatch.setattr("pyspark.sql.SparkSession.sql", lambda self, text, real=type(spark).sql: statements.append(text) or real(self, text))
    tables.land(spark.range(4).withColumn("x", F.lit(1.5)), "landing", "wider", "parquet")
    monkeypatch.undo()
    assert not any(s.startswith("DROP") for s in statements)
    assert spark.table(name).columns == ["id", "x"] and spark.table(name).count() == 4
    # columns that go need a new entry
    tables.land(spark.range(2).select(F.col("id").cast("string")), "landing", "wider", "parquet")
    assert spark.table(name).dtypes == [("id", "string")]


def test_partitioned_catalog_table(spark, tmp_path):
    lake = Lake(spark, str(tmp_path), catalog=True)
    rows = spark.range(6).withColumn("side", F.col("id") % 2 == 0)
    for n in (6, 4):
        lake.write(rows.limit(n), "parted", "t", partition_by=["side"])
        assert spark.table("parted.t").count() == n and lake.read("parted", "t").count() == n
    lake.write(rows.filter("false"), "parted", "t", partition_by=["side"])
    assert spark.table("parted.t").count() == 0
