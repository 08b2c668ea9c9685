import pytest
from pyspark.sql import functions as F

from ledgerloom.session import scratch_folder
from ledgerloom.sources import csv_files, discovery, jdbc, tables
from ledgerloom.sources.tables import Lake


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_file_map():
    assert len(csv_files.RAW_FILES) == 7
    assert all(name.endswith(".csv") and table == table.lower() for name, table in csv_files.RAW_FILES.items())


def test_trim_column_names(spark):
    df = spark.createDataFrame([(1, 2, 3)], "` SK_ID_CURR ` int, ` AMT_CREDIT ` int, `a.b ` int")
    assert csv_files.trim_column_names(df).columns == ["SK_ID_CURR", "AMT_CREDIT", "a.b"]
    with pytest.raises(ValueError):
        csv_files.trim_column_names(spark.createDataFrame([(1, 2)], "`a ` int, ` A` int"))


def test_ingest(spark, tmp_path):
    (tmp_path / "one.csv").write_text(" SK_ID_CURR , AMT_CREDIT\n1,2.5\n2,\n2,\n")
    (tmp_path / "two.csv").write_text("k,v\n7,x\n,\n8,1\n")
    lake = Lake(spark, str(tmp_path / "lake"))
    landed = csv_files.ingest(lake, str(tmp_path), {"one.csv": "one", "two.csv": "two"}, {"two": "k string, v string"})
    assert landed == [csv_files.Landed("raw.one", 3, 2), csv_files.Landed("raw.two", 3, 2)]
    assert lake.read("raw", "one").dtypes == [("SK_ID_CURR", "int"), ("AMT_CREDIT", "double")]
    assert lake.read("raw", "two").dtypes == [("k", "string"), ("v", "string")]
    # a second run replaces the tables
    assert csv_files.ingest(lake, str(tmp_path), {"one.csv": "one"})[0].rows == 3
    assert lake.read("raw", "one").count() == 3


def test_one_dirty_value_makes_text(spark, tmp_path):
    (tmp_path / "d.csv").write_text("k\n1\nabc\n")
    assert csv_files.read_csv(spark, str(tmp_path / "d.csv")).dtypes == [("k", "string")]


def test_lake_reads_existing_columns(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    lake.write(spark.createDataFrame([(1, 2, 3)], "a int, b int, c int"), "raw", "t")
    assert lake.read("raw", "t", ["c", "x", "A"]).columns == ["c", "A"]
    assert tables.table_columns(lake.read("raw", "t")) == ["a", "b", "c"]
    assert tables.preferred_key(["SK_ID_CURR"], ["SK_ID_PREV", "SK_ID_CURR"]) == "SK_ID_CURR"
    assert tables.preferred_key(["x"], ["SK_ID_PREV"]) is None


def test_key_bounds(spark):
    df = spark.createDataFrame([(5,), (None,), (-2,)], "k int")
    assert tables.key_bounds(df, "k") == (-2, 5)
    assert tables.key_bounds(df.filter("false"), "k") == (0, 1)


def test_catalog_layers(spark, tmp_path):
    lake = Lake(spark, str(tmp_path), catalog=True)
    lake.create_layers()
    lake.write(spark.range(3), "staging", "numbers")
    lake.write(spark.range(5), "staging", "numbers")
    assert spark.table("staging.numbers").count() == 5
    assert {"raw", "silver", "quarantine", "staging", "warehouse"} <= {d.name for d in spark.catalog.listDatabases()}


def test_sides_are_read_by_their_layer(spark, tmp_path):
    """Also in a session that overwrites single partitions only, rejects of an earlier run are gone."""
    from ledgerloom.quality.validators import validate_and_store

    lake = Lake(spark, str(tmp_path))
    schema = "SK_ID_BUREAU string, MONTHS_BALANCE string, STATUS string"
    dirty = spark.createDataFrame([("1", "-1", "C"), ("x", "-1", "C")], schema)
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        validate_and_store(lake, dirty, "bureau_balance")
        assert lake.read("silver", "bureau_balance").collect() == [("1", "-1", "C")]
        assert lake.read("quarantine", "bureau_balance_rejects").collect() == [("x", "-1", "C", "INVALID_SK_ID_BUREAU_TYPE")]
        validate_and_store(lake, dirty.limit(1), "bureau_balance")
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert lake.read("quarantine", "bureau_balance_rejects").count() == 0
    assert lake.read("silver", "bureau_balance", ["status"]).columns == ["status"]


def test_materialize_and_land(spark):
    assert tables.materialize(spark.range(3), "three_rows").count() == 3
    assert tables.materialize(spark.range(4), "marts.four_rows", "table").count() == 4
    assert tables.land(spark.range(2), "lakehouse", "two_rows", "parquet") == "lakehouse.two_rows"
    assert tables.land(spark.range(6), "lakehouse", "two_rows", "parquet") == "lakehouse.two_rows"
    assert spark.table("lakehouse.two_rows").count() == 6
    with pytest.raises(ValueError, match="no catalog"):
        tables.land(spark.range(2), "lakehouse", "two_rows")
    with pytest.raises(ValueError):
        tables.materialize(spark.range(1), "x", "index")


@pytest.fixture(scope="module")
def event_tables(spark, tmp_path_factory):
    lake = Lake(spark, str(tmp_path_factory.mktemp("events")), catalog=True)
    for day in (1, 2, 3):
        events = spark.createDataFrame([(2 * day - 1, "play"), (2 * day, "pause")], "user_id int, event string")
        lake.write(events, "logs", f"data_events_2018010{day}")
    lake.write(spark.range(1), "logs", "data_people")
    lake.create_view("logs", "data_events_view", ("logs", "data_people"), [("id", "user_id")], "true")
    return lake


def test_discovery(spark, event_tables):
    found = discovery.tables_like(spark, "LOGS", "Data_Events%")
    assert [(r.name[-2:], r.type) for r in found] == [("01", "external"), ("02", "external"), ("03", "external"), ("ew", "view")]
    assert discovery.tables_like(spark, "log_", "data_people")[0].schema == "logs"
    assert discovery.tables_with_prefix(spark, "logs", "data_ev", exclude="%view") == found[:3]
    assert discovery.tables_like(spark, "nowhere", "%") == []


def test_union_by_prefix(spark, event_tables):
    union = discovery.union_tables_like(spark, "logs", "data_events_2018%")
    assert union.columns == ["_dbt_source_relation", "user_id", "event"]
    assert rows(union.select("user_id", "event")) == [(i, "play" if i % 2 else "pause") for i in range(1, 7)]
    assert union.filter("event = 'play'").count() == 3
    folders = [event_tables.path("logs", f"data_events_2018010{d}") for d in (1, 3)]
    assert rows(discovery.union_folders(spark, folders, where="user_id > 1").select("user_id")) == [(2,), (5,), (6,)]
    with pytest.raises(ValueError):
        discovery.union_tables_like(spark, "logs", "nothing")


def test_session_views_are_found(spark):
    spark.range(1).createOrReplaceTempView("loose_view")
    assert [r.qualified for r in discovery.tables_like(spark, "", "loose%")] == ["`loose_view`"]


class Recorder(jdbc.Database):
    """A database whose scans are only noted down: there is none to ask in the tests."""

    scans = []
    answer = (1, 100)

    def _load(self, options):
        self.scans.append(options)
        if "MIN(" in options["dbtable"]:
            return self.spark.createDataFrame([self.answer], "lo int, hi int")
        return self.spark.createDataFrame([(1, 2, 3)], "SK_ID_CURR int, A int, B int")


@pytest.fixture
def database(spark):
    Recorder.scans, Recorder.answer = [], (1, 100)
    return Recorder(spark, "jdbc:postgresql://host/db", {"user": "u"})


def test_partitioned_jdbc_scan(database):
    database.read_partitioned("raw.bureau", "SK_ID_CURR", 16)
    assert database.scans[0]["dbtable"] == '(SELECT MIN("SK_ID_CURR") AS lo, MAX("SK_ID_CURR") AS hi FROM raw.bureau) t'
    assert database.scans[1] == {
        "dbtable": "raw.bureau",
        "partitionColumn": "SK_ID_CURR",
        "lowerBound": "1",
        "upperBound": "100",
        "numPartitions": "16",
    }


@pytest.mark.parametrize("answer", [(None, None), (7, 7)])
def test_no_range_means_plain_scan(database, answer):
    Recorder.answer = answer
    database.read_partitioned("raw.bureau", "SK_ID_CURR")
    assert database.scans[-1] == {"dbtable": "raw.bureau"}


def test_jdbc_scan_of_columns(database):
    df = database.read_columns("silver.t", ["SK_ID_PREV", "SK_ID_CURR"], ["B", "missing"], 4)
    assert df is not None
    assert database.scans[-1]["dbtable"] == '(SELECT "B", "SK_ID_CURR" FROM silver.t) t'
    assert database.scans[-1]["partitionColumn"] == "SK_ID_CURR"
    assert database.read_columns("silver.t", ["nothing"], ["B", "missing"]).columns == ["B"]
    Recorder.answer = (None, None)
    database.read_columns("silver.t", ["SK_ID_CURR"], ["A"])
    assert (database.scans[-1]["lowerBound"], database.scans[-1]["upperBound"]) == ("0", "1")


def test_jdbc_write_options():
    assert jdbc.write_options("overwrite", 1000, 1, "NONE") == {
        "truncate": "true",
        "batchsize": "1000",
        "isolationLevel": "NONE",
        "numPartitions": "1",
    }
    appended = jdbc.write_options("append", 5000, None, "NONE")
    assert appended["truncate"] == "false" and "numPartitions" not in appended


def test_scratch_folder_follows_the_cluster_setting(spark, tmp_path):
    class Conf:
        def get(self, name, default=None):
            return str(tmp_path) if name == "spark.checkpoint.dir" else default

    class Cluster:
        conf = Conf()
        sparkContext = spark.sparkContext

    assert scratch_folder(Cluster(), "x").startswith(f"{tmp_path}/x-")
    assert scratch_folder(spark, "x") != scratch_folder(spark, "x")

    class NoSetting:
        class conf:
            get = staticmethod(lambda name, default=None: default)

        class sparkContext:
            master = "yarn"
            getCheckpointDir = staticmethod(lambda: None)

    with pytest.raises(RuntimeError):
        scratch_folder(NoSetting(), "x")



def test_landing_as_text_observes_types(spark, tmp_path):
    lines = [" id ,code,wide,price,mixed,day,empty,round"]
    lines += [f"{i},{i:04d},{i * 10**11},{i}.50,{i if i % 2 else f'{i}.25'},2020-01-{i + 1:02d},,{i}" for i in range(1, 9)]
    lines += ["9,0009,9,1.5,3,x,,12345678901234567.5", "too,few", "1,2,3,4,5,6,7,8,9,many", "-3,-1,-9,-1.5,-7,2020-02-01,,-1"]
    (tmp_path / "t.csv").write_text("\n".join(lines) + "\n")
    lake = Lake(spark, str(tmp_path / "lake"))
    (landed,) = csv_files.ingest_as_text(lake, str(tmp_path), {"t.csv": "t"})
    assert (landed.table, landed.rows, landed.columns, landed.broken) == ("raw.t", 12, 8, 2)
    assert landed.types == {"id": "int", "code": "string", "wide": "bigint", "price": "double", "mixed": "double", "day": "string", "empty": "string", "round": "string"}
    assert lake.read("raw", "t").filter("_broken_line IS NOT NULL").count() == 2
    typed = csv_files.read_typed(lake, "raw", "t")
    assert dict(typed.dtypes) == landed.types
    assert sorted(r["code"] for r in typed.collect())[:2] == ["-1", "0001"] and typed.count() == 10
    assert typed.agg(F.sum("wide")).first()[0] == sum(i * 10**11 for i in range(1, 9))


def test_kinds_of_text(spark):
    texts = ["0", "-0", "007", "+1", " 1", "12", "2147483648", "-2147483648", "9223372036854775808", "1.50", "01.5", ".5", "1e5", "1234567890123.456", "", "x", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    found = [r["k"] for r in df.select(csv_files._kind(F.col("t")).alias("k")).collect()]
    assert found == [0, 3, 3, 3, 3, 0, 1, 0, 3, 2, 3, 3, 3, 3, 3, 3, None]


def test_landing_as_text_is_one_pass(spark, tmp_path):
    """The plan is built from the header; no values are read before the write."""
    (tmp_path / "t.csv").write_text("a,b\n" + "1,2\n" * 1000)
    df = csv_files.read_csv_text(spark, str(tmp_path / "t.csv"))
    assert df.dtypes == [("a", "string"), ("b", "string"), ("_broken_line", "string")]


def test_union_of_many_folders_is_one_scan(spark, tmp_path):
    lake, parent = Lake(spark, str(tmp_path)), tmp_path / "plain"
    for i in range(40):
        spark.range(i, i + 2).write.parquet(str(parent / f"day {i}+%41"))
    paths = [str(parent / f"day {i}+%41") for i in range(40)]
    union = discovery.union_folders(spark, paths)
    plan = union._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Union" not in plan
    assert rows(union) == sorted(((f"day {i}+%41", j) for i in range(40) for j in (i, i + 1)), key=str)
    assert len(discovery.union_folders(spark, paths[:2])._jdf.queryExecution().optimizedPlan().toString()) * 1.2 > len(
        union._jdf.queryExecution().optimizedPlan().toString()
    )
    # versioned folders, one of them refreshed, one with a further column
    for n in (9, 1):
        lake.write(spark.range(n), "v", "a")
    lake.write(spark.range(2).withColumn("x", F.lit("y")), "v", "b")
    both = discovery.union_folders(spark, [lake.path("v", name) for name in "ab"])
    assert rows(both) == sorted([("a", 0, None), ("b", 0, "y"), ("b", 1, "y")], key=str)
    # unlike types need a branch each
    lake.write(spark.range(1).select(F.col("id").cast("string")), "v", "c")
    assert rows(discovery.union_folders(spark, [lake.path("v", name) for name in "ac"])) == [("a", "0"), ("c", "0")]
