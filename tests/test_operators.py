from datetime import datetime

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import columns, grouping, reshape, series, setops


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture(scope="module")
def fields(spark):
    return spark.createDataFrame([tuple("abc"), tuple("def"), tuple("ghi")], "field_1 string, field_2 string, field_3 string")


def test_star(fields):
    assert fields.select(*columns.star(fields, exclude=["FIELD_3"])).columns == ["field_1", "field_2"]
    named = fields.select(*columns.star(fields, prefix="prefix_", suffix="_suffix"))
    assert named.columns == [f"prefix_field_{i}_suffix" for i in (1, 2, 3)]
    assert columns.star(fields, exclude=fields.columns) == []
    aliased = fields.alias("f").select(*columns.star(fields, relation_alias="f"))
    assert rows(aliased) == rows(fields)


def test_star_in_group_by(spark):
    df = spark.createDataFrame([("a", "b", 1), ("a", "b", 2), ("c", "d", 3), ("c", "e", 4)], "g1 string, g2 string, v int")
    grouped = df.groupBy(*columns.star(df, exclude=["v"])).agg(F.sum("v"))
    assert rows(grouped) == [("a", "b", 3), ("c", "d", 3), ("c", "e", 4)]
    assert rows(grouping.group_by_first(df, 2, F.sum("v"))) == rows(grouped)
    with pytest.raises(ValueError):
        grouping.first_columns(df, 4)


def test_filtered_columns(fields):
    names = columns.filtered_columns(fields, exclude=["field_1"])
    assert rows(fields.agg(*[F.max(n) for n in names])) == [("h", "i")]


def test_nullcheck(spark):
    df = spark.createDataFrame([("a", "", 1), ("", "b", 2), ("", "", 3)], "f1 string, f2 string, f3 int")
    assert rows(columns.nullcheck_table(df)) == rows(
        spark.createDataFrame([("a", None, 1), (None, "b", 2), (None, None, 3)], df.schema)
    )


@pytest.fixture(scope="module")
def shirts(spark):
    return spark.createDataFrame([("S", "red"), ("S", "blue"), ("S", "blue's"), ("M", "red")], "size string, color string")


def test_pivot(shirts):
    pivoted = reshape.pivot(shirts, ["size"], "color", ["red", "blue"])
    assert pivoted.columns == ["size", "red", "blue"]
    assert rows(pivoted) == [("M", 1, 0), ("S", 1, 1)]


def test_pivot_slugs_and_options(shirts):
    pivoted = reshape.pivot(shirts, ["size"], "color", ["red", "blue", "blue's"], quote_identifiers=False)
    assert pivoted.columns == ["size", "red", "blue", "blues"]
    assert rows(pivoted) == [("M", 1, 0, 0), ("S", 1, 1, 1)]
    other = reshape.pivot(shirts, ["size"], "color", ["RED"], cmp="ilike", agg="max", then_value="length(size) + 4", else_value=-1)
    assert rows(other) == [("M", 5), ("S", 5)]
    unaliased = reshape.pivot(shirts, ["size"], "color", ["red"], alias=False)
    assert unaliased.columns[1] != "red"
    # any operator and aggregate of SQL
    same = reshape.pivot(shirts, ["size"], "color", ["red", "blue's"], cmp="==", agg="median", then_value=2)
    assert rows(same) == rows(reshape.pivot(shirts, ["size"], "color", ["red", "blue's"], agg=F.median, then_value=2))
    with pytest.raises(ValueError):
        reshape.pivot(shirts, ["size"], "color", ["red"], agg="median", distinct=True)


@pytest.mark.parametrize("agg, expected", [("sum", [(1, 3, 0), (2, 0, 9)]), ("count", [(1, 3, 1), (2, 1, 2)])])
def test_pivot_distinct(spark, agg, expected):
    df = spark.createDataFrame([(1, "a", 1), (1, "a", 1), (1, "a", 2), (2, "b", 9)], "g int, c string, v int")
    pivoted = reshape.pivot(df, ["g"], "c", ["a", "b"], agg=agg, then_value="v", distinct=True)
    naive = df.groupBy("g").agg(
        *[F.expr(f"{agg}(DISTINCT CASE WHEN c = '{v}' THEN v ELSE 0 END)") for v in ("a", "b")]
    )
    assert rows(pivoted) == rows(naive)
    if agg == "sum":
        assert rows(pivoted) == expected
    others_null = reshape.pivot(df, ["g"], "c", ["a", "b"], agg=agg, then_value="v", else_value=None, distinct=True)
    naive = df.groupBy("g").agg(*[F.expr(f"{agg}(DISTINCT CASE WHEN c = '{v}' THEN v END)") for v in ("a", "b")])
    assert rows(others_null) == rows(naive)
    assert "Expand" not in others_null._jdf.queryExecution().executedPlan().toString()


CUSTOMERS = [(123, "2017-01-01", "active", "tier 1", "name 1"), (234, "2017-02-01", "active", "tier 3", "name 3"), (567, "2017-03-01", "churned", "tier 2", "name 2")]


def test_unpivot(spark):
    df = spark.createDataFrame(CUSTOMERS, "customer_id int, created_at string, status string, segment string, name string")
    melted = reshape.unpivot(df, exclude=["customer_id", "created_at"], remove=["NAME"], field_name="prop", value_name="val")
    assert melted.columns == ["customer_id", "created_at", "prop", "val"]
    assert rows(melted) == sorted(
        [(c, d, k, v) for c, d, status, segment, _ in CUSTOMERS for k, v in (("status", status), ("segment", segment))], key=str
    )
    assert reshape.unpivot(df, exclude=["customer_id", "created_at"]).count() == 9
    with pytest.raises(ValueError):
        reshape.unpivot(df, remove=df.columns)


def test_unpivot_booleans_and_nulls(spark):
    df = spark.createDataFrame([(1, True, 5), (2, False, 6), (3, None, None)], "id int, is_updated boolean, n int")
    assert rows(reshape.unpivot(df, exclude=["id"])) == rows(
        spark.createDataFrame(
            [(1, "is_updated", "true"), (2, "is_updated", "false"), (3, "is_updated", None), (1, "n", "5"), (2, "n", "6"), (3, "n", None)],
            "id int, f string, v string",
        )
    )
    assert rows(reshape.unpivot(df, "bigint", exclude=["id"], remove=["is_updated"])) == [(1, "n", 5), (2, "n", 6), (3, "n", None)]


@pytest.fixture(scope="module")
def union_inputs(spark):
    one = spark.createDataFrame([(1, "dora", "pi"), (2, "bob", "e"), (3, "alice", "4")], "id int, name string, favorite_number string")
    two = spark.createDataFrame([(1, "green", 7), (2, "pink", 13)], "id int, favorite_color string, favorite_number int")
    return one, two


EXPECTED_UNION = [
    (1, "dora", "pi", None),
    (2, "bob", "e", None),
    (3, "alice", "4", None),
    (1, None, "7", "green"),
    (2, None, "13", "pink"),
]


@pytest.mark.parametrize("swapped", [False, True])
def test_union_relations(union_inputs, swapped):
    one, two = reversed(union_inputs) if swapped else union_inputs
    union = reshape.union_relations([("one", one), ("two", two)], source_column=None)
    assert rows(union.select("id", "name", "favorite_number", "favorite_color")) == sorted(EXPECTED_UNION, key=str)


def test_union_options(union_inputs):
    relations = dict(zip(("one", "two"), union_inputs))
    full = reshape.union_relations(relations)
    assert full.columns == ["_dbt_source_relation", "id", "name", "favorite_number", "favorite_color"]
    for exclude in (["name"], ["NAME"]):
        assert "name" not in reshape.union_relations(relations, exclude=exclude).columns
    included = reshape.union_relations(relations, include=["ID"], source_column="origin", where="id = 1")
    assert rows(included) == [("one", 1), ("two", 1)]
    overridden = reshape.union_relations(relations, column_override={"id": "string"})
    assert dict(overridden.dtypes)["id"] == "string"
    with pytest.raises(ValueError):
        reshape.union_relations(relations, include=["id"], exclude=["name"])
    with pytest.raises(ValueError):
        reshape.union_relations(relations, include=["nothing"])


def test_deduplicate(spark):
    df = spark.createDataFrame([(1, "play", 1), (1, "play", 2), (2, "pause", 1), (None, "play", 3), (None, "play", 4)], "user_id int, event string, version int")
    assert rows(grouping.deduplicate(df.filter("user_id = 1"), ["user_id"], [F.desc("version")])) == [(1, "play", 2)]
    assert rows(grouping.deduplicate(df, ["user_id"], ["version"])) == [(1, "play", 1), (2, "pause", 1), (None, "play", 3)]


def test_column_values(spark):
    df = spark.createDataFrame([(v, "left" if i % 2 == 0 else "right") for i, v in enumerate("abcdefggggg")], "field string, condition string")
    assert grouping.column_values(df, "field") == ["g", "a", "b", "c", "d", "e", "f"]
    assert grouping.column_values(df, "field", order_by="value") == list("abcdefg")
    assert sorted(grouping.column_values(df, "field", where="condition = 'left'")) == ["a", "c", "e", "g"]
    assert grouping.column_values(df, "field", max_records=2) == ["g", "a"]
    assert grouping.column_values(df, "field", where="false", default=["x"]) == ["x"]
    assert grouping.column_values(None, "field", default=[]) == []
    with pytest.raises(ValueError):
        grouping.column_values(None, "field")
    with pytest.raises(ValueError):
        grouping.column_values(df, "field", refuse_above=3)
    assert len(grouping.column_values(spark.range(10_001), "id")) == 10_001


def test_scalar_value(spark):
    df = spark.createDataFrame([(datetime(2017, 1, 1), 3.3, 19, "string_a")], "d timestamp_ntz, f double, i int, s string")
    for name, value in (("d", datetime(2017, 1, 1)), ("f", 3.3), ("i", 19), ("s", "string_a")):
        assert grouping.scalar_value(df.select(name)) == value
        assert grouping.scalar_value(df.select(name).filter("false"), value) == value
        shown = spark.range(2).select(grouping.scalar_column(df.select(name)).alias("v"))
        assert [r["v"] for r in shown.collect()] == [value, value]
    missing = spark.range(1).select(grouping.scalar_column(df.select("i").filter("false"), 7))
    assert missing.first()[0] == 7


def test_key_counts(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    assert tuple(grouping.key_counts(df, "k").first()) == (4, 2, 1)
    assert [tuple(r) for r in grouping.distribution(df, "k").collect()] == [(1, 2), (2, 1), (None, 1)]
    assert [tuple(r) for r in grouping.sample_rows(df.filter("k IS NOT NULL"), 2, ["k"]).collect()] == [(1,), (1,)]


def test_except_both_ways(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, None), (3, "z")], "k int, v string")
    b = spark.createDataFrame([(1, "x"), (2, None), (4, "w"), (4, "w")], "k int, v string")
    assert rows(setops.except_both_ways(a, b)) == [("a_minus_b", 3, "z"), ("b_minus_a", 4, "w")]
    assert rows(setops.except_both_ways(a, b, multiset=True)) == [
        ("a_minus_b", 1, "x"),
        ("a_minus_b", 3, "z"),
        ("b_minus_a", 4, "w"),
        ("b_minus_a", 4, "w"),
    ]
    assert rows(setops.except_both_ways(a, b, ["v"])) == [("a_minus_b", "z"), ("b_minus_a", "w")]


def test_series(spark):
    assert [r[0] for r in series.generate_series(spark, 10).collect()] == list(range(1, 11))
    with pytest.raises(ValueError):
        series.generate_series(spark, 0)


@pytest.mark.parametrize(
    "part, start, end, first, last, n",
    [
        ("day", "2018-01-01", "2018-01-10", datetime(2018, 1, 1), datetime(2018, 1, 9), 9),
        ("month", "2020-01-31", "2020-04-01", datetime(2020, 1, 31), datetime(2020, 3, 31), 3),
        ("hour", datetime(2020, 1, 1, 22), datetime(2020, 1, 2, 1), datetime(2020, 1, 1, 22), datetime(2020, 1, 2), 3),
        ("week", "2020-01-01", "2020-01-20", datetime(2020, 1, 1), datetime(2020, 1, 15), 3),
        ("year", "2018-06-01", "2020-01-01", datetime(2018, 6, 1), datetime(2019, 6, 1), 2),
    ],
)
def test_date_spine(spark, part, start, end, first, last, n):
    spine = series.date_spine(spark, part, start, end)
    assert spine.columns == [f"date_{part}"]
    values = sorted(r[0] for r in spine.collect())
    assert (values[0], values[-1], len(values)) == (first, last, n)


@pytest.mark.parametrize("agg", ["sum", "count", "min", "max", "avg"])
@pytest.mark.parametrize("else_value", [0, 7, None])
def test_pivot_in_two_phases(spark, monkeypatch, agg, else_value):
    """The same as evaluating every value for every row, NULLs and values that do not occur included."""
    data = [("a", 1, 5.0), ("a", 1, -2.0), ("a", 2, None), ("b", None, 3.0), ("b", 3, 4.0), ("c", 1, None), (None, 2, 1.0), ("d", 9, 8.0), ("e", 1, 2.5)]
    df = spark.createDataFrame(data, "g string, k int, v double")
    wanted = {"agg": agg, "then_value": "v", "else_value": else_value, "prefix": "k_"}
    plain = reshape.pivot(df, ["g"], "k", [1, 2, 3, 4], **wanted)
    monkeypatch.setattr(reshape, "FEW_VALUES", 2)
    quick = reshape.pivot(df, ["g"], "k", [1, 2, 3, 4], **wanted)
    assert quick.dtypes == plain.dtypes
    assert sorted(map(str, quick.collect())) == sorted(map(str, plain.collect()))
    texts = df.withColumn("k", F.concat(F.lit("n "), "k"))
    slugs = reshape.pivot(texts, ["g"], "k", ["n 1", "n 2", "n 3"], agg="sum", quote_identifiers=False)
    assert slugs.columns == ["g", "n_1", "n_2", "n_3"]
    assert {r["g"]: r["n_1"] for r in slugs.collect()} == {"a": 2, "b": 0, "c": 1, None: 0, "d": 0, "e": 1}


def test_pivot_of_thousands_of_values(spark):
    df = spark.range(20_000).selectExpr("id % 3 AS g", "CAST(id % 5000 AS INT) AS k", "id AS v")
    wide = reshape.pivot(df, ["g"], "k", list(range(5000)), then_value="v")
    found = {r[0]: r for r in wide.collect()}
    assert found[1][1 + 4999] == sum(i for i in range(20_000) if i % 3 == 1 and i % 5000 == 4999)
    assert len(found) == 3 and len(wide.columns) == 5001
