from datetime import datetime

import pytest
from pyspark.sql import functions as F

from ledgerloom import functions as L
from ledgerloom.functions.dates import DATE_PARTS


def one(df, column):
    return [row[0] for row in df.select(column).collect()]


KEY_ROWS = [("a", "b", "c"), ("a", None, "c"), (None, None, "c"), (None, None, None)]


def test_surrogate_key(spark):
    df = spark.createDataFrame(KEY_ROWS, "c1 string, c2 string, c3 string")
    assert one(df, L.surrogate_key(["c1", "c2", "c3"])) == [
        "7b193b3d33184464106f41ddf733783b",
        "4f32a73dc87b7bbb7a654d8898d58c7e",
        "d9c538b129f1a3ad6ecfe55345c32a05",
        "2fa5491950d66d153d23cfbcfea4e164",
    ]
    assert one(df, L.surrogate_key(["c1"]))[1:3] == [
        "0cc175b9c0f1b6a831c399e269772661",
        "f14cc5cdce0420f4a5a6b6d9d7b85f39",
    ]
    empty_key = "d41d8cd98f00b204e9800998ecf8427e"  # MD5 of ''
    assert one(df, L.surrogate_key(["c1"], nulls_as_empty=True))[3] == empty_key
    with pytest.raises(TypeError):
        L.surrogate_key("c1")


@pytest.mark.parametrize(
    "function, rows, expected",
    [
        (L.safe_add, [(1, 2, 3), (1, None, 3), (None, None, 2), (None, None, None)], [6, 4, 2, 0]),
        (L.safe_subtract, [(3, 2, 1), (4, None, 3), (None, None, 2), (None, None, None)], [0, 1, -2, 0]),
    ],
)
def test_null_safe_arithmetic(spark, function, rows, expected):
    df = spark.createDataFrame(rows, "a int, b int, c int")
    assert one(df, function(["a", "b", "c"])) == expected
    with pytest.raises(TypeError):
        function("a")


def test_safe_divide(spark):
    rows = [(6, 0), (10, 5), (None, None), (None, 0), (17, None), (0, None), (None, 9), (0, 5)]
    df = spark.createDataFrame(rows, "n int, d int")
    assert one(df, L.safe_divide("n", "d")) == [None, 2, None, None, None, None, None, 0]
    assert one(df, L.safe_divide(F.col("n") * 2, F.col("d") + 1))[:2] == [12, 20 / 6]


def test_width_bucket(spark):
    amounts = [190000, 290000, 320000, 399999.99, 400000, 470000, 510000, 610000]
    df = spark.createDataFrame([(float(a),) for a in amounts], "amount double")
    assert one(df, L.width_bucket("amount", 200000.0, 600000.0, 4)) == [0, 1, 2, 2, 3, 3, 4, 5]


def test_haversine(spark):
    df = spark.createDataFrame([(48.864716, 2.349014, 52.379189, 4.899431)], "a double, b double, c double, d double")
    assert round(one(df, L.haversine_distance("a", "b", "c", "d"))[0]) == 267
    assert round(one(df, L.haversine_distance("a", "b", "c", "d", "km"))[0]) == 430
    opposite = spark.createDataFrame([(0.0, 0.0, 0.0, 180.0)], "a double, b double, c double, d double")
    assert one(opposite, L.haversine_distance("a", "b", "c", "d"))[0] == pytest.approx(3961 * 3.141592653589793)
    with pytest.raises(ValueError):
        L.haversine_distance("a", "b", "c", "d", "yards")


HOSTS = {
    "www.google.co.uk?utm_source=google&utm_medium=cpc&utm_campaign=spring-summer": "www.google.co.uk",
    "http://running.example.com/2018/01/tips-tricks-how-run-half-marathon-first-time/": "running.example.com",
    "https://www.nytimes.com/2018/01/01/blog": "www.nytimes.com",
    "android-app://m.facebook.com/": "m.facebook.com",
    "docs.nytimes.com/2021/01/01/index.js?utm_source=google": "docs.nytimes.com",
    "https://m.facebook.com/": "m.facebook.com",
    "http://example.com:8080/x": "example.com:8080",
}
MARATHON = "2018/01/tips-tricks-how-run-half-marathon-first-time/"
PATHS = {
    "www.google.co.uk?utm_source=google&utm_medium=cpc&utm_campaign=spring-summer": "",
    f"http://running.example.com/{MARATHON}": MARATHON,
    "https://www.nytimes.com/2018/01/01/blog": "2018/01/01/blog",
    f"http://running.example.com/{MARATHON}?utm_source=google&utm_medium=cpc&utm_campaign=spring-summer": MARATHON,
    "example.com": "example.com",
    "example.com?u=a/b": "b",
}


@pytest.mark.parametrize("function, cases", [(L.url_host, HOSTS), (L.url_path, PATHS)])
def test_url_parts(spark, function, cases):
    df = spark.createDataFrame([(url,) for url in cases], "url string")
    assert one(df, function("url")) == list(cases.values())


def test_url_parameter(spark):
    urls = ["http://example.com/milky?utm_medium=organic", "http://example.com/milky?utm_medium=organic&utm_source=github"]
    df = spark.createDataFrame([(url,) for url in urls], "url string")
    assert one(df, L.url_parameter("url", "utm_medium")) == ["organic", "organic"]
    assert one(df, L.url_parameter("url", "utm_source")) == [None, "github"]


@pytest.mark.parametrize(
    "name, expected",
    [("Some Name", "some_name"), ("a - b", "a_b"), ("blue's", "blues"), ("1st", "_1st"), ("", ""), ("Ü x", "_x")],
)
def test_slug(spark, name, expected):
    assert L.slugify(name) == expected
    df = spark.createDataFrame([(name,)], "name string")
    assert one(df, L.slug("name")) == [expected]


def test_integers_from_text(spark):
    texts = {
        "12": 12,
        " 12 ": 12,
        "12.7": 12,
        "-3": -3,
        "+4.": 4,
        "007": 7,
        "1e3": None,
        "abc": None,
        "": None,
        "2147483647": 2147483647,
        "2147483648": None,
        "99999999999999999999": None,
        ".5": 0,
        "-.5": 0,
        ".": 0,
        "\x01 7": 7,
        "7\x7f": 7,
        "+": None,
        "1 2": None,
        "12.x": None,
    }
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert one(df, L.as_integer("t")) == list(texts.values())


def test_texts_convert_as_without_ansi(spark):
    texts = [".5", "-.5", ".", "-.", "+.", "\x01 7", "7\x00", " 12.9 ", "+4.", "1e3", "0x1p3", "0x.8P1", "", " ", "+", "-", "1.2.3", "٣", "1_0", "NaN", "inf", "+Infinity", "1f", "12L"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    ours = df.select(L.as_integer("t").alias("i"), L.as_double("t").alias("d")).collect()
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        plain = df.selectExpr("CAST(t AS INT) AS i", "CAST(t AS DOUBLE) AS d").collect()
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
    assert [(t, str(r["i"]), str(r["d"])) for t, r in zip(texts, ours)] == [(t, str(r["i"]), str(r["d"])) for t, r in zip(texts, plain)]


def test_doubles_from_text(spark):
    texts = {"12": 12.0, " 1.5 ": 1.5, "1e3": 1000.0, ".5": 0.5, "-2.": -2.0, "1d": 1.0, "0x1p3": 8.0, "\x01 7": 7.0, ".": None, "n/a": None, "": None, "1,5": None}
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert one(df, L.as_double("t")) == list(texts.values())
    special = spark.createDataFrame([("NaN",), ("-Infinity",), ("inf",)], "t string")
    assert [str(v) for v in one(special, L.as_double("t"))] == ["nan", "-inf", "inf"]


def test_numbers_need_no_parsing(spark):
    df = spark.createDataFrame([(3, 2**40, 7.9)], "i int, l bigint, d double")
    types = {f.name: f.dataType for f in df.schema.fields}
    assert one(df, L.as_integer("i", types["i"])) == [3]
    assert one(df, L.as_integer("l", types["l"])) == [None]
    assert one(df, L.as_integer("d", types["d"])) == [7]


STARTS = [datetime(2020, 1, 31), datetime(2019, 12, 29, 23, 59, 59), datetime(2020, 2, 29, 12)]
ENDS = [datetime(2020, 2, 1), datetime(2020, 1, 5), datetime(2021, 3, 1)]


@pytest.mark.parametrize(
    "part, expected",
    [
        ("day", [1, 7, 366]),
        ("week", [0, 1, 53]),
        ("month", [1, 1, 13]),
        ("quarter", [0, 1, 4]),
        ("year", [0, 1, 1]),
        ("hour", [24, 145, 366 * 24 - 12]),
    ],
)
def test_boundaries(spark, part, expected):
    from ledgerloom.operators.series import periods_between

    df = spark.createDataFrame(list(zip(STARTS, ENDS)), "s timestamp_ntz, e timestamp_ntz")
    assert one(df, L.boundaries_between(part, "s", "e")) == expected
    assert [periods_between(part, s, e) for s, e in zip(STARTS, ENDS)] == expected


def test_add_interval(spark):
    df = spark.createDataFrame([(datetime(2020, 1, 31),)], "t timestamp_ntz")
    assert one(df, L.add_interval("month", 1, "t")) == [datetime(2020, 2, 29)]
    assert one(df, L.add_interval("hour", -1, "t")) == [datetime(2020, 1, 30, 23)]
    assert set(DATE_PARTS) >= {"second", "minute"}
    with pytest.raises(ValueError):
        L.add_interval("fortnight", 1, "t")
