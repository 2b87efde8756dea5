import pytest
from pyspark.sql import functions as F

from bazaarlens.functions import dates, numbers, payload, text


def one(spark, column, **values):
    df = spark.range(1)
    for name, value in values.items():
        df = df.withColumn(name, F.lit(value))
    return df.select(column.alias("v")).collect()[0]["v"]


@pytest.mark.parametrize("value,expected", [(0.285, 0.28), (0.125, 0.12), (2.675, 2.68), (-0.125, -0.12), (5.0, 5.0)])
def test_rounding_is_half_to_even(spark, value, expected):
    assert one(spark, numbers.np_round(F.col("x"), 2), x=value) == expected


@pytest.mark.parametrize(
    "url,expected",
    [
        ("/search?q=notebook", "notebook"),
        ("/search?limit=8&q=note book", "note book"),
        ("/search?q=note+book", "note book"),
        ("/search?q=note%20book#top", "note book"),
        ("/search?q=a%zz", "a%zz"),
        ("/search?q=", None),
        ("/search?qq=1", None),
        ("/search?x=1&q=first&q=second", "first"),
        ("/search", None),
        ("/q=1", None),
    ],
)
def test_query_param(spark, url, expected):
    assert one(spark, text.url_query_param(F.col("u"), "q"), u=url) == expected


def test_query_param_of_null(spark):
    assert one(spark, text.url_query_param(F.lit(None).cast("string"), "q")) is None


@pytest.mark.parametrize("value,expected", [("12", 12), ("5.0", 5), ("5.7", None), ("n/a", None), ("9007199254740993", 9007199254740993), (None, None)])
def test_whole_numbers(spark, value, expected):
    assert one(spark, numbers.to_whole_number(F.lit(value).cast("string"))) == expected


@pytest.mark.parametrize("value,expected", [("2500.5", 2500.5), ("NaN", None), ("x", None)])
def test_numbers(spark, value, expected):
    assert one(spark, numbers.to_number(F.lit(value))) == expected


@pytest.mark.parametrize(
    "value,expected",
    [(1234567, "1,2M"), (3000, "3 mil"), (2500, "2 mil"), (950, "950"), (-1234567, "-1,2M"), (999999, "1000 mil")],
)
def test_compact(spark, value, expected):
    assert one(spark, text.pt_compact(F.lit(value))) == expected


def test_thousands(spark):
    assert one(spark, text.pt_thousands(F.lit(617558.9))) == "617.558"


@pytest.mark.parametrize("value,expected", [(75.94, "75.94"), (10.0, "10.0"), (12345678.5, "12345678.5"), (20000000.0, "20000000.0")])
def test_float_text(spark, value, expected):
    assert one(spark, numbers.python_float(F.lit(value))) == expected


@pytest.mark.parametrize("path,depth", [("A > B > C", 3), ("", 0), (None, 0), (" > A", 1)])
def test_path_depth(spark, path, depth):
    assert one(spark, text.path_depth(F.lit(path).cast("string"))) == depth


def test_iso_text_and_key(spark):
    ts = dates.parse_utc(F.lit("2026-09-10T11:00:00Z"))
    assert one(spark, dates.iso_text(ts)) == "2026-09-10T11:00:00+00:00"
    assert one(spark, dates.iso_text(dates.parse_utc(F.lit("2026-09-10T11:00:00.25Z")))) == "2026-09-10T11:00:00.250000+00:00"
    assert one(spark, dates.date_key(ts)) == 20260910
    assert one(spark, dates.parse_utc(F.lit("10 of September"))) is None
    assert one(spark, dates.seconds_between(ts, dates.parse_utc(F.lit("2026-09-10T11:00:01.5Z")))) == 1.5


@pytest.mark.parametrize("body,kind", [('{"a":1}', "object"), ("[1]", "array"), ("5", "scalar"), ('{"a"', "invalid"), (None, "missing")])
def test_json_kind(spark, body, kind):
    assert one(spark, payload.json_kind(F.lit(body).cast("string"))) == kind


def test_exact_mean_falls_back_for_values_off_the_grid(spark):
    df = spark.createDataFrame([(1e17,), (3e17,)], "x double")
    assert df.agg(numbers.exact_mean(F.col("x")).alias("m")).collect()[0]["m"] == 2e17
    empty = spark.createDataFrame([(None,)], "x double")
    assert empty.agg(numbers.exact_mean(F.col("x")).alias("m")).collect()[0]["m"] is None
