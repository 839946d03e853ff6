import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F
from tests.conftest import one, rows

from celltide.functions import geo, lookups, numbers, text, times


@pytest.mark.parametrize("value,expected", [
    ("1.5", 1.5), (" 2 ", 2.0), ("abc", None), ("", None), (None, None), ("nan", None),
    ("NaN", None), ("-inf", -math.inf), ("1.0d", None), ("1f", None), ("0x1p3", None), ("1e3", 1e3),
])
def test_to_number(spark, value, expected):
    assert one(spark, numbers.to_number(F.lit(value).cast("string"))) == expected


def test_bad_numbers_are_not_missing_ones(spark):
    df = spark.createDataFrame([("abc",), ("nan",), (None,), ("",), ("1",)], "x string")
    got = [r[0] for r in df.select(numbers.is_bad_number(F.col("x"))).collect()]
    assert got == [True, False, False, False, False]


@pytest.mark.parametrize("value,expected", [
    ("1700-2100", 1900.0), ("700", 700.0), ("x", 0.0), (None, 0.0), ("1-x", 0.0), ("1-2-3", 0.0),
])
def test_frequency_mid(spark, value, expected):
    assert one(spark, numbers.frequency_mid(F.lit(value).cast("string"))) == expected


def test_two_decimals_as_python_writes_them(spark):
    rng = random.Random(7)
    values = [0.125, 2.675, -0.125, 1.005, 96.0, 0.0, 97.125, 0.375, -2.675, 1e9 + 0.125, 12.345]
    values += [rng.randint(-10**6, 10**6) / 1000 for _ in range(3000)]
    values += [rng.uniform(-1000, 1000) for _ in range(500)]
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    got = df.select("x", numbers.fixed2("x").alias("s")).collect()
    wrong = [(r.x, r.s) for r in got if r.s.replace("-0.00", "0.00") != f"{r.x:.2f}".replace(
        "-0.00", "0.00")]
    assert wrong == []


def test_whole_doubles_as_python_writes_them(spark):
    values = [80.0, -111.17, 0.5, 12345678.0, 123456789.25, 0.0005, -0.00025, 5.0, 0.001]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = df.select("x", numbers.shown("x").alias("s")).collect()
    assert [(r.x, r.s) for r in got] == [(r.x, str(r.x)) for r in got]


@pytest.mark.parametrize("seconds,expected", [
    (0, "N/A"), (45, "45 seconds"), (60, "1 minute"), (300, "5 minutes"), (90, "1m 30s"),
    (3600, "1 hour"), (5400, "1h 30m"), (7200, "2 hours"),
])
def test_duration_text(spark, seconds, expected):
    assert one(spark, times.duration_text(F.lit(seconds))) == expected


def test_time_parts(spark):
    df = spark.createDataFrame([
        (dt.datetime(2024, 1, 6, 17, 59, 59),), (dt.datetime(2024, 1, 8, 18, 0, 0),),
        (dt.datetime(2024, 1, 8, 6, 0, 0),), (dt.datetime(2024, 1, 8, 5, 59, 59),),
    ], "t timestamp")
    got = [tuple(r) for r in df.select(
        times.daypart(F.col("t")), times.daytype(F.col("t")), times.day_name(F.col("t"))
    ).collect()]
    assert got == [
        ("day", "weekends", "Saturday"), ("night", "weekdays", "Monday"),
        ("day", "weekdays", "Monday"), ("night", "weekdays", "Monday"),
    ]


def test_utc_texts(spark):
    for value in ("2024-01-31T12:00:00", "2024-01-31 12:00:00Z"):
        got = one(spark, F.unix_timestamp(times.as_utc(F.lit(value))))
        assert got == 1706702400
    assert one(spark, times.as_utc(F.lit("soon"))) is None


def test_text_helpers(spark):
    assert one(spark, text.decode_utf8(F.lit(bytearray(b"A\xffB")))) == "AB"
    assert one(spark, text.int_list(F.lit('"1, 2,x,3"'))) == [1, 2, 3]
    assert one(spark, text.int_list(F.lit(""))) == []
    assert one(spark, text.text_list(F.lit("a, b,,"))) == ["a", "b"]
    assert one(spark, text.strip(F.lit("\t a b \x0b　"))) == "a b"
    parts = "one\r\ntwo\n\nthree\x85four five\rsix"
    assert one(spark, text.lines_of(F.lit(parts))) == parts.splitlines()
    assert one(spark, text.snippet(F.lit("x" * 51))) == "x" * 50 + "..."
    assert one(spark, text.snippet(F.lit("x" * 50))) == "x" * 50


def test_lookups(spark):
    assert one(spark, lookups.band_frequency(F.lit("Band 66"))) == "1700-2100"
    assert one(spark, lookups.band_frequency(F.lit("Band 1"))) == "Unknown"
    assert one(spark, lookups.event_title(F.lit("tower-up"))) == "Tower Online"
    assert one(spark, lookups.event_title(F.lit("x"))) == "Unknown Event"
    assert one(spark, lookups.event_badge(F.lit("x"))) == "outline"
    got = one(spark, lookups.usage_range(
        F.lit("Residential"), F.lit("weekdays"), F.lit("day")))
    assert (got.low, got.high) == (0.2, 0.3)


def test_haversine(spark):
    got = one(spark, geo.haversine(F.lit(33.0), F.lit(-97.0), F.lit(33.5), F.lit(-96.5)))
    a = math.sin(math.radians(0.25)) ** 2 + math.cos(math.radians(33)) * math.cos(
        math.radians(33.5)) * math.sin(math.radians(0.25)) ** 2
    assert got == pytest.approx(2 * 6371 * math.atan2(math.sqrt(a), math.sqrt(1 - a)))
    assert rows(spark.range(1).select(F.lit(1))) == [(1,)]


def test_intermediate_tables_go_at_the_end(spark):
    import os

    from celltide import session

    kept, session._made[:] = list(session._made), []
    path = session.materialize(spark.range(3), "x").inputFiles()[0].removeprefix("file:").rsplit("/", 1)[0]
    assert os.path.isdir(path)
    session.drop_scratch(spark)
    assert not os.path.exists(path) and session._made == []
    session._made[:] = kept


def test_opposite_places(spark):
    df = spark.range(20_000).selectExpr("id * 0.0089 - 89 AS lat", "id * 0.0179 - 179 AS lon")
    km = geo.haversine(F.col("lat"), F.col("lon"), -F.col("lat"), F.col("lon") + 180)
    assert df.select(km.alias("km")).where("isnan(km) OR abs(km - 20015.086796) > 1e-3").count() == 0
