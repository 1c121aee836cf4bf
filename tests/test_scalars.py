import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from fluxwatch.functions.scalars import (
    fixed_one,
    guard_duration,
    instant_ms,
    percent,
    rate_value,
    short_number,
    spaced,
    time_bucket,
    zero_fill,
)


def column(spark, values, dtype):
    return spark.createDataFrame([(v,) for v in values], f"v {dtype}")


def got(df, expression):
    return [r[0] for r in df.select(expression).collect()]


def test_short_number(spark):
    df = column(spark, [999.4, 999.5, 1000.0, 1234567.0, 1250.0, 1350.0, 1450.0, 0.5], "double")
    # 1250 is an exact half and goes up; 1350 and 1450 follow their binary value
    assert got(df, short_number(F.col("v"))) == ["999", "1000", "1.0K", "1.2M", "1.3K", "1.4K", "1.4K", "1"]


def test_fixed_one_half_up(spark):
    df = column(spark, [0.25, 0.75, 0.05, 2.0], "double")
    assert got(df, fixed_one(F.col("v"))) == ["0.3", "0.8", "0.1", "2.0"]


def test_percent(spark):
    df = column(spark, [0.9876, 0.0, None], "double")
    assert got(df, percent(F.col("v"))) == ["98.8%", "0.0%", "—"]


def test_bucket_truncates_toward_zero(spark):
    df = column(spark, [-1.7, -0.5, 0.9, 3.0], "double")
    assert got(df, time_bucket(F.col("v"))) == [-1, 0, 0, 3]


def test_guard(spark):
    df = column(spark, [0.0, 0.0005, 2.0], "double")
    assert got(df, guard_duration(F.col("v"))) == [0.001, 0.001, 2.0]


def test_zero_fill(spark):
    df = spark.createDataFrame([(None, float("nan"), None, None)], "a int, b double, c string, d boolean")
    assert tuple(zero_fill(df).first()) == (0, 0.0, None, None)
    assert tuple(zero_fill(df, ["a"]).first())[0] == 0


def test_rate_value_skips_zero_and_missing(spark):
    df = spark.createDataFrame([(0.0, 5.0), (3.0, 5.0), (None, None)], "flow_bytes_s double, avgBytesPerSec double")
    assert got(df, rate_value(df, "flow_bytes_s", "avgBytesPerSec", "absent")) == [5.0, 3.0, 0.0]


def test_instants(spark):
    texts = column(spark, ["1704067200123", "2024-01-01T00:00:00.123Z", "never", None], "string")
    assert got(texts, instant_ms(F.col("v"), T.StringType())) == [1704067200123, 1704067200123, None, None]
    stamps = column(spark, [dt.datetime(2024, 1, 1)], "timestamp")
    assert got(stamps.select(F.lit("2024-01-01T00:00:00Z").cast("timestamp").alias("v")), instant_ms(F.col("v"), T.TimestampType())) == [1704067200000]


def test_spaced(spark):
    assert got(column(spark, ["Flow_Bytes_s"], "string"), spaced(F.col("v"))) == ["Flow Bytes s"]
