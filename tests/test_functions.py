"""Column helpers: decimal-exact rounding, NULL-safe ratios, dates."""

import datetime as dt

from pyspark.sql import functions as F

from carelake.functions.dates import days_between, epoch_seconds, length_of_stay, month_start
from carelake.functions.numeric import pct, round_half, safe_div


def test_round_half_away_from_zero_on_binary_ties(spark):
    df = spark.createDataFrame([(2.345,), (1.005,), (-2.345,), (0.125,), (2.5,), (None,)], "x double")
    got = [r[0] for r in df.select(round_half(F.col("x"), 2).alias("r")).collect()]
    assert got == [2.35, 1.01, -2.35, 0.13, 2.5, None]
    assert [r[0] for r in df.select(round_half(F.col("x"), 0)).collect()] == [2.0, 1.0, -2.0, 0.0, 3.0, None]


def test_ratios_are_null_for_zero_or_null_denominators(spark):
    df = spark.createDataFrame([(1, 3), (2, 0), (5, None)], "a long, b long")
    assert [r[0] for r in df.select(safe_div(F.col("a"), F.col("b"))).collect()] == [1 / 3, None, None]
    assert [r[0] for r in df.select(pct(F.col("a"), F.col("b"))).collect()] == [33.33, None, None]


def test_date_helpers(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 8, 20, 14, 0), dt.date(2024, 8, 25), None)],
                               "t timestamp_ntz, d date, open date")
    r = df.select(month_start(F.col("t")).alias("m"), month_start(F.col("d")).alias("md"),
                  days_between(F.col("d"), F.to_date("t")).alias("days"),
                  length_of_stay(F.col("open"), F.col("t"), "2024-10-01").alias("los"),
                  epoch_seconds(F.col("t")).alias("e")).first()
    assert r.m == dt.datetime(2024, 8, 1) and r.md == dt.datetime(2024, 8, 1)
    assert (r.days, r.los) == (5, 42)
    assert r.e == (dt.datetime(2024, 8, 20, 14, 0) - dt.datetime(1970, 1, 1)).total_seconds()
