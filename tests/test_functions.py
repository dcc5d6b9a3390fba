"""Column helpers: casts, trimming, decoders, calendar attributes, exact money."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripyard.functions import (
    day_name,
    decode,
    is_weekend,
    minutes_between,
    round2_mean,
    safe_cast,
    seconds_between,
    share_pct,
    text_to_utc_ntz,
    time_period,
    trim_ws,
)
from tripyard.schemas import PAYMENT_TYPE_NAMES, RATE_CODE_NAMES, VENDOR_NAMES


def one(spark, col, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(col).collect()]


@pytest.mark.parametrize(
    "hour,label",
    [
        (0, "late night"),
        (5, "late night"),
        (6, "morning"),
        (7, "morning rush"),
        (9, "morning rush"),
        (10, "morning"),
        (11, "afternoon"),
        (15, "afternoon"),
        (16, "evening rush"),
        (19, "evening rush"),
        (20, "night"),
        (23, "night"),
        (None, "Unknown"),
    ],
)
def test_time_period_branch_order(spark, hour, label):
    assert one(spark, time_period(F.col("h")), [(hour,)], "h int") == [label]


def test_decoders_null_and_other_codes(spark):
    rows = [(1,), (2,), (6,), (9,), (None,)]
    got = one(spark, decode(F.col("c"), VENDOR_NAMES), rows, "c bigint")
    assert got == [
        "Creative Mobile Technologies, LLC",
        "VeriFone Inc.",
        "Myle Technologies Inc",
        "Unknown",
        "Unknown",
    ]
    assert one(spark, decode(F.col("c"), PAYMENT_TYPE_NAMES), [(0,), (5,), (None,)], "c bigint") == [
        "flex fare frip",
        "unknown",
        "Unknown",
    ]
    assert one(spark, decode(F.col("c"), RATE_CODE_NAMES), [(99,), (None,)], "c bigint") == [
        "Null/unknown",
        "Unknown",
    ]


def test_safe_cast_rounds_half_away_from_zero(spark):
    got = one(spark, safe_cast(F.col("x"), T.DoubleType(), "bigint"), [(2.5,), (-2.5,), (1.4,), (None,)], "x double")
    assert got == [3, -3, 1, None]
    got = one(spark, safe_cast(F.col("s"), T.StringType(), "bigint"), [("7",), ("N/A",), ("1.5",)], "s string")
    assert got == [7, None, None]


def test_text_timestamps_are_utc_wall_clock(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = one(
            spark,
            text_to_utc_ntz(F.col("s")),
            [("2026-06-01 10:00:00 UTC",), ("2026-06-01 10:00:00",), ("2026-06-01 12:00:00+02:00",), ("x",)],
            "s string",
        )
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got[:3] == [datetime(2026, 6, 1, 10, 0)] * 3
    assert got[3] is None


def test_trim_all_whitespace(spark):
    got = one(spark, trim_ws(F.col("s")), [("\t Bronx  ",), (" Queens ",)], "s string")
    assert got == ["Bronx", "Queens"]


def test_duration_units(spark):
    df = spark.createDataFrame(
        [(datetime(2026, 4, 1, 0, 0, 0), datetime(2026, 4, 1, 0, 5, 59))], "a timestamp_ntz, b timestamp_ntz"
    )
    row = df.select(
        minutes_between(F.col("a"), F.col("b")).alias("m"), seconds_between(F.col("a"), F.col("b")).alias("s")
    ).first()
    assert (row.m, row.s) == (5, 359)


def test_weekend_and_day_names(spark):
    rows = [(datetime(2026, 6, 6, 12),), (datetime(2026, 6, 7, 12),), (datetime(2026, 6, 8, 12),)]
    df = spark.createDataFrame(rows, "t timestamp_ntz")
    got = [(r.d, r.w) for r in df.select(day_name(F.col("t")).alias("d"), is_weekend(F.col("t")).alias("w")).collect()]
    assert got == [("Saturday", True), ("Sunday", True), ("Monday", False)]


def test_round2_mean_is_exact_half_away(spark):
    # mean 1.005 exactly: doubles would give 1.0 or 1.01 depending on the engine
    df = spark.createDataFrame([(1.00,), (1.01,)], "x double")
    assert df.agg(round2_mean("x")).first()[0] == 1.01
    df = spark.createDataFrame([(-1.00,), (-1.01,)], "x double")
    assert df.agg(round2_mean("x")).first()[0] == -1.01
    df = spark.createDataFrame([(None,)], "x double")
    assert df.agg(round2_mean("x")).first()[0] is None


def test_share_pct(spark):
    df = spark.createDataFrame([(1, 8), (1, 3), (2, 3)], "a bigint, b bigint")
    assert [r[0] for r in df.select(share_pct(F.col("a"), F.col("b"))).collect()] == [12.5, 33.33, 66.67]


def test_trip_total_and_every_nth(spark):
    from tripyard.operators.payload import every_nth, trip_total

    df = spark.createDataFrame([(10.1, 0.2, 0.5, 1.11, 6.55, 1.0, 2.75, 0.75, 5)],
                               "fare_amount double, extra double, mta_tax double, tip_amount double, "
                               "tolls_amount double, improvement_surcharge double, congestion_surcharge double, "
                               "cbd_congestion_fee double, n bigint")
    row = df.select(
        trip_total().alias("t"),
        every_nth(F.col("n"), 5, 0, F.lit(-3.0), F.lit(1.0)).alias("a"),
        every_nth(F.col("n"), 0, 0, F.lit(-3.0), F.lit(1.0)).alias("b"),
    ).first()
    assert row.t == 22.96  # exact two-decimal sum, not 22.959999...
    assert (row.a, row.b) == (-3.0, 1.0)


def test_cluster_conf_scales_shuffle_partitions():
    from tripyard.session import cluster_conf

    big = cluster_conf(100 * 1024**4, executor_cores=8, executors=1000)
    small = cluster_conf(10 * 1024**3, executor_cores=8, executors=10)
    assert int(big["spark.sql.shuffle.partitions"]) == 100 * 1024
    assert int(small["spark.sql.shuffle.partitions"]) == 160


@pytest.mark.parametrize(
    "values,mean,total,total2",
    [
        ([0.004, 0.004, 0.007], 0.01, 0.015, 0.02),
        ([9.1e18, 1.0], 4.55e18, 9.1e18, 9.1e18),
        ([float("inf"), 2.0], float("inf"), float("inf"), float("inf")),
        ([-0.125, -0.125, None], -0.13, -0.25, -0.25),
        ([1e-12, 0.1], 0.05, 0.1, 0.1),  # amounts count to the millionth
        ([None], None, None, None),
    ],
)
def test_money_is_rounded_at_the_end_only(spark, values, mean, total, total2):
    from tripyard.functions import money_sum, round2_ratio, round2_sum

    df = spark.createDataFrame([(v, 1) for v in values], "x double, n bigint")
    row = df.agg(
        round2_mean("x").alias("m"), money_sum("x").alias("s"), round2_sum("x").alias("r"),
        round2_ratio("x", "n").alias("q"),
    ).first()
    assert (row.m, row.s, row.r) == (mean, total, total2)
    assert None in values or row.q == mean


def test_integers_of_the_whole_bigint_range(spark):
    rows = [(9.1e18,), (-9.2e18,), (2.0**63,), (-(2.0**63),), (1e300,), (float("nan"),), (2.5,), (-2.5,)]
    got = one(spark, safe_cast(F.col("x"), T.DoubleType(), "bigint"), rows, "x double")
    assert got == [int(9.1e18), int(-9.2e18), None, -(2**63), None, None, 3, -3]


def test_trim_takes_all_white_space(spark):
    text = "\t\x0b\x85\xa0\u2003\u3000 a b \u2028\u205f\n"
    assert one(spark, trim_ws(F.col("x")), [(text,)], "x string") == ["a b"]
