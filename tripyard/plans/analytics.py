"""Ranked business queries over the gold summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripyard.functions.money import round2_mean, round2_ratio, round2_sum, share_pct

TOP_ZONES = 5


def top_pickup_zones(zone_perf: DataFrame, k: int = TOP_ZONES) -> DataFrame:
    """A4: busiest pickup zones per source, top ``k`` by trips.

    Ties on the trip count are broken by zone and source so the top-k is
    deterministic; the plan is a TakeOrderedAndProject (per-task heaps), no
    global sort.
    """
    return (
        zone_perf.groupBy("pickup_zone", "source_type")
        .agg(
            F.sum("total_trips").alias("total_perjalanan"),
            round2_sum("total_revenue").alias("total_revenue"),
            round2_ratio("total_revenue", "total_trips").alias("revenue_per_trip"),
        )
        .select("pickup_zone", "total_perjalanan", "total_revenue", "revenue_per_trip", "source_type")
        .orderBy(F.desc("total_perjalanan"), F.asc("pickup_zone"), F.asc("source_type"))
        .limit(k)
    )


def busiest_period(daily: DataFrame) -> DataFrame:
    """A5: per time period: trips, average of the daily averages, revenue."""
    return (
        daily.groupBy("time_period")
        .agg(
            F.sum("total_trips").cast("double").alias("total_perjalanan"),
            round2_mean("average_duration_minutes").alias("average_trip_duration"),
            round2_mean("average_trip_distance").alias("average_trip_distance"),
            round2_sum("total_revenue").alias("total_revenue"),
        )
        .orderBy(F.desc("total_perjalanan"), F.asc("time_period"))
    )


def payment_usage_rank(payment: DataFrame) -> DataFrame:
    """A6 + W1 + W2: payment methods ranked by trips, with share of all trips.

    The windows run after the aggregation, over one row per payment-type
    name; the decoder yields at most eight names, so the un-partitioned
    window holds at most eight rows whatever the data size.
    """
    per_type = payment.groupBy("payment_type_name").agg(
        F.sum("total_trips").alias("_trips"),
        round2_sum("total_revenue").alias("total_revenue"),
        round2_sum("total_tip").alias("total_tip"),
    )
    ranked = Window.orderBy(F.desc("_trips"))
    everything = Window.partitionBy()
    return (
        per_type.select(
            "payment_type_name",
            F.col("_trips").cast("double").alias("total_perjalanan"),
            F.rank().over(ranked).cast("bigint").alias("payment_rank"),
            share_pct(F.col("_trips"), F.sum("_trips").over(everything)).alias("usage_percentage"),
            "total_revenue",
            "total_tip",
        )
        .orderBy("payment_rank", "payment_type_name")
    )


def batch_vs_stream(daily: DataFrame) -> DataFrame:
    """Batch vs stream totals and averages of the daily averages."""
    return (
        daily.groupBy("source_type")
        .agg(
            F.sum("total_trips").cast("double").alias("total_perjalanan"),
            round2_sum("total_revenue").alias("total_revenue"),
            round2_ratio("total_revenue", "total_trips").alias("average_revenue_per_trip"),
            round2_mean("average_fare").alias("average_fare"),
            round2_mean("average_tip").alias("average_tip"),
            round2_mean("average_trip_distance").alias("average_trip_distance"),
        )
        .orderBy(F.desc("total_perjalanan"), F.asc("source_type"))
    )
