"""Hot keys: a third of all rows on one key must not become one task."""

from __future__ import annotations

import os
from contextlib import contextmanager

from pyspark.sql import functions as F

from tripyard.operators.zones import attach_zones
from tripyard.sources.sinks import write_table


@contextmanager
def confs(spark, **kv):
    old = {k: spark.conf.get(k, None) for k in kv}
    for k, v in kv.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _trips(spark, n=30_000):
    # location 7 holds a third of all trips
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 50).alias("pickup_location_id"),
        (F.col("id") % 50).alias("dropoff_location_id"),
        F.col("id"),
    )


def test_hot_location_is_split_when_not_broadcast(spark):
    zones = spark.range(50).select(
        F.col("id").alias("location_id"),
        F.lit("B").alias("borough"),
        F.concat(F.lit("Z"), F.col("id").cast("string")).alias("zone_name"),
        F.lit("S").alias("service_zone"),
    )
    trips = _trips(spark)
    expected = attach_zones(trips, zones).groupBy("pickup_zone").count()
    with confs(
        spark,
        **{
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.shuffle.partitions": "16",
        },
    ):
        out = attach_zones(trips, zones)  # above the session's threshold: shuffle join
        got = out.groupBy("pickup_zone").count()
        out.collect()  # runs this DataFrame's own adaptive plan to its final form
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in plan
        assert "SortMergeJoin(skew=true)" in plan and "AQEShuffleRead skewed" in plan
        assert sorted(got.collect()) == sorted(expected.collect())


def test_hot_day_is_written_by_several_tasks(spark, scratch):
    df = spark.range(60_000).select(
        F.when(F.col("id") % 3 != 0, F.lit("2026-06-01")).otherwise(
            F.date_format(F.date_add(F.lit("2026-06-01").cast("date"), (F.col("id") % 20).cast("int")), "yyyy-MM-dd")
        ).alias("day"),
        F.col("id"),
        (F.col("id") * 7919 % 1000).alias("loc"),
    )
    with confs(spark, **{"spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k"}):
        write_table(df, f"{scratch}/t", partition_by="day", cluster_by=("loc",))
    files = [f for f in os.listdir(f"{scratch}/t/day=2026-06-01") if f.endswith(".parquet")]
    assert len(files) > 1
    assert spark.read.parquet(f"{scratch}/t").count() == 60_000
