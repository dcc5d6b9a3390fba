"""Layer plans: zone joins, partitioned sinks, gates, analytics ordering."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tripyard.operators.zones import attach_zones, build_zone_dim
from tripyard.plans import quality
from tripyard.plans.layers import TripLakehouse
from tripyard.sources.sinks import write_table
from tests.conftest import SF_SMALL
from tests.test_skew import confs


@pytest.fixture(scope="module")
def house(spark):
    return TripLakehouse(spark, SF_SMALL, materialize="table")


def test_zone_dim_trims_and_keeps_distinct_spellings(spark):
    rows = [(1, " Bronx\t", "Zone A ", "Boro Zone"), (1, "Bronx", "Zone A", "Boro Zone"),
            (2, "Queens", "Zone B", "Boro Zone"), (2, "Queens", "Zone b", "Boro Zone"), (None, "x", "y", "z")]
    lookup = spark.createDataFrame(rows, "LocationID bigint, Borough string, Zone string, service_zone string")
    dim = build_zone_dim(lookup)
    assert dim.count() == 3  # id 1 collapses after TRIM, id 2 keeps two spellings, NULL id dropped
    report = quality.zone_key_unique(dim).first()
    assert report.duplicate_keys == 1 and report.key_unique is False


@pytest.mark.parametrize("threshold", ["10m", "-1"])
def test_zone_join_same_rows_with_or_without_broadcast(spark, threshold):
    dim = spark.createDataFrame([(1, "B", "Z1", "S"), (2, "B", "Z2", "S")],
                                "location_id bigint, borough string, zone_name string, service_zone string")
    trips = spark.createDataFrame([(1, 2), (2, 9), (9, 9)], "pickup_location_id bigint, dropoff_location_id bigint")
    with confs(spark, **{"spark.sql.autoBroadcastJoinThreshold": threshold}):
        out = attach_zones(trips, dim)
        got = sorted((r.pickup_location_id, r.pickup_zone, r.dropoff_zone) for r in out.collect())
        plan = out._jdf.queryExecution().executedPlan().toString()
    assert ("BroadcastHashJoin" in plan) == (threshold != "-1")
    assert got == [(1, "Z1", "Z2"), (2, "Z2", None), (9, None, None)]


def test_silver_is_written_partitioned_and_pruned(spark, house):
    silver = house.silver()
    assert house.silver_path is not None
    pruned = house.silver_between("2026-06-01", "2026-06-08")
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "pickup_date" in plan
    n = pruned.count()
    assert 0 < n < silver.count()
    assert pruned.agg(F.min("pickup_date")).first()[0] >= datetime(2026, 6, 1).date()


def test_clean_window_prunes_days(house):
    week = (datetime(2026, 6, 1), datetime(2026, 6, 8))
    pruned = house.clean_between(week)
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [isnotnull(_pickup_day") == 2
    whole = house.clean_union().where((F.col("pickup_datetime") >= F.lit(week[0])) & (F.col("pickup_datetime") < F.lit(week[1])))
    assert pruned.count() == whole.count() > 0


def test_gates(spark, house):
    assert quality.run_gate(quality.silver_gate(spark, house.silver()), "silver")
    rec = quality.run_gate(
        quality.gold_reconciliation(
            spark, house.silver(), house.daily_summary(), house.payment_summary(), house.zone_performance()
        ),
        "gold",
    )
    assert rec["reconciled"] is True and rec["silver_rows"] == 6253
    ready = quality.staging_ready(spark, house.staging_april(), house.staging_may(), house.staging_zone(),
                                  house.stream_staging())
    assert quality.run_gate(ready, "staging")
    with pytest.raises(quality.GateFailed):
        quality.run_gate(spark.range(1).select(F.lit(0).alias("violations_ok")), "falsy")
    with pytest.raises(quality.GateFailed):
        quality.run_gate(spark.range(0).select(F.lit(True).alias("x")), "empty")


def test_sanity_numbers_sf0001(house):
    silver = house.silver()
    by_source = {r.source_type: r["count"] for r in silver.groupBy("source_type").count().collect()}
    assert by_source == {"batch": 5633, "stream": 620}
    assert house.daily_summary().count() == 6138
    assert house.payment_summary().count() == 2031
    assert house.zone_performance().count() == 486
    assert house.zone_dim().count() == 24


def test_write_table_layout(spark, scratch):
    df = spark.range(100).select(
        (F.col("id") % 3).alias("p"), F.col("id"), (F.col("id") % 7).alias("c")
    )
    write_table(df, f"{scratch}/t", partition_by="p", cluster_by=("c",))
    back = spark.read.parquet(f"{scratch}/t")
    assert back.count() == 100 and set(back.columns) == {"p", "id", "c"}


def test_build_all_runs_every_gate_and_registers_views(spark, house):
    from tripyard.plans.flow import build_all

    results = build_all(spark, SF_SMALL, house)
    assert results["gold"]["reconciled"] is True
    assert results["zone_key_unique"]["key_unique"] is True


def test_doubled_zone_key_stops_the_build_before_silver(spark):
    from tripyard.plans.flow import build_all

    class Doubled(TripLakehouse):
        def staging_zone(self):
            rows = super().staging_zone()
            return rows.unionAll(rows.withColumn("Zone", F.lit("another name")))

    house = Doubled(spark, SF_SMALL, materialize="persist")
    with pytest.raises(quality.GateFailed, match="zone_key_unique"):
        build_all(spark, SF_SMALL, house)
    assert "_silver" not in house.__dict__
    house.release()


def test_check_reports_are_sorted(house):
    for trips in (house.silver(), house.batch_clean()):
        rows = [tuple(r)[:3] for r in quality.monthly_volume(trips).collect()]
        assert rows == sorted(rows) and len(rows) > 1
    sources = [r.source_type for r in quality.duration_profile(house.silver()).collect()]
    assert sources == sorted(sources) == ["batch", "stream"]


def test_views_answer(spark, house):
    from tripyard.plans.flow import register_views

    register_views(house)
    n = spark.sql("SELECT SUM(total_trips) FROM vw_zone_performance").first()[0]
    assert n == 6253


def test_analyst_sql_runs_on_registered_views(spark, house):
    from tripyard.plans import analytics
    from tripyard.plans.flow import register_views

    register_views(house)
    busiest = spark.sql("SELECT source_type, SUM(total_trips) trips FROM vw_zone_performance GROUP BY ALL").collect()
    ours = {r.source_type: r.total_perjalanan for r in analytics.batch_vs_stream(house.daily_summary()).collect()}
    assert {r.source_type: float(r.trips) for r in busiest} == ours
    assert spark.sql("SELECT COUNT(*) FROM trips_batch_clean").first()[0] == house.batch_clean().count()
    assert spark.sql("SELECT COUNT(*) FROM stream_events_rejected").first()[0] == 340


def test_reports_of_the_writing_pass_equal_those_of_a_scan(spark, house):
    written = house.silver_written()
    assert written.measured is not None
    pairs = [
        (written.volume(), quality.monthly_volume(house.silver(), "total_trips")),
        (written.durations(), quality.duration_profile(house.silver())),
        (written.gate(), quality.silver_gate(spark, house.silver())),
    ]
    for ours, scanned in pairs:
        assert ours.collect() == scanned.collect() and ours.columns == scanned.columns
        assert "Scan parquet" not in ours._jdf.queryExecution().executedPlan().toString()


def test_measures_that_disagree_with_the_files_do_not_count(house):
    measured = dict(house.written["trips"])
    measured["rows"] += 1  # as after a stage that ran twice
    reports = quality.SilverReports(house.silver(), measured, (datetime(2026, 4, 1), datetime(2026, 8, 1)))
    assert reports.measured is None
    assert reports.volume().collect() == quality.monthly_volume(house.silver(), "total_trips").collect()


def test_months_of_a_window():
    assert quality.months_of((datetime(2026, 11, 1), datetime(2027, 2, 1))) == [(2026, 11), (2026, 12), (2027, 1)]
    assert quality.months_of((datetime(2026, 4, 1), datetime(2026, 5, 2))) == [(2026, 4), (2026, 5)]


def test_changed_input_is_read_again(spark, scratch):
    from tripyard.registry import INPUTS, QUERIES

    for t in INPUTS:
        spark.read.parquet(f"{SF_SMALL}/{t}.parquet").write.parquet(f"{scratch}/in/{t}.parquet")
    before = QUERIES["batch_clean"](spark, f"{scratch}/in").count()
    spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").write.mode("append").parquet(f"{scratch}/in/lineitem.parquet")
    assert QUERIES["batch_clean"](spark, f"{scratch}/in").count() == 2 * before
