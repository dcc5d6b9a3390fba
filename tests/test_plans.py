"""Plan guards: the properties that must hold at scale, checked on every query."""

from __future__ import annotations

import pytest

from tests.conftest import SF_SMALL
from tripyard.plans.layers import TripLakehouse
from tripyard.registry import _BUILDERS, QUERIES

FORBIDDEN = (
    "CartesianProduct",
    "BroadcastNestedLoopJoin",
    "BatchEvalPython",
    "ArrowEvalPython",
    "FlatMapGroupsInPandas",
    "MapInPandas",
)


def executed_plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()  # final AQE plan
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def bare(spark):
    """Nothing is materialised, so a query's plan holds all layers beneath it."""
    return TripLakehouse(spark, SF_SMALL, materialize="none")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join_and_no_python_in_plan(spark, bare, name):
    house = TripLakehouse(spark, SF_SMALL) if "ingest" in name else bare
    plan = executed_plan(_BUILDERS[name](house))
    for op in FORBIDDEN:
        assert op not in plan, f"{name}: {op} in plan"


def test_gold_scan_reads_only_needed_columns(spark):
    from tripyard.plans.marts import daily_trip_summary
    from tripyard.registry import lakehouse

    df = daily_trip_summary(lakehouse(spark, SF_SMALL).silver())
    plan = df._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line or "ReadSchema" in line]
    text = "\n".join(scans)
    assert "vendor_name" not in text and "pickup_zone" not in text
    assert "total_amount" in text


def test_silver_joins_are_broadcast_and_aggregates_partial(spark):
    from tripyard.registry import lakehouse

    house = lakehouse(spark, SF_SMALL)
    silver_plan = executed_plan(house.build_silver())
    assert silver_plan.count("BroadcastHashJoin") == 2
    assert "LeftOuter" in silver_plan
    from tripyard.plans.marts import zone_performance

    gold_plan = zone_performance(house.silver())._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in gold_plan  # map-side combine before the shuffle


def test_top_k_uses_take_ordered(spark):
    df = QUERIES["top_pickup_zones"](spark, SF_SMALL)
    assert "TakeOrderedAndProject" in df._jdf.queryExecution().executedPlan().toString()


def test_dedup_moves_keys_only(spark, bare):
    plan = executed_plan(_BUILDERS["stream_dedup"](bare))
    assert "to_json" not in plan and "value" not in plan.split("ReadSchema")[1].split("\n")[0]


def test_no_scan_is_shuffled_for_its_size(spark, bare):
    assert "Exchange" not in executed_plan(bare.staging_april())
