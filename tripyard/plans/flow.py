"""End-to-end layer build with data-quality gates between the layers.

staging -> G1 -> batch clean, stream clean, zones -> G5 -> silver trips -> G2
-> gold views -> G3.  Each gate fails the run (``GateFailed``) the way the
original scheduler's check tasks stop a run.  Only the data steps and their
gates are here; scheduling belongs to whatever orchestrator runs this.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from tripyard.plans import quality
from tripyard.plans.layers import TripLakehouse

GOLD_VIEWS = {
    "vw_daily_trip_summary": "daily_summary",
    "vw_payment_summary": "payment_summary",
    "vw_zone_performance": "zone_performance",
}


LAYER_VIEWS = {
    "stream_events_valid": "stream_staging",
    "stream_events_rejected": "rejected_staging",
    "trips_batch_clean": "batch_clean",
    "trips_stream_clean": "stream_clean",
    "zone_lookup": "zone_dim",
    "trips_silver": "silver",
}


def register_views(house: TripLakehouse) -> None:
    """Expose every layer and the gold summaries as temporary views, so
    analysts' SQL statements run via ``spark.sql`` after a FROM-clause rename."""
    for view, method in {**LAYER_VIEWS, **GOLD_VIEWS}.items():
        getattr(house, method)().createOrReplaceTempView(view)


def build_all(spark: SparkSession, sf_dir: str, house: TripLakehouse | None = None) -> dict:
    """Build every layer and run every gate; returns the gate results."""
    house = house or TripLakehouse(spark, sf_dir)
    results = {}
    results["staging_ready"] = quality.run_gate(
        quality.staging_ready(
            spark, house.staging_april(), house.staging_may(), house.staging_zone(), house.stream_staging()
        ),
        "staging_ready",
    )
    # a doubled zone key would double trips: it stops the run before the joins
    results["zone_key_unique"] = quality.run_gate(
        quality.zone_key_unique(house.zone_dim()).select("key_unique"), "zone_key_unique"
    )
    results["silver"] = quality.run_gate(house.silver_written().gate(), "silver")
    register_views(house)
    results["gold"] = quality.run_gate(
        quality.gold_reconciliation(
            spark, house.silver(), house.daily_summary(), house.payment_summary(), house.zone_performance()
        ),
        "gold",
    )
    return results
