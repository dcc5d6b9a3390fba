"""Registered queries: one callable per operator of the inventory.

Each callable takes ``(spark, sf_dir)`` and returns a lazy DataFrame.  The
layers of one input folder are built once per session (see
:class:`tripyard.plans.layers.TripLakehouse`), so each shared layer (stream
staging, clean tables, zones, silver, summaries) is materialised once and
read by every query and gate that needs it.  Columns stamped with the
load time are dropped: they are never comparable.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripyard.functions.timeattrs import seconds_between
from tripyard.operators.events import dedup_key, dedup_messages, message_key
from tripyard.operators.normalize import DURATION_GATE_SECONDS, normalize_raw_trips, union_all, union_months
from tripyard.operators.payload import trip_total
from tripyard.operators.zones import join_zone_role
from tripyard.plans import analytics, flow, quality
from tripyard.plans.layers import REPLAY_ROWS_PER_FILE, TripLakehouse
from tripyard.plans.marts import GOLD_VIEWS
from tripyard.schemas import LOAD_TIME_COLUMNS
from tripyard.session import ensure_checkpoint_dir
from tripyard.sources import files
from tripyard.sources.carriers import trip_event_fields
from tripyard.sources.sinks import layer_path, load_month, read_months
from tripyard.sources.store import TableStore
from tripyard.sources.tables import read_monthly_trips
from tripyard.streaming.ingest import replay
from tripyard.streaming.tables import BATCH, REJECTED, VALID, Declared, StreamTables

Query = Callable[[SparkSession, str], DataFrame]

#: Tables that the layers are derived from.
INPUTS = ("lineitem", "nation", "region", "events")
_HOUSES: dict[tuple[str, str], tuple[TripLakehouse, list]] = {}


def lakehouse(spark: SparkSession, sf_dir: str) -> TripLakehouse:
    """The session's layers for ``sf_dir``: built once, and anew when the input's files have changed."""
    folder = sf_dir.rstrip("/")
    key = (spark.sparkContext.applicationId, folder)
    stamps = [files.stamps(spark, f"{folder}/{t}.parquet") for t in INPUTS]
    house, seen = _HOUSES.get(key, (None, None))
    if house is None or house.spark is not spark or seen != stamps:
        if house is not None and house.spark is spark:
            house.release()
        house = TripLakehouse(spark, folder, name=f"trips_{zlib.crc32(folder.encode()):08x}")
        _HOUSES[key] = house, stamps
    return house


def _no_load_time(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in LOAD_TIME_COLUMNS if c in df.columns])


def _batch_union(h: TripLakehouse) -> DataFrame:
    return union_all(h.staging_april(), h.staging_may())


def _stream_dedup(h: TripLakehouse) -> DataFrame:
    keys = h.envelopes().select(dedup_key().alias("event_key"), "message_id", "publish_time", message_key().alias("_key"))
    return dedup_messages(keys, F.col("_key")).drop("_key")


def _duration_gate(h: TripLakehouse) -> DataFrame:
    lo, hi = DURATION_GATE_SECONDS
    d = seconds_between(F.col("pickup_datetime"), F.col("dropoff_datetime"))
    return (
        h.clean_union()
        .select("source_type", d.alias("d"))
        .groupBy("source_type")
        .agg(
            F.count(F.lit(1)).alias("candidate_rows"),
            F.count_if(F.col("d").between(lo, hi)).alias("passing_rows"),
            F.count_if(F.col("d") < lo).alias("too_short_rows"),
            F.count_if(F.col("d") > hi).alias("too_long_rows"),
        )
    )


def _zone_join(h: TripLakehouse, role: str) -> DataFrame:
    trips = h.gated_trips().select(f"{role}_location_id")
    joined = join_zone_role(trips, h.zone_dim(), role)
    return joined.groupBy(*joined.columns).agg(F.count(F.lit(1)).alias("trips"))


def _decode_labels(h: TripLakehouse) -> DataFrame:
    cols = (
        "vendor_id",
        "vendor_name",
        "store_and_fwd_flag",
        "store_and_fwd_name",
        "rate_code_id",
        "rate_code_name",
        "payment_type",
        "payment_type_name",
        "trip_type",
        "trip_name",
    )
    return h.silver().groupBy(*cols).agg(F.count(F.lit(1)).alias("trips"))


def _time_attributes(h: TripLakehouse) -> DataFrame:
    cols = ("pickup_date", "pickup_day_name", "is_weekend", "pickup_hour", "time_period")
    return h.silver().groupBy(*cols).agg(F.count(F.lit(1)).alias("trips"))


def _fare_totals(h: TripLakehouse) -> DataFrame:
    """T12 over every event's fields."""
    return trip_event_fields(h.table("events")).select("event_id", trip_total().alias("total"))


def _stored(h: TripLakehouse) -> TripLakehouse:
    """The same layers as named tables, also in a session without a shared folder (a plain local one)."""
    ensure_checkpoint_dir(h.spark)
    if h.materialize == "table":
        return h
    if "_stored" not in h.__dict__:
        h.__dict__["_stored"] = TripLakehouse(h.spark, h.sf_dir, "table", h.name)
    return h.__dict__["_stored"]


def _view(view: str) -> Callable[[TripLakehouse], DataFrame]:
    """A gold view, stored over the silver table, by its name."""
    return lambda h: _stored(h).gold_view(view)


def _silver_by_name(h: TripLakehouse) -> DataFrame:
    """The silver table as any session opens it: by the store's folder and its names."""
    stored = _stored(h)
    stored.silver()
    other = TableStore(h.spark, f"{ensure_checkpoint_dir(h.spark)}/tripyard", h.name)
    return other.open("silver", "trips")


def _namespace_tables(h: TripLakehouse) -> DataFrame:
    """Everything that the three namespaces hold, read by name."""
    stored = _stored(h)
    for build in (stored.validated, stored.silver, stored.daily_summary, stored.payment_summary, stored.zone_performance):
        build()
    for view in GOLD_VIEWS:
        stored.gold_view(view)
    listing = stored.store.listing()
    return listing.where(~F.col("table_name").isin("stream_events_valid", "stream_events_rejected"))


def _run_folder(h: TripLakehouse, name: str) -> str:
    return layer_path(ensure_checkpoint_dir(h.spark), h.run_id, name)


def _months_differ(h: TripLakehouse) -> DataFrame:
    """April's file lacks a column, May's has whole miles."""
    april, may = h.months()
    base = _run_folder(h, "months")
    april.drop("cbd_congestion_fee").write.mode("overwrite").parquet(f"{base}/april")
    may.withColumn("trip_distance", F.col("trip_distance").cast("int")).write.mode("overwrite").parquet(f"{base}/may")
    return union_months(*[read_monthly_trips(h.spark, f"{base}/{m}") for m in ("april", "may")])


def _month_reloaded(h: TripLakehouse) -> DataFrame:
    """S3: both months loaded, then the first one again."""
    path, months = _run_folder(h, "reloaded"), [normalize_raw_trips(m) for m in h.months()]
    for i in (0, 1, 0):
        load_month(months[i], path, f"2026_0{4 + i}")
    return read_months(h.spark, path, months[0].schema)


def _compacted(h: TripLakehouse):
    """The stream tables after compaction."""
    tables = h.stream_tables()
    tables.compact()
    return tables


def _bounded_dedup(h: TripLakehouse) -> DataFrame:
    """The ingest with a horizon, in three micro-batches of files of a fixed size."""
    base = _run_folder(h, "bounded")
    tables = StreamTables(h.spark, f"{base}/tables")
    return replay(h.spark, h.envelopes(), base, tables, REPLAY_ROWS_PER_FILE, batches=3, dedup_horizon="2 hours").valid()


def _declared(h: TripLakehouse, table: Declared) -> DataFrame:
    """A declared stream table by its name in the catalog."""
    return h.stream_tables().table(table).drop(BATCH)


def _gates(h: TripLakehouse) -> DataFrame:
    """The whole build with every gate run."""
    passed = flow.build_all(h.spark, h.sf_dir, h)
    return h.spark.createDataFrame([(name, all(row.values())) for name, row in passed.items()], "gate string, passed boolean")


def _load_stamps(h: TripLakehouse) -> DataFrame:
    """Every silver row has the time of its load."""
    stamped = F.count_if(F.col("silver_loaded_at") <= F.current_timestamp())
    return h.silver().groupBy("source_type").agg(F.count(F.lit(1)).alias("trips"), stamped.alias("stamped"))


def _staging_ready(h: TripLakehouse) -> DataFrame:
    return quality.staging_ready(
        h.spark, h.staging_april(), h.staging_may(), h.staging_zone(), h.stream_staging()
    )


def _reconcile(h: TripLakehouse) -> DataFrame:
    return quality.gold_reconciliation(
        h.spark, h.silver(), h.daily_summary(), h.payment_summary(), h.zone_performance()
    )


_BUILDERS: dict[str, Callable[[TripLakehouse], DataFrame]] = {
    # staging / batch clean
    "batch_union": _batch_union,
    "batch_normalize": lambda h: normalize_raw_trips(_batch_union(h)),
    "batch_clean": lambda h: h.batch_clean(),
    # stream ingest (batch twin of the streaming query)
    "stream_dedup": _stream_dedup,
    "stream_validate_valid": lambda h: h.stream_staging(),
    "stream_validate_rejected": lambda h: h.rejected_staging(),
    "rejected_by_reason": lambda h: quality.rejected_by_reason(h.rejected_staging()),
    "stream_clean": lambda h: h.stream_clean(),
    # the same, through the Structured Streaming ingest (readStream + foreachBatch)
    "stream_ingest_valid": lambda h: h.ingested_valid(),
    "stream_ingest_rejected_by_reason": lambda h: quality.rejected_by_reason(h.ingested_rejected()),
    "stream_ingest_rejected": lambda h: h.ingested_rejected().drop("pipeline_timestamp"),
    # the same over real inputs: monthly Parquet files, zone CSV, the tables that the ingest wrote
    "files_monthly_load": lambda h: union_all(*h.from_files().months()),
    "files_zone_load": lambda h: h.from_files().zone_dim(),
    "files_silver_trips": lambda h: h.from_files().silver(),
    "files_months_differ": _months_differ,
    "files_month_reloaded": _month_reloaded,
    "stream_declared_valid": lambda h: _declared(h, VALID),
    "stream_declared_rejected": lambda h: _declared(h, REJECTED).drop("pipeline_timestamp", "pipeline_date"),
    "stream_compacted_valid": lambda h: _compacted(h).valid(),
    "stream_compacted_rejected": lambda h: _compacted(h).rejected().drop("pipeline_timestamp"),
    "stream_bounded_dedup": _bounded_dedup,
    "written_stream_counts": lambda h: h.stream_tables().counts(),
    "fare_totals": _fare_totals,
    # silver
    "zone_dim": lambda h: h.zone_dim(),
    "clean_union": lambda h: h.clean_union(),
    "duration_gate": _duration_gate,
    "zone_left_join_pickup": lambda h: _zone_join(h, "pickup"),
    "zone_left_join_dropoff": lambda h: _zone_join(h, "dropoff"),
    "silver_trips": lambda h: h.silver(),
    "decode_labels": _decode_labels,
    "time_attributes": _time_attributes,
    # gold
    "daily_trip_summary": lambda h: h.daily_summary(),
    "payment_summary": lambda h: h.payment_summary(),
    "zone_performance": lambda h: h.zone_performance(),
    "view_daily_summary": _view("vw_daily_trip_summary"),
    "view_payment_summary": _view("vw_payment_summary"),
    "view_zone_performance": _view("vw_zone_performance"),
    # named tables
    "silver_by_name": _silver_by_name,
    "namespace_tables": _namespace_tables,
    # analytics
    "top_pickup_zones": lambda h: analytics.top_pickup_zones(h.zone_performance()),
    "busiest_period": lambda h: analytics.busiest_period(h.daily_summary()),
    "payment_usage_rank": lambda h: analytics.payment_usage_rank(h.payment_summary()),
    "batch_vs_stream": lambda h: analytics.batch_vs_stream(h.daily_summary()),
    # data-quality gates
    "check_staging_ready": _staging_ready,
    "check_batch_clean": lambda h: quality.monthly_volume(h.batch_clean(), "trip_count"),
    "check_stream_clean": lambda h: quality.monthly_volume(h.stream_clean(), "trip_count"),
    "check_silver_volume": lambda h: quality.monthly_volume(h.silver(), "total_trips"),
    "check_silver_duration": lambda h: quality.duration_profile(h.silver()),
    "check_silver_gate": lambda h: quality.silver_gate(h.spark, h.silver()),
    "check_gold_reconciliation": _reconcile,
    "gates_passed": _gates,
    "load_stamps": _load_stamps,
    # the same reports as silver's writing pass measured them
    "written_silver_volume": lambda h: _stored(h).silver_written().volume(),
    "written_silver_duration": lambda h: _stored(h).silver_written().durations(),
    "written_silver_gate": lambda h: _stored(h).silver_written().gate(),
    "stream_table_counts": lambda h: quality.stream_table_counts(
        h.spark, h.stream_staging(), h.rejected_staging()
    ),
    "zone_key_unique": lambda h: quality.zone_key_unique(h.zone_dim()),
}


def _wrap(builder: Callable[[TripLakehouse], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _no_load_time(builder(lakehouse(spark, sf_dir)))

    return run


QUERIES: dict[str, Query] = {name: _wrap(b) for name, b in _BUILDERS.items()}
