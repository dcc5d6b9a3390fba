"""Deterministic carriers: the reference's inputs re-expressed over the test tables.

The test tables hold no taxi trips, so raw trips, the zone lookup and the
message stream are *derived* from ``lineitem``, ``nation``/``region`` and
``events`` with plain column expressions (FIXTURES.md §3).  The same formulas
exist in DuckDB SQL (``tripyard.oracle``); both sides must stay in step.
Work grows with the input tables: every carrier is a narrow projection.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripyard.functions.casts import utc_ntz_from_epoch_seconds
from tripyard.operators.payload import encode_event, every_nth
from tripyard.schemas import EVENT_TIME_TEXT_FORMAT

# Carrier parameters (FIXTURES.md §3).
TRIP_EPOCH_START = 1774980000  # 2026-03-31 18:00:00 UTC
TRIP_EPOCH_SPAN = 5310000
EVENT_EPOCH_START = 1780268400  # 2026-05-31 23:00:00 UTC
EVENT_EPOCH_SPAN = 5280000
ZONE_NULL_KEY = 24


def _c(name: str) -> Column:
    return F.col(name)


def raw_trips(lineitem: DataFrame) -> DataFrame:
    """Raw monthly-file columns (VendorID ... cbd_congestion_fee) plus ``month_tag``."""
    ok, pk, sk, ln = _c("l_orderkey"), _c("l_partkey"), _c("l_suppkey"), _c("l_linenumber")
    qty, price = _c("l_quantity"), _c("l_extendedprice")
    pickup_s = F.lit(TRIP_EPOCH_START) + (ok * 7919 + pk * 104729 + ln * 1301) % TRIP_EPOCH_SPAN
    dur_s = (pk * 31 + sk * 17 + ln * 613) % 17000 - 900
    vendor = (
        F.when(sk % 4 == 0, 1).when(sk % 4 == 1, 2).when(sk % 4 == 2, 6).otherwise(9)
    ).cast("string")
    return lineitem.select(
        F.when(sk % 11 == 0, F.lit("N/A")).otherwise(vendor).alias("VendorID"),
        utc_ntz_from_epoch_seconds(pickup_s).alias("lpep_pickup_datetime"),
        F.when(ok % 101 == 0, F.lit(None))
        .otherwise(utc_ntz_from_epoch_seconds(pickup_s + dur_s))
        .alias("lpep_dropoff_datetime"),
        F.when(_c("l_returnflag") == "A", F.lit("Y"))
        .when(_c("l_returnflag") == "N", F.lit("N"))
        .alias("store_and_fwd_flag"),
        F.when(pk % 13 == 0, F.lit(None)).otherwise(ln.cast("double")).alias("RatecodeID"),
        (pk % 30).alias("PULocationID"),
        (sk % 30).alias("DOLocationID"),
        F.when(ok % 17 == 0, F.lit(None)).otherwise(ln + F.lit(0.5)).alias("passenger_count"),
        ((qty - 1) * 0.25).cast("double").alias("trip_distance"),
        F.when(ok % 97 == 0, -price).otherwise(price).alias("fare_amount"),
        (ln % 2).cast("double").alias("extra"),
        F.lit(0.5).alias("mta_tax"),
        (qty * 0.125).cast("double").alias("tip_amount"),
        F.when(pk % 5 == 0, F.lit(6.5)).otherwise(F.lit(0.0)).alias("tolls_amount"),
        F.lit(1.0).alias("improvement_surcharge"),
        (price + qty * 0.125 + 1.5).alias("total_amount"),
        F.when(ok % 19 == 0, F.lit(None)).otherwise(ok % 7).alias("payment_type"),
        (ln % 3).alias("trip_type"),
        F.when(sk % 2 == 0, F.lit(2.75)).otherwise(F.lit(0.0)).alias("congestion_surcharge"),
        F.lit(0.75).alias("cbd_congestion_fee"),
        F.when(ln <= 4, F.lit("2026_04")).otherwise(F.lit("2026_05")).alias("month_tag"),
    )


def raw_trip_months(lineitem: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The two monthly staging frames ("April", "May"); their union is all of lineitem."""
    trips = raw_trips(lineitem)
    april = trips.where(F.col("month_tag") == "2026_04").drop("month_tag")
    may = trips.where(F.col("month_tag") == "2026_05").drop("month_tag")
    return april, may


def zone_lookup_rows(nation: DataFrame, region: DataFrame) -> DataFrame:
    """Zone CSV rows (LocationID, Borough, Zone, service_zone), padded and doubled."""
    n = nation.select("n_nationkey", "n_name", "n_regionkey")
    r = region.select("r_regionkey", "r_name")
    rows = n.join(r, n.n_regionkey == r.r_regionkey, "inner").select(
        F.when(F.col("n_nationkey") == ZONE_NULL_KEY, F.lit(None))
        .otherwise(F.col("n_nationkey").cast("bigint"))
        .alias("LocationID"),
        F.concat(F.lit(" "), F.col("r_name"), F.lit(" ")).alias("Borough"),
        F.concat(F.col("n_name"), F.lit(" ")).alias("Zone"),
        F.when(F.col("n_nationkey") % 3 == 0, F.lit("Boro Zone"))
        .otherwise(F.lit("Yellow Zone"))
        .alias("service_zone"),
    )
    return rows.unionAll(rows)


def _ts_text(ts: Column) -> Column:
    return F.date_format(ts, EVENT_TIME_TEXT_FORMAT)


def trip_event_fields(events: DataFrame) -> DataFrame:
    """Typed trip-event fields derived from ``events`` (before JSON encoding).

    Returns the 26 payload fields (timestamps as '... UTC' text) plus
    ``seq`` (source event id), ``fault`` (event_id % 10) and ``ts``.
    """
    eid, uid, val, ts = _c("event_id"), _c("user_id"), _c("value"), _c("ts")
    epoch_s = F.timestamp_diff("SECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"), ts)
    pickup_s = F.lit(EVENT_EPOCH_START) + (epoch_s * 2) % EVENT_EPOCH_SPAN
    dropoff_s = pickup_s + (eid * 37) % 15000 - 300
    pickup, dropoff = utc_ntz_from_epoch_seconds(pickup_s), utc_ntz_from_epoch_seconds(dropoff_s)
    fault = eid % 10
    distance = every_nth(eid, 10, 7, F.lit(-3.0), ((eid % 60 + 2) * 0.25).cast("double"))
    return events.select(
        eid.alias("seq"),
        ts,
        fault.alias("fault"),
        F.concat(F.lit("e-"), eid.cast("string")).alias("event_id"),
        _ts_text(dropoff).alias("event_time"),
        _ts_text(ts).alias("ingestion_time"),
        F.lit("1.0").alias("schema_version"),
        F.lit("test").alias("publisher_name"),
        F.lit("stream").alias("source_type"),
        F.when(fault == 5, F.lit(None).cast("bigint"))
        .otherwise(F.when(uid % 4 == 3, F.lit(9)).otherwise(uid % 4))
        .alias("vendor_id"),
        _ts_text(pickup).alias("pickup_datetime"),
        _ts_text(dropoff).alias("dropoff_datetime"),
        F.lit("N").alias("store_and_fwd_flag"),
        F.lit(1).cast("bigint").alias("rate_code_id"),
        (uid % 30).alias("pickup_location_id"),
        (eid % 30).alias("dropoff_location_id"),
        (eid % 4 + 1).alias("passenger_count"),
        distance.alias("trip_distance"),
        val.alias("fare_amount"),
        F.lit(0.0).alias("extra"),
        F.lit(0.5).alias("mta_tax"),
        ((eid % 3) * 0.5).cast("double").alias("tip_amount"),
        F.lit(0.0).alias("tolls_amount"),
        F.lit(1.0).alias("improvement_surcharge"),
        (val + 1.5).alias("total_amount"),
        F.when(fault == 5, F.lit(None).cast("bigint")).otherwise(eid % 2 + 1).alias("payment_type"),
        F.lit(1).cast("bigint").alias("trip_type"),
        F.lit(0.0).alias("congestion_surcharge"),
        F.lit(0.0).alias("cbd_congestion_fee"),
    )


def trip_envelopes(events: DataFrame) -> DataFrame:
    """Broker envelopes for the trip events, with faults and re-deliveries.

    Faults by ``event_id % 10``: 3 closing brace cut off (bad JSON); 5
    ``vendor_id`` absent and ``payment_type`` explicit null; 7 negative
    distance.  By ``event_id % 50``: 4 a closing bracket and 14 ``],[1`` behind the
    object (bad JSON); 8 a byte in the publisher's name that is no UTF-8 (decoded as
    U+FFFD); 9 no ``event_id`` attribute.  Events with ``event_id % 20 = 1`` are
    delivered twice (same attribute, message id + '-dup', publish time + 1 s).
    """
    fields = trip_event_fields(events)
    text = (
        F.when(F.col("fault") == 3, F.expr("substring(payload_json, 1, length(payload_json) - 1)"))
        .when(F.col("fault") == 5, F.regexp_replace("payload_json", '"vendor_id":null,', ""))
        .when(F.col("seq") % 50 == 4, F.concat("payload_json", F.lit("]")))
        .when(F.col("seq") % 50 == 14, F.concat("payload_json", F.lit("],[1")))
        .otherwise(F.col("payload_json"))
    )
    # the two halves of the publisher's name around a byte that no UTF-8 text has
    name_at = F.instr("payload_json", '"publisher_name":"te') + F.lit(len('"publisher_name":"te'))
    bad_bytes = F.concat(
        F.substring("payload_json", F.lit(1), name_at - 1).cast("binary"),
        F.unhex(F.lit("FF")),
        F.substring("payload_json", name_at, F.length("payload_json")).cast("binary"),
    )
    base = fields.select(
        F.col("seq"), F.col("ts"), F.col("fault"), F.col("event_id"), encode_event(fields).alias("payload_json")
    ).select(
        F.when(F.col("seq") % 50 == 8, bad_bytes).otherwise(text.cast("binary")).alias("data"),
        F.concat(F.lit("m-"), F.col("seq").cast("string")).alias("message_id"),
        F.col("ts").alias("publish_time"),
        F.when(F.col("seq") % 50 == 9, F.create_map().cast("map<string,string>"))
        .otherwise(F.create_map(F.lit("event_id"), F.col("event_id")))
        .alias("attributes"),
        F.col("seq"),
    )
    redelivered = base.where(F.col("seq") % 20 == 1).select(
        "data",
        F.concat(F.col("message_id"), F.lit("-dup")).alias("message_id"),
        F.timestamp_add("SECOND", F.lit(1), F.col("publish_time")).alias("publish_time"),
        "attributes",
    )
    return base.drop("seq").unionAll(redelivered)
