"""DuckDB SQL twins of the registered queries (the correctness oracle).

The SQL recomputes every layer from the same test tables with the same
carrier formulas, but without going through JSON: stream validity is read
off the carrier's fault class.  Money is summed here in integers of a
millionth.
"""

from __future__ import annotations

from tripyard.schemas import (
    DEFAULT_PAYMENT_TYPE,
    DEFAULT_RATE_CODE,
    ERROR_TYPE,
    PAYMENT_TYPE_NAMES,
    RATE_CODE_NAMES,
    REASON_BAD_JSON,
    REASON_MISSING_PREFIX,
    REASON_NOT_POSITIVE,
    STORE_AND_FWD_NAMES,
    TIME_PERIODS,
    TRIP_FIELDS,
    TRIP_TYPE_NAMES,
    UNKNOWN_LABEL,
    UNKNOWN_ZONE,
    VALID_EVENT_SCHEMA,
    VALID_FIELDS,
    VENDOR_NAMES,
)

# ------------------------------------------------------------------ helpers


def _q(value) -> str:
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    return str(value)


def _case(col: str, labels: dict) -> str:
    whens = " ".join(f"WHEN {_q(k)} THEN {_q(v)}" for k, v in labels.items())
    return f"CASE {col} {whens} ELSE {_q(UNKNOWN_LABEL)} END"


def _periods(hour: str) -> str:
    whens = " ".join(f"WHEN {hour} BETWEEN {lo} AND {hi} THEN {_q(n)}" for lo, hi, n in TIME_PERIODS)
    return f"CASE {whens} ELSE {_q(UNKNOWN_LABEL)} END"


def _round_half_away(v: str) -> str:
    return (
        f"CAST(CASE WHEN isnan({v}) OR {v} >= 9223372036854775808.0 OR {v} < -9223372036854775808.0 THEN NULL "
        f"WHEN {v} >= 0 THEN CASE WHEN {v} - floor({v}) >= 0.5 THEN floor({v}) + 1 ELSE floor({v}) END "
        f"ELSE CASE WHEN ceil({v}) - {v} >= 0.5 THEN ceil({v}) - 1 ELSE ceil({v}) END END AS BIGINT)"
    )


def _units(x: str) -> str:
    """An amount in millionths, as HUGEINT."""
    d = f"CAST({x} AS DOUBLE)"
    return f"(CAST(floor({d}) AS HUGEINT) * 1000000 + CAST(floor(({d} - floor({d})) * 1e6 + 0.5) AS HUGEINT))"


def _half_away(num: str, den: str) -> str:
    """round(num / den), halves away from zero, for integers."""
    return (
        f"(CASE WHEN ({den}) IS NULL OR ({den}) = 0 THEN NULL "
        f"WHEN ({num}) < 0 THEN -((2 * abs({num}) + ({den})) // (2 * ({den}))) "
        f"ELSE (2 * abs({num}) + ({den})) // (2 * ({den})) END)"
    )


def _ratio2(total: str, den: str) -> str:
    """ROUND(total / den, 2) for a total in millionths."""
    return f"(CAST({_half_away(f'({total})', f'(CAST({den} AS HUGEINT) * 10000)')} AS DOUBLE) / 100)"


def _mean2(col: str) -> str:
    return _ratio2(f"SUM({_units(col)})", f"COUNT({col})")


def _sum2(col: str) -> str:
    return _ratio2(f"SUM({_units(col)})", "1")


def _money_sum(col: str) -> str:
    return f"(CAST(SUM({_units(col)}) AS DOUBLE) / 1e6)"


def _ts(seconds: str) -> str:
    return f"make_timestamp(CAST({seconds} AS BIGINT) * 1000000)"


def _positive(col: str) -> str:
    return f"({col} > 0 AND NOT isnan({col}))"


def _quality(start: str, end: str) -> str:
    return (
        "pickup_datetime IS NOT NULL AND dropoff_datetime IS NOT NULL "
        "AND dropoff_datetime > pickup_datetime "
        f"AND {_positive('trip_distance')} AND {_positive('fare_amount')} "
        f"AND {_positive('total_amount')} "
        f"AND pickup_datetime >= TIMESTAMP '{start}' AND pickup_datetime < TIMESTAMP '{end}'"
    )


def _payload() -> str:
    """An event's JSON text, nulls written out."""
    parts = []
    for f in VALID_EVENT_SCHEMA.fields:
        kind = f.dataType.simpleString()
        if kind == "string":
            value = f"'\"' || {f.name} || '\"'"
        elif kind == "timestamp_ntz":
            value = f"strftime({f.name}, '\"%Y-%m-%d %H:%M:%S UTC\"')"
        else:
            value = f"CAST({f.name} AS VARCHAR)"
        parts.append(f"'\"{f.name}\":' || coalesce({value}, 'null')")
    return "('{' || " + " || ',' || ".join(parts) + " || '}')"


_WS = "' ' || chr(9) || chr(10) || chr(13) || chr(11) || chr(12) || chr(160)"
_TRIP = ", ".join(TRIP_FIELDS)
_CLEAN = _TRIP + ", trip_duration_minutes, source_type, event_id"

# ----------------------------------------------------------- layer CTEs

_PICKUP_S = "(1774980000 + (l_orderkey * 7919 + l_partkey * 104729 + l_linenumber * 1301) % 5310000)"
_DUR_S = "((l_partkey * 31 + l_suppkey * 17 + l_linenumber * 613) % 17000 - 900)"

CTES = {
    "raw_trips": f"""
  SELECT
    CASE WHEN l_suppkey % 11 = 0 THEN 'N/A'
         ELSE CAST(CASE l_suppkey % 4 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 6 ELSE 9 END AS VARCHAR)
    END AS VendorID,
    {_ts(_PICKUP_S)} AS lpep_pickup_datetime,
    CASE WHEN l_orderkey % 101 = 0 THEN NULL ELSE {_ts(f"{_PICKUP_S} + {_DUR_S}")} END AS lpep_dropoff_datetime,
    CASE l_returnflag WHEN 'A' THEN 'Y' WHEN 'N' THEN 'N' END AS store_and_fwd_flag,
    CASE WHEN l_partkey % 13 = 0 THEN NULL ELSE CAST(l_linenumber AS DOUBLE) END AS RatecodeID,
    l_partkey % 30 AS PULocationID,
    l_suppkey % 30 AS DOLocationID,
    CASE WHEN l_orderkey % 17 = 0 THEN NULL ELSE CAST(l_linenumber AS DOUBLE) + CAST(0.5 AS DOUBLE) END
      AS passenger_count,
    CAST((l_quantity - 1) * CAST(0.25 AS DOUBLE) AS DOUBLE) AS trip_distance,
    CASE WHEN l_orderkey % 97 = 0 THEN -l_extendedprice ELSE l_extendedprice END AS fare_amount,
    CAST(l_linenumber % 2 AS DOUBLE) AS extra,
    CAST(0.5 AS DOUBLE) AS mta_tax,
    CAST(l_quantity * CAST(0.125 AS DOUBLE) AS DOUBLE) AS tip_amount,
    CASE WHEN l_partkey % 5 = 0 THEN CAST(6.5 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS tolls_amount,
    CAST(1.0 AS DOUBLE) AS improvement_surcharge,
    l_extendedprice + l_quantity * CAST(0.125 AS DOUBLE) + CAST(1.5 AS DOUBLE) AS total_amount,
    CASE WHEN l_orderkey % 19 = 0 THEN NULL ELSE l_orderkey % 7 END AS payment_type,
    l_linenumber % 3 AS trip_type,
    CASE WHEN l_suppkey % 2 = 0 THEN CAST(2.75 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS congestion_surcharge,
    CAST(0.75 AS DOUBLE) AS cbd_congestion_fee,
    CASE WHEN l_linenumber <= 4 THEN '2026_04' ELSE '2026_05' END AS month_tag
  FROM lineitem""",
    "tagged": f"""
  SELECT
    TRY_CAST(VendorID AS BIGINT) AS vendor_id,
    lpep_pickup_datetime AS pickup_datetime,
    lpep_dropoff_datetime AS dropoff_datetime,
    CAST(store_and_fwd_flag AS VARCHAR) AS store_and_fwd_flag,
    {_round_half_away('RatecodeID')} AS rate_code_id,
    CAST(PULocationID AS BIGINT) AS pickup_location_id,
    CAST(DOLocationID AS BIGINT) AS dropoff_location_id,
    {_round_half_away('CAST(passenger_count AS DOUBLE)')} AS passenger_count,
    trip_distance, fare_amount, extra, mta_tax, tip_amount, tolls_amount,
    improvement_surcharge, total_amount,
    CAST(payment_type AS BIGINT) AS payment_type,
    CAST(trip_type AS BIGINT) AS trip_type,
    congestion_surcharge, cbd_congestion_fee, month_tag
  FROM raw_trips""",
    "normalized": """
  SELECT * EXCLUDE (month_tag) FROM tagged""",
    "batch_clean": f"""
  SELECT {_TRIP},
    date_sub('minute', pickup_datetime, dropoff_datetime) AS trip_duration_minutes,
    'batch' AS source_type,
    CAST(NULL AS VARCHAR) AS event_id
  FROM normalized
  WHERE {_quality('2026-04-01', '2026-06-01')}""",
    "ev": """
  SELECT event_id AS seq, ts, user_id, value, event_id % 10 AS fault,
    1780268400 + (CAST(floor(epoch(ts)) AS BIGINT) * 2) % 5280000 AS q
  FROM events""",
    "stream_events": f"""
  SELECT seq, fault, ts,
    'e-' || CAST(seq AS VARCHAR) AS event_id,
    {_ts("q + (seq * 37) % 15000 - 300")} AS event_time,
    date_trunc('second', ts) AS ingestion_time,
    '1.0' AS schema_version,
    CASE WHEN seq % 50 = 8 THEN 'te' || chr(65533) || 'st' ELSE 'test' END AS publisher_name,
    'stream' AS source_type,
    CAST(CASE WHEN fault = 5 THEN NULL WHEN user_id % 4 = 3 THEN 9 ELSE user_id % 4 END AS BIGINT)
      AS vendor_id,
    {_ts("q")} AS pickup_datetime,
    {_ts("q + (seq * 37) % 15000 - 300")} AS dropoff_datetime,
    'N' AS store_and_fwd_flag,
    CAST(1 AS BIGINT) AS rate_code_id,
    CAST(user_id % 30 AS BIGINT) AS pickup_location_id,
    CAST(seq % 30 AS BIGINT) AS dropoff_location_id,
    CAST(seq % 4 + 1 AS BIGINT) AS passenger_count,
    CASE WHEN seq % 10 = 7 THEN CAST(-3.0 AS DOUBLE)
         ELSE CAST(seq % 60 + 2 AS DOUBLE) * CAST(0.25 AS DOUBLE) END AS trip_distance,
    value AS fare_amount,
    CAST(0 AS DOUBLE) AS extra,
    CAST(0.5 AS DOUBLE) AS mta_tax,
    CAST(seq % 3 AS DOUBLE) * CAST(0.5 AS DOUBLE) AS tip_amount,
    CAST(0 AS DOUBLE) AS tolls_amount,
    CAST(1 AS DOUBLE) AS improvement_surcharge,
    value + CAST(1.5 AS DOUBLE) AS total_amount,
    CAST(CASE WHEN fault = 5 THEN NULL ELSE seq % 2 + 1 END AS BIGINT) AS payment_type,
    CAST(1 AS BIGINT) AS trip_type,
    CAST(0 AS DOUBLE) AS congestion_surcharge,
    CAST(0 AS DOUBLE) AS cbd_congestion_fee
  FROM ev""",
    "stream_flagged": f"""
  SELECT *,
    CASE WHEN fault = 3 OR seq % 50 IN (4, 14) THEN {_q(REASON_BAD_JSON)}
         WHEN fault = 5 THEN {_q(REASON_MISSING_PREFIX + "vendor_id, payment_type")}
         WHEN NOT ({_positive('trip_distance')} AND {_positive('fare_amount')}
                   AND {_positive('total_amount')}) THEN {_q(REASON_NOT_POSITIVE)}
    END AS error_reason
  FROM stream_events""",
    "stream_valid": f"""
  SELECT {", ".join(VALID_FIELDS)} FROM stream_flagged WHERE error_reason IS NULL""",
    "stream_rejected": f"""
  SELECT
    CASE WHEN fault = 3 OR seq % 50 IN (4, 14) THEN NULL ELSE event_id END AS event_id,
    CASE WHEN fault = 3 OR seq % 50 IN (4, 14) THEN NULL ELSE event_time END AS event_time,
    CASE WHEN fault = 3 OR seq % 50 IN (4, 14) THEN NULL ELSE ingestion_time END AS ingestion_time,
    'm-' || CAST(seq AS VARCHAR) AS message_id,
    ts AS publish_time,
    CASE WHEN fault = 3 THEN left({_payload()}, length({_payload()}) - 1)
         WHEN fault = 5 THEN replace({_payload()}, '"vendor_id":null,', '')
         WHEN seq % 50 = 4 THEN {_payload()} || ']'
         WHEN seq % 50 = 14 THEN {_payload()} || '],[1'
         ELSE {_payload()} END AS raw_payload,
    {_q(ERROR_TYPE)} AS error_type,
    error_reason
  FROM stream_flagged WHERE error_reason IS NOT NULL""",
    "stream_clean": f"""
  SELECT {_TRIP},
    date_sub('minute', pickup_datetime, dropoff_datetime) AS trip_duration_minutes,
    'stream' AS source_type,
    event_id
  FROM stream_valid
  WHERE {_quality('2026-06-01', '2026-08-01')}""",
    "zone_once": """
  SELECT
    CASE WHEN n.n_nationkey = 24 THEN NULL ELSE CAST(n.n_nationkey AS BIGINT) END AS LocationID,
    ' ' || r.r_name || ' ' AS Borough,
    n.n_name || ' ' AS Zone,
    CASE WHEN n.n_nationkey % 3 = 0 THEN 'Boro Zone' ELSE 'Yellow Zone' END AS service_zone
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey""",
    "zone_rows": """
  SELECT * FROM zone_once UNION ALL SELECT * FROM zone_once""",
    "zone_dim": f"""
  SELECT DISTINCT
    CAST(LocationID AS BIGINT) AS location_id,
    trim(CAST(Borough AS VARCHAR), {_WS}) AS borough,
    trim(CAST(Zone AS VARCHAR), {_WS}) AS zone_name,
    trim(CAST(service_zone AS VARCHAR), {_WS}) AS service_zone
  FROM zone_rows
  WHERE LocationID IS NOT NULL""",
    "clean_union": f"""
  SELECT {_CLEAN} FROM batch_clean
  UNION ALL
  SELECT {_CLEAN} FROM stream_clean""",
    "gated": f"""
  SELECT * FROM clean_union
  WHERE {_quality('2026-04-01', '2026-08-01')}
    AND date_sub('second', pickup_datetime, dropoff_datetime) BETWEEN 300 AND 14400""",
    "silver": f"""
  SELECT
    t.vendor_id,
    {_case('t.vendor_id', VENDOR_NAMES)} AS vendor_name,
    t.pickup_datetime,
    CAST(t.pickup_datetime AS DATE) AS pickup_date,
    dayname(t.pickup_datetime) AS pickup_day_name,
    dayofweek(t.pickup_datetime) IN (0, 6) AS is_weekend,
    CAST(hour(t.pickup_datetime) AS BIGINT) AS pickup_hour,
    {_periods('hour(t.pickup_datetime)')} AS time_period,
    t.dropoff_datetime,
    t.store_and_fwd_flag,
    {_case('t.store_and_fwd_flag', STORE_AND_FWD_NAMES)} AS store_and_fwd_name,
    COALESCE(t.rate_code_id, {DEFAULT_RATE_CODE}) AS rate_code_id,
    {_case('t.rate_code_id', RATE_CODE_NAMES)} AS rate_code_name,
    t.pickup_location_id,
    pz.borough AS pickup_borough,
    pz.zone_name AS pickup_zone,
    pz.service_zone AS pickup_service_zone,
    t.dropoff_location_id,
    dz.borough AS dropoff_borough,
    dz.zone_name AS dropoff_zone,
    dz.service_zone AS dropoff_service_zone,
    t.passenger_count, t.trip_distance, t.trip_duration_minutes,
    t.fare_amount, t.extra, t.mta_tax, t.tip_amount, t.tolls_amount,
    t.improvement_surcharge, t.congestion_surcharge, t.cbd_congestion_fee, t.total_amount,
    COALESCE(t.payment_type, {DEFAULT_PAYMENT_TYPE}) AS payment_type,
    {_case('t.payment_type', PAYMENT_TYPE_NAMES)} AS payment_type_name,
    t.trip_type,
    {_case('t.trip_type', TRIP_TYPE_NAMES)} AS trip_name,
    t.source_type,
    t.event_id
  FROM gated t
  LEFT JOIN zone_dim pz ON t.pickup_location_id = pz.location_id
  LEFT JOIN zone_dim dz ON t.dropoff_location_id = dz.location_id""",
    "daily": f"""
  SELECT pickup_date, pickup_day_name, is_weekend, pickup_hour, time_period, trip_duration_minutes,
    COUNT(pickup_datetime) AS total_trips,
    {_mean2('trip_duration_minutes')} AS average_duration_minutes,
    {_mean2('trip_distance')} AS average_trip_distance,
    {_money_sum('total_amount')} AS total_revenue,
    {_mean2('total_amount')} AS average_revenue,
    {_mean2('fare_amount')} AS average_fare,
    {_mean2('tip_amount')} AS average_tip,
    source_type
  FROM silver
  GROUP BY pickup_date, pickup_day_name, is_weekend, pickup_hour, time_period,
           trip_duration_minutes, source_type""",
    "payment": f"""
  SELECT payment_type_name, vendor_name, pickup_zone, dropoff_zone,
    COUNT(pickup_datetime) AS total_trips,
    {_sum2('total_amount')} AS total_revenue,
    {_mean2('total_amount')} AS average_revenue,
    {_sum2('tip_amount')} AS total_tip,
    {_mean2('tip_amount')} AS average_tip_amount,
    {_mean2('fare_amount')} AS average_fare_amount,
    source_type
  FROM silver
  GROUP BY payment_type_name, vendor_name, pickup_zone, dropoff_zone, source_type""",
    "zone_perf": f"""
  SELECT pickup_borough,
    COALESCE(pickup_zone, {_q(UNKNOWN_ZONE)}) AS pickup_zone,
    pickup_service_zone,
    dropoff_borough,
    COALESCE(dropoff_zone, {_q(UNKNOWN_ZONE)}) AS dropoff_zone,
    dropoff_service_zone,
    COUNT(pickup_datetime) AS total_trips,
    {_money_sum('total_amount')} AS total_revenue,
    {_mean2('total_amount')} AS average_revenue,
    {_mean2('fare_amount')} AS average_fare_amount,
    {_mean2('tip_amount')} AS average_tip_amount,
    {_mean2('trip_distance')} AS average_trip_distance,
    {_mean2('trip_duration_minutes')} AS average_trip_duration,
    source_type
  FROM silver
  GROUP BY pickup_borough, silver.pickup_zone, pickup_service_zone,
           dropoff_borough, silver.dropoff_zone, dropoff_service_zone, source_type""",
}

_ORDER = list(CTES)


def with_ctes(body: str, *needed: str) -> str:
    """Prefix ``body`` with the CTE chain up to the last layer it needs."""
    last = max(_ORDER.index(n) for n in needed)
    ctes = ",\n".join(f"{name} AS ({CTES[name]}\n)" for name in _ORDER[: last + 1])
    return f"WITH {ctes}\n{body}"


# ------------------------------------------------------------- queries

_RAW_COLS = (
    "VendorID, lpep_pickup_datetime, lpep_dropoff_datetime, store_and_fwd_flag, RatecodeID, "
    "PULocationID, DOLocationID, passenger_count, trip_distance, fare_amount, extra, mta_tax, "
    "tip_amount, tolls_amount, improvement_surcharge, total_amount, payment_type, trip_type, "
    "congestion_surcharge, cbd_congestion_fee"
)

_SILVER_NO_LOAD = (
    "vendor_id, vendor_name, pickup_datetime, pickup_date, pickup_day_name, is_weekend, pickup_hour, "
    "time_period, dropoff_datetime, store_and_fwd_flag, store_and_fwd_name, rate_code_id, "
    "rate_code_name, pickup_location_id, pickup_borough, pickup_zone, pickup_service_zone, "
    "dropoff_location_id, dropoff_borough, dropoff_zone, dropoff_service_zone, passenger_count, "
    "trip_distance, trip_duration_minutes, fare_amount, extra, mta_tax, tip_amount, tolls_amount, "
    "improvement_surcharge, congestion_surcharge, cbd_congestion_fee, total_amount, payment_type, "
    "payment_type_name, trip_type, trip_name, source_type, event_id"
)


def _volume(table: str, count_alias: str) -> str:
    return with_ctes(
        f"""SELECT CAST(year(pickup_datetime) AS BIGINT) AS trip_year,
  CAST(month(pickup_datetime) AS BIGINT) AS trip_month, source_type,
  COUNT(pickup_datetime) AS {count_alias}
FROM {table} GROUP BY 1, 2, 3""",
        table,
    )


def _zone_join(role: str) -> str:
    return with_ctes(
        f"""SELECT t.{role}_location_id,
  z.borough AS {role}_borough, z.zone_name AS {role}_zone, z.service_zone AS {role}_service_zone,
  COUNT(*) AS trips
FROM gated t LEFT JOIN zone_dim z ON t.{role}_location_id = z.location_id
GROUP BY 1, 2, 3, 4""",
        "gated",
    )


_NAMESPACES = """SELECT 'staging' AS layer, 'stream_staging' AS table_name, false AS is_view, COUNT(*) AS table_rows FROM stream_flagged
UNION ALL SELECT 'silver', 'batch_clean', false, COUNT(*) FROM batch_clean
UNION ALL SELECT 'silver', 'stream_clean', false, COUNT(*) FROM stream_clean
UNION ALL SELECT 'silver', 'taxi_zone', false, COUNT(*) FROM zone_dim
UNION ALL SELECT 'silver', 'trips', false, COUNT(*) FROM silver
UNION ALL SELECT 'gold', 'daily_trip_summary', false, COUNT(*) FROM daily
UNION ALL SELECT 'gold', 'payment_summary', false, COUNT(*) FROM payment
UNION ALL SELECT 'gold', 'zone_performance', false, COUNT(*) FROM zone_perf
UNION ALL SELECT 'gold', 'vw_daily_trip_summary', true, COUNT(*) FROM daily
UNION ALL SELECT 'gold', 'vw_payment_summary', true, COUNT(*) FROM payment
UNION ALL SELECT 'gold', 'vw_zone_performance', true, COUNT(*) FROM zone_perf"""

# April's file has no CBD fee, May's has whole miles
_MONTHS_DIFFER = """SELECT * EXCLUDE (month_tag) REPLACE (
  CASE WHEN month_tag = '2026_04' THEN NULL ELSE cbd_congestion_fee END AS cbd_congestion_fee,
  CASE WHEN month_tag = '2026_05' THEN CAST(trunc(trip_distance) AS DOUBLE) ELSE trip_distance END AS trip_distance)
FROM tagged"""

_RELOADED = "SELECT * EXCLUDE (month_tag), month_tag AS load_month FROM tagged"

_GATES = """SELECT 'staging_ready' AS gate,
  (SELECT COUNT(*) FROM raw_trips) > 0 AND (SELECT COUNT(*) FROM zone_rows) > 0 AND (SELECT COUNT(*) FROM stream_valid) > 0 AS passed
UNION ALL SELECT 'zone_key_unique', (SELECT COUNT(*) = COUNT(DISTINCT location_id) FROM zone_dim)
UNION ALL SELECT 'silver', (SELECT COUNT(*) > 0 AND COUNT(*) FILTER (WHERE trip_duration_minutes <= 0 OR trip_duration_minutes > 240) = 0 FROM silver)
UNION ALL SELECT 'gold', (SELECT COUNT(*) FROM silver) = (SELECT SUM(total_trips) FROM daily)
  AND (SELECT COUNT(*) FROM silver) = (SELECT SUM(total_trips) FROM payment)
  AND (SELECT COUNT(*) FROM silver) = (SELECT SUM(total_trips) FROM zone_perf)"""


def oracle_queries() -> dict[str, str]:
    q: dict[str, str] = {}
    q["batch_union"] = with_ctes(f"SELECT {_RAW_COLS} FROM raw_trips", "raw_trips")
    q["batch_normalize"] = with_ctes("SELECT * FROM normalized", "normalized")
    q["batch_clean"] = with_ctes("SELECT * FROM batch_clean", "batch_clean")
    q["stream_dedup"] = """SELECT CASE WHEN event_id % 50 = 9 THEN NULL ELSE 'e-' || CAST(event_id AS VARCHAR) END AS event_key,
  'm-' || CAST(event_id AS VARCHAR) AS message_id, ts AS publish_time FROM events"""
    q["stream_validate_valid"] = with_ctes("SELECT * FROM stream_valid", "stream_valid")
    q["stream_validate_rejected"] = with_ctes("SELECT * FROM stream_rejected", "stream_rejected")
    q["rejected_by_reason"] = with_ctes(
        "SELECT error_type, error_reason, COUNT(*) AS rejected_events FROM stream_rejected GROUP BY 1, 2",
        "stream_rejected",
    )
    q["stream_clean"] = with_ctes("SELECT * FROM stream_clean", "stream_clean")
    # the streaming ingest must write exactly what the batch twin computes
    q["stream_ingest_valid"] = q["stream_validate_valid"]
    q["stream_ingest_rejected_by_reason"] = q["rejected_by_reason"]
    q["stream_ingest_rejected"] = q["stream_validate_rejected"]
    parts = ("fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount", "improvement_surcharge", "congestion_surcharge", "cbd_congestion_fee")
    total = " + ".join(f"CAST({c} AS DECIMAL(23,8))" for c in parts)
    q["fare_totals"] = with_ctes(f"SELECT event_id, CAST(round({total}, 2) AS DOUBLE) AS total FROM stream_events", "stream_events")
    q["zone_dim"] = with_ctes("SELECT * FROM zone_dim", "zone_dim")
    q["clean_union"] = with_ctes("SELECT * FROM clean_union", "clean_union")
    q["duration_gate"] = with_ctes(
        """SELECT source_type, COUNT(*) AS candidate_rows,
  COUNT(*) FILTER (WHERE d BETWEEN 300 AND 14400) AS passing_rows,
  COUNT(*) FILTER (WHERE d < 300) AS too_short_rows,
  COUNT(*) FILTER (WHERE d > 14400) AS too_long_rows
FROM (SELECT source_type, date_sub('second', pickup_datetime, dropoff_datetime) AS d FROM clean_union)
GROUP BY source_type""",
        "clean_union",
    )
    q["zone_left_join_pickup"] = _zone_join("pickup")
    q["zone_left_join_dropoff"] = _zone_join("dropoff")
    q["silver_trips"] = with_ctes(f"SELECT {_SILVER_NO_LOAD} FROM silver", "silver")
    q["decode_labels"] = with_ctes(
        """SELECT vendor_id, vendor_name, store_and_fwd_flag, store_and_fwd_name, rate_code_id,
  rate_code_name, payment_type, payment_type_name, trip_type, trip_name, COUNT(*) AS trips
FROM silver GROUP BY ALL""",
        "silver",
    )
    q["time_attributes"] = with_ctes(
        """SELECT pickup_date, pickup_day_name, is_weekend, pickup_hour, time_period, COUNT(*) AS trips
FROM silver GROUP BY ALL""",
        "silver",
    )
    q["daily_trip_summary"] = with_ctes("SELECT * FROM daily", "daily")
    q["payment_summary"] = with_ctes("SELECT * FROM payment", "payment")
    q["zone_performance"] = with_ctes("SELECT * FROM zone_perf", "zone_perf")
    q["view_daily_summary"] = q["daily_trip_summary"]
    q["files_monthly_load"] = q["batch_union"]
    q["files_zone_load"] = q["zone_dim"]
    q["files_silver_trips"] = q["silver_trips"]
    q["view_payment_summary"] = q["payment_summary"]
    q["view_zone_performance"] = q["zone_performance"]
    q["silver_by_name"] = q["silver_trips"]
    q["namespace_tables"] = with_ctes(_NAMESPACES, "zone_perf")
    q["files_months_differ"] = with_ctes(_MONTHS_DIFFER, "tagged")
    q["files_month_reloaded"] = with_ctes(_RELOADED, "tagged")
    q["stream_bounded_dedup"] = q["stream_validate_valid"]
    q["stream_compacted_valid"] = q["stream_validate_valid"]
    q["stream_compacted_rejected"] = q["stream_validate_rejected"]
    q["stream_declared_valid"] = with_ctes("SELECT *, CAST(event_time AS DATE) AS event_date FROM stream_valid", "stream_valid")
    q["stream_declared_rejected"] = q["stream_validate_rejected"]
    q["gates_passed"] = with_ctes(_GATES, "zone_perf")
    q["load_stamps"] = with_ctes("SELECT source_type, COUNT(*) AS trips, COUNT(*) AS stamped FROM silver GROUP BY source_type", "silver")
    q["top_pickup_zones"] = with_ctes(
        f"""SELECT pickup_zone, CAST(SUM(total_trips) AS BIGINT) AS total_perjalanan,
  {_sum2('total_revenue')} AS total_revenue,
  {_ratio2(f"SUM({_units('total_revenue')})", "SUM(total_trips)")} AS revenue_per_trip,
  source_type
FROM zone_perf GROUP BY pickup_zone, source_type
ORDER BY total_perjalanan DESC, pickup_zone ASC, source_type ASC
LIMIT 5""",
        "zone_perf",
    )
    q["busiest_period"] = with_ctes(
        f"""SELECT time_period, CAST(SUM(total_trips) AS DOUBLE) AS total_perjalanan,
  {_mean2('average_duration_minutes')} AS average_trip_duration,
  {_mean2('average_trip_distance')} AS average_trip_distance,
  {_sum2('total_revenue')} AS total_revenue
FROM daily GROUP BY time_period""",
        "daily",
    )
    q["payment_usage_rank"] = with_ctes(
        f"""SELECT payment_type_name, CAST(trips AS DOUBLE) AS total_perjalanan,
  CAST(RANK() OVER (ORDER BY trips DESC) AS BIGINT) AS payment_rank,
  (CAST({_half_away("trips * 10000", "SUM(trips) OVER ()")} AS DOUBLE) / 100) AS usage_percentage,
  total_revenue, total_tip
FROM (SELECT payment_type_name, SUM(total_trips) AS trips,
        {_sum2('total_revenue')} AS total_revenue,
        {_sum2('total_tip')} AS total_tip
      FROM payment GROUP BY payment_type_name)""",
        "payment",
    )
    q["batch_vs_stream"] = with_ctes(
        f"""SELECT source_type, CAST(SUM(total_trips) AS DOUBLE) AS total_perjalanan,
  {_sum2('total_revenue')} AS total_revenue,
  {_ratio2(f"SUM({_units('total_revenue')})", "SUM(total_trips)")}
    AS average_revenue_per_trip,
  {_mean2('average_fare')} AS average_fare,
  {_mean2('average_tip')} AS average_tip,
  {_mean2('average_trip_distance')} AS average_trip_distance
FROM daily GROUP BY source_type""",
        "daily",
    )
    q["check_staging_ready"] = with_ctes(
        """SELECT
  (SELECT COUNT(*) > 0 FROM raw_trips WHERE month_tag = '2026_04') AS april_ready,
  (SELECT COUNT(*) > 0 FROM raw_trips WHERE month_tag = '2026_05') AS may_ready,
  (SELECT COUNT(*) > 0 FROM zone_rows) AS zone_ready,
  (SELECT COUNT(*) > 0 FROM stream_valid) AS stream_ready""",
        "zone_rows",
    )
    q["check_batch_clean"] = _volume("batch_clean", "trip_count")
    q["check_stream_clean"] = _volume("stream_clean", "trip_count")
    q["check_silver_volume"] = _volume("silver", "total_trips")
    q["check_silver_duration"] = with_ctes(
        """SELECT source_type, COUNT(*) AS total_rows,
  COUNT(*) FILTER (WHERE trip_duration_minutes <= 0) AS duration_zero_or_negative,
  COUNT(*) FILTER (WHERE trip_duration_minutes > 240) AS duration_over_240,
  MIN(trip_duration_minutes) AS minimum_duration,
  MAX(trip_duration_minutes) AS maximum_duration
FROM silver GROUP BY source_type""",
        "silver",
    )
    q["check_silver_gate"] = with_ctes(
        """SELECT COUNT(*) > 0 AS silver_not_empty,
  COUNT(*) FILTER (WHERE trip_duration_minutes <= 0 OR trip_duration_minutes > 240) = 0
    AS durations_valid
FROM silver""",
        "silver",
    )
    q["check_gold_reconciliation"] = with_ctes(
        """SELECT s.n AS silver_rows, d.n AS daily_trips, p.n AS payment_trips, z.n AS zone_trips,
  (s.n = d.n AND s.n = p.n AND s.n = z.n) AS reconciled
FROM (SELECT COUNT(*) AS n FROM silver) s,
     (SELECT CAST(SUM(total_trips) AS BIGINT) AS n FROM daily) d,
     (SELECT CAST(SUM(total_trips) AS BIGINT) AS n FROM payment) p,
     (SELECT CAST(SUM(total_trips) AS BIGINT) AS n FROM zone_perf) z""",
        "zone_perf",
    )
    q["written_silver_volume"] = q["check_silver_volume"]
    q["written_silver_duration"] = q["check_silver_duration"]
    q["written_silver_gate"] = q["check_silver_gate"]
    q["stream_table_counts"] = with_ctes(
        """SELECT (SELECT COUNT(*) FROM stream_valid) AS total_stream,
  (SELECT COUNT(*) FROM stream_rejected) AS total_rejected""",
        "stream_rejected",
    )
    q["written_stream_counts"] = q["stream_table_counts"]
    q["zone_key_unique"] = with_ctes(
        """SELECT CAST(SUM(n) AS BIGINT) AS zone_rows, COUNT(*) AS distinct_keys,
  COUNT(*) FILTER (WHERE n > 1) AS duplicate_keys,
  COUNT(*) FILTER (WHERE n > 1) = 0 AS key_unique
FROM (SELECT location_id, COUNT(*) AS n FROM zone_dim GROUP BY location_id)""",
        "zone_dim",
    )
    return q
