"""Table schemas, column orders and fixed label values.

Everything in the "fixed values" block below must stay byte-for-byte equal to
the values the original trip pipeline emits (labels, error texts, code
tables); they are data, not code.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --------------------------------------------------------------------------
# Fixed values (must equal the reference pipeline's output strings)
# --------------------------------------------------------------------------

VENDOR_NAMES = {
    1: "Creative Mobile Technologies, LLC",
    2: "VeriFone Inc.",
    6: "Myle Technologies Inc",
}

STORE_AND_FWD_NAMES = {
    "Y": "store and forward",
    "N": "normal",
}

RATE_CODE_NAMES = {
    1: "standard rate",
    2: "JFK",
    3: "Newark",
    4: "Nassau or Westchester",
    5: "Negotiated fare",
    6: "Group ride",
    99: "Null/unknown",
}

PAYMENT_TYPE_NAMES = {
    0: "flex fare frip",
    1: "credit card",
    2: "cash",
    3: "no charge",
    4: "dispute",
    5: "unknown",
    6: "voided trip",
}

TRIP_TYPE_NAMES = {
    1: "street-hail",
    2: "dispatch",
}

# Searched CASE on the pickup hour; the order matters (7-9 shadows 6-10).
TIME_PERIODS = (
    (7, 9, "morning rush"),
    (0, 5, "late night"),
    (6, 10, "morning"),
    (11, 15, "afternoon"),
    (16, 19, "evening rush"),
    (20, 23, "night"),
)

UNKNOWN_LABEL = "Unknown"
UNKNOWN_ZONE = "unknown"
DEFAULT_RATE_CODE = 99
DEFAULT_PAYMENT_TYPE = 5

ERROR_TYPE = "validation_error"
REASON_BAD_JSON = "JSON tidak valid"
REASON_MISSING_PREFIX = "Field kosong: "
REASON_NOT_POSITIVE = "Nilai perjalanan harus lebih besar dari 0"
# Extension (not in the reference): a present value that the table type
# cannot hold.
REASON_BAD_TYPE_PREFIX = "Tipe tidak valid: "

POSITIVE_FIELDS = ("trip_distance", "fare_amount", "total_amount")

EVENT_TIME_TEXT_FORMAT = "yyyy-MM-dd HH:mm:ss 'UTC'"

# --------------------------------------------------------------------------
# Schemas
# --------------------------------------------------------------------------

TS = T.TimestampNTZType()

# Valid stream event, 26 required fields, in table order.
VALID_EVENT_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("event_time", TS),
        T.StructField("ingestion_time", TS),
        T.StructField("schema_version", T.StringType()),
        T.StructField("publisher_name", T.StringType()),
        T.StructField("source_type", T.StringType()),
        T.StructField("vendor_id", T.LongType()),
        T.StructField("pickup_datetime", TS),
        T.StructField("dropoff_datetime", TS),
        T.StructField("store_and_fwd_flag", T.StringType()),
        T.StructField("rate_code_id", T.LongType()),
        T.StructField("pickup_location_id", T.LongType()),
        T.StructField("dropoff_location_id", T.LongType()),
        T.StructField("passenger_count", T.LongType()),
        T.StructField("trip_distance", T.DoubleType()),
        T.StructField("fare_amount", T.DoubleType()),
        T.StructField("extra", T.DoubleType()),
        T.StructField("mta_tax", T.DoubleType()),
        T.StructField("tip_amount", T.DoubleType()),
        T.StructField("tolls_amount", T.DoubleType()),
        T.StructField("improvement_surcharge", T.DoubleType()),
        T.StructField("total_amount", T.DoubleType()),
        T.StructField("payment_type", T.LongType()),
        T.StructField("trip_type", T.LongType()),
        T.StructField("congestion_surcharge", T.DoubleType()),
        T.StructField("cbd_congestion_fee", T.DoubleType()),
    ]
)
VALID_FIELDS = tuple(f.name for f in VALID_EVENT_SCHEMA.fields)

REJECTED_EVENT_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("event_time", TS),
        T.StructField("ingestion_time", TS),
        T.StructField("message_id", T.StringType()),
        T.StructField("publish_time", TS),
        T.StructField("raw_payload", T.StringType()),
        T.StructField("error_type", T.StringType()),
        T.StructField("error_reason", T.StringType()),
        T.StructField("pipeline_timestamp", T.TimestampType()),
    ]
)
REJECTED_FIELDS = tuple(f.name for f in REJECTED_EVENT_SCHEMA.fields)

# Message envelope as delivered by a broker (or a file stream standing in).
ENVELOPE_SCHEMA = T.StructType(
    [
        T.StructField("data", T.BinaryType()),
        T.StructField("message_id", T.StringType()),
        T.StructField("publish_time", TS),
        T.StructField("attributes", T.MapType(T.StringType(), T.StringType())),
    ]
)
DEDUP_ATTRIBUTE = "event_id"

# Raw monthly trip file -> clean name.
RAW_TRIP_COLUMNS = (
    ("VendorID", "vendor_id", "bigint"),
    ("lpep_pickup_datetime", "pickup_datetime", "timestamp"),
    ("lpep_dropoff_datetime", "dropoff_datetime", "timestamp"),
    ("store_and_fwd_flag", "store_and_fwd_flag", "string"),
    ("RatecodeID", "rate_code_id", "bigint"),
    ("PULocationID", "pickup_location_id", "bigint"),
    ("DOLocationID", "dropoff_location_id", "bigint"),
    ("passenger_count", "passenger_count", "bigint"),
    ("trip_distance", "trip_distance", "double"),
    ("fare_amount", "fare_amount", "double"),
    ("extra", "extra", "double"),
    ("mta_tax", "mta_tax", "double"),
    ("tip_amount", "tip_amount", "double"),
    ("tolls_amount", "tolls_amount", "double"),
    ("improvement_surcharge", "improvement_surcharge", "double"),
    ("total_amount", "total_amount", "double"),
    ("payment_type", "payment_type", "bigint"),
    ("trip_type", "trip_type", "bigint"),
    ("congestion_surcharge", "congestion_surcharge", "double"),
    ("cbd_congestion_fee", "cbd_congestion_fee", "double"),
)
TRIP_FIELDS = tuple(clean for _, clean, _ in RAW_TRIP_COLUMNS)

# Canonical clean-trip layout shared by batch and stream (24 columns).
CLEAN_COLUMNS = TRIP_FIELDS + (
    "trip_duration_minutes",
    "source_type",
    "event_id",
    "silver_loaded_at",
)

# Zone lookup CSV header -> clean name.
ZONE_COLUMNS = (
    ("LocationID", "location_id"),
    ("Borough", "borough"),
    ("Zone", "zone_name"),
    ("service_zone", "service_zone"),
)
ZONE_CSV_SCHEMA = T.StructType(
    [
        T.StructField("LocationID", T.LongType()),
        T.StructField("Borough", T.StringType()),
        T.StructField("Zone", T.StringType()),
        T.StructField("service_zone", T.StringType()),
    ]
)

# Silver trip table (40 columns), in table order.
SILVER_COLUMNS = (
    "vendor_id",
    "vendor_name",
    "pickup_datetime",
    "pickup_date",
    "pickup_day_name",
    "is_weekend",
    "pickup_hour",
    "time_period",
    "dropoff_datetime",
    "store_and_fwd_flag",
    "store_and_fwd_name",
    "rate_code_id",
    "rate_code_name",
    "pickup_location_id",
    "pickup_borough",
    "pickup_zone",
    "pickup_service_zone",
    "dropoff_location_id",
    "dropoff_borough",
    "dropoff_zone",
    "dropoff_service_zone",
    "passenger_count",
    "trip_distance",
    "trip_duration_minutes",
    "fare_amount",
    "extra",
    "mta_tax",
    "tip_amount",
    "tolls_amount",
    "improvement_surcharge",
    "congestion_surcharge",
    "cbd_congestion_fee",
    "total_amount",
    "payment_type",
    "payment_type_name",
    "trip_type",
    "trip_name",
    "source_type",
    "event_id",
    "silver_loaded_at",
)

# Columns whose value is the wall clock at load time; never compared.
LOAD_TIME_COLUMNS = ("silver_loaded_at", "pipeline_timestamp")
