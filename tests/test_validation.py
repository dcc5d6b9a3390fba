"""Stream message validation (T2-T10) on literal payloads."""

from __future__ import annotations

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tripyard.operators.events import (
    dedup_messages,
    rejected_events,
    valid_events,
    validate_envelopes,
)
from tripyard.schemas import ENVELOPE_SCHEMA, VALID_FIELDS

GOOD = {
    "event_id": "e-1",
    "event_time": "2026-06-01 10:20:00 UTC",
    "ingestion_time": "2026-06-01 10:21:00 UTC",
    "schema_version": "1.0",
    "publisher_name": "test",
    "source_type": "stream",
    "vendor_id": 1,
    "pickup_datetime": "2026-06-01 10:00:00 UTC",
    "dropoff_datetime": "2026-06-01 10:20:00 UTC",
    "store_and_fwd_flag": "N",
    "rate_code_id": 1,
    "pickup_location_id": 10,
    "dropoff_location_id": 20,
    "passenger_count": 1,
    "trip_distance": 2.5,
    "fare_amount": 10.0,
    "extra": 0.0,
    "mta_tax": 0.5,
    "tip_amount": 1.0,
    "tolls_amount": 0.0,
    "improvement_surcharge": 1.0,
    "total_amount": 12.5,
    "payment_type": 1,
    "trip_type": 1,
    "congestion_surcharge": 0.0,
    "cbd_congestion_fee": 0.0,
}
BAD_JSON = "JSON tidak valid"
NOT_POSITIVE = "Nilai perjalanan harus lebih besar dari 0"


def with_(**kw):
    d = dict(GOOD)
    for k, v in kw.items():
        if v is ...:
            d.pop(k)
        else:
            d[k] = v
    return json.dumps(d)


CASES = [
    ("valid", json.dumps(GOOD), None),
    ("malformed", json.dumps(GOOD)[:-1], BAD_JSON),
    ("empty", "", BAD_JSON),
    ("trailing text", json.dumps(GOOD) + " x", BAD_JSON),
    ("early bracket", json.dumps(GOOD) + "]", BAD_JSON),
    ("early bracket and text", json.dumps(GOOD) + "] x", BAD_JSON),
    ("second list", json.dumps(GOOD) + "],[1", BAD_JSON),
    ("second object", json.dumps(GOOD) + "," + json.dumps(GOOD), BAD_JSON),
    ("early brace", json.dumps(GOOD) + "}", BAD_JSON),
    ("another member", json.dumps(GOOD) + ',"q":1', BAD_JSON),
    ("white space around", " \n" + json.dumps(GOOD) + "\t ", None),
    ("integral number for an integer", with_(vendor_id=1.0), None),
    ("fraction for an integer", with_(passenger_count=1.5), "Tipe tidak valid: passenger_count"),
    ("suffix of a cast", with_(trip_distance="5d"), NOT_POSITIVE),
    ("infinity as text", with_(fare_amount="Infinity"), NOT_POSITIVE),
    ("beyond double", with_(extra="1e999"), "Tipe tidak valid: extra"),
    ("single quotes", "{'event_id': 'e-1'}", BAD_JSON),
    ("not an object", "[1]", BAD_JSON),
    ("json null", "null", BAD_JSON),
    ("NaN literal", with_(trip_distance=float("nan")), BAD_JSON),
    ("key absent", with_(vendor_id=...), "Field kosong: vendor_id"),
    ("explicit null", with_(store_and_fwd_flag=None), "Field kosong: store_and_fwd_flag"),
    (
        "two missing in schema order",
        with_(payment_type=None, vendor_id=...),
        "Field kosong: vendor_id, payment_type",
    ),
    ("null checked number", with_(fare_amount=None), "Field kosong: fare_amount"),
    ("missing beats non-positive", with_(trip_distance=-1.0, event_id=...), "Field kosong: event_id"),
    ("negative distance", with_(trip_distance=-3.0), NOT_POSITIVE),
    ("zero fare", with_(fare_amount=0), NOT_POSITIVE),
    ("number as text", with_(total_amount="12.5"), None),
    ("non-numeric text in checked field", with_(total_amount="abc"), NOT_POSITIVE),
    ("bad type elsewhere", with_(vendor_id="abc"), "Tipe tidak valid: vendor_id"),
    ("duplicate key, last wins", json.dumps(GOOD)[:-1] + ', "trip_distance": -1}', NOT_POSITIVE),
]


@pytest.fixture(scope="module")
def validated(spark):
    rows = [
        (raw.encode("utf-8"), f"m-{i}", datetime(2026, 6, 1, 10, 0, i), {"event_id": f"k-{i}"})
        for i, (_, raw, _) in enumerate(CASES)
    ]
    rows.append((b"A\xffB", "m-bytes", datetime(2026, 6, 1, 11), {"event_id": "k-bytes"}))
    env = spark.createDataFrame(rows, ENVELOPE_SCHEMA)
    return {r.message_id: r for r in validate_envelopes(env).collect()}


@pytest.mark.parametrize("i,case", list(enumerate(CASES)), ids=[c[0] for c in CASES])
def test_reason(validated, i, case):
    _, _, reason = case
    assert validated[f"m-{i}"].error_reason == reason


def test_valid_row_is_typed(validated):
    row = validated["m-0"]
    assert row.vendor_id == 1 and row.trip_distance == 2.5
    assert row.pickup_datetime == datetime(2026, 6, 1, 10, 0)


def test_invalid_bytes_are_replaced(validated):
    row = validated["m-bytes"]
    assert row.raw_payload == "A�B"
    assert row.error_reason == BAD_JSON


def test_split_and_rejected_envelope(spark):
    rows = [
        (json.dumps(GOOD).encode(), "m-a", datetime(2026, 6, 1, 10), {"event_id": "e-1"}),
        (with_(trip_distance=-3.0).encode(), "m-b", datetime(2026, 6, 1, 10), {"event_id": "e-2"}),
        (b"{oops", "m-c", datetime(2026, 6, 1, 10), {"event_id": "e-3"}),
    ]
    v = validate_envelopes(spark.createDataFrame(rows, ENVELOPE_SCHEMA))
    valid = valid_events(v)
    assert valid.columns == list(VALID_FIELDS)
    assert valid.count() == 1
    rej = {r.message_id: r for r in rejected_events(v).collect()}
    assert rej["m-b"].event_id == "e-1" and rej["m-b"].event_time == datetime(2026, 6, 1, 10, 20)
    assert rej["m-c"].event_id is None and rej["m-c"].raw_payload == "{oops"
    assert {r.error_type for r in rej.values()} == {"validation_error"}
    assert all(r.pipeline_timestamp is not None for r in rej.values())


def test_dedup_keeps_earliest_and_keyless(spark):
    t = datetime(2026, 6, 1, 10)
    rows = [
        (b"1", "late", datetime(2026, 6, 1, 10, 0, 5), {"event_id": "x"}),
        (b"1", "first", t, {"event_id": "x"}),
        (b"2", "n1", t, {}),
        (b"3", "n2", t, {}),
    ]
    # a hot key holding most rows is combined map-side, not shipped whole
    rows += [(b"h", f"h{i:03d}", datetime(2026, 6, 1, 12, 0, i % 60), {"event_id": "hot"}) for i in range(200)]
    out = dedup_messages(spark.createDataFrame(rows, ENVELOPE_SCHEMA))
    got = sorted(r.message_id for r in out.collect())
    assert got == ["first", "h000", "n1", "n2"]


def test_carrier_payloads_round_trip(spark):
    from tripyard.sources.carriers import trip_envelopes

    env = trip_envelopes(spark.read.parquet("/root/testdata/sf0.001/events.parquet"))
    sample = env.where(~F.col("message_id").endswith("-dup")).limit(50).collect()
    for r in sample:
        text = bytes(r.data).decode()
        seq = int(r.message_id[2:])
        if seq % 10 == 3:
            with pytest.raises(json.JSONDecodeError):
                json.loads(text)
            continue
        event = json.loads(text)
        assert event["event_id"] == f"e-{seq}"
        assert ("vendor_id" in event) == (seq % 10 != 5)


def test_fields_are_typed_once_and_not_in_the_generator(spark):
    """A generator evaluates its fields row by row without compiled code, each as often as it is named."""
    shown = spark.conf.get("spark.sql.debug.maxToStringFields")
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")
    try:
        rows = validate_envelopes(spark.createDataFrame([], ENVELOPE_SCHEMA))
        plan = rows._jdf.queryExecution().sparkPlan().toString()
    finally:
        spark.conf.set("spark.sql.debug.maxToStringFields", shown)
    typing = [line for line in plan.splitlines() if "try_cast" in line]
    assert len(typing) == 1 and "Project" in typing[0]
