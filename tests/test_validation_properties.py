"""Property test: Spark validation agrees with a plain-Python statement of the rules.

Each example is a batch of random events (fields absent, null, zero,
negative or valid; sometimes truncated JSON) validated in one Spark job.
"""

from __future__ import annotations

import json
from datetime import datetime

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tripyard.operators.events import validate_envelopes
from tripyard.schemas import (
    ENVELOPE_SCHEMA,
    POSITIVE_FIELDS,
    REASON_BAD_JSON,
    REASON_MISSING_PREFIX,
    REASON_NOT_POSITIVE,
    VALID_EVENT_SCHEMA,
)
from pyspark.sql import types as T

ABSENT = object()


def value_for(dtype):
    if isinstance(dtype, T.StringType):
        good = st.text(alphabet="abcxyz-1", min_size=1, max_size=6)
    elif isinstance(dtype, T.TimestampNTZType):
        good = st.builds(
            lambda d, h: f"2026-06-{d:02d} {h:02d}:15:00 UTC", st.integers(1, 28), st.integers(0, 23)
        )
    elif isinstance(dtype, T.LongType):
        good = st.integers(-5, 300)
    else:
        good = st.one_of(st.integers(-3, 50), st.floats(-10, 100, allow_nan=False).map(lambda x: round(x, 2)))
    return st.one_of(good, good, good, st.just(None), st.just(ABSENT))


event = st.fixed_dictionaries({f.name: value_for(f.dataType) for f in VALID_EVENT_SCHEMA.fields})
message = st.tuples(event, st.booleans(), st.integers(0, 9))


def encode(ev, truncate, k):
    text = json.dumps({k2: v for k2, v in ev.items() if v is not ABSENT})
    return text[:-1] if truncate and k == 0 else text


def expected_reason(text):
    """The rules as the reference states them (null checked numbers count as missing)."""
    try:
        ev = json.loads(text)
    except json.JSONDecodeError:
        return REASON_BAD_JSON
    missing = [f.name for f in VALID_EVENT_SCHEMA.fields if ev.get(f.name) is None]
    if missing:
        return REASON_MISSING_PREFIX + ", ".join(missing)
    if not all(ev[f] > 0 for f in POSITIVE_FIELDS):
        return REASON_NOT_POSITIVE
    return None


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(message, min_size=20, max_size=60))
def test_reasons_match_python_rules(spark, batch):
    rows, expected = [], {}
    for i, (ev, truncate, k) in enumerate(batch):
        text = encode(ev, truncate, k)
        mid = f"m-{i}"
        rows.append((text.encode(), mid, datetime(2026, 6, 1), {"event_id": f"k-{i}"}))
        expected[mid] = expected_reason(text)
    got = {
        r.message_id: r.error_reason
        for r in validate_envelopes(spark.createDataFrame(rows, ENVELOPE_SCHEMA)).collect()
    }
    assert got == expected
