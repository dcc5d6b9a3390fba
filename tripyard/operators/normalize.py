"""Raw -> clean trips: safe casts, quality filters, canonical layout."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripyard.functions.casts import safe_cast
from tripyard.functions.timeattrs import minutes_between, seconds_between
from tripyard.schemas import CLEAN_COLUMNS, RAW_TRIP_COLUMNS

# Half-open pickup windows [start, end) per layer (parameters, not constants
# of the operator).
BATCH_WINDOW = (datetime(2026, 4, 1), datetime(2026, 6, 1))
STREAM_WINDOW = (datetime(2026, 6, 1), datetime(2026, 8, 1))
SILVER_WINDOW = (datetime(2026, 4, 1), datetime(2026, 8, 1))
# Inclusive trip-duration gate in seconds (5 min .. 4 h).
DURATION_GATE_SECONDS = (300, 14400)


def ntz_literal(value: datetime) -> Column:
    """A TIMESTAMP_NTZ literal (wall clock, independent of the session zone)."""
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")


def union_all(*frames: DataFrame) -> DataFrame:
    """UNION ALL by column name (duplicates kept)."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def _typed_null(target: str) -> Column:
    return F.lit(None).cast("timestamp_ntz" if target == "timestamp" else target)


def normalize_raw_trips(raw: DataFrame) -> DataFrame:
    """Rename and SAFE_CAST the 20 raw trip columns (types chosen from the input).

    A column that the input lacks becomes typed nulls, and further columns are left out,
    so months whose files differ have one layout afterwards.
    """
    types = {f.name: f.dataType for f in raw.schema.fields}
    return raw.select(
        *[
            (safe_cast(F.col(src), types[src], target) if src in types else _typed_null(target)).alias(dst)
            for src, dst, target in RAW_TRIP_COLUMNS
        ]
    )


def union_months(*monthly_raw: DataFrame) -> DataFrame:
    """U1 for months whose files may differ: each month is reconciled to the clean names and types before the union."""
    return union_all(*[normalize_raw_trips(month) for month in monthly_raw])


def _positive(c: str) -> Column:
    # NaN > 0 is true in Spark but false in the warehouse: exclude NaN.
    return (F.col(c) > 0) & ~F.isnan(F.col(c))


def trip_quality_filter(df: DataFrame, window: tuple[datetime, datetime] | None) -> Column:
    """P2-P5 predicate: both times present, dropoff after pickup, positive
    distance/fare/total, pickup in the half-open ``window``."""
    pred = (
        F.col("pickup_datetime").isNotNull()
        & F.col("dropoff_datetime").isNotNull()
        & (F.col("dropoff_datetime") > F.col("pickup_datetime"))
        & _positive("trip_distance")
        & _positive("fare_amount")
        & _positive("total_amount")
    )
    if window is not None:
        start, end = window
        pred = pred & (F.col("pickup_datetime") >= ntz_literal(start)) & (
            F.col("pickup_datetime") < ntz_literal(end)
        )
    return pred


def duration_gate(lo_hi: tuple[int, int] = DURATION_GATE_SECONDS) -> Column:
    """Trip duration in seconds BETWEEN lo AND hi (inclusive)."""
    lo, hi = lo_hi
    return seconds_between(F.col("pickup_datetime"), F.col("dropoff_datetime")).between(lo, hi)


def to_clean_layout(df: DataFrame, source_type: str, with_event_id: bool) -> DataFrame:
    """Canonical 24-column clean layout.

    ``source_type`` is a lineage literal that overrides any payload value;
    batch rows get a typed NULL ``event_id``.
    """
    extra = {
        "trip_duration_minutes": minutes_between(F.col("pickup_datetime"), F.col("dropoff_datetime")),
        "source_type": F.lit(source_type),
        "event_id": F.col("event_id") if with_event_id else F.lit(None).cast("string"),
        "silver_loaded_at": F.current_timestamp(),
    }
    return df.select(*[extra[c].alias(c) if c in extra else F.col(c) for c in CLEAN_COLUMNS])


def clean_batch_trips(
    *monthly_raw: DataFrame, window: tuple[datetime, datetime] | None = BATCH_WINDOW
) -> DataFrame:
    """Batch clean table: normalise each month -> UNION ALL -> filter -> layout."""
    normalized = union_months(*monthly_raw)
    return to_clean_layout(
        normalized.where(trip_quality_filter(normalized, window)), "batch", with_event_id=False
    )


def clean_stream_trips(
    valid_events: DataFrame, window: tuple[datetime, datetime] | None = STREAM_WINDOW
) -> DataFrame:
    """Stream clean table from valid events; works on batch and streaming frames."""
    return to_clean_layout(
        valid_events.where(trip_quality_filter(valid_events, window)), "stream", with_event_id=True
    )
