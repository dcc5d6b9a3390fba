"""Gold summaries over silver trips (A1-A3).

Each is one aggregation: a partial (map-side) aggregate, one shuffle on the grouping
keys, a final aggregate.  A summary is defined once, as SQL over any trip table
(:func:`summary_sql`); the DataFrame functions and the stored views of the gold
namespace run the same text.  Views carry no ORDER BY (ordering binds no reader);
consumers order.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from tripyard.functions.money import money_sum_sql, round2_mean_sql, round2_sum_sql
from tripyard.schemas import UNKNOWN_ZONE


@dataclass(frozen=True)
class Summary:
    """Grouping keys, measures by name, and the output columns in order (name, or name -> expression on the groups)."""

    keys: tuple[str, ...]
    measures: dict[str, str]
    shown: dict[str, str]

    def columns(self) -> list[str]:
        """The keys before ``source_type``, the measures, ``source_type``."""
        return [*self.keys[:-1], *self.measures, self.keys[-1]]


_TRIPS = "COUNT(pickup_datetime)"

DAILY = Summary(
    keys=(
        "pickup_date", "pickup_day_name", "is_weekend", "pickup_hour", "time_period", "trip_duration_minutes", "source_type",
    ),
    measures={
        "total_trips": _TRIPS,
        "average_duration_minutes": round2_mean_sql("trip_duration_minutes"),
        "average_trip_distance": round2_mean_sql("trip_distance"),
        "total_revenue": money_sum_sql("total_amount"),
        "average_revenue": round2_mean_sql("total_amount"),
        "average_fare": round2_mean_sql("fare_amount"),
        "average_tip": round2_mean_sql("tip_amount"),
    },
    shown={},
)

PAYMENT = Summary(
    keys=("payment_type_name", "vendor_name", "pickup_zone", "dropoff_zone", "source_type"),
    measures={
        "total_trips": _TRIPS,
        "total_revenue": round2_sum_sql("total_amount"),
        "average_revenue": round2_mean_sql("total_amount"),
        "total_tip": round2_sum_sql("tip_amount"),
        "average_tip_amount": round2_mean_sql("tip_amount"),
        "average_fare_amount": round2_mean_sql("fare_amount"),
    },
    shown={},
)

# Grouped by the raw zone names; NULL names are shown as 'unknown' after grouping.
ZONES = Summary(
    keys=(
        "pickup_borough", "pickup_zone", "pickup_service_zone", "dropoff_borough", "dropoff_zone", "dropoff_service_zone", "source_type",
    ),
    measures={
        "total_trips": _TRIPS,
        "total_revenue": money_sum_sql("total_amount"),
        "average_revenue": round2_mean_sql("total_amount"),
        "average_fare_amount": round2_mean_sql("fare_amount"),
        "average_tip_amount": round2_mean_sql("tip_amount"),
        "average_trip_distance": round2_mean_sql("trip_distance"),
        "average_trip_duration": round2_mean_sql("trip_duration_minutes"),
    },
    shown={name: f"COALESCE({name}, '{UNKNOWN_ZONE}')" for name in ("pickup_zone", "dropoff_zone")},
)

#: Name of the gold view -> its definition.
GOLD_VIEWS = {"vw_daily_trip_summary": DAILY, "vw_payment_summary": PAYMENT, "vw_zone_performance": ZONES}


def summary_sql(summary: Summary, trips: str) -> str:
    """The summary as one SQL statement over the table ``trips``."""
    measures = ", ".join(f"{sql} AS {name}" for name, sql in summary.measures.items())
    keys = ", ".join(summary.keys)
    shown = ", ".join(f"{summary.shown[c]} AS {c}" if c in summary.shown else c for c in summary.columns())
    return f"SELECT {shown} FROM (SELECT {keys}, {measures} FROM {trips} GROUP BY {keys})"


def _summarise(summary: Summary, silver: DataFrame) -> DataFrame:
    return silver.sparkSession.sql(summary_sql(summary, "{trips}"), trips=silver)


def daily_trip_summary(silver: DataFrame) -> DataFrame:
    """A1: per day / hour / period / duration / source; total_revenue unrounded."""
    return _summarise(DAILY, silver)


def payment_summary(silver: DataFrame) -> DataFrame:
    """A2: per payment name / vendor / zones / source (NULL zones form their own group)."""
    return _summarise(PAYMENT, silver)


def zone_performance(silver: DataFrame) -> DataFrame:
    """A3: per pickup/dropoff zone attributes and source."""
    return _summarise(ZONES, silver)
