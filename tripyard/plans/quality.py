"""Data-quality gates between the layers.

Each report is a DataFrame; :func:`run_gate` is the runner that fails a job
when the first row of a report is missing or has a falsy value.  Global
numbers are combined with scalar subqueries over one-row aggregates (no
joins), so each one is a partial + final aggregate.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SOURCES = ("batch", "stream")
_VOLUME = "trip_year bigint, trip_month bigint, source_type string, total_trips bigint"
_PROFILE = (
    "source_type string, total_rows bigint, duration_zero_or_negative bigint, duration_over_240 bigint, "
    "minimum_duration bigint, maximum_duration bigint"
)


class GateFailed(AssertionError):
    """A data-quality gate did not pass."""


def run_gate(report: DataFrame, name: str = "gate") -> dict:
    """Evaluate a report, take its first row, fail unless every value is truthy."""
    row = report.first()
    if row is None:
        raise GateFailed(f"{name}: no row")
    values = row.asDict()
    falsy = [k for k, v in values.items() if not v]
    if falsy:
        raise GateFailed(f"{name}: falsy values in {falsy}: {values}")
    return values


def staging_ready(
    spark: SparkSession, april: DataFrame, may: DataFrame, zone: DataFrame, stream: DataFrame
) -> DataFrame:
    """G1: the four staging tables are non-empty (EXISTS stops at the first row)."""
    return spark.range(1).select(
        april.exists().alias("april_ready"),
        may.exists().alias("may_ready"),
        zone.exists().alias("zone_ready"),
        stream.exists().alias("stream_ready"),
    )


def monthly_volume(trips: DataFrame, count_alias: str = "trip_count") -> DataFrame:
    """Trips per (year, month, source), in that order."""
    return trips.groupBy(
        F.year("pickup_datetime").cast("bigint").alias("trip_year"),
        F.month("pickup_datetime").cast("bigint").alias("trip_month"),
        F.col("source_type"),
    ).agg(F.count("pickup_datetime").alias(count_alias)).orderBy("trip_year", "trip_month", "source_type")


def duration_profile(silver: DataFrame) -> DataFrame:
    """Per source: rows, durations <= 0, durations > 240 min, min, max."""
    d = F.col("trip_duration_minutes")
    return silver.groupBy("source_type").agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(d <= 0).alias("duration_zero_or_negative"),
        F.count_if(d > 240).alias("duration_over_240"),
        F.min(d).alias("minimum_duration"),
        F.max(d).alias("maximum_duration"),
    ).orderBy("source_type")


def silver_gate(spark: SparkSession, silver: DataFrame) -> DataFrame:
    """G2 as an explicit boolean gate: no duration violation and silver non-empty."""
    d = F.col("trip_duration_minutes")
    stats = silver.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if((d <= 0) | (d > 240)).alias("violations"),
    )
    return stats.select(
        (F.col("rows") > 0).alias("silver_not_empty"),
        (F.col("violations") == 0).alias("durations_valid"),
    )


def months_of(window: tuple[datetime, datetime]) -> list[tuple[int, int]]:
    """The (year, month)s of a half-open window."""
    start, end = window
    first, last = start.year * 12 + start.month - 1, end.year * 12 + end.month - 1
    whole = end == datetime(end.year, end.month, 1)
    return [(m // 12, m % 12 + 1) for m in range(first, last if whole else last + 1)]


def silver_measures(window: tuple[datetime, datetime]) -> list[Column]:
    """What A10, A11 and G2 need, as aggregates without groups: silver's rows lie in the
    window's months and come from two sources, so there are few."""
    d, at = F.col("trip_duration_minutes"), F.col("pickup_datetime")
    out = [F.count(F.lit(1)).alias("rows"), F.count_if((d <= 0) | (d > 240)).alias("violations")]
    for source in SOURCES:
        own = F.col("source_type") == source
        out += [
            F.count_if(own).alias(f"{source}_rows"), F.count_if(own & (d <= 0)).alias(f"{source}_low"),
            F.count_if(own & (d > 240)).alias(f"{source}_high"), F.min(F.when(own, d)).alias(f"{source}_min"),
            F.max(F.when(own, d)).alias(f"{source}_max"),
        ]
        out += [
            F.count_if(own & (F.year(at) == y) & (F.month(at) == m)).alias(f"{source}_{y}_{m}") for y, m in months_of(window)
        ]
    return out


class SilverReports:
    """A10, A11 and G2 from the measures of silver's writing pass.

    A stage that was run again after a lost executor may be measured twice.  So the
    measures count only if they agree with the number of rows that the written files'
    footers give; else, or without measures, the reports read the table.
    """

    def __init__(self, silver: DataFrame, measured: dict | None, window: tuple[datetime, datetime]):
        self.silver, self.window = silver, window
        parts = [f"{source}_{y}_{m}" for source in SOURCES for y, m in months_of(window)]
        good = measured is not None and measured["rows"] == sum(measured[p] for p in parts) == silver.count()
        self.measured = measured if good else None

    def _frame(self, rows: list[tuple], schema: str) -> DataFrame:
        return self.silver.sparkSession.createDataFrame(rows, schema)

    def volume(self) -> DataFrame:
        """A10."""
        if self.measured is None:
            return monthly_volume(self.silver, "total_trips")
        counts = [(y, m, s, self.measured[f"{s}_{y}_{m}"]) for y, m in months_of(self.window) for s in SOURCES]
        return self._frame([c for c in counts if c[3]], _VOLUME)

    def durations(self) -> DataFrame:
        """A11."""
        if self.measured is None:
            return duration_profile(self.silver)
        rows = [(s, *(self.measured[f"{s}_{x}"] for x in ("rows", "low", "high", "min", "max"))) for s in SOURCES]
        return self._frame([r for r in rows if r[1]], _PROFILE)

    def gate(self) -> DataFrame:
        """G2."""
        if self.measured is None:
            return silver_gate(self.silver.sparkSession, self.silver)
        m = self.measured
        return self._frame([(m["rows"] > 0, m["violations"] == 0)], "silver_not_empty boolean, durations_valid boolean")


def gold_reconciliation(
    spark: SparkSession, silver: DataFrame, daily: DataFrame, payment: DataFrame, zones: DataFrame
) -> DataFrame:
    """Silver row count equals the trips summed over each gold summary."""
    total = silver.agg(F.count(F.lit(1))).scalar()
    sums = [v.agg(F.sum("total_trips")).scalar() for v in (daily, payment, zones)]
    return spark.range(1).select(
        total.alias("silver_rows"),
        sums[0].alias("daily_trips"),
        sums[1].alias("payment_trips"),
        sums[2].alias("zone_trips"),
        ((total == sums[0]) & (total == sums[1]) & (total == sums[2])).alias("reconciled"),
    )


def zone_key_unique(zone_dim: DataFrame) -> DataFrame:
    """Every location id appears once in the zone dimension."""
    per_key = zone_dim.groupBy("location_id").agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.sum("n").alias("zone_rows"),
        F.count(F.lit(1)).alias("distinct_keys"),
        F.count_if(F.col("n") > 1).alias("duplicate_keys"),
    ).select("*", (F.col("duplicate_keys") == 0).alias("key_unique"))


def stream_table_counts(spark: SparkSession, valid: DataFrame, rejected: DataFrame) -> DataFrame:
    """Row counts of the valid and rejected stream tables."""
    return spark.range(1).select(
        valid.agg(F.count(F.lit(1))).scalar().alias("total_stream"),
        rejected.agg(F.count(F.lit(1))).scalar().alias("total_rejected"),
    )


def rejected_by_reason(rejected: DataFrame) -> DataFrame:
    """Rejected events per error type and reason."""
    return rejected.groupBy("error_type", "error_reason").agg(
        F.count(F.lit(1)).alias("rejected_events")
    )
