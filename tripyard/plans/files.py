"""The layers over real inputs: monthly Parquet files, the zone CSV and the tables that the ingest wrote."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tripyard.plans.layers import TripLakehouse
from tripyard.sources.tables import read_monthly_trips, read_zone_csv
from tripyard.streaming.tables import StreamTables


class FileLakehouse(TripLakehouse):
    """A lakehouse whose staging is read from files; everything above it is the same."""

    def __init__(
        self,
        spark: SparkSession,
        months: Sequence[str],
        zone_csv: str,
        tables: StreamTables,
        materialize: str = "auto",
        name: str | None = None,
    ):
        super().__init__(spark, "", materialize, name)
        self.month_paths, self.zone_csv, self.tables = list(months), zone_csv, tables

    def months(self) -> list[DataFrame]:
        return [read_monthly_trips(self.spark, path) for path in self.month_paths]

    def staging_zone(self) -> DataFrame:
        return read_zone_csv(self.spark, self.zone_csv)

    def stream_staging(self) -> DataFrame:
        return self.tables.valid()

    def rejected_staging(self) -> DataFrame:
        return self.tables.rejected()


def write_inputs(house: TripLakehouse, base: str) -> FileLakehouse:
    """Write a house's staging as real inputs (two months, a CSV, an ingest run) and open them."""
    paths = []
    for i, month in enumerate(house.months()):
        paths.append(f"{base}/month-{i + 1}.parquet")
        month.write.mode("overwrite").parquet(paths[-1])
    house.staging_zone().write.mode("overwrite").option("header", True).csv(f"{base}/zones.csv")
    return FileLakehouse(house.spark, paths, f"{base}/zones.csv", house.stream_tables(), house.materialize, f"{house.name}_files")
