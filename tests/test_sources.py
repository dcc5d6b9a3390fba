"""Real input formats: monthly Parquet files, zone CSV, namespaces."""

from __future__ import annotations

from pyspark.sql import functions as F

from tripyard.operators.normalize import clean_batch_trips
from tripyard.operators.zones import build_zone_dim
from tripyard.sources.carriers import raw_trip_months, zone_lookup_rows
from tripyard.sources.sinks import create_namespace
from tripyard.sources.tables import read_monthly_trips, read_zone_csv
from tests.conftest import SF_SMALL


def _drop_load_time(df):
    return df.drop("silver_loaded_at")


def test_monthly_parquet_files_clean_like_the_carrier(spark, scratch):
    lineitem = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    april, may = raw_trip_months(lineitem)
    april.write.parquet(f"{scratch}/2026-04.parquet")
    may.write.parquet(f"{scratch}/2026-05.parquet")
    from_files = clean_batch_trips(
        read_monthly_trips(spark, f"{scratch}/2026-04.parquet"),
        read_monthly_trips(spark, f"{scratch}/2026-05.parquet"),
    )
    direct = clean_batch_trips(april, may)
    assert _drop_load_time(from_files).exceptAll(_drop_load_time(direct)).count() == 0
    assert from_files.count() == direct.count() > 0


def test_zone_csv_with_header_padding_and_quotes(spark, scratch):
    rows = zone_lookup_rows(spark.read.parquet(f"{SF_SMALL}/nation.parquet"),
                            spark.read.parquet(f"{SF_SMALL}/region.parquet"))
    extra = spark.createDataFrame([(99, " Queens ", "Jamaica, South ", "Boro Zone")],
                                  "LocationID bigint, Borough string, Zone string, service_zone string")
    rows.unionByName(extra).coalesce(1).write.option("header", True).csv(f"{scratch}/zones.csv")
    expected = build_zone_dim(rows.unionByName(extra))
    for infer in (False, True):
        got = build_zone_dim(read_zone_csv(spark, f"{scratch}/zones.csv", infer_schema=infer))
        assert got.exceptAll(expected).count() == 0 and expected.exceptAll(got).count() == 0
    names = {r.zone_name for r in expected.where(F.col("location_id") == 99).collect()}
    assert names == {"Jamaica, South"}


def test_create_namespace_is_idempotent(spark):
    for _ in range(2):
        create_namespace(spark, "trip_silver")
    assert "trip_silver" in [d.name for d in spark.catalog.listDatabases()]


def test_months_whose_files_differ(spark, scratch):
    """A missing column becomes typed nulls, other types are cast, further columns are left out."""
    from tripyard.operators.normalize import normalize_raw_trips, union_months

    april, may = raw_trip_months(spark.read.parquet(f"{SF_SMALL}/lineitem.parquet"))
    june = (
        april.drop("cbd_congestion_fee", "store_and_fwd_flag")
        .withColumn("trip_distance", F.col("trip_distance").cast("int"))
        .withColumn("PULocationID", F.col("PULocationID").cast("string"))
        .withColumn("request_source", F.lit("x"))
    )
    june.write.parquet(f"{scratch}/june")
    got = union_months(may, read_monthly_trips(spark, f"{scratch}/june"))
    assert got.schema.simpleString() == normalize_raw_trips(may).schema.simpleString()
    assert got.count() == may.count() + april.count()
    assert got.where("cbd_congestion_fee IS NULL").count() == april.count()
    assert clean_batch_trips(may, june).count() > clean_batch_trips(may).count()
    no_rows = union_months(may.limit(0), june.select("VendorID").limit(0))
    assert no_rows.count() == 0


def test_loading_a_month_again_touches_no_other(spark, scratch):
    from tripyard.operators.normalize import normalize_raw_trips
    from tripyard.sources import files
    from tripyard.sources.sinks import load_month, read_months

    months = [normalize_raw_trips(m) for m in raw_trip_months(spark.read.parquet(f"{SF_SMALL}/lineitem.parquet"))]
    path = f"{scratch}/staging"
    load_month(months[0], path, "2026-04")
    load_month(months[1], path, "2026-05")
    before = read_months(spark, path, months[0].schema).groupBy("load_month").count().collect()
    may = files.stamps(spark, f"{path}/load_month=2026-05")
    april = files.stamps(spark, f"{path}/load_month=2026-04")
    load_month(months[0], path, "2026-04")
    after = read_months(spark, path, months[0].schema)
    assert sorted(after.groupBy("load_month").count().collect()) == sorted(before)
    assert files.stamps(spark, f"{path}/load_month=2026-05") == may != []
    assert files.stamps(spark, f"{path}/load_month=2026-04") != april
    load_month(months[1].limit(3), path, "2026-04")  # a month's object that was put right
    assert read_months(spark, path, months[0].schema).where("load_month = '2026-04'").count() == 3
