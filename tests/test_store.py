"""Named tables: replaced as a whole, opened by other sessions, views by name."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import pytest

from tests.conftest import SF_SMALL
from tripyard.plans.layers import TripLakehouse
from tripyard.plans.marts import GOLD_VIEWS
from tripyard.sources import files, store
from tripyard.sources.store import TableStore

ROOT = Path(__file__).resolve().parents[1]


def numbers(spark, n, day="2026-06-01"):
    return spark.range(n).selectExpr("id", f"DATE'{day}' AS d", "id % 3 AS g")


def test_replace_and_open(spark, scratch):
    own = TableStore(spark, scratch, "replace_test")
    with pytest.raises(LookupError):
        own.open("silver", "t")
    assert own.replace(numbers(spark, 5), "silver", "t", "d", ("g",)).count() == 5
    reader = own.open("silver", "t")
    own.replace(numbers(spark, 7, "2026-06-02"), "silver", "t", "d", ("g",))
    assert reader.count() == 5  # one that began before goes on with its version
    assert own.open("silver", "t").count() == 7
    assert own.open("silver", "t").schema["d"].dataType.simpleString() == "date"
    assert spark.table("replace_test_silver.t").count() == 7
    assert spark.table("replace_test_silver.t").where("d = DATE'2026-06-01'").count() == 0
    own.replace(numbers(spark, 9).selectExpr("id AS other"), "silver", "t")  # other columns, no partitions
    assert own.open("silver", "t").columns == ["other"] and spark.table("replace_test_silver.t").columns == ["other"]


def test_a_build_killed_halfway_leaves_the_old_version(spark, scratch, monkeypatch):
    own = TableStore(spark, scratch, "killed_test")
    own.replace(numbers(spark, 5), "gold", "t")
    write = store.write_table

    def dies(df, path, **kwargs):
        write(df, path, **kwargs)
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(store, "write_table", dies)
        with pytest.raises(KeyboardInterrupt):
            own.replace(numbers(spark, 50), "gold", "t")
    assert own.open("gold", "t").count() == 5 and spark.table("killed_test_gold.t").count() == 5
    own.replace(numbers(spark, 6), "gold", "t")
    assert own.open("gold", "t").count() == 6
    # what the dead build left is gone, as are all but the last versions
    own.replace(numbers(spark, 7), "gold", "t")
    folders = [n for n in files.names(spark, own.folder("gold", "t")) if not n.startswith("_")]
    assert folders == own.versions("gold", "t") and len(folders) == store.KEPT


def test_published_files_are_whole_and_new(spark, scratch):
    files.publish(spark, f"{scratch}/x/a", "té\n")
    assert files.read(spark, f"{scratch}/x/a") == "té\n"
    assert files.names(spark, f"{scratch}/x") == ["a"] and files.names(spark, f"{scratch}/none") == []


def test_layers_are_tables_of_three_namespaces(spark):
    house = TripLakehouse(spark, SF_SMALL, materialize="table", name="layers_test")
    silver = house.silver()
    house.payment_summary()
    found = {(r.layer, r.table_name): r.table_rows for r in house.store.listing().collect()}
    assert found["silver", "trips"] == silver.count() == spark.table("layers_test_silver.trips").count()
    assert {"batch_clean", "stream_clean", "taxi_zone"} <= {t for layer, t in found if layer == "silver"}
    assert found["gold", "payment_summary"] == spark.table("layers_test_gold.payment_summary").count()
    again = TripLakehouse(spark, SF_SMALL, materialize="table", name="layers_test")
    assert again.silver().count() == silver.count()  # replaced; the first one's reader keeps its version
    assert len(again.store.versions("silver", "trips")) == 2


def test_views_follow_the_table(spark, scratch):
    house = TripLakehouse(spark, SF_SMALL, materialize="table", name="views_test")
    for view in GOLD_VIEWS:
        assert house.gold_view(view).count() > 0
    trips = house.silver()
    total = "SELECT SUM(total_trips) FROM views_test_gold.vw_payment_summary"
    assert spark.sql(total).first()[0] == trips.count()
    house.store.replace(trips.limit(10), "silver", "trips", "pickup_date")
    assert spark.sql(total).first()[0] == 10


def test_another_application_opens_tables_and_views_by_name(spark, scratch):
    own = TableStore(spark, scratch, "attach_test")
    own.replace(numbers(spark, 12), "silver", "trips", "d")
    own.replace_view("gold", "vw", "SELECT g, COUNT(*) AS n FROM attach_test_silver.trips GROUP BY g")
    code = f"""
from tripyard.session import build_session
from tripyard.sources.store import TableStore
spark = build_session("local[1]", 1)
print(TableStore(spark, {scratch!r}, "attach_test").attach())
print("got", spark.table("attach_test_silver.trips").where("d = DATE'2026-06-01'").count(), sorted(tuple(r) for r in spark.table("attach_test_gold.vw").collect()))
"""
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=ROOT, timeout=300)
    assert "got 12 [(0, 4), (1, 4), (2, 4)]" in done.stdout, done.stderr[-2000:]


def test_silver_is_written_where_its_days_were_read(spark):
    """Silver's rows are not shuffled again: the clean tables lie by day; with a shuffle join of the zones they are."""
    from tripyard.plans.layers import moves_rows

    house = TripLakehouse(spark, SF_SMALL, materialize="table", name="by_day_test")
    house.batch_clean(), house.stream_clean(), house.zone_dim()
    seen = []
    replace = house.store.replace
    house.store.replace = lambda *args: (seen.append(args[-1]), replace(*args))[1]
    silver = house.silver()
    assert seen == [False] and not moves_rows(house.build_silver())
    other = house.build_silver()
    columns = [c for c in other.columns if c != "silver_loaded_at"]
    assert silver.select(columns).exceptAll(other.select(columns)).count() == 0 and silver.count() == other.count()
    days = silver.select("pickup_date").distinct().count()
    written = files.matching(spark, f"{house.silver_path}/pickup_date=*/*.parquet")
    read = files.matching(spark, f"{house.store.current('silver', 'batch_clean')}/*=*/*.parquet")
    read += files.matching(spark, f"{house.store.current('silver', 'stream_clean')}/*=*/*.parquet")
    assert days <= len(written) <= len(read)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert moves_rows(house.build_silver())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
