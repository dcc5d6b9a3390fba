"""Structured Streaming ingest equals its batch twin; batch replays are idempotent."""

from __future__ import annotations

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tripyard.operators.events import dedup_messages, message_key
from tripyard.plans.layers import TripLakehouse
from tripyard.schemas import ENVELOPE_SCHEMA
from tripyard.streaming.ingest import split_batch, start_ingest, write_envelope_files
from tripyard.streaming.tables import VALID, SchemaMismatch, StreamTables
from tests.conftest import SF_SMALL


def test_stream_equals_batch_twin(spark, scratch):
    h = TripLakehouse(spark, SF_SMALL, materialize="none")
    write_envelope_files(h.envelopes(), f"{scratch}/src", files=4)
    tables = StreamTables(spark, f"{scratch}/tables")
    q = start_ingest(spark, f"{scratch}/src", tables, f"{scratch}/ckpt", max_files_per_trigger=1, available_now=True)
    q.awaitTermination(600)
    assert q.exception() is None
    valid, rejected = tables.valid(), tables.rejected()
    twin_valid = h.stream_staging()
    assert valid.exceptAll(twin_valid).count() == 0
    assert twin_valid.exceptAll(valid).count() == 0
    cols = [c for c in rejected.columns if c != "pipeline_timestamp"]
    twin_rej = h.rejected_staging().select(*cols)
    assert rejected.select(*cols).exceptAll(twin_rej).count() == 0
    assert twin_rej.exceptAll(rejected.select(*cols)).count() == 0
    # invariant: valid + rejected = distinct event ids delivered
    distinct = h.envelopes().select(message_key()).distinct().count()
    assert valid.count() + rejected.count() == distinct
    # keyless messages and bad bytes come through, bracket endings do not
    assert valid.where("publisher_name = 'te\ufffdst'").count() == 20
    assert rejected.where("raw_payload LIKE '%],[1' AND error_reason = 'JSON tidak valid'").count() == 20


def test_replayed_batch_changes_nothing(spark, scratch):
    h = TripLakehouse(spark, SF_SMALL, materialize="none")
    env = h.stream_messages()
    tables = StreamTables(spark, f"{scratch}/tables")
    assert tables.valid().count() == 0  # readable before the first commit
    sink = split_batch(tables, "one")
    sink(env, 0)
    first = tables.valid().count()
    sink(env, 0)  # the same batch again after a failure
    assert tables.valid().count() == first == h.stream_staging().count()
    split_batch(tables, "two")(env, 0)  # another query's first batch
    assert tables.valid().count() == 2 * first


def test_few_files_for_each_date_and_batch(spark, scratch):
    h = TripLakehouse(spark, SF_SMALL, materialize="none")
    tables = StreamTables(spark, f"{scratch}/tables")
    split_batch(tables, "one")(h.stream_messages(), 0)
    files = tables.valid().inputFiles()
    dates = {f.split("event_date=")[1].split("/")[0] for f in files}
    assert all("/batch=one-0-" in f for f in files) and len(files) <= 2 * len(dates)


def _run(spark, scratch, files, n):
    """Each list of messages is one file and one micro-batch."""
    import time

    for i, rows in enumerate(files):
        spark.createDataFrame(rows, ENVELOPE_SCHEMA).coalesce(1).write.mode("append").parquet(f"{scratch}/src")
        time.sleep(1.1)  # files are taken by modification time
    tables = StreamTables(spark, f"{scratch}/tables")
    q = start_ingest(spark, f"{scratch}/src", tables, f"{scratch}/ckpt{n}", max_files_per_trigger=1, available_now=True)
    q.awaitTermination(600)
    assert q.exception() is None
    return tables


def _message(key, mid, minute, body=None):
    payload = json.dumps({"event_id": body or key}).encode()
    return (payload, mid, datetime(2026, 6, 1, 10, minute), {"event_id": key} if key else {})


def test_repeats_across_batches_and_keyless_messages(spark, scratch):
    """The first arrival wins, also when it was published later; messages without a key are told apart by themselves."""
    files = [
        [_message("a", "m1", 5), _message(None, None, 1, "x"), _message(None, None, 1, "y")],
        [_message("a", "m0", 0), _message("b", "m2", 6), _message(None, None, 1, "x"), _message(None, "n", 1, "x")],
        [_message("b", "m3", 1), _message("a", "m4", 9), _message(None, None, 2, "x")],
    ]
    tables = _run(spark, scratch, files, 0)
    assert tables.valid().count() == 0  # every message is rejected: the table is readable
    assert sorted(str(r.message_id) for r in tables.rejected().collect()) == ["None", "None", "None", "m1", "m2", "n"]
    _run(spark, scratch, [], 1)  # a new checkpoint reads all again and replaces nothing
    assert tables.rejected().count() == 12


def test_batch_twin_keeps_different_keyless_messages(spark):
    rows = [_message(None, None, 1, "x"), _message(None, None, 1, "y"), _message("a", "m1", 5), _message("a", "m0", 0), _message(None, None, 1, "x")]
    got = dedup_messages(spark.createDataFrame(rows, ENVELOPE_SCHEMA)).collect()
    assert sorted(str(r.message_id) for r in got) == ["None", "None", "m0"]


def test_kafka_records_map_to_envelopes(spark):
    from datetime import datetime, timezone

    from tripyard.schemas import ENVELOPE_SCHEMA
    from tripyard.sources.tables import kafka_envelopes

    schema = (
        "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp, "
        "timestampType int, headers array<struct<key:string,value:binary>>"
    )
    ts = datetime(2026, 6, 1, 10, 0, tzinfo=timezone.utc)
    rows = [(None, b'{"a":1}', "trips", 3, 42, ts, 0, [("event_id", b"e-7")]), (None, b"x", "trips", 0, 1, ts, 0, None)]
    env = kafka_envelopes(spark.createDataFrame(rows, schema))
    assert [(f.name, f.dataType.simpleString()) for f in env.schema] == [
        (f.name, f.dataType.simpleString()) for f in ENVELOPE_SCHEMA
    ]
    got = {r.message_id: r for r in env.collect()}
    assert got["trips-3-42"].attributes == {"event_id": "e-7"}
    assert got["trips-0-1"].attributes == {}
    assert got["trips-3-42"].publish_time == datetime(2026, 6, 1, 10, 0)


def test_repeated_kafka_header(spark):
    from datetime import timezone

    from tripyard.sources.tables import kafka_envelopes

    schema = "value binary, topic string, partition int, offset bigint, timestamp timestamp, headers array<struct<key:string,value:binary>>"
    rows = [(b"x", "t", 0, 1, datetime(2026, 6, 1, tzinfo=timezone.utc), [("event_id", b"old"), ("h", b"1"), ("event_id", b"new")])]
    assert kafka_envelopes(spark.createDataFrame(rows, schema)).first().attributes == {"event_id": "new", "h": "1"}


def test_one_source_read_with_and_without_a_horizon(spark, scratch):
    """With a horizon the plan has the bounded de-dup, without one the exact one; the source is read once."""
    from tripyard.streaming.ingest import deduplicate

    spark.createDataFrame([], ENVELOPE_SCHEMA).write.parquet(f"{scratch}/src")
    stream = spark.readStream.schema(ENVELOPE_SCHEMA).parquet(f"{scratch}/src")
    bounded = deduplicate(stream)._jdf.queryExecution().logical().toString()
    assert "DeduplicateWithinWatermark" in bounded and bounded.count("StreamingRelation") == 1
    assert "Deduplicate [_key" in deduplicate(stream, None)._jdf.queryExecution().logical().toString()


def test_keys_are_forgotten_after_the_horizon(spark, scratch):
    """The state shrinks, a repeat beyond the horizon passes again, and an old message that is new is never late."""
    import time

    tables = StreamTables(spark, f"{scratch}/tables")

    def deliver(rows) -> list[int]:
        spark.createDataFrame(rows, ENVELOPE_SCHEMA).coalesce(1).write.mode("append").parquet(f"{scratch}/src")
        q = start_ingest(spark, f"{scratch}/src", tables, f"{scratch}/ckpt", dedup_horizon="3 seconds", available_now=True)
        q.awaitTermination(600)
        assert q.exception() is None
        return [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]]

    assert max(deliver([_message(f"k{i}", f"m{i}", 5) for i in range(50)])) == 50
    time.sleep(4)
    deliver([_message("late", "old", 0)])  # published before all others
    time.sleep(4)
    left = deliver([_message("k0", "again", 50)])
    assert left[-1] <= 2
    assert sorted(r.message_id for r in tables.rejected().where("event_id IN ('k0', 'late')").collect()) == ["again", "m0", "old"]


def _two_batches(spark, scratch, namespace=None):
    h = TripLakehouse(spark, SF_SMALL, materialize="none")
    tables = StreamTables(spark, f"{scratch}/tables", namespace)
    tables.declare()
    env = h.stream_messages()
    sink = split_batch(tables, "q")
    for i in range(2):
        sink(env.where(f"crc32(data) % 2 = {i}"), i)
    return h, tables


def test_a_run_killed_between_the_two_writes_shows_neither(spark, scratch, monkeypatch):
    _, tables = _two_batches(spark, scratch)
    valid, rejected = tables.valid().count(), tables.rejected().count()
    write = StreamTables._write

    def dies(self, df, table, batch):
        if table.name == "stream_events_rejected":
            raise KeyboardInterrupt
        write(self, df, table, batch)

    h = TripLakehouse(spark, SF_SMALL, materialize="none")
    with monkeypatch.context() as m:
        m.setattr(StreamTables, "_write", dies)
        try:
            split_batch(tables, "other")(h.stream_messages(), 0)
        except KeyboardInterrupt:
            pass
    assert spark.read.parquet(f"{scratch}/tables/stream_events_valid").count() == 2 * valid  # its files are there
    assert (tables.valid().count(), tables.rejected().count()) == (valid, rejected)
    split_batch(tables, "other")(h.stream_messages(), 0)  # the batch runs again
    assert (tables.valid().count(), tables.rejected().count()) == (2 * valid, 2 * rejected)
    assert tables.counts().first()["total_stream"] == 2 * valid
    assert tables.vacuum(grace_seconds=0) > 0
    assert spark.read.parquet(f"{scratch}/tables/stream_events_valid").count() == 2 * valid


def test_compaction_is_not_noticed(spark, scratch):
    h, tables = _two_batches(spark, scratch, "compaction_test")
    open_reader, before = tables.valid(), tables.valid().exceptAll(h.stream_staging()).count()

    def files_read(df) -> int:
        return df.select(F.input_file_name()).distinct().count()

    files = files_read(tables.valid())
    assert tables.compact() is not None and tables.compact() is None
    after = tables.valid()
    dates = spark.table("compaction_test.stream_events_valid").select("event_date").distinct().count()
    assert files_read(after) <= 1.2 * dates < files
    for frame in (open_reader, after, tables.table(VALID).select(*after.columns)):  # a reader that began before reads on
        assert frame.exceptAll(h.stream_staging()).count() == before == 0
        assert frame.count() == h.stream_staging().count()
    split_batch(tables, "q")(h.stream_messages(), 1)  # compacted batches are still known
    assert tables.valid().count() == after.count()
    tables.vacuum(grace_seconds=0)
    assert tables.valid().count() == after.count() and tables.rejected().count() == 340
    split_batch(tables, "q")(h.stream_messages(), 1)  # the query's last batch is known for good
    assert tables.valid().count() == after.count()


def test_declared_tables_check_rows_and_prune_dates(spark, scratch):
    h, tables = _two_batches(spark, scratch, "declared_test")
    valid, rejected = h.stream_staging(), tables.rejected()
    for wrong in (valid.drop("fare_amount"), valid.withColumn("fare_amount", F.lit("1")), valid.withColumnRenamed("extra", "more")):
        with pytest.raises(SchemaMismatch):
            tables.append("bad", wrong, rejected)
    named = spark.table("declared_test.stream_events_valid")
    assert named.count() == valid.count()
    day = named.agg(F.min("event_date")).first()[0]
    one = named.where(F.col("event_date") == F.lit(day))
    assert "PartitionFilters: [isnotnull(event_date" in one._jdf.queryExecution().executedPlan().toString()
    assert all(f"event_date={day}" in f for f in one.inputFiles()) and 0 < one.count() < valid.count()
    spark.sql("DROP TABLE declared_test.stream_events_valid")
    tables.declare()  # as another session would
    assert spark.table("declared_test.stream_events_valid").count() == valid.count()


def test_bounded_replay_has_files_of_a_fixed_size(spark, monkeypatch):
    """The bounded ingest's files, each sorted by one task, do not grow with the messages."""
    from tripyard import registry
    from tripyard.sources import files

    h = TripLakehouse(spark, SF_SMALL, materialize="none")
    messages = h.envelopes().count()
    monkeypatch.setattr(registry, "REPLAY_ROWS_PER_FILE", 150)
    got = registry._bounded_dedup(h)
    written = [n for n in files.names(spark, f"{registry._run_folder(h, 'bounded')}/source") if n.startswith("part-")]
    assert len(written) == -(-messages // 150) > 3
    twin = h.stream_staging()
    assert got.exceptAll(twin).count() == twin.exceptAll(got).count() == 0
