"""Streaming ingest: messages -> de-dup -> validate -> valid / rejected tables.

One streaming query that reads its source once.  De-duplication is the engine's own
stateful operator with its state in RocksDB, so a micro-batch costs in proportion to its
own messages; the first arrival of a key wins.  A key is forgotten once the de-dup
horizon has passed since it arrived, so the state stays bounded, as in a broker; a
message is never late.  Each micro-batch (``foreachBatch``) is then validated once and
committed to the two tables (:mod:`tripyard.streaming.tables`).
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tripyard.operators.events import message_key, rejected_events, valid_events, validate_envelopes
from tripyard.schemas import ENVELOPE_SCHEMA
from tripyard.sources import files
from tripyard.sources.tables import kafka_envelopes, read_envelopes
from tripyard.streaming.tables import StreamTables, batch_name

#: How long a key is remembered.
DEDUP_HORIZON = "7 days"
_STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def write_envelope_files(envelopes: DataFrame, path: str, files: int) -> None:
    """Replay helper: write envelopes as Parquet files in publish-time order.

    Range partitioning makes file k hold earlier messages than file k+1, the order a
    broker would deliver them in; the message id splits a burst within one second.
    """
    (
        envelopes.repartitionByRange(files, "publish_time", "message_id")
        .sortWithinPartitions("publish_time", "message_id")
        .write.mode("overwrite")
        .parquet(path)
    )


def deduplicate(messages: DataFrame, horizon: str | None = DEDUP_HORIZON) -> DataFrame:
    """T1 on a stream: the first arrival of each key (see ``message_key``).

    The watermark runs on the time of arrival (the micro-batch's own time, which a replay
    after a failure repeats), so no first delivery is ever too late, however old it is.
    ``horizon=None`` remembers every key for good.
    """
    keyed = messages.withColumn("_key", message_key())
    if horizon is None:
        return keyed.dropDuplicates(["_key"]).drop("_key")
    timed = keyed.withColumn("_arrived", F.current_timestamp()).withWatermark("_arrived", horizon)
    return timed.dropDuplicatesWithinWatermark(["_key"]).drop("_key", "_arrived")


def query_id(spark: SparkSession, checkpoint_path: str) -> str:
    """The id that a streaming query keeps in its checkpoint."""
    return spark.read.json(f"{checkpoint_path.rstrip('/')}/metadata").first()["id"]


def split_batch(tables: StreamTables, name: str | None = None, checkpoint_path: str | None = None):
    """foreachBatch sink (T7, S5, S6): one batch of messages -> one commit to both tables.

    ``name`` tells this query's batches from those of other queries; by default it is
    the id in ``checkpoint_path``.  A batch that runs again after it was committed changes
    nothing.
    """
    known = {"name": name}

    def sink(batch: DataFrame, batch_id: int) -> None:
        if known["name"] is None:
            known["name"] = query_id(batch.sparkSession, checkpoint_path)
        own = batch_name(known["name"], batch_id)
        if tables.committed(own):
            return
        # one persisted frame feeds both writes
        validated = validate_envelopes(batch).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            tables.append(own, valid_events(validated), rejected_events(validated))
        finally:
            validated.unpersist()

    return sink


def start_ingest(
    spark: SparkSession,
    source_path: str | None,
    tables: StreamTables,
    checkpoint_path: str,
    dedup_horizon: str | None = DEDUP_HORIZON,
    max_files_per_trigger: int | None = None,
    available_now: bool = False,
    processing_time: str | None = None,
    kafka_options: dict[str, str] | None = None,
) -> StreamingQuery:
    """Start the ingest query over envelope files at ``source_path``.

    With ``kafka_options`` (``kafka.bootstrap.servers``, ``subscribe`` ...)
    the source is ``readStream.format("kafka")`` instead, mapped to the same
    envelope columns; nothing downstream changes.
    """
    if kafka_options:
        reader = spark.readStream.format("kafka").option("includeHeaders", "true")
        for key, value in kafka_options.items():
            reader = reader.option(key, value)
        source = kafka_envelopes(reader.load())
    elif max_files_per_trigger:
        reader = spark.readStream.schema(ENVELOPE_SCHEMA).option("maxFilesPerTrigger", max_files_per_trigger)
        source = reader.parquet(source_path)
    else:
        source = read_envelopes(spark, source_path, streaming=True)
    tables.declare()
    writer = (
        deduplicate(source, dedup_horizon)
        .writeStream.foreachBatch(split_batch(tables, checkpoint_path=checkpoint_path))
        .option("checkpointLocation", checkpoint_path)
        .outputMode("append")
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    old = spark.conf.get(_STATE_STORE)
    spark.conf.set(_STATE_STORE, _ROCKSDB)  # the query keeps the setting that it starts with
    try:
        return writer.start()
    finally:
        spark.conf.set(_STATE_STORE, old)


def replay(
    spark: SparkSession, envelopes: DataFrame, base: str, tables: StreamTables, rows_per_file: int, batches: int = 2, **options
) -> StreamTables:
    """Run the ingest over a file replay of ``envelopes`` in a few micro-batches, to its end."""
    if not files.names(spark, f"{base}/source"):
        count = max(batches, -(-envelopes.count() // rows_per_file))
        write_envelope_files(envelopes, f"{base}/source", count)
    count = len([n for n in files.names(spark, f"{base}/source") if n.startswith("part-")])
    query = start_ingest(
        spark, f"{base}/source", tables, f"{base}/checkpoint", max_files_per_trigger=-(-count // batches), available_now=True, **options
    )
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(f"stream ingest failed: {query.exception()}")
    return tables
