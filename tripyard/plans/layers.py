"""The medallion layers as lazily built DataFrames over one input folder.

Staging (raw months, zone rows, stream envelopes) -> silver (batch clean,
stream clean, zone dimension, enriched trips) -> gold (three summaries).
Every layer that more than one consumer reads (stream staging, clean
tables, zone dimension, silver, the summaries) is materialised once per
input, like the reference's CTAS tables: as a named, replaceable table
(date-partitioned where the reference partitions) of a
:class:`~tripyard.sources.store.TableStore` in the shared folder when the
session names one -- lineage cut, survives lost executors, opened by other
sessions -- else persisted with MEMORY_AND_DISK.

The pass that writes silver also measures it (``DataFrame.observe``), so the
silver gate and the reports on silver need no scan of their own.
"""

from __future__ import annotations

import uuid
from datetime import datetime
from functools import cached_property

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tripyard.operators.events import (
    dedup_messages,
    rejected_events,
    valid_events,
    validate_envelopes,
)
from tripyard.operators.labels import silver_projection
from tripyard.operators.normalize import (
    BATCH_WINDOW,
    SILVER_WINDOW,
    STREAM_WINDOW,
    clean_batch_trips,
    clean_stream_trips,
    duration_gate,
    ntz_literal,
    trip_quality_filter,
    union_all,
)
from tripyard.operators.zones import attach_zones, build_zone_dim
from tripyard.plans import marts, quality
from tripyard.session import checkpoint_root, ensure_checkpoint_dir
from tripyard.sources.carriers import raw_trip_months, trip_envelopes, zone_lookup_rows
from tripyard.sources.sinks import layer_path
from tripyard.sources.store import TableStore
from tripyard.sources.tables import read_parquet_table

SILVER_PARTITION = "pickup_date"
# Clean tables are partitioned by the pickup day too (a derived column that
# readers drop), clustered by the location ids.
CLEAN_PARTITION = "_pickup_day"
CLEAN_CLUSTER = ("pickup_location_id", "dropoff_location_id")
SILVER_CLUSTER = ("source_type", "pickup_location_id", "dropoff_location_id")
# Layer -> namespace of its table.
NAMESPACES = {
    "stream_staging": "staging",
    "batch_clean": "silver",
    "stream_clean": "silver",
    "taxi_zone": "silver",
    "trips": "silver",
    "daily_trip_summary": "gold",
    "payment_summary": "gold",
    "zone_performance": "gold",
}
# Messages in one file of the streaming ingest's replay; the replay takes two micro-batches.
REPLAY_ROWS_PER_FILE = 100_000


def moves_rows(df: DataFrame) -> bool:
    """Whether the planned query shuffles its rows by a key (a broadcast join does not)."""
    return "Exchange hashpartitioning" in df._jdf.queryExecution().executedPlan().toString()


class TripLakehouse:
    """All layers for one input folder (``sf_dir``) in one session."""

    def __init__(self, spark: SparkSession, sf_dir: str, materialize: str = "auto", name: str | None = None):
        """``materialize``: "table" (write layers to the checkpoint folder),
        "persist", "none", or "auto" (table if a checkpoint folder is set now).

        ``name``: the table store that the layers are created or replaced in; without one
        the layers are this object's own."""
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        if materialize == "auto":  # settled here: what the session does later changes nothing
            materialize = "table" if checkpoint_root(spark) else "persist"
        self.materialize = materialize
        self.run_id = uuid.uuid4().hex[:12]
        self.name = name or f"trips_{self.run_id}"
        self.written: dict[str, dict] = {}  # layer -> what its writing pass measured
        self._by_day: dict[str, DataFrame] = {}  # clean tables with their day column

    # ---------------------------------------------------------------- staging
    def table(self, name: str) -> DataFrame:
        return read_parquet_table(self.spark, self.sf_dir, name)

    @cached_property
    def _months(self) -> tuple[DataFrame, DataFrame]:
        return raw_trip_months(self.table("lineitem"))

    def months(self) -> list[DataFrame]:
        """The raw monthly frames."""
        return [self.staging_april(), self.staging_may()]

    def staging_april(self) -> DataFrame:
        return self._months[0]

    def staging_may(self) -> DataFrame:
        return self._months[1]

    def staging_zone(self) -> DataFrame:
        return zone_lookup_rows(self.table("nation"), self.table("region"))

    def envelopes(self) -> DataFrame:
        """Broker messages as delivered (with re-deliveries)."""
        return trip_envelopes(self.table("events"))

    def stream_messages(self) -> DataFrame:
        """Messages after de-duplication on the ``event_id`` attribute."""
        return dedup_messages(self.envelopes())

    @cached_property
    def _validated(self) -> DataFrame:
        """The ingest's output (valid + rejected messages), materialised once:
        in production the streaming job writes these staging tables and the
        batch layers read them."""
        return self._materialize(validate_envelopes(self.stream_messages()), "stream_staging")

    def validated(self) -> DataFrame:
        return self._validated

    def stream_staging(self) -> DataFrame:
        """Valid-event staging table (26 fields)."""
        return valid_events(self.validated())

    def rejected_staging(self) -> DataFrame:
        """Rejected-event table (9 fields)."""
        return rejected_events(self.validated())

    @cached_property
    def _ingest_run(self):
        """Run the Structured Streaming ingest over a file replay of the envelopes.

        The envelopes are written as files in publish-time order, then read by
        ``readStream`` a few files per micro-batch (available-now trigger), so
        re-deliveries cross batch boundaries.  Returns the tables that the stream wrote.
        """
        from tripyard.streaming.ingest import replay
        from tripyard.streaming.tables import StreamTables

        base = layer_path(ensure_checkpoint_dir(self.spark), self.run_id, "ingest")
        tables = StreamTables(self.spark, f"{base}/tables", self.store.namespace("staging"))
        return replay(self.spark, self.envelopes(), base, tables, REPLAY_ROWS_PER_FILE)

    def stream_tables(self):
        """The two stream tables as written by the streaming ingest."""
        return self._ingest_run

    def ingested_valid(self) -> DataFrame:
        """Valid-event table as written by the streaming ingest."""
        return self._ingest_run.valid()

    def ingested_rejected(self) -> DataFrame:
        """Rejected-event table as written by the streaming ingest."""
        return self._ingest_run.rejected()

    @cached_property
    def _files(self):
        from tripyard.plans.files import write_inputs

        return write_inputs(self, layer_path(ensure_checkpoint_dir(self.spark), self.run_id, "inputs"))

    def from_files(self):
        """The same layers over real inputs: this house's staging written as files and by the ingest."""
        return self._files

    # ----------------------------------------------------------------- silver
    @cached_property
    def _batch_clean(self) -> DataFrame:
        return self._materialize(
            clean_batch_trips(*self.months(), window=BATCH_WINDOW),
            "batch_clean",
            partition_by=CLEAN_PARTITION,
            cluster_by=CLEAN_CLUSTER,
        )

    def batch_clean(self) -> DataFrame:
        """Batch clean table (24 columns), materialised once like its CTAS."""
        return self._batch_clean

    @cached_property
    def _stream_clean(self) -> DataFrame:
        return self._materialize(
            clean_stream_trips(self.stream_staging(), window=STREAM_WINDOW),
            "stream_clean",
            partition_by=CLEAN_PARTITION,
            cluster_by=CLEAN_CLUSTER,
        )

    def stream_clean(self) -> DataFrame:
        """Stream clean table (24 columns), materialised once like its CTAS."""
        return self._stream_clean

    @cached_property
    def _zone_dim(self) -> DataFrame:
        return self._materialize(build_zone_dim(self.staging_zone()), "taxi_zone")

    def zone_dim(self) -> DataFrame:
        """Zone dimension, materialised once (both join roles read it)."""
        return self._zone_dim

    def clean_union(self) -> DataFrame:
        """Batch + stream clean trips, 24 columns."""
        return union_all(self.batch_clean(), self.stream_clean())

    def clean_between(self, window: tuple[datetime, datetime]) -> DataFrame:
        """U2 for pickups in [start, end): day partitions outside the window are not read."""
        start, end = window
        frames = []
        for layer, df in (("batch_clean", self.batch_clean()), ("stream_clean", self.stream_clean())):
            if layer in self._by_day:
                day = F.col(CLEAN_PARTITION)
                inside = (day >= F.lit(start.date())) & (day <= F.lit(end.date()))
                df = self._by_day[layer].where(inside).select(*df.columns)
            frames.append(df)
        trips = union_all(*frames)
        at = F.col("pickup_datetime")
        return trips.where((at >= ntz_literal(start)) & (at < ntz_literal(end)))

    def gated_trips(self) -> DataFrame:
        """P5 + P6 on the union (applied before the joins; same rows as after)."""
        trips = self.clean_between(SILVER_WINDOW)
        return trips.where(trip_quality_filter(trips, SILVER_WINDOW) & duration_gate())

    def build_silver(self) -> DataFrame:
        """Silver trips (40 columns), not materialised."""
        return silver_projection(attach_zones(self.gated_trips(), self.zone_dim()))

    @cached_property
    def store(self) -> TableStore:
        """Where the layers' tables are, under the shared folder."""
        return TableStore(self.spark, f"{ensure_checkpoint_dir(self.spark)}/tripyard", self.name)

    @property
    def silver_path(self) -> str | None:
        return self.store.current(NAMESPACES["trips"], "trips")

    def _materialize(self, df: DataFrame, layer: str, partition_by=None, cluster_by=(), measure=(), spread=True) -> DataFrame:
        """Cut lineage: create or replace the layer's table and read it back
        (survives lost executors), or persist it, per ``materialize``.

        ``measure``: aggregates that the writing pass computes beside.
        ``spread``: whether the rows of a partition value are brought together first."""
        mode = self.materialize
        if mode == "table" and checkpoint_root(self.spark):
            out = df
            if partition_by and partition_by not in df.columns:
                out = df.withColumn(partition_by, F.to_date("pickup_datetime"))
            seen = Observation(layer) if measure else None
            if seen is not None:
                out = out.observe(seen, *measure)
            back = self.store.replace(out, NAMESPACES[layer], layer, partition_by, cluster_by, spread)
            if seen is not None:
                self.written[layer] = seen.get
            if partition_by == CLEAN_PARTITION:
                self._by_day[layer] = back
            return back.select(*df.columns)
        if mode == "persist":
            return df.persist(StorageLevel.MEMORY_AND_DISK)
        return df

    @cached_property
    def _silver(self) -> DataFrame:
        silver = self.build_silver()
        # the clean tables lie in files of one pickup day each, and silver's rows stay where they
        # were read unless the zones are too many to be broadcast: then they are brought together anew
        by_day = len(self._by_day) == 2 and not moves_rows(silver)
        return self._materialize(
            silver,
            "trips",
            partition_by=SILVER_PARTITION,
            cluster_by=SILVER_CLUSTER,
            measure=quality.silver_measures(SILVER_WINDOW),
            spread=not by_day,
        )

    def silver_written(self) -> quality.SilverReports:
        """The reports on silver as its writing pass measured them."""
        silver = self.silver()
        return quality.SilverReports(silver, self.written.get("trips"), SILVER_WINDOW)

    def silver(self) -> DataFrame:
        return self._silver

    def silver_between(self, start_date: str, end_date: str) -> DataFrame:
        """Silver rows with pickup_date in [start, end): prunes date partitions."""
        return self.silver().where(
            (F.col(SILVER_PARTITION) >= F.lit(start_date).cast("date"))
            & (F.col(SILVER_PARTITION) < F.lit(end_date).cast("date"))
        )

    # ------------------------------------------------------------------- gold
    # The summaries are views over silver (:meth:`gold_view`).  Each is read by
    # several analytics queries and the reconciliation gate, and the daily one is
    # nearly as large as silver (its keys almost identify a trip), so these read
    # written copies, aggregated once per input.
    @cached_property
    def _daily(self) -> DataFrame:
        return self._materialize(marts.daily_trip_summary(self.silver()), "daily_trip_summary")

    @cached_property
    def _payment(self) -> DataFrame:
        return self._materialize(marts.payment_summary(self.silver()), "payment_summary")

    @cached_property
    def _zones(self) -> DataFrame:
        return self._materialize(marts.zone_performance(self.silver()), "zone_performance")

    def daily_summary(self) -> DataFrame:
        return self._daily

    def payment_summary(self) -> DataFrame:
        return self._payment

    def zone_performance(self) -> DataFrame:
        return self._zones

    def gold_view(self, view: str) -> DataFrame:
        """A summary as a stored view over the silver table, by its name in the catalog."""
        self.silver()
        trips = self.store.qualified(NAMESPACES["trips"], "trips")
        return self.store.replace_view("gold", view, marts.summary_sql(marts.GOLD_VIEWS[view], trips))

    def release(self) -> None:
        """Drop persisted layers, also those of the house over files (written tables stay for readers)."""
        if "_files" in self.__dict__:
            self.__dict__.pop("_files").release()
        for name in (
            "_silver",
            "_validated",
            "_batch_clean",
            "_stream_clean",
            "_zone_dim",
            "_daily",
            "_payment",
            "_zones",
        ):
            if name in self.__dict__:
                self.__dict__[name].unpersist()
                del self.__dict__[name]
