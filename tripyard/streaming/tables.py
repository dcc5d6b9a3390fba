"""The two stream tables: declared schemas, one commit for both, compaction.

Both tables are Parquet folders partitioned by date and batch.  A micro-batch writes its
rows of both tables under a folder name of its own attempt and then publishes one commit
record; readers take the batches that records name.  So a run that dies between the two
writes shows neither, an attempt that is repeated leaves no second copy, and a batch that
was committed is not written again.

Compaction writes the rows of the committed batches anew as one batch and publishes a
record that replaces theirs: readers see the old files or the new ones, never both.
:meth:`StreamTables.vacuum` removes what no record names.

The tables are also declared in the session's catalog (``CREATE TABLE ... PARTITIONED
BY``), with the committed batches' folders as their partitions.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType

from tripyard.schemas import REJECTED_EVENT_SCHEMA, VALID_EVENT_SCHEMA
from tripyard.sources import files
from tripyard.sources.sinks import create_namespace

BATCH = "batch"
_RECORD = "batch string, valid long, rejected long, compacted boolean, replaces array<string>, at double"


class SchemaMismatch(ValueError):
    """Rows that do not have the declared columns."""


@dataclass(frozen=True)
class Declared:
    """A declared table: its columns, its date partition and the columns that its files are sorted by."""

    name: str
    schema: StructType
    partition: str
    partition_source: str
    cluster: tuple[str, ...]

    @property
    def stored(self) -> StructType:
        return StructType([*self.schema.fields, StructField(self.partition, DateType()), StructField(BATCH, StringType())])

    def check(self, df: DataFrame) -> None:
        """Names, order and types as declared (nullability aside)."""
        want = [(f.name, f.dataType.simpleString()) for f in self.schema.fields]
        got = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
        if got != want:
            wrong = [f"{g} for {w}" for g, w in zip(got, want, strict=False) if g != w] or [f"{len(got)} columns for {len(want)}"]
            raise SchemaMismatch(f"{self.name}: {'; '.join(wrong)}")


VALID = Declared(
    "stream_events_valid", VALID_EVENT_SCHEMA, "event_date", "event_time", ("pickup_location_id", "dropoff_location_id")
)
REJECTED = Declared("stream_events_rejected", REJECTED_EVENT_SCHEMA, "pipeline_date", "pipeline_timestamp", ("error_type",))
TABLES = (VALID, REJECTED)


class StreamTables:
    """Both tables and their commit records below one shared folder."""

    def __init__(self, spark: SparkSession, base: str, namespace: str | None = None):
        self.spark, self.base, self.namespace = spark, base.rstrip("/"), namespace

    def path(self, table: Declared) -> str:
        return f"{self.base}/{table.name}"

    @property
    def _commits(self) -> str:
        return f"{self.base}/commits"

    # ------------------------------------------------------------------------------ records
    def records(self) -> list[dict]:
        """The records that count: those that no other one replaces.  Compaction keeps them few."""
        if not files.names(self.spark, self._commits):
            return []
        found = [r.asDict() for r in self.spark.read.schema(_RECORD).json(self._commits).collect()]
        gone = {b for r in found for b in r["replaces"] or []}
        return [r for r in found if r["batch"] not in gone]

    def committed(self, name: str) -> bool:
        """Whether the batch with this name is in the tables, compacted or not."""
        return bool(files.matching(self.spark, f"{self._commits}/{name}.json"))

    def _publish(self, name: str, record: dict) -> None:
        files.publish(self.spark, f"{self._commits}/{name}.json", json.dumps({**record, "at": time.time()}))

    def counts(self) -> DataFrame:
        """The tables' rows, from the records alone."""
        found = self.records()
        total = [sum(r[c] for r in found) for c in ("valid", "rejected")]
        return self.spark.createDataFrame([tuple(total)], "total_stream long, total_rejected long")

    # ------------------------------------------------------------------------------ writing
    def _write(self, df: DataFrame, table: Declared, batch: str) -> None:
        # rebalanced by date: a few files for each date and batch, and a large date is split
        (
            df.withColumn(table.partition, F.to_date(table.partition_source))
            .withColumn(BATCH, F.lit(batch))
            .hint("rebalance", table.partition)
            .sortWithinPartitions(table.partition, *table.cluster)
            .write.mode("append")
            .partitionBy(table.partition, BATCH)
            .parquet(self.path(table))
        )

    def append(self, name: str, valid: DataFrame, rejected: DataFrame) -> bool:
        """Commit one batch's rows to both tables; False if a batch of this name is there already."""
        frames = (valid, rejected)
        for table, df in zip(TABLES, frames, strict=True):
            table.check(df)
        if self.committed(name):
            return False
        attempt = f"{name}-{uuid.uuid4().hex[:8]}"
        counts = {}
        for table, df, key in zip(TABLES, frames, ("valid", "rejected"), strict=True):
            seen = Observation(f"{key} rows")
            self._write(df.observe(seen, F.count(F.lit(1)).alias("n")), table, attempt)
            counts[key] = seen.get["n"]
        self._publish(name, {"batch": attempt, **counts, "compacted": False, "replaces": []})
        self._add_partitions([attempt])
        return True

    # ------------------------------------------------------------------------------ reading
    def read(self, table: Declared) -> DataFrame:
        """The committed rows with the table's partition columns."""
        live = [r["batch"] for r in self.records()]
        if not live:
            return self.spark.createDataFrame([], table.stored)
        return self.spark.read.schema(table.stored).parquet(self.path(table)).where(F.col(BATCH).isin(live))

    def valid(self) -> DataFrame:
        return self.read(VALID).select(*VALID.schema.names)

    def rejected(self) -> DataFrame:
        return self.read(REJECTED).select(*REJECTED.schema.names)

    # --------------------------------------------------------------------------- compaction
    def compact(self, least: int = 2, merged: int = 8) -> str | None:
        """Write the batches that are not compacted yet as one; the compacted ones, too, once there are ``merged``.

        Returns the new batch, or None if there are fewer than ``least`` batches to join.
        """
        found = self.records()
        done = [r for r in found if r["compacted"]]
        old = [r for r in found if not r["compacted"]] + (done if len(done) >= merged else [])
        if len(old) < least:
            return None
        names = [r["batch"] for r in old]
        batch = f"compacted-{uuid.uuid4().hex}"
        for table in TABLES:
            rows = self.spark.read.schema(table.stored).parquet(self.path(table)).where(F.col(BATCH).isin(names))
            self._write(rows.select(*table.schema.names), table, batch)
        total = {key: sum(r[key] for r in old) for key in ("valid", "rejected")}
        self._publish(batch, {"batch": batch, **total, "compacted": True, "replaces": names})
        self._add_partitions([batch])
        self._drop_partitions(names)
        return batch

    def vacuum(self, grace_seconds: float = 7 * 86400.0) -> int:
        """Remove folders that no record has named for the grace time; returns their number."""
        live = {r["batch"] for r in self.records()}
        before, removed = time.time() - grace_seconds, 0
        self._forget(live, before)
        for table in TABLES:
            for folder in files.matching(self.spark, f"{self.path(table)}/{table.partition}=*/{BATCH}=*"):
                if folder.rsplit("=", 1)[1] in live:
                    continue
                if all(at / 1000 <= before for _, _, at in files.stamps(self.spark, folder)):
                    files.remove(self.spark, folder)
                    removed += 1
        return removed

    def _forget(self, live: set[str], before: float) -> None:
        """Remove old records of replaced batches, but each query's last one: that batch may run again."""
        newest: dict[str, int] = {}
        names = [n.removesuffix(".json") for n in files.names(self.spark, self._commits) if not n.startswith(".")]
        numbered = [(n, *n.rsplit("-", 1)) for n in names if n.rsplit("-", 1)[-1].isdigit()]
        for _, query, number in numbered:
            newest[query] = max(newest.get(query, 0), int(number))
        for name, query, number in numbered:
            path = f"{self._commits}/{name}.json"
            record = json.loads(files.read(self.spark, path))
            if int(number) < newest[query] and record["batch"] not in live and record["at"] <= before:
                files.remove(self.spark, path)

    # ------------------------------------------------------------------------------ catalog
    def _name(self, table: Declared) -> str:
        return f"`{self.namespace}`.`{table.name}`"

    def declare(self) -> None:
        """The two tables in the session's catalog, if absent, with the committed partitions."""
        if self.namespace is None:
            return
        create_namespace(self.spark, self.namespace)
        for table in TABLES:
            if self._declared(table) and not self._location(table).endswith(self.path(table).split(":", 1)[-1]):
                self.spark.sql(f"DROP TABLE {self._name(table)}")  # the name of other tables' files; these stay
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table.stored.fields)
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {self._name(table)} ({columns}) USING parquet "
                f"PARTITIONED BY ({table.partition}, {BATCH}) LOCATION '{self.path(table)}'"
            )
        self._add_partitions([r["batch"] for r in self.records()])

    def table(self, table: Declared) -> DataFrame:
        """A declared table by its name."""
        return self.spark.table(self._name(table))

    def _partitions(self, table: Declared, batches: Sequence[str]) -> list[str]:
        out = []
        for batch in batches:
            for folder in files.matching(self.spark, f"{self.path(table)}/{table.partition}=*/{BATCH}={batch}"):
                date = folder.rsplit("/", 2)[1].split("=")[1]
                value = "NULL" if date.startswith("__HIVE") else f"'{date}'"
                out.append(f"PARTITION ({table.partition} = {value}, {BATCH} = '{batch}')")
        return out

    def _location(self, table: Declared) -> str:
        rows = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self._name(table)}").where("col_name = 'Location'").collect()
        return rows[-1]["data_type"] if rows else ""

    def _declared(self, table: Declared) -> bool:
        return self.namespace is not None and self.spark.catalog.tableExists(f"{self.namespace}.{table.name}")

    def _add_partitions(self, batches: Sequence[str]) -> None:
        for table in TABLES:
            if self._declared(table) and (found := self._partitions(table, batches)):
                self.spark.sql(f"ALTER TABLE {self._name(table)} ADD IF NOT EXISTS {' '.join(found)}")

    def _drop_partitions(self, batches: Sequence[str]) -> None:
        for table in TABLES:
            if self._declared(table) and (found := self._partitions(table, batches)):
                self.spark.sql(f"ALTER TABLE {self._name(table)} DROP IF EXISTS {', '.join(found)}")


def batch_name(query: str, batch_id: int) -> str:
    return f"{query}-{batch_id}"
