"""Named, replaceable tables and views that other sessions open.

A table is a folder of versions.  A build writes a new version next to the old ones and
then publishes one small marker that names it; the newest marker is the table.  A build
that dies halfway has published nothing, so readers keep the old version, and one that
reads while a new version appears goes on reading its own.  Versions before the last
:data:`KEPT` and what dead builds left are removed by the next build; a table has one
writer at a time.

The session's catalog gets a database for each namespace and an external table or view
for each name (:meth:`TableStore.attach` does it for all of a store), so ``spark.table``
and SQL work in every session.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tripyard.sources import files
from tripyard.sources.sinks import create_namespace, write_table

#: Versions of a table that stay: the newest and the one that its readers may still hold.
KEPT = 2
_MARKERS, _VIEWS = "_published", "_views"


class TableStore:
    """The namespaces ``<name>_staging``, ``<name>_silver`` and ``<name>_gold`` below one shared folder."""

    LAYERS = ("staging", "silver", "gold")

    def __init__(self, spark: SparkSession, root: str, name: str = "trips"):
        self.spark, self.name = spark, name
        self.root = f"{root.rstrip('/')}/{name}"

    def namespace(self, layer: str) -> str:
        if layer not in self.LAYERS:
            raise ValueError(f"no such layer: {layer}")
        return f"{self.name}_{layer}"

    def qualified(self, layer: str, table: str) -> str:
        return f"`{self.namespace(layer)}`.`{table}`"

    def folder(self, layer: str, table: str) -> str:
        return f"{self.root}/{self.namespace(layer)}/{table}"

    # ------------------------------------------------------------------------------ versions
    def versions(self, layer: str, table: str) -> list[str]:
        """The published versions, oldest first."""
        return [v for v in files.names(self.spark, f"{self.folder(layer, table)}/{_MARKERS}") if not v.startswith(".")]

    def current(self, layer: str, table: str) -> str | None:
        """The folder of the newest published version."""
        published = self.versions(layer, table)
        return f"{self.folder(layer, table)}/{published[-1]}" if published else None

    def replace(
        self, df: DataFrame, layer: str, table: str, partition_by: str | None = None, cluster_by: Sequence[str] = (),
        spread: bool = True,
    ) -> DataFrame:
        """Create or replace a table; returns it as it was written (``spread``: see ``write_table``)."""
        folder, published = self.folder(layer, table), self.versions(layer, table)
        number = int(published[-1].split("-")[0]) + 1 if published else 0
        version = f"{number:06d}-{uuid.uuid4().hex[:8]}"
        write_table(df, f"{folder}/{version}", partition_by=partition_by, cluster_by=cluster_by, spread=spread)
        files.publish(self.spark, f"{folder}/{_MARKERS}/{version}", df.schema.json())
        self._clean(folder, [*published, version])
        self._register(layer, table)
        return self.open(layer, table)

    def _clean(self, folder: str, published: list[str]) -> None:
        for old in published[:-KEPT]:
            files.remove(self.spark, f"{folder}/{_MARKERS}/{old}")
        stay = {_MARKERS, *published[-KEPT:]}
        for name in files.names(self.spark, folder):
            if name not in stay and name <= published[-1]:
                files.remove(self.spark, f"{folder}/{name}")

    def open(self, layer: str, table: str) -> DataFrame:
        """The table's newest version, in any session."""
        path = self.current(layer, table)
        if path is None:
            raise LookupError(f"no table {self.qualified(layer, table)} below {self.root}")
        return self.spark.read.schema(self._schema(layer, table)).parquet(path)

    def _schema(self, layer: str, table: str) -> StructType:
        newest = self.versions(layer, table)[-1]
        return StructType.fromJson(json.loads(files.read(self.spark, f"{self.folder(layer, table)}/{_MARKERS}/{newest}")))

    # ------------------------------------------------------------------------------ catalog
    def create_namespaces(self) -> list[str]:
        """The three namespaces."""
        for layer in self.LAYERS:
            create_namespace(self.spark, self.namespace(layer))
        return [self.namespace(layer) for layer in self.LAYERS]

    def _register(self, layer: str, table: str) -> None:
        """The name in this session's catalog, at the newest version."""
        self.create_namespaces()
        name, path = self.qualified(layer, table), self.current(layer, table)
        partitioned = bool(files.matching(self.spark, f"{path}/*=*"))
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.spark.catalog.createTable(name, path=path, source="parquet")
        if partitioned:
            self.spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")

    def replace_view(self, layer: str, view: str, sql: str) -> DataFrame:
        """Create or replace a view; its text is kept in the store, so other sessions get it, too."""
        self.create_namespaces()
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.qualified(layer, view)} AS {sql}")
        kept = f"{self.root}/{self.namespace(layer)}/{_VIEWS}/{view}"
        old = files.names(self.spark, kept)
        number = int(old[-1].split("-")[0]) + 1 if old else 0
        files.publish(self.spark, f"{kept}/{number:06d}-{uuid.uuid4().hex[:8]}", sql)
        for name in old:
            files.remove(self.spark, f"{kept}/{name}")
        return self.spark.table(self.qualified(layer, view))

    def attach(self) -> list[str]:
        """Register everything in the store with this session's catalog; returns the names."""
        self.create_namespaces()
        found = []
        for layer in self.LAYERS:
            base = f"{self.root}/{self.namespace(layer)}"
            for table in files.names(self.spark, base):
                if not table.startswith("_") and self.versions(layer, table):
                    self._register(layer, table)
                    found.append(self.qualified(layer, table))
        for layer in self.LAYERS:
            base = f"{self.root}/{self.namespace(layer)}/{_VIEWS}"
            for view in files.names(self.spark, base):
                newest = files.names(self.spark, f"{base}/{view}")[-1]
                text = files.read(self.spark, f"{base}/{view}/{newest}")
                self.spark.sql(f"CREATE OR REPLACE VIEW {self.qualified(layer, view)} AS {text}")
                found.append(self.qualified(layer, view))
        return found

    def listing(self) -> DataFrame:
        """(layer, table_name, is_view, table_rows) of the tables and views in the session's catalog, read by name."""
        rows = []
        for layer in self.LAYERS:
            for t in self.spark.catalog.listTables(self.namespace(layer)):
                if not t.isTemporary:
                    n = self.spark.table(self.qualified(layer, t.name)).agg(F.count(F.lit(1)).alias("table_rows"))
                    rows.append(
                        n.select(
                            F.lit(layer).alias("layer"), F.lit(t.name).alias("table_name"),
                            F.lit(t.tableType == "VIEW").alias("is_view"), "table_rows",
                        )
                    )
        if not rows:
            return self.spark.createDataFrame([], "layer string, table_name string, is_view boolean, table_rows long")
        return reduce(DataFrame.unionAll, rows)
