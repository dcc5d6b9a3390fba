"""Table sinks: create-or-replace, partitioned and clustered layouts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def create_namespace(spark: SparkSession, name: str) -> None:
    """Namespace create-if-absent."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")


def write_table(
    df: DataFrame,
    path: str,
    partition_by: str | None = None,
    cluster_by: Sequence[str] = (),
    mode: str = "overwrite",
    spread: bool = True,
) -> None:
    """Write ``df`` as Parquet, optionally partitioned by one column and clustered.

    * ``rebalance`` (an AQE hint) spreads rows by the partition column but lets
      AQE split a hot partition value into several tasks, so one day holding a
      third of the data does not become one giant task and one giant file;
    * ``sortWithinPartitions`` on the clustering columns gives tight Parquet
      row-group min/max statistics for data skipping.
    ``spread=False`` leaves out the first, for rows that come from files of one partition
    value each: such tasks hold few values, so nothing is shuffled.
    ``mode="overwrite"`` is the create-or-replace / truncate-on-write disposition.
    """
    out = df
    if partition_by and spread:
        out = out.hint("rebalance", partition_by)
    sort_cols = ([partition_by] if partition_by else []) + list(cluster_by)
    if sort_cols:
        out = out.sortWithinPartitions(*sort_cols)
    writer = out.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)


def layer_path(root: str, run_id: str, layer: str) -> str:
    """Folder of one materialised layer under the shared checkpoint folder."""
    return f"{root.rstrip('/')}/tripyard/{run_id}/{layer}"


#: The partition of a staging table that one monthly object is loaded into.
LOAD_MONTH = "load_month"


def load_month(rows: DataFrame, path: str, month: str) -> None:
    """S3: load one month's object into a staging table, in place of what was loaded for that month before.

    Only that month's partition is replaced; the files of all others stay as they are.
    """
    (
        rows.withColumn(LOAD_MONTH, F.lit(month))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(LOAD_MONTH)
        .parquet(path)
    )


def read_months(spark: SparkSession, path: str, columns: StructType) -> DataFrame:
    """The staging table of all loaded months."""
    return spark.read.schema(StructType([*columns.fields, StructField(LOAD_MONTH, StringType())])).parquet(path)
