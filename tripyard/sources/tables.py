"""Readers for the raw inputs (monthly Parquet, zone CSV, envelope files)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripyard.schemas import ENVELOPE_SCHEMA, ZONE_CSV_SCHEMA


def read_parquet_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One test table, e.g. ``lineitem`` -> ``{sf_dir}/lineitem.parquet``."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_monthly_trips(spark: SparkSession, path: str) -> DataFrame:
    """One monthly raw-trip Parquet object -> one staging frame (schema from footer)."""
    return spark.read.parquet(path)


def read_zone_csv(spark: SparkSession, path: str, infer_schema: bool = False) -> DataFrame:
    """Zone lookup CSV: one header row, ',' delimiter, UTF-8.

    The warehouse infers types; an explicit schema gives the same columns
    without a second pass over the file, so it is the default.
    """
    reader = spark.read.option("header", True).option("sep", ",").option("encoding", "UTF-8")
    if infer_schema:
        return reader.option("inferSchema", True).csv(path)
    return reader.schema(ZONE_CSV_SCHEMA).csv(path)


def read_envelopes(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    """Message envelopes (data, message_id, publish_time, attributes) as files.

    In production the same frame comes from ``readStream.format("kafka")``;
    here a directory of envelope Parquet files stands in for the broker.
    """
    if streaming:
        return spark.readStream.schema(ENVELOPE_SCHEMA).parquet(path)
    return spark.read.schema(ENVELOPE_SCHEMA).parquet(path)


def kafka_envelopes(records: DataFrame) -> DataFrame:
    """Kafka source rows -> message envelopes (S4 on a Kafka broker).

    ``value`` is the payload, ``topic-partition-offset`` the message id, the
    broker timestamp the publish time (UTC wall clock) and the record
    headers the attributes (the ``event_id`` header carries the de-dup key).
    """
    headers = F.coalesce(F.col("headers"), F.array())
    names = F.array_distinct(F.transform(headers, lambda h: h["key"]))
    # a record may repeat a header; the last one counts
    last = F.transform(names, lambda k: F.element_at(F.filter(headers, lambda h: h["key"] == k), -1)["value"].cast("string"))
    return records.select(
        F.col("value").alias("data"),
        F.concat_ws("-", F.col("topic"), F.col("partition").cast("string"), F.col("offset").cast("string")).alias(
            "message_id"
        ),
        F.timestamp_add(
            "MICROSECOND", F.unix_micros(F.col("timestamp")), F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")
        ).alias("publish_time"),
        F.map_from_arrays(names, last).alias("attributes"),
    )
