"""Definitions of the two sink tables in the session catalog."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession

from kerbflow.schema import AGGREGATE_TABLE_TYPES, RAW_TABLE_TYPES


def _create(spark: SparkSession, name: str, types: Mapping[str, str], location: str | None) -> None:
    columns = ", ".join(f"{column} {kind}" for column, kind in types.items())
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{place}")


def create_aggregate_table(spark: SparkSession, name: str = "taxi_aggregates", location: str | None = None) -> None:
    _create(spark, name, AGGREGATE_TABLE_TYPES, location)


def create_raw_table(spark: SparkSession, name: str = "taxi_events_raw", location: str | None = None) -> None:
    _create(spark, name, RAW_TABLE_TYPES, location)
