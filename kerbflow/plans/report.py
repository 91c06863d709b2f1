"""Queries over stored results and messages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

REPORT_COLUMNS = ("window_start", "window_end", "pickup_location", "trip_count", "avg_fare")


def newest_windows(result: DataFrame, limit: int = 20, columns: tuple[str, ...] = REPORT_COLUMNS) -> DataFrame:
    """The windows that started last. Location and end break ties, so the answer is always the same."""
    newest = result.orderBy(F.desc("window_start"), F.asc("pickup_location"), F.asc("window_end"))
    return newest.limit(limit).select(*columns)


def total_rows(result: DataFrame) -> DataFrame:
    return result.agg(F.count(F.lit(1)).alias("total_rows"))


def peek_messages(messages: DataFrame, limit: int = 5) -> DataFrame:
    """The first messages of a topic, as text."""
    first = messages.orderBy("partition", "offset").limit(limit)
    return first.select("partition", "offset", F.col("value").cast("string").alias("value"))
