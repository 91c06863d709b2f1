"""Single events of each batch, and beside them those that could not be used, in one commit."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbflow.operators.rejects import BAD_JSON, BAD_TIME
from kerbflow.schema import RAW_STORED_SCHEMA
from kerbflow.sinks.committed import EVENT, KIND, REJECT, Commit, CommittedSink
from kerbflow.sources.committed import read_committed

REJECT_SCHEMA = T.StructType(
    [T.StructField("id", T.LongType()), T.StructField("value", T.BinaryType()), T.StructField("reject_reason", T.StringType())]
)


class CommittedRawSink(CommittedSink):
    """Callback for batches of ``raw_events``: what the raw event table takes to ``kind=event``, whatever has a reject reason
    to ``kind=reject``, with its payload.

    An event without a location, or with a number out of range, is both. Both kinds are written in one pass over the batch, and a
    reader sees both or neither.
    """

    def __init__(self, path: str):
        super().__init__(path, prepare=lambda df: df, stamp="ingested_at")

    def rows_of(self, batch: DataFrame, batch_id: int, before: Commit | None) -> DataFrame:
        reason = F.col("reject_reason")
        stored = reason.isNull() | ~reason.isin(BAD_JSON, BAD_TIME)
        kinds = F.array_compact(F.array(F.when(stored, EVENT), F.when(reason.isNotNull(), REJECT)))
        rows = batch.withColumn(KIND, F.explode(kinds))
        event = F.col(KIND) == EVENT
        return rows.withColumns({"value": F.when(~event, F.col("value")), "reject_reason": F.when(~event, reason)})

    def write(self, rows: DataFrame, folder: str) -> None:
        rows.write.partitionBy(KIND).parquet(folder)


class CommittedFeedSink(CommittedSink):
    """Callback for batches of ``trips_to_counted_messages``: messages to ``kind=event``, rows that are none to ``kind=reject``."""

    def __init__(self, path: str):
        super().__init__(path, prepare=lambda df: df, stamp=None)

    def rows_of(self, batch: DataFrame, batch_id: int, before: Commit | None) -> DataFrame:
        return batch.withColumn(KIND, F.when(F.col("value").isNotNull(), EVENT).otherwise(REJECT))

    def write(self, rows: DataFrame, folder: str) -> None:
        rows.write.partitionBy(KIND).parquet(folder)


def read_chunk_counts(spark: SparkSession, path: str) -> DataFrame:
    """``events_in_chunk`` and ``input_rows`` of each ``chunk`` that a ``CommittedFeedSink`` took, with its batch."""
    schema = T.StructType([T.StructField("chunk", T.LongType()), T.StructField(KIND, T.StringType())])
    counts = [F.count_if(F.col(KIND) == EVENT).alias("events_in_chunk"), F.count(F.lit(1)).alias("input_rows")]
    return read_committed(spark, path, schema).groupBy("batch_id", "chunk").agg(*counts)


def read_raw_events(spark: SparkSession, path: str) -> DataFrame:
    return read_committed(spark, path, RAW_STORED_SCHEMA, kind=EVENT)


def read_rejects(spark: SparkSession, path: str) -> DataFrame:
    return read_committed(spark, path, REJECT_SCHEMA, kind=REJECT)
