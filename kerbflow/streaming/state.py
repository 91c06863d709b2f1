"""What a stream holds in its state, read back from its checkpoint."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kerbflow.operators.windows import results_of_state


def state_operators(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The stateful steps of a stream: ``operatorId``, ``operatorName``, number of partitions and the batches that can be read."""
    return spark.read.format("state-metadata").load(checkpoint)


def open_windows(spark: SparkSession, checkpoint: str, batch_id: int | None = None) -> DataFrame:
    """The windows that a stream of ``trip_aggregates`` has not closed, with their values so far.

    ``batch_id`` asks for the state as it was after that batch, as long as the checkpoint keeps it; the last one by default. In
    append mode these are the windows that no result has been written for. For streams with one stateful step.
    """
    reader = spark.read.format("statestore")
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    return results_of_state(reader.load(checkpoint))
