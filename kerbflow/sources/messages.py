"""Topics of JSON messages, and parquet folders that hold the same columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbflow.config import FlowConfig
from kerbflow.schema import MESSAGE_SCHEMA


def kafka_read_options(config: FlowConfig) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": config.kafka_servers,
        "subscribe": config.kafka_topic,
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
    }


def kafka_stream_options(config: FlowConfig) -> dict[str, str]:
    """From the earliest message on a cold start, with a bounded number of messages per batch."""
    most = config.max_offsets_per_trigger
    return kafka_read_options(config) | ({"maxOffsetsPerTrigger": str(most)} if most is not None else {})


def stream_kafka(spark: SparkSession, config: FlowConfig) -> DataFrame:
    return (
        spark.readStream.format("kafka")
        .options(**kafka_stream_options(config))
        .load()
        .select(*MESSAGE_SCHEMA.names)
    )


def read_kafka(spark: SparkSession, config: FlowConfig) -> DataFrame:
    """All messages the topic holds now."""
    options = {**kafka_read_options(config), "endingOffsets": "latest"}
    return spark.read.format("kafka").options(**options).load().select(*MESSAGE_SCHEMA.names)


def read_message_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MESSAGE_SCHEMA).parquet(path)


def stream_message_files(
    spark: SparkSession, path: str, max_files: int | None = None, file_name: str | None = None
) -> DataFrame:
    """Message files as a stream, oldest first; ``max_files`` bounds a micro-batch, ``file_name`` names a column for each row's file."""
    reader = spark.readStream.schema(MESSAGE_SCHEMA).option("ignoreMissingFiles", True)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    stream = reader.parquet(path)
    return stream.select("*", F.col("_metadata.file_name").alias(file_name)) if file_name else stream
