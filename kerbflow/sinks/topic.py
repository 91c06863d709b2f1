"""JSON messages to a topic, or to a folder that stands in for one."""

from __future__ import annotations

from pyspark.sql import DataFrame

from kerbflow.config import FlowConfig

# Delivery settings of the feed.
DELIVERY = {
    "kafka.acks": "all",
    "kafka.retries": "5",
    "kafka.linger.ms": "5",
    "kafka.compression.type": "gzip",
}


def kafka_write_options(config: FlowConfig) -> dict[str, str]:
    return {"kafka.bootstrap.servers": config.kafka_servers, "topic": config.kafka_topic, **DELIVERY}


def write_kafka(messages: DataFrame, config: FlowConfig) -> None:
    messages.select("value").write.format("kafka").options(**kafka_write_options(config)).save()


def write_message_files(messages: DataFrame, path: str) -> None:
    """Append to a folder that ``stream_message_files`` follows."""
    messages.write.mode("append").parquet(path)
