"""Delimited files, message streams and result tables."""

from kerbflow.sources.committed import read_attempts, read_committed
from kerbflow.sources.delimited import read_trips, stream_trips
from kerbflow.sources.headers import MixedTripsSink, files_by_header, read_mixed_trips, read_trip_groups, stream_file_names
from kerbflow.sources.messages import (
    kafka_read_options,
    kafka_stream_options,
    read_kafka,
    read_message_files,
    stream_kafka,
    stream_message_files,
)
from kerbflow.sources.tables import read_changelog, read_jdbc_table

__all__ = [
    "MixedTripsSink",
    "files_by_header",
    "kafka_read_options",
    "kafka_stream_options",
    "read_attempts",
    "read_changelog",
    "read_committed",
    "read_jdbc_table",
    "read_kafka",
    "read_message_files",
    "read_mixed_trips",
    "read_trip_groups",
    "read_trips",
    "stream_file_names",
    "stream_kafka",
    "stream_message_files",
    "stream_trips",
]
