"""Batch folders, database tables, topics and table definitions."""

from kerbflow.sinks.changelog import BatchFolderSink, RawEventSink
from kerbflow.sinks.committed import Commit, CommittedSink, commits
from kerbflow.sinks.jdbc import JdbcSink, jdbc_options
from kerbflow.sinks.late import LateRowsSink, read_late_rows, read_results
from kerbflow.sinks.raw import CommittedFeedSink, CommittedRawSink, read_chunk_counts, read_raw_events, read_rejects
from kerbflow.sinks.tables import create_aggregate_table, create_raw_table
from kerbflow.sinks.topic import kafka_write_options, write_kafka, write_message_files

__all__ = [
    "BatchFolderSink",
    "Commit",
    "CommittedFeedSink",
    "CommittedRawSink",
    "CommittedSink",
    "JdbcSink",
    "LateRowsSink",
    "RawEventSink",
    "commits",
    "create_aggregate_table",
    "create_raw_table",
    "jdbc_options",
    "kafka_write_options",
    "read_chunk_counts",
    "read_late_rows",
    "read_raw_events",
    "read_rejects",
    "read_results",
    "write_kafka",
    "write_message_files",
]
