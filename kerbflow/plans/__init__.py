"""The steps put together: aggregate job, raw events, feed and reports."""

from kerbflow.plans.aggregate import aggregates_with_events, trip_aggregates, trip_partials, typed_trip_aggregates
from kerbflow.plans.feed import chunk_of, feed_batches, trips_to_counted_messages, trips_to_messages, write_chunks
from kerbflow.plans.raw import raw_events
from kerbflow.plans.report import newest_windows, peek_messages, total_rows
from kerbflow.plans.snapshot import compact, newest_results, read_latest, remove_compacted, snapshot_of

__all__ = [
    "aggregates_with_events",
    "chunk_of",
    "compact",
    "feed_batches",
    "newest_results",
    "newest_windows",
    "peek_messages",
    "raw_events",
    "read_latest",
    "remove_compacted",
    "snapshot_of",
    "total_rows",
    "trip_aggregates",
    "trip_partials",
    "trips_to_counted_messages",
    "trips_to_messages",
    "typed_trip_aggregates",
    "write_chunks",
]
