"""DataFrame-to-DataFrame steps, the same for tables and streams unless noted."""

from kerbflow.operators.barrier import computed_once
from kerbflow.operators.coerce import out_of_range, to_table_types
from kerbflow.operators.enrich import drop_bad_time, with_event_time, with_locations
from kerbflow.operators.latest import latest_versions
from kerbflow.operators.normalise import canonical_trips, detect_time_column, normalise_columns, unread_trips
from kerbflow.operators.numbering import dense_numbers
from kerbflow.operators.payload import decode_messages, encode_messages
from kerbflow.operators.rejects import reject_counts, with_reject_reason
from kerbflow.operators.running import running_totals
from kerbflow.operators.windows import (
    drop_null_location,
    only_located,
    results_of_state,
    running_versions,
    windowed_aggregate,
    windowed_partials,
)

__all__ = [
    "canonical_trips",
    "computed_once",
    "decode_messages",
    "dense_numbers",
    "detect_time_column",
    "drop_bad_time",
    "drop_null_location",
    "encode_messages",
    "latest_versions",
    "normalise_columns",
    "only_located",
    "out_of_range",
    "reject_counts",
    "results_of_state",
    "running_totals",
    "running_versions",
    "to_table_types",
    "unread_trips",
    "windowed_aggregate",
    "windowed_partials",
    "with_event_time",
    "with_locations",
    "with_reject_reason",
]
