"""Starting, running and watching the streaming queries."""

from kerbflow.streaming.metrics import FeedMetrics, chunk_metrics, read_feed_metrics, with_feed_metrics
from kerbflow.streaming.progress import BatchLog, batch_rates
from kerbflow.streaming.run import checkpoint_path, run_available_now, start
from kerbflow.streaming.state import open_windows, state_operators

__all__ = [
    "BatchLog",
    "FeedMetrics",
    "batch_rates",
    "checkpoint_path",
    "chunk_metrics",
    "open_windows",
    "read_feed_metrics",
    "run_available_now",
    "start",
    "state_operators",
    "with_feed_metrics",
]
