"""Log lines and rates per micro-batch."""

from __future__ import annotations

import logging

from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

log = logging.getLogger(__name__)


def batch_rates(query: StreamingQuery) -> list[dict]:
    """Input rows and rates of the recent batches, oldest first."""
    return [
        {
            "batch_id": progress.batchId,
            "input_rows": progress.numInputRows,
            "input_rows_per_second": progress.inputRowsPerSecond,
            "processed_rows_per_second": progress.processedRowsPerSecond,
            "late_keys_dropped": sum(state.numRowsDroppedByWatermark for state in progress.stateOperators),
        }
        for progress in query.recentProgress
    ]


class BatchLog(StreamingQueryListener):
    """Logs start, each batch and end of the queries of a session."""

    def onQueryStarted(self, event):
        log.info("query %s started", event.name or event.id)

    def onQueryProgress(self, event):
        progress = event.progress
        log.info(
            "batch %d: %d input rows, %.1f rows/s", progress.batchId, progress.numInputRows, progress.processedRowsPerSecond
        )

    def onQueryIdle(self, event):
        log.info("query %s: no new data", event.id)

    def onQueryTerminated(self, event):
        log.info("query %s ended%s", event.id, f": {event.exception}" if event.exception else "")
