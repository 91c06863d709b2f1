"""Counts and rates of each micro-batch, kept as a table."""

from __future__ import annotations

import json
import threading

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from kerbflow.storage import names_in, put_text

METRICS_SCHEMA = """batch_id bigint, events_in_chunk bigint, input_rows bigint, seconds double, rows_per_second double,
    finished_at string"""
NAME = "feed"


def with_feed_metrics(events: DataFrame, sent: Column | None = None) -> DataFrame:
    """``events`` of a stream, counted as they pass, or those for which ``sent`` is not null; ``FeedMetrics`` picks the count up."""
    return events.observe(NAME, F.count(F.lit(1) if sent is None else sent).alias("events"))


class FeedMetrics(StreamingQueryListener):
    """Writes ``<path>/N.json`` for each batch that had input: events sent, rows read, duration and rate.

    With one file of ``CHUNK_SIZE`` rows a batch, a batch is a chunk of the feed. A batch that is run again replaces its record. The
    listener is called for all queries of a session; it keeps to those that carry the metric.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.ended: set[str] = set()
        self.change = threading.Condition()

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        progress = event.progress
        counted = progress.observedMetrics.get(NAME)
        if counted is None or not progress.numInputRows:
            return
        seconds = max(progress.batchDuration, 1) / 1000
        record = {
            "batch_id": progress.batchId,
            "events_in_chunk": counted["events"],
            "input_rows": progress.numInputRows,
            "seconds": seconds,
            "rows_per_second": counted["events"] / seconds,
            "finished_at": progress.timestamp,
        }
        put_text(self.spark, f"{self.path}/{progress.batchId:019d}.json", json.dumps(record))

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        with self.change:
            self.ended.add(str(event.id))
            self.change.notify_all()

    def wait_for(self, query: StreamingQuery, seconds: float = 60) -> None:
        """Until the records of a query that has ended are written; progress is told in the background."""
        with self.change:
            if not self.change.wait_for(lambda: str(query.id) in self.ended, seconds):
                raise TimeoutError(f"no end of query {query.id} was told within {seconds} s")


def read_feed_metrics(spark: SparkSession, path: str) -> DataFrame:
    """One row per batch, with the total sent so far. The table has a row per chunk, so it is small beside the feed."""
    names = names_in(spark, path)
    if not names:
        return spark.createDataFrame([], METRICS_SCHEMA + ", total_sent bigint")
    return _with_total(spark.read.schema(METRICS_SCHEMA).json(path), "batch_id")


def chunk_metrics(counts: DataFrame, batches: DataFrame) -> DataFrame:
    """One row per chunk from the ``counts`` of each (``batch_id``, ``chunk``), with the total sent so far and the rate of its batch.

    For a stream whose batches carry several chunks; ``batches`` is what ``read_feed_metrics`` gives.
    """
    rates = batches.select("batch_id", "seconds", "rows_per_second", "finished_at")
    return _with_total(counts.join(F.broadcast(rates), "batch_id", "left"), "chunk")


def _with_total(counts: DataFrame, by: str) -> DataFrame:
    so_far = Window.orderBy(by).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return counts.withColumn("total_sent", F.sum("events_in_chunk").over(so_far))
