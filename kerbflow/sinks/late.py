"""Results of each batch, and beside them the window rows that came too late for their window."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbflow.config import FlowConfig, duration_micros
from kerbflow.schema import AGGREGATE_SCHEMA
from kerbflow.sinks.committed import KIND, LATE, RESULT, Commit, CommittedSink, commit_of
from kerbflow.sources.committed import read_committed

LATE_SCHEMA = T.StructType(
    [
        *AGGREGATE_SCHEMA.fields[:3],
        T.StructField("event_time", T.TimestampType()),
        T.StructField("fare_amount", T.DoubleType()),
        T.StructField("trip_distance", T.DoubleType()),
    ]
)


class LateRowsSink(CommittedSink):
    """Callback for batches of ``aggregates_with_events``: results to ``kind=result``, late window rows to ``kind=late``.

    A batch drops a row for a window that ended by the watermark of the batch before it, which is the newest event
    time up to two batches ago less the delay. Each commit carries the newest event time so far and the mark that held, so the mark
    is found again after a restart, and a batch that is run again has the same late rows. Both kinds are written in one pass, nothing is
    cached, and no event is spread over its windows unless one of them is closed.
    """

    def __init__(self, path: str, config: FlowConfig = FlowConfig()):
        super().__init__(path)
        self.size, self.slide = config.window.size_micros, config.window.slide_micros
        self.delay = duration_micros(config.watermark_delay)
        self.watched = [F.max(F.unix_micros("event_time")).alias("newest")]

    def mark(self, spark: SparkSession, batch_id: int) -> int | None:
        """Microseconds up to which windows are closed to this batch; None while nothing is."""
        two_ago = commit_of(spark, self.path, batch_id - 2)
        return None if two_ago is None or two_ago.newest is None else two_ago.newest - self.delay

    def rows_of(self, batch: DataFrame, batch_id: int, before: Commit | None) -> DataFrame:
        self.in_force = mark = self.mark(batch.sparkSession, batch_id)
        results = (F.col(KIND) == RESULT) & F.col("pickup_location").isNotNull()
        if mark is None:
            return batch.filter(results)
        at, down = F.unix_micros("event_time"), lambda t: t - F.pmod(t, F.lit(self.slide))
        first = down(at - self.size) + self.slide
        last_closed = F.least(down(at), down(F.lit(mark - self.size)))
        late = (F.col(KIND) == LATE) & (first + self.size <= mark)
        # A filter and a generator over the batch, which is computed once: it holds the state's update.
        starts = F.when(F.col(KIND) == LATE, F.sequence(first, last_closed, F.lit(self.slide)))
        window = lambda s: F.struct(F.timestamp_micros(s).alias("start"), F.timestamp_micros(s + self.size).alias("end"))
        own = F.array(F.struct(F.col("window_start").alias("start"), F.col("window_end").alias("end")))
        rows = batch.filter(results | late).withColumn("w", F.explode(F.coalesce(F.transform(starts, window), own)))
        return rows.withColumns({"window_start": F.col("w.start"), "window_end": F.col("w.end")}).drop("w")

    def write(self, rows: DataFrame, folder: str) -> None:
        rows.write.partitionBy(KIND).parquet(folder)

    def committed(self, commit: Commit, before: Commit | None, seen: dict) -> Commit:
        known = [t for t in (before.newest if before else None, seen["newest"]) if t is not None]
        return replace(commit, newest=max(known, default=None), late_mark=self.in_force)


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """Results of every committed batch, with its ``batch_id``."""
    return read_committed(spark, path)


def read_late_rows(spark: SparkSession, path: str) -> DataFrame:
    """One row per event and closed window that it missed, with the batch it came in."""
    return read_committed(spark, path, LATE_SCHEMA, kind=LATE)
