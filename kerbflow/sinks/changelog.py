"""Micro-batches to folders, one folder per batch."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from kerbflow.operators.rejects import BAD_JSON, BAD_TIME
from kerbflow.operators.windows import drop_null_location

log = logging.getLogger(__name__)


class BatchFolderSink:
    """Callback for ``foreachBatch`` that writes batch N to ``<path>/batch_id=N``.

    A batch that is run again after a failure overwrites its own folder, so a reader of the
    whole path sees each batch once. The rows are counted while they are written: one job per
    batch, and nothing is cached.
    """

    def __init__(
        self, path: str, prepare: Callable[[DataFrame], DataFrame] = drop_null_location, stamp: str | None = "processed_at"
    ):
        self.path = path
        self.prepare = prepare
        self.stamp = stamp

    def __call__(self, batch: DataFrame, batch_id: int) -> int:
        rows = self.prepare(batch)
        if self.stamp:
            rows = rows.withColumn(self.stamp, F.current_timestamp())
        counted = Observation()
        rows = rows.observe(counted, F.count(F.lit(1)).alias("written"))
        rows.write.mode("overwrite").parquet(f"{self.path}/batch_id={batch_id}")
        written = counted.get["written"]
        log.info("batch %d: %s", batch_id, f"{written} rows written" if written else "no rows")
        return written


class RawEventSink:
    """Callback that stores the events of a batch, and beside them those that could not be used.

    Good events and events without a location go to ``<path>/events``; whatever has a reject reason
    goes to ``<path>/rejects``. The batch is cached since it is read twice.
    """

    def __init__(self, path: str):
        stored = F.col("reject_reason").isNull() | ~F.col("reject_reason").isin(BAD_JSON, BAD_TIME)
        self.events = BatchFolderSink(f"{path}/events", lambda df: df.filter(stored).drop("reject_reason", "value"), "ingested_at")
        self.rejects = BatchFolderSink(
            f"{path}/rejects",
            lambda df: df.filter("reject_reason is not null").select("id", "value", "reject_reason"),
            "ingested_at",
        )

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            self.events(batch, batch_id)
            self.rejects(batch, batch_id)
        finally:
            batch.unpersist()
