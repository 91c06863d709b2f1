"""Append to a database table."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from kerbflow.config import FlowConfig
from kerbflow.operators.coerce import out_of_range, to_table_types
from kerbflow.operators.windows import drop_null_location
from kerbflow.schema import AGGREGATE_TABLE_TYPES

log = logging.getLogger(__name__)


def jdbc_options(config: FlowConfig, table: str) -> dict[str, str]:
    """Connection options, without user or password where none is set."""
    options = {
        "url": config.jdbc_url,
        "dbtable": table,
        "driver": config.jdbc_driver,
        "batchsize": str(config.jdbc_batch_rows),
        "numPartitions": str(config.jdbc_max_connections),
        "user": config.jdbc_user,
        "password": config.jdbc_password,
    }
    return {key: value for key, value in options.items() if value is not None}


class JdbcSink:
    """Callback for ``foreachBatch`` that appends the rows of a batch, at most ``jdbc_max_connections`` at a time.

    A batch that is run again after a failure is appended again. Each row carries its ``batch_id``, so that
    ``latest_versions`` over the table gives one row per window all the same. ``with_batch_id=False`` is for a table without
    that column. The rows are counted while they are written.
    """

    def __init__(self, config: FlowConfig, table: str | None = None, with_batch_id: bool = True):
        self.config = config
        self.table = table or config.aggregate_table
        self.with_batch_id = with_batch_id

    def __call__(self, batch: DataFrame, batch_id: int) -> int:
        rows = drop_null_location(batch).persist()
        try:
            if rows.isEmpty():
                log.info("batch %d: no rows", batch_id)
                return 0
            stamped = rows.withColumn("processed_at", F.current_timestamp())
            if self.with_batch_id:
                stamped = stamped.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
            counted = Observation()
            too_large = F.count_if(out_of_range(stamped, AGGREGATE_TABLE_TYPES)).alias("too_large")
            watched = stamped.observe(counted, F.count(F.lit(1)).alias("written"), too_large)
            typed = to_table_types(watched, AGGREGATE_TABLE_TYPES, self.config.on_overflow)
            typed.write.format("jdbc").options(**jdbc_options(self.config, self.table)).mode("append").save()
            written = counted.get["written"]
            log.info("batch %d: %d rows written", batch_id, written)
            if counted.get["too_large"]:
                log.warning("batch %d: %d rows hold a number too large for its column, stored as NULL", batch_id, counted.get["too_large"])
            return written
        finally:
            rows.unpersist()
