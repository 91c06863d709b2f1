"""Start of a streaming query with a per-batch callback."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from kerbflow.config import FlowConfig
from kerbflow.session import named_dir, session_settings

# State in RocksDB stays off the executors' heap, so it may outgrow memory; a commit uploads the changes
# alone. Keeping count of the rows would cost one more lookup per update. The store in memory is about twice as
# fast while all open windows fit in the heap.
STATE_STORES = {
    "rocksdb": {
        "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
        "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
    },
    "memory": {},
}

BatchSink = Callable[[DataFrame, int], object]


def checkpoint_path(
    spark: SparkSession, config: FlowConfig, label: str = "trip-aggregates", source: str = "", sink: str = ""
) -> str:
    """The folder set in the config, else the cluster's shared folder, plus a name for this run.

    One of the two must be set, also in a local session: a folder that is new at each start would forget what was read.
    """
    base = config.checkpoint_dir or named_dir(spark)
    if not base:
        raise ValueError("set CHECKPOINT_DIR or spark.checkpoint.dir, so that a restart finds its checkpoint")
    return f"{base.rstrip('/')}/{config.checkpoint_name(label, source, sink)}"


def start(
    result: DataFrame,
    sink: BatchSink,
    checkpoint: str,
    *,
    output_mode: str = "update",
    interval: str | None = None,
    state_store: str = "rocksdb",
    settings: dict[str, str] | None = None,
) -> StreamingQuery:
    """Run ``sink`` on every micro-batch: each ``interval``, or once over all there is when it is None.

    The number of state partitions is ``spark.sql.shuffle.partitions`` at the first start and stays so
    for the life of the checkpoint; choose it for the cluster before that.
    """
    trigger = {"processingTime": interval} if interval else {"availableNow": True}

    def callback(batch: DataFrame, batch_id: int) -> None:
        sink(batch, batch_id)

    writer = (
        result.writeStream.outputMode(output_mode)
        .foreachBatch(callback)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
    )
    with session_settings(result.sparkSession, {**STATE_STORES[state_store], **(settings or {})}):
        return writer.start()


def run_available_now(result: DataFrame, sink: BatchSink, checkpoint: str, **options) -> StreamingQuery:
    """Process everything available, then stop. Raises what a batch raised."""
    query = start(result, sink, checkpoint, **options)
    query.awaitTermination()
    return query
