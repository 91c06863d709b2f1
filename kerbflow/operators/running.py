"""Events per chunk of the feed and the running total."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK_CHUNKS = 1000


def running_totals(events: DataFrame, ordinal: str, chunk_size: int, keep: str | None = None) -> DataFrame:
    """Events of each chunk of ``chunk_size`` input rows, and the total sent up to its end.

    ``ordinal`` is the row number in the input, from 0. Rows for which ``keep`` (a SQL condition) is
    not true fill their chunk but are not sent, so a chunk can hold 0 events.

    A running total needs an order over all chunks, and there may be very many. They are cut into blocks
    of 1,000 consecutive chunks: only the block sums are put in one sequence, and the chunks of a block are then
    summed in parallel with the others. No job runs while the plan is built.
    """
    sent = F.count(F.when(F.expr(keep), 1)) if keep else F.count(F.lit(1))
    chunks = (
        events.groupBy(F.expr(f"{ordinal} div {chunk_size}").alias("chunk"))
        .agg(sent.alias("events_in_chunk"))
        .withColumn("block", F.expr(f"chunk div {BLOCK_CHUNKS}"))
    )
    in_order = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (
        chunks.groupBy("block")
        .agg(F.sum("events_in_chunk").alias("block_total"))
        .select("block", F.coalesce(F.sum("block_total").over(in_order), F.lit(0)).alias("sent_before"))
    )
    in_block = Window.partitionBy("block").orderBy("chunk").rowsBetween(Window.unboundedPreceding, 0)
    # A left join adds no test for NULL to one side alone, so both sides share one shuffle of the counts.
    return chunks.join(blocks, "block", "left").select(
        "chunk",
        "events_in_chunk",
        (F.col("sent_before") + F.sum("events_in_chunk").over(in_block)).alias("total_sent"),
    )
