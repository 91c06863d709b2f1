"""Row numbers without a gap and without one task that sorts everything."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbflow.session import scratch_dir

BLOCK_BITS = 33


def dense_numbers(df: DataFrame, order: Sequence[Column], to: str = "row_number", after: int = 0) -> DataFrame:
    """``df`` with the numbers ``after + 1``, ``after + 2``, ... in ``to``, in the given order.

    Rows are dealt out by ranges of the order and each range is sorted and numbered by itself; the table that this
    writes to the shared folder fixes the numbers, so a task that is run again does not change them. The ranges are
    counted, their counts summed up (one row per range), and each row takes the sum of the ranges before its own. Rows that are
    equal in ``order`` are numbered in any order, so name a unique column last. A column ``to`` of the input is replaced.
    """
    spark = df.sparkSession
    rest = [F.col(f"`{name}`") for name in df.columns if name.lower() != to.lower()]
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = placed.select(F.struct(*rest).alias("row"), F.monotonically_increasing_id().alias("place"))
    path = scratch_dir(spark, "numbers")
    placed.write.parquet(path)
    stored = spark.read.schema(placed.schema).parquet(path)
    block = F.shiftright("place", BLOCK_BITS).alias("block")
    counts = stored.groupBy(block).agg(F.count(F.lit(1)).alias("rows"))
    before = F.sum("rows").over(Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select("block", F.coalesce(before, F.lit(0)).alias("start"))
    number = F.col("start") + F.col("place").bitwiseAND(2**BLOCK_BITS - 1) + (after + 1)
    # One row per range: as many as the shuffle has partitions.
    return stored.withColumn("block", block).join(F.broadcast(starts), "block").select("row.*", number.alias(to))
