"""Trip files to messages, and a bounded table replayed as a stream."""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbflow.operators import canonical_trips, dense_numbers, encode_messages, normalise_columns
from kerbflow.schema import PICKUP_TIME
from kerbflow.session import scratch_dir
from kerbflow.storage import move, names_in, set_modified


def trips_to_messages(trips: DataFrame, time_formats: Sequence[str] = (), keep: Sequence[str] = ()) -> DataFrame:
    """Messages for the rows of a delimited file (table or stream) whose pickup time can be read."""
    return encode_messages(canonical_trips(normalise_columns(trips), time_formats), keep)


def trips_to_counted_messages(trips: DataFrame, time_formats: Sequence[str] = (), keep: Sequence[str] = ()) -> DataFrame:
    """The same with the rows whose pickup time cannot be read, as rows without a ``value``, so that both can be counted."""
    read = canonical_trips(normalise_columns(trips), time_formats, unread=True)
    messages = encode_messages(read.withColumn("__sent", F.col(PICKUP_TIME).isNotNull()), [*keep, "__sent"])
    return messages.withColumn("value", F.when(F.col("__sent"), F.col("value"))).drop("__sent")


def _publish(spark: SparkSession, staged: str, topic: str, name: str) -> list[str]:
    """Move the files of one staged part into a folder that a stream follows; they appear one by one, each as a whole."""
    moved, run = [], uuid.uuid4().hex[:12]
    for number, file in enumerate(names_in(spark, staged)):
        moved.append(f"{topic}/{name}-{number:05d}-{run}.{file.split('.', 1)[1]}")
        move(spark, f"{staged}/{file}", moved[-1])
    return moved


def feed_batches(messages: DataFrame, part: Column, parts: int, path: str) -> Iterator[int]:
    """Make the rows with ``part`` = 0, 1, ... appear in ``path`` in turn, yielding after each.

    Run the stream between two parts and each part is one micro-batch, however many files it has. The rows are computed and
    written once, beside the topic; a part's files are then renamed into it.
    """
    spark, staged = messages.sparkSession, scratch_dir(messages.sparkSession, "feed")
    messages.withColumn("__part", part).write.partitionBy("__part").parquet(staged)
    for number in range(parts):
        _publish(spark, f"{staged}/__part={number}", path, f"part-{number:05d}")
        yield number


#: Milliseconds between the times of two chunks; a stream takes files by time.
CHUNK_STEP = 10


def chunk_of(file_name: str) -> Column:
    """The number of the chunk that a file of ``write_chunks`` holds, from 0."""
    return F.regexp_extract(file_name, r"^chunk-(\d+)-", 1).cast("bigint")


def write_chunks(
    rows: DataFrame,
    order: Sequence[Column],
    chunk_size: int,
    path: str,
    kind: str = "parquet",
    position: str | None = None,
    without: Sequence[str] = (),
    **options,
) -> int:
    """Write rows as files of ``chunk_size`` rows in the given order, and return how many there are.

    Files appear in ``path`` in that order, and their times tell it too, so a stream that follows the folder with
    ``maxFilesPerTrigger`` gets the next chunks in each batch. Places in the order come from ``dense_numbers``: no task
    sorts everything, and a chunk is written by one task. ``position`` names a column for the place, from 0; the columns
    in ``without`` are for the order alone. The file system must let the time of a file be set.
    """
    spark, staged = rows.sparkSession, scratch_dir(rows.sparkSession, "chunks")
    placed = dense_numbers(rows, order, "__place").withColumn("__place", F.col("__place") - 1)
    if position:
        placed = placed.withColumn(position, F.col("__place"))
    chunked = placed.withColumn("__chunk", F.expr(f"__place div {int(chunk_size)}"))
    ready = chunked.repartition("__chunk").sortWithinPartitions("__chunk", "__place").drop("__place", *without)
    ready.write.partitionBy("__chunk").format(kind).options(**options).save(staged)
    chunks = sorted(int(name.split("=")[1]) for name in names_in(spark, staged))
    begin = int(time.time() * 1000) - CHUNK_STEP * len(chunks)
    for number in chunks:
        for file in _publish(spark, f"{staged}/__chunk={number}", path, f"chunk-{number:09d}"):
            set_modified(spark, file, begin + CHUNK_STEP * number)
    return len(chunks)
