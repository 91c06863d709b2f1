"""Command line: feed a topic, run the aggregate job, look at its results.

    python -m kerbflow feed            trip file to JSON messages on the topic
    python -m kerbflow stream          messages to windowed results in the database
    python -m kerbflow raw --out DIR   messages to stored events and rejects
    python -m kerbflow verify          the 20 newest windows
    python -m kerbflow count           rows of the result table
    python -m kerbflow peek            the first 5 messages
    python -m kerbflow metrics --out DIR   messages and rate of the last 20 batches
    python -m kerbflow late --out DIR      rows of each batch that came too late, after stream --keep-late
    python -m kerbflow compact --out DIR   take finished batches into the snapshot that reports read

Settings come from the environment, see ``FlowConfig``. ``--topic-dir`` and ``--out`` name folders to use in place
of the topic and of the database. Results of each topic and window shape have a folder of their own below ``--out``, so
``verify``, ``count``, ``metrics`` and ``compact`` take the same settings and folders as ``stream`` did. ``feed --out DIR`` keeps the rows whose pickup time
cannot be read in ``DIR/feed-rejects``. To a folder the feed writes files of ``CHUNK_SIZE`` messages in order of pickup time; ``stream`` and ``raw``
take as many of them a batch as ``MAX_OFFSETS_PER_TRIGGER`` allows.
"""

from __future__ import annotations

import argparse
import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbflow.config import FlowConfig
from kerbflow.operators import canonical_trips, encode_messages, latest_versions, normalise_columns, unread_trips
from kerbflow.plans import compact as compact_results
from kerbflow.plans import (
    aggregates_with_events,
    newest_results,
    newest_windows,
    peek_messages,
    raw_events,
    read_latest,
    remove_compacted,
    total_rows,
    trip_aggregates,
    write_chunks,
)
from kerbflow.schema import PICKUP_TIME
from kerbflow.session import build_session
from kerbflow.sinks import CommittedSink, JdbcSink, LateRowsSink, RawEventSink, read_late_rows, write_kafka
from kerbflow.sources import read_jdbc_table, read_kafka, read_message_files, read_mixed_trips, stream_kafka, stream_message_files
from kerbflow.storage import claim
from kerbflow.streaming import BatchLog, FeedMetrics, checkpoint_path, read_feed_metrics, start, with_feed_metrics


def _stream_source(spark: SparkSession, config: FlowConfig, args: argparse.Namespace) -> DataFrame:
    if not args.topic_dir:
        return stream_kafka(spark, config)
    most = config.max_offsets_per_trigger
    return stream_message_files(spark, args.topic_dir, max_files=max(1, most // config.chunk_size) if most else None)


def _source_name(config: FlowConfig, args: argparse.Namespace) -> str:
    return args.topic_dir or f"{config.kafka_servers}/{config.kafka_topic}"


def _result_folder(config: FlowConfig, args: argparse.Namespace) -> str:
    return f"{args.out.rstrip('/')}/{config.checkpoint_name('run', _source_name(config, args))}"


def _checkpoint(spark: SparkSession, config: FlowConfig, args: argparse.Namespace, label: str) -> str:
    sink = args.out or f"{config.jdbc_url}/{config.aggregate_table}"
    return checkpoint_path(spark, config, label, _source_name(config, args), sink)


def feed(spark: SparkSession, config: FlowConfig, args: argparse.Namespace) -> None:
    formats = config.time_patterns
    trips = read_mixed_trips(spark, config.data_path, lambda df: canonical_trips(normalise_columns(df), formats))
    if args.out:
        lost = read_mixed_trips(spark, config.data_path, lambda df: unread_trips(normalise_columns(df), formats))
        lost.write.mode("append").parquet(f"{args.out.rstrip('/')}/feed-rejects")
    if args.topic_dir:
        ordered = encode_messages(trips.withColumn("__order", F.col(PICKUP_TIME)), keep=("__order",))
        write_chunks(ordered, [F.asc("__order"), F.asc("value")], config.chunk_size, args.topic_dir.rstrip("/"), without=["__order"])
    else:
        write_kafka(encode_messages(trips), config)


def stream(spark: SparkSession, config: FlowConfig, args: argparse.Namespace) -> None:
    messages = _stream_source(spark, config, args)
    if args.out:
        messages = with_feed_metrics(messages)
        spark.streams.addListener(FeedMetrics(spark, f"{_result_folder(config, args)}/metrics"))
    if args.keep_late:
        result, sink = aggregates_with_events(messages, config), LateRowsSink(_result_folder(config, args), config)
    else:
        result = trip_aggregates(messages, config)
        sink = CommittedSink(_result_folder(config, args)) if args.out else JdbcSink(config)
    _run(spark, result, sink, _checkpoint(spark, config, args, "trip-aggregates"), "update", config, args)


def raw(spark: SparkSession, config: FlowConfig, args: argparse.Namespace) -> None:
    events = raw_events(_stream_source(spark, config, args), config.on_overflow, config.location_key)
    checkpoint = _checkpoint(spark, config, args, "raw-events")
    claim(spark, args.out, checkpoint)
    _run(spark, events, RawEventSink(args.out), checkpoint, "append", config, args)


def _run(spark, result, sink, checkpoint, mode, config, args) -> None:
    spark.streams.addListener(BatchLog())
    interval = None if args.once else config.trigger_interval
    start(
        result, sink, checkpoint, output_mode=mode, interval=interval, state_store=config.state_store
    ).awaitTermination()


def verify(spark: SparkSession, config: FlowConfig, args: argparse.Namespace) -> None:
    if args.out:
        newest = newest_results(spark, _result_folder(config, args))
    else:
        newest = newest_windows(latest_versions(read_jdbc_table(spark, config)))
    newest.show(20, truncate=False)


def count(spark: SparkSession, config: FlowConfig, args: argparse.Namespace) -> None:
    latest = read_latest(spark, _result_folder(config, args)) if args.out else latest_versions(read_jdbc_table(spark, config))
    total_rows(latest).show()


def metrics(spark: SparkSession, config: FlowConfig, args: argparse.Namespace) -> None:
    stored = read_feed_metrics(spark, f"{_result_folder(config, args)}/metrics")
    stored.orderBy(F.desc("batch_id")).limit(20).show(20, truncate=False)


def late(spark: SparkSession, config: FlowConfig, args: argparse.Namespace) -> None:
    missed = read_late_rows(spark, _result_folder(config, args))
    counts = missed.groupBy("batch_id").agg(F.count("*").alias("late_rows"), F.countDistinct("event_time").alias("event_times"))
    counts.orderBy(F.desc("batch_id")).limit(20).show()


def compact(spark: SparkSession, config: FlowConfig, args: argparse.Namespace) -> None:
    compact_results(spark, _result_folder(config, args))
    remove_compacted(spark, _result_folder(config, args))


def peek(spark: SparkSession, config: FlowConfig, args: argparse.Namespace) -> None:
    messages = read_message_files(spark, args.topic_dir) if args.topic_dir else read_kafka(spark, config)
    peek_messages(messages).show(truncate=False)


COMMANDS = {command.__name__: command for command in (feed, stream, raw, verify, count, peek, metrics, late, compact)}


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="kerbflow", description="Windowed analytics over trip events")
    parser.add_argument("command", choices=COMMANDS)
    parser.add_argument("--topic-dir", help="folder of message files in place of the topic")
    parser.add_argument("--out", help="folder of results in place of the database")
    parser.add_argument("--once", action="store_true", help="process what there is, then stop")
    parser.add_argument("--keep-late", action="store_true", help="stream: keep rows that come too late for a window, beside the results")
    args = parser.parse_args(argv)
    if args.keep_late and not args.out:
        parser.error("--keep-late needs --out")
    if args.command in ("raw", "metrics", "late", "compact") and not args.out:
        parser.error(f"{args.command} needs --out")
    logging.basicConfig(level=logging.INFO, format="%(asctime)s [%(levelname)s] %(message)s")
    COMMANDS[args.command](build_session(), FlowConfig.from_env(), args)


if __name__ == "__main__":
    main()
