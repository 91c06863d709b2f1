"""Messages or typed events to windowed results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbflow.config import FlowConfig
from kerbflow.operators import (
    decode_messages,
    drop_bad_time,
    only_located,
    windowed_aggregate,
    windowed_partials,
    with_event_time,
    with_locations,
)
from kerbflow.schema import AGGREGATE_FIELDS, ZONE_FIELDS
from kerbflow.sinks.committed import KIND, LATE, RESULT


def _fields(config: FlowConfig) -> list[str]:
    """What the aggregate reads: coordinates, zone number or both."""
    grid, zone = ("pickup_latitude", "pickup_longitude"), ZONE_FIELDS["pickup"]
    names = [name for name in AGGREGATE_FIELDS if config.location_key != "zone" or name not in grid]
    return names if config.location_key == "grid" else [*names, zone]


def trip_aggregates(messages: DataFrame, config: FlowConfig = FlowConfig(), *, panes: bool | None = None) -> DataFrame:
    """Results of a message table or stream, groups without a location included."""
    return _aggregates(decode_messages(messages, _fields(config)), config, panes)


def typed_trip_aggregates(
    events: DataFrame, config: FlowConfig = FlowConfig(), *, panes: bool | None = None
) -> DataFrame:
    """The same from event rows, with a pickup time as text or as a timestamp.

    On a stream the watermark is set after bad times are dropped and before anything else is, so
    that events without a location move it too. ``drop_null_location_early`` gives that up for less state;
    on a table it changes nothing but the cost and the absence of the groups without a location, and its NULL tests
    reach the scan whatever type the pickup time has.
    """
    fields = events.select(*_fields(config))
    if config.location_key == "grid" and config.drop_null_location_early and not fields.isStreaming:
        fields = only_located(fields)
    return _aggregates(fields, config, panes)


def trip_partials(messages: DataFrame, part: str, config: FlowConfig = FlowConfig()) -> DataFrame:
    """The share of each ``part`` of a message stream in each window and location, for ``running_versions``.

    The column ``part`` numbers the parts in the order they come in, as batches of the stream would; a micro-batch holds whole ones.
    """
    timed = _timed(decode_messages(messages, _fields(config), keep=(part,)), config)
    if config.location_key == "grid":
        return windowed_partials(timed, config.window, part)
    return windowed_partials(with_locations(timed, by=config.location_key), config.window, part, by="pickup_location")


def aggregates_with_events(messages: DataFrame, config: FlowConfig = FlowConfig()) -> DataFrame:
    """``trip_aggregates`` of a stream and, in the same batches, the events they are made of, for ``LateRowsSink``.

    ``kind`` is ``result`` or ``late``; the latter rows are all events of the batch, of which the sink keeps those that a
    window was closed to. Both sides come from one source, so they hold the same messages in each batch.
    """
    timed = _timed(decode_messages(messages, _fields(config)), config)
    results = _windows(timed, config, None).withColumn(KIND, F.lit(RESULT))
    events = with_locations(timed, by=config.location_key)
    events = events.select("pickup_location", "event_time", "fare_amount", "trip_distance", F.lit(LATE).alias(KIND))
    return results.unionByName(events, allowMissingColumns=True)


def _timed(events: DataFrame, config: FlowConfig) -> DataFrame:
    timed = drop_bad_time(with_event_time(events))
    return timed.withWatermark("event_time", config.watermark_delay) if timed.isStreaming else timed


def _aggregates(events: DataFrame, config: FlowConfig, panes: bool | None) -> DataFrame:
    return _windows(_timed(events, config), config, panes)


def _windows(timed: DataFrame, config: FlowConfig, panes: bool | None) -> DataFrame:
    if config.location_key == "grid":
        if config.drop_null_location_early:
            timed = only_located(timed)
        return windowed_aggregate(timed, config.window, panes=panes)
    timed = with_locations(timed, by=config.location_key)
    if config.drop_null_location_early:
        timed = timed.filter("pickup_location is not null")
    return windowed_aggregate(timed, config.window, by="pickup_location", panes=panes)
