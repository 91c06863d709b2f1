"""Single events, for the raw event table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbflow.operators import (
    decode_messages,
    out_of_range,
    to_table_types,
    with_event_time,
    with_locations,
    with_reject_reason,
)
from kerbflow.operators.rejects import NO_LOCATION, OUT_OF_RANGE
from kerbflow.schema import EVENT_SCHEMA, RAW_TABLE_TYPES, ZONE_SCHEMA

# Offsets of one partition stay below this, so (partition, offset) packs into one number.
OFFSETS_PER_PARTITION = 2**48


def message_id(messages: DataFrame) -> Column:
    """Row id that is the same each time a message is read: its place in the topic.

    Without a place, a hash of the payload; equal payloads then share an id.
    """
    if {"partition", "offset"} <= set(messages.columns):
        return F.col("partition").cast("bigint") * OFFSETS_PER_PARTITION + F.col("offset")
    return F.xxhash64("value")


def raw_events(messages: DataFrame, on_overflow: str = "null", location_key: str = "grid") -> DataFrame:
    """Every message as a row of the raw event table, with ``reject_reason`` and the payload.

    A number too large for its column is stored as NULL and the row marked ``out_of_range``, so one such message does not
    stop a stream at every restart; ``on_overflow="error"`` fails instead.
    """
    placed = messages.withColumn("id", message_id(messages))
    names = EVENT_SCHEMA.names + (ZONE_SCHEMA.names if location_key != "grid" else [])
    timed = with_event_time(decode_messages(placed, names, keep=("id", "value")))
    events = with_reject_reason(with_locations(timed, by=location_key))
    usable = F.coalesce("reject_reason", F.lit(NO_LOCATION)) == NO_LOCATION
    reason = F.when(usable & out_of_range(events, RAW_TABLE_TYPES), OUT_OF_RANGE).otherwise(F.col("reject_reason"))
    events = events.withColumn("reject_reason", reason)
    typed = {**RAW_TABLE_TYPES, "reject_reason": "string", "value": "binary"}
    return to_table_types(events, typed, on_overflow)
