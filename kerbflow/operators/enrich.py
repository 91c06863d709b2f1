"""Event time and location of each event."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbflow.config import LOCATION_KEYS
from kerbflow.functions import grid_key, missing_to_null, parse_time, whole_number, zone_key
from kerbflow.operators.barrier import computed_once
from kerbflow.schema import PICKUP_TIME, ZONE_FIELDS


def with_event_time(events: DataFrame, time_formats: Sequence[str] = ()) -> DataFrame:
    """``event_time`` from the pickup time, which may be text or a timestamp already.

    It is a timestamp with the session zone, since a watermark accepts no other type. Text is read
    once, together with whatever the event was decoded from.
    """
    column = F.col(PICKUP_TIME)
    if dict(events.dtypes)[PICKUP_TIME] != "string":
        return events.withColumn("event_time", column.cast("timestamp"))
    return computed_once(events.withColumn("event_time", parse_time(column, time_formats)))


def drop_bad_time(events: DataFrame) -> DataFrame:
    return events.filter(F.col("event_time").isNotNull())


def with_locations(events: DataFrame, dp: int = 2, by: str = "grid") -> DataFrame:
    """Location keys of the pickup point and, where the event has one, of the dropoff point.

    ``by="grid"`` takes the coordinates, ``"zone"`` the zone number, ``"grid_or_zone"`` the number where coordinates are missing.
    """
    if by not in LOCATION_KEYS:
        raise ValueError(f"by is one of: {', '.join(LOCATION_KEYS)}")

    def keys(side: str):
        if by != "zone" and f"{side}_latitude" in events.columns:
            yield grid_key(missing_to_null(F.col(f"{side}_latitude")), missing_to_null(F.col(f"{side}_longitude")), dp)
        if by != "grid" and ZONE_FIELDS[side] in events.columns:
            yield zone_key(whole_number(F.col(ZONE_FIELDS[side])))

    found = {f"{side}_location": list(keys(side)) for side in ("pickup", "dropoff")}
    return events.withColumns({name: F.coalesce(*columns) for name, columns in found.items() if columns})
