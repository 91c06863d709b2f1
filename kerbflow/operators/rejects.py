"""Why an event does not reach the result, so that it can be kept and counted."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbflow.schema import EVENT_SCHEMA

BAD_JSON = "bad_json"
BAD_TIME = "bad_time"
NO_LOCATION = "no_location"
OUT_OF_RANGE = "out_of_range"


def with_reject_reason(events: DataFrame) -> DataFrame:
    """``reject_reason`` of each decoded and enriched event, NULL for a good one.

    ``bad_json``: no known field could be read. ``bad_time``: no event time. ``no_location``: the event
    is counted but its group never leaves the job.
    """
    fields = [F.col(name) for name in EVENT_SCHEMA.names if name in events.columns]
    reason = (
        F.when(F.coalesce(*[column.cast("string") for column in fields]).isNull(), BAD_JSON)
        .when(F.col("event_time").isNull(), BAD_TIME)
        .when(F.col("pickup_location").isNull(), NO_LOCATION)
    )
    return events.withColumn("reject_reason", reason)


def reject_counts(events: DataFrame) -> DataFrame:
    """Events per reason; ``accepted`` for the rest."""
    return events.groupBy(F.coalesce("reject_reason", F.lit("accepted")).alias("reason")).agg(
        F.count(F.lit(1)).alias("event_count")
    )
