"""Trip events derived from the generic ``events`` table, for queries and tests without a trip file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbflow.functions import iso_text

# Number of partitions of the message topic.
TOPIC_PARTITIONS = 3


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def props_k() -> Column:
    """The number ``k`` of ``props``, which holds ``{"k": 0..99}``."""
    return F.regexp_extract("props", r'"k": *(-?\d+)', 1).try_cast("int")


def trip_events(events: DataFrame, *, keep: tuple[str, ...] = (), text_times: bool = True) -> DataFrame:
    """The ten event fields of each row of ``events``, in time order by ``event_id``.

    Positions stay clear of rounding ties; ``error`` rows have no pickup latitude and ``signup`` rows no
    fare. ``text_times=False`` leaves the pickup time a timestamp, as a typed table would hold it.
    """
    k = F.col("k")

    def latitude(user):
        return (F.lit(4_060_000) + (user % 30) * 137).cast("double") / 100_000

    def longitude(step):
        return -(F.lit(7_400_000) - step * 89).cast("double") / 100_000

    user = F.col("user_id")
    pickup = F.col("ts").cast("timestamp")
    dropoff = F.timestamp_add("MINUTE", (3 + k % 58).cast("int"), pickup)
    return events.withColumn("k", props_k()).select(
        (iso_text(pickup) if text_times else pickup).alias("tpep_pickup_datetime"),
        F.date_format(dropoff, "yyyy-MM-dd HH:mm:ss").alias("tpep_dropoff_datetime"),
        (k % 6 + 1).cast("int").alias("passenger_count"),
        (k / F.lit(4.0)).alias("trip_distance"),
        longitude(k).alias("pickup_longitude"),
        F.when(F.col("event_type") != "error", latitude(user)).alias("pickup_latitude"),
        longitude((k + 13) % 100).alias("dropoff_longitude"),
        latitude(user + 7).alias("dropoff_latitude"),
        F.when(F.col("event_type") != "signup", F.col("value")).alias("fare_amount"),
        F.round(F.col("value") + 1.3, 2).alias("total_amount"),
        *keep,
    )


def topic_position(events: DataFrame) -> DataFrame:
    """Partition and offset each row would have in a topic filled round robin in ``event_id`` order."""
    return events.withColumns(
        {
            "partition": (F.col("event_id") % TOPIC_PARTITIONS).cast("int"),
            "offset": F.expr(f"event_id div {TOPIC_PARTITIONS}"),
        }
    )
