"""Fixed schemas of events, messages and results."""

from pyspark.sql import types as T

EVENT_SCHEMA = T.StructType(
    [
        T.StructField("tpep_pickup_datetime", T.StringType()),
        T.StructField("tpep_dropoff_datetime", T.StringType()),
        T.StructField("passenger_count", T.IntegerType()),
        T.StructField("trip_distance", T.DoubleType()),
        T.StructField("pickup_longitude", T.DoubleType()),
        T.StructField("pickup_latitude", T.DoubleType()),
        T.StructField("dropoff_longitude", T.DoubleType()),
        T.StructField("dropoff_latitude", T.DoubleType()),
        T.StructField("fare_amount", T.DoubleType()),
        T.StructField("total_amount", T.DoubleType()),
    ]
)

PICKUP_TIME = "tpep_pickup_datetime"

# Newer files hold zone numbers in place of coordinates. They are extra columns of a file, so a message may hold them
# as text, as a number or not at all.
ZONE_SCHEMA = T.StructType([T.StructField("pulocationid", T.StringType()), T.StructField("dolocationid", T.StringType())])
ZONE_FIELDS = {"pickup": "pulocationid", "dropoff": "dolocationid"}

# The fields the windowed aggregate reads. from_json parses every field it is given,
# so the aggregate asks for these alone.
AGGREGATE_FIELDS = (
    "tpep_pickup_datetime",
    "trip_distance",
    "pickup_longitude",
    "pickup_latitude",
    "fare_amount",
)

MESSAGE_SCHEMA = T.StructType(
    [
        T.StructField("value", T.BinaryType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
    ]
)

AGGREGATE_SCHEMA = T.StructType(
    [
        T.StructField("window_start", T.TimestampType()),
        T.StructField("window_end", T.TimestampType()),
        T.StructField("pickup_location", T.StringType()),
        T.StructField("trip_count", T.LongType()),
        T.StructField("avg_fare", T.DoubleType()),
        T.StructField("total_fare", T.DoubleType()),
        T.StructField("avg_trip_distance", T.DoubleType()),
    ]
)

AGGREGATE_KEYS = ("window_start", "window_end", "pickup_location")
AGGREGATE_MEASURES = ("trip_count", "avg_fare", "total_fare", "avg_trip_distance")

# Column types of the sink tables.
AGGREGATE_TABLE_TYPES = {
    "window_start": "timestamp",
    "window_end": "timestamp",
    "pickup_location": "varchar(100)",
    "trip_count": "bigint",
    "avg_fare": "decimal(10,2)",
    "total_fare": "decimal(12,2)",
    "avg_trip_distance": "decimal(8,4)",
    "processed_at": "timestamp",
    "batch_id": "bigint",
}

RAW_TABLE_TYPES = {
    "id": "bigint",
    "event_time": "timestamp",
    "pickup_location": "varchar(100)",
    "dropoff_location": "varchar(100)",
    "passenger_count": "int",
    "trip_distance": "decimal(8,4)",
    "fare_amount": "decimal(10,2)",
    "ingested_at": "timestamp",
}

RAW_STORED_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("event_time", T.TimestampType()),
        T.StructField("pickup_location", T.StringType()),
        T.StructField("dropoff_location", T.StringType()),
        T.StructField("passenger_count", T.IntegerType()),
        T.StructField("trip_distance", T.DecimalType(8, 4)),
        T.StructField("fare_amount", T.DecimalType(10, 2)),
        T.StructField("ingested_at", T.TimestampType()),
    ]
)


def changelog_schema(base: T.StructType = AGGREGATE_SCHEMA) -> T.StructType:
    """``base`` plus the micro-batch that wrote the row, taken from the folder name."""
    return T.StructType(base.fields + [T.StructField("batch_id", T.LongType())])
