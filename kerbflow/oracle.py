"""The same answers in SQL over the given tables, written independently of the DataFrame code."""

from __future__ import annotations

# Trip fields of each event.
TRIPS = """
parsed AS (
  SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events
),
trips AS (
  SELECT event_id, event_type, ts, user_id, props, k,
    CAST(event_id % 3 AS INTEGER) AS "partition", event_id // 3 AS "offset",
    strftime(ts, '%Y-%m-%dT%H:%M:%S')
      || CASE WHEN microsecond(ts) % 1000000 = 0 THEN '' ELSE strftime(ts, '.%f') END AS tpep_pickup_datetime,
    strftime(ts + (3 + k % 58) * INTERVAL 1 MINUTE, '%Y-%m-%d %H:%M:%S') AS tpep_dropoff_datetime,
    k % 6 + 1 AS passenger_count,
    CAST(k AS DOUBLE) / 4 AS trip_distance,
    -CAST(7400000 - k * 89 AS DOUBLE) / 100000 AS pickup_longitude,
    CASE WHEN event_type <> 'error' THEN CAST(4060000 + (user_id % 30) * 137 AS DOUBLE) / 100000 END AS pickup_latitude,
    -CAST(7400000 - ((k + 13) % 100) * 89 AS DOUBLE) / 100000 AS dropoff_longitude,
    CAST(4060000 + ((user_id + 7) % 30) * 137 AS DOUBLE) / 100000 AS dropoff_latitude,
    CASE WHEN event_type <> 'signup' THEN value END AS fare_amount,
    round(value + CAST(1.3 AS DOUBLE), 2) AS total_amount
  FROM parsed
),
located AS (
  SELECT *,
    CAST(round(pickup_latitude, 2) AS VARCHAR) || ',' || CAST(round(pickup_longitude, 2) AS VARCHAR) AS pickup_location,
    CAST(round(dropoff_latitude, 2) AS VARCHAR) || ',' || CAST(round(dropoff_longitude, 2) AS VARCHAR) AS dropoff_location
  FROM trips
)"""

FIELDS = """tpep_pickup_datetime, tpep_dropoff_datetime, passenger_count, trip_distance, pickup_longitude,
  pickup_latitude, dropoff_longitude, dropoff_latitude, fare_amount, total_amount"""

# Each event in each of its five windows.
SPREAD = """
spread AS (
  SELECT located.*, time_bucket(INTERVAL '1 minute', ts) - i * INTERVAL 1 MINUTE AS window_start,
    time_bucket(INTERVAL '1 minute', ts) + (5 - i) * INTERVAL 1 MINUTE AS window_end
  FROM located, (SELECT unnest([0, 1, 2, 3, 4]) AS i) AS steps
)"""

# 1e-9 lifts exact half-cent ties over the double's own error; it is far below any other distance to a tie.
MEASURES = """count(*) AS trip_count,
    round(avg(fare_amount) + CAST(1e-9 AS DOUBLE), 2) AS avg_fare,
    round(sum(fare_amount), 2) AS total_fare,
    round(avg(trip_distance) + CAST(1e-9 AS DOUBLE), 4) AS avg_trip_distance"""

RESULT = f"""
result AS (
  SELECT window_start, window_end, pickup_location, {MEASURES}
  FROM spread GROUP BY ALL
)"""

WITH_RESULT = f"WITH {TRIPS},{SPREAD},{RESULT}"
FLAGSHIP = f"{WITH_RESULT} SELECT * FROM result WHERE pickup_location IS NOT NULL"

TUMBLING = f"""WITH {TRIPS}
SELECT time_bucket(INTERVAL '5 minutes', ts) AS window_start,
  time_bucket(INTERVAL '5 minutes', ts) + INTERVAL 5 MINUTE AS window_end, pickup_location, {MEASURES}
FROM located WHERE pickup_location IS NOT NULL GROUP BY ALL"""

# Running value of each window after each part, from the rows that were not late.
LOG = """
counted AS (
  SELECT part, window_start, window_end, pickup_location, count(*) AS n, count(fare_amount) AS n_fare,
    sum(fare_amount) AS fare, sum(trip_distance) AS distance
  FROM kept GROUP BY ALL
),
changelog AS (
  SELECT part AS batch_id, window_start, window_end, pickup_location,
    CAST(sum(n) OVER w AS BIGINT) AS trip_count,
    round(sum(fare) OVER w / nullif(sum(n_fare) OVER w, 0) + CAST(1e-9 AS DOUBLE), 2) AS avg_fare,
    round(sum(fare) OVER w, 2) AS total_fare,
    round(sum(distance) OVER w / sum(n) OVER w + CAST(1e-9 AS DOUBLE), 4) AS avg_trip_distance
  FROM counted WHERE pickup_location IS NOT NULL
  WINDOW w AS (PARTITION BY window_start, pickup_location ORDER BY part)
)"""

BY_TIME = f"""WITH {TRIPS},{SPREAD},
kept AS (SELECT *, CAST((day(ts) - 1) // 8 AS BIGINT) AS part FROM spread),{LOG}"""

# Rows of part b are late for a window that ended by the watermark after part b - 2.
MARKS = """
newest AS (SELECT part, max(ts) AS newest FROM parted GROUP BY part),
marks AS (
  SELECT a.part, max(b.newest) - INTERVAL 10 MINUTE AS late_mark
  FROM newest a JOIN newest b ON b.part <= a.part - 2 GROUP BY a.part
),
kept AS (
  SELECT parted.* FROM parted LEFT JOIN marks USING (part)
  WHERE late_mark IS NULL OR window_end > late_mark
)"""

BY_HASH = f"""WITH {TRIPS},{SPREAD},
parted AS (SELECT *, CAST((event_id * 7919 % 10007) * 4 // 10007 AS BIGINT) AS part FROM spread),
{MARKS},
missed AS (SELECT parted.* FROM parted JOIN marks USING (part) WHERE window_end <= late_mark),{LOG}"""

SPOILED = f"""WITH {TRIPS},
spoiled AS (
  SELECT *, k >= 90 AS cut, event_type = 'click' AS no_time,
    "partition" * CAST(281474976710656 AS BIGINT) + "offset" AS id
  FROM located
)"""

UNTIDY = """SELECT tpep_pickup_datetime, tpep_dropoff_datetime, passenger_count, trip_distance, pickup_longitude,
  pickup_latitude, CAST(NULL AS DOUBLE) AS dropoff_longitude, CAST(NULL AS DOUBLE) AS dropoff_latitude,
  fare_amount, CAST(NULL AS DOUBLE) AS total_amount"""


def _json(column: str, quoted: bool = False) -> str:
    text = f"""'"' || {column} || '"'""" if quoted else f"CAST({column} AS VARCHAR)"
    return f"""'"{column}":' || coalesce({text}, 'null')"""


# Time is replaced on clicks, as in the spoiled messages, when no_time is true.
PAYLOAD = "'{' || " + " || ',' || ".join(
    [
        _json("tpep_pickup_datetime", True),
        _json("tpep_dropoff_datetime", True),
        _json("passenger_count"),
        _json("trip_distance"),
        _json("pickup_longitude"),
        _json("pickup_latitude"),
        _json("dropoff_longitude"),
        _json("dropoff_latitude"),
        _json("fare_amount"),
        _json("total_amount"),
    ]
) + " || '}'"



def _exact(total: str, count: str, decimals: int, dp: int) -> str:
    """``total`` / ``count`` in wide whole numbers of 10**-decimals, half up to ``dp`` places; for totals of 0 and more."""
    step = 10 ** (decimals - dp)
    steps = f"((2 * {total} + {count} * {step}) // (2 * {count} * {step}))"
    return f"CAST({steps} // {10**dp} AS DOUBLE) + CAST({steps} % {10**dp} AS DOUBLE) / {10**dp}"


def _scaled(fare: str, distance: str, windows: str, group: str, where: str) -> str:
    """Aggregates of fares given in units of 1e-9; ``cents`` is the value in hundredths."""
    return f"""WITH {TRIPS},{SPREAD},
priced AS (
  SELECT *, {fare} AS fare FROM (
    SELECT {windows}.*, CAST(round(e.value * 100) AS HUGEINT) AS cents FROM {windows} JOIN events e USING (event_id)
  ) AS priced
),
summed AS (
  SELECT {group}, count(*) AS trip_count, sum(fare) AS s, nullif(count(fare), 0) AS n, {distance} AS avg_trip_distance
  FROM priced {where} GROUP BY ALL
)
SELECT window_start, window_end, pickup_location, trip_count, {_exact("s", "n", 9, 2)} AS avg_fare,
  {_exact("s", "CAST(1 AS HUGEINT)", 9, 2)} AS total_fare, avg_trip_distance FROM summed"""


_LARGE = f"cents * CAST({10**18} AS HUGEINT)"
_WINDOW = "window_start, window_end, pickup_location"
_LOCATED = "WHERE pickup_location IS NOT NULL"
_DISTANCE = "round(avg(trip_distance) + CAST(1e-9 AS DOUBLE), 4)"
_DAY = """time_bucket(INTERVAL '1 day', ts) AS window_start,
    time_bucket(INTERVAL '1 day', ts) + INTERVAL 1 DAY AS window_end, event_type AS pickup_location"""

ZONE = f"""WITH {TRIPS},{SPREAD}
SELECT window_start, window_end, 'zone:' || CAST(user_id % 265 + 1 AS VARCHAR) AS pickup_location, {MEASURES}
FROM spread GROUP BY ALL"""

RAW_EVENTS = f"""{SPOILED}
SELECT id, ts AS event_time, pickup_location, dropoff_location, passenger_count,
  CAST(trip_distance AS DECIMAL(8, 4)) AS trip_distance, CAST(fare_amount AS DECIMAL(10, 2)) AS fare_amount
FROM spoiled WHERE NOT cut AND NOT no_time"""

REJECTS = f"""{SPOILED},
damaged AS (
  SELECT * REPLACE (CASE WHEN no_time THEN 'yesterday' ELSE tpep_pickup_datetime END AS tpep_pickup_datetime)
  FROM spoiled
)
SELECT id,
  CASE WHEN cut THEN 'bad_json' WHEN no_time THEN 'bad_time' ELSE 'no_location' END AS reject_reason,
  CASE WHEN cut THEN substr({PAYLOAD}, 1, 40) ELSE {PAYLOAD} END AS payload
FROM damaged WHERE cut OR no_time OR pickup_location IS NULL"""

MIXED = f"""WITH {TRIPS}
SELECT event_id, ts AS event_time,
  CASE WHEN event_id % 3 = 2 THEN 'zone:' || CAST(user_id % 265 + 1 AS VARCHAR)
    ELSE CAST(round(pickup_latitude, 2) AS VARCHAR) || ',' || CAST(round(pickup_longitude, 2) AS VARCHAR) END AS pickup_location,
  trip_distance, fare_amount, CASE WHEN event_id % 3 = 2 THEN '2' END AS vendor
FROM trips WHERE event_type <> 'click' OR event_id % 3 = 2"""

SQL: dict[str, str] = {
    "normalise_headers": """SELECT event_id, ts AS tpep_pickup_datetime, user_id, event_type,
  value AS fare_amount, props FROM events""",
    "canonical_fields": f"WITH {TRIPS} {UNTIDY}, event_id FROM trips WHERE event_type <> 'click'",
    "csv_feed": f"WITH {TRIPS} {UNTIDY} FROM trips WHERE event_type <> 'click'",
    "csv_time_formats": f"WITH {TRIPS} {UNTIDY} FROM trips WHERE event_type <> 'click'",
    "csv_stream_feed": f"WITH {TRIPS} {UNTIDY} FROM trips WHERE event_type <> 'click'",
    "csv_mixed_headers": MIXED,
    "csv_stream_mixed_headers": MIXED,
    "encode_decode_json": f'WITH {TRIPS} SELECT {FIELDS}, "partition", "offset" FROM trips',
    "enrich_events": f"""WITH {TRIPS}
SELECT "partition", "offset", ts AS event_time, pickup_location, dropoff_location FROM located""",
    "bad_time_dropped": f"""{SPOILED}
SELECT "partition", "offset", ts AS event_time, fare_amount FROM spoiled WHERE NOT cut AND NOT no_time""",
    "rejects_by_reason": f"""{SPOILED}
SELECT CASE WHEN cut THEN 'bad_json' WHEN no_time THEN 'bad_time' WHEN pickup_location IS NULL THEN 'no_location'
  ELSE 'accepted' END AS reason, count(*) AS event_count
FROM spoiled GROUP BY ALL""",
    "window_agg_by_location": FLAGSHIP,
    "window_agg_panes": FLAGSHIP,
    "window_agg_direct": FLAGSHIP,
    "window_agg_with_null_location": f"{WITH_RESULT} SELECT * FROM result",
    "window_agg_null_location_dropped": FLAGSHIP,
    "tumbling_agg": TUMBLING,
    "window_agg_by_zone": ZONE,
    "window_agg_zone_messages": ZONE,
    "stream_zone": ZONE,
    "window_agg_large_values": _scaled(_LARGE, _DISTANCE, "spread", _WINDOW, _LOCATED),
    "window_agg_fine_values": _scaled(
        "cents", _exact("sum(cents)", "CAST(count(*) AS HUGEINT)", 7, 4), "spread", _WINDOW, _LOCATED
    ),
    "window_agg_mixed_values": _scaled(
        f"CASE WHEN event_id % 2 = 0 THEN {_LARGE} ELSE cents END", _DISTANCE, "located", _DAY, ""
    ),
    "sink_decimal_shape": f"""{WITH_RESULT}
SELECT window_start, window_end, pickup_location, trip_count,
  CAST(avg_fare AS DECIMAL(10, 2)) AS avg_fare, CAST(total_fare AS DECIMAL(12, 2)) AS total_fare,
  CAST(avg_trip_distance AS DECIMAL(8, 4)) AS avg_trip_distance
FROM result WHERE pickup_location IS NOT NULL""",
    "aggregate_table": f"""{WITH_RESULT}
SELECT window_start, window_end, pickup_location, trip_count,
  CAST(avg_fare AS DECIMAL(10, 2)) AS avg_fare, CAST(total_fare AS DECIMAL(12, 2)) AS total_fare,
  CAST(avg_trip_distance AS DECIMAL(8, 4)) AS avg_trip_distance, CAST(0 AS BIGINT) AS batch_id, true AS stamped
FROM result WHERE pickup_location IS NOT NULL""",
    "stream_fixed_interval": FLAGSHIP,
    "stream_update_single_batch": FLAGSHIP,
    "stream_tumbling": TUMBLING,
    "stream_append_closed": f"""{WITH_RESULT}
SELECT * FROM result WHERE pickup_location IS NOT NULL
  AND window_end <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE""",
    "stream_changelog_versions": f"{BY_TIME} SELECT * FROM changelog",
    "stream_late_data": f"{BY_HASH} SELECT * FROM changelog",
    "latest_per_window": f"""{BY_HASH}
SELECT window_start, window_end, pickup_location, trip_count, avg_fare, total_fare, avg_trip_distance
FROM changelog
QUALIFY row_number() OVER (PARTITION BY window_start, pickup_location ORDER BY batch_id DESC) = 1""",
    "restart_equals_unbroken": FLAGSHIP,
    "committed_batches": f"{BY_HASH} SELECT * FROM changelog",
    "snapshot_latest": f"""{BY_HASH}
SELECT window_start, window_end, pickup_location, trip_count, avg_fare, total_fare, avg_trip_distance
FROM changelog
QUALIFY row_number() OVER (PARTITION BY window_start, pickup_location ORDER BY batch_id DESC) = 1""",
    "stream_late_rows": f"""{BY_HASH}
SELECT part AS batch_id, window_start, window_end, pickup_location, ts AS event_time, fare_amount, trip_distance FROM missed""",
    "stream_late_accounted": f"""{BY_HASH}
SELECT part AS batch_id, count(*) FILTER (late_mark IS NULL OR window_end > late_mark) AS kept_rows,
  count(*) FILTER (window_end <= late_mark) AS late_rows
FROM parted LEFT JOIN marks USING (part) WHERE pickup_location IS NOT NULL GROUP BY part""",
    "stream_open_windows": f"""{WITH_RESULT}
SELECT * FROM result WHERE pickup_location IS NOT NULL
  AND window_end > (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE""",
    "stream_bounded_batches": f"""WITH {TRIPS},{SPREAD},
placed AS (SELECT event_id, CAST((row_number() OVER (ORDER BY ts, event_id) - 1) // 1000 // 3 AS BIGINT) AS part FROM events),
parted AS (SELECT spread.*, part FROM spread JOIN placed USING (event_id)),
{MARKS},{LOG}
SELECT * FROM changelog""",
    "dense_row_ids": "SELECT event_id, ts, row_number() OVER (ORDER BY ts, event_id) AS id FROM events",
    "raw_dense_ids": f"""WITH {TRIPS}
SELECT row_number() OVER (ORDER BY event_id) AS id, ts AS event_time, pickup_location, dropoff_location, passenger_count,
  CAST(trip_distance AS DECIMAL(8, 4)) AS trip_distance, CAST(fare_amount AS DECIMAL(10, 2)) AS fare_amount
FROM located""",
    "stream_append_chained": f"""{WITH_RESULT}
SELECT * FROM result WHERE pickup_location IS NOT NULL
  AND window_end <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE""",
    "raw_event_sink": RAW_EVENTS,
    "raw_events_committed": RAW_EVENTS,
    "reject_sink": REJECTS,
    "rejects_committed": REJECTS,
    "raw_out_of_range": f"""{SPOILED}
SELECT id, ts AS event_time, CASE WHEN k < 10 THEN CAST(k * 1000 AS DECIMAL(8, 4)) END AS trip_distance,
  CAST(fare_amount AS DECIMAL(10, 2)) AS fare_amount,
  CASE WHEN k >= 10 THEN 'out_of_range' WHEN pickup_location IS NULL THEN 'no_location' END AS reject_reason
FROM spoiled""",
    "feed_rejects": """SELECT event_id, 'not known' AS pickup_text, 'bad_time' AS reject_reason
FROM events WHERE event_type = 'click'""",
    "report_top20": f"""{WITH_RESULT}
SELECT window_start, window_end, pickup_location, trip_count, avg_fare
FROM result WHERE pickup_location IS NOT NULL
ORDER BY window_start DESC, pickup_location, window_end LIMIT 20""",
    "report_top20_pruned": f"""{WITH_RESULT}
SELECT window_start, window_end, pickup_location, trip_count, avg_fare
FROM result WHERE pickup_location IS NOT NULL
ORDER BY window_start DESC, pickup_location, window_end LIMIT 20""",
    "report_top20_all_columns": f"""{WITH_RESULT}
SELECT * FROM result WHERE pickup_location IS NOT NULL
ORDER BY window_start DESC, pickup_location, window_end LIMIT 20""",
    "report_count": f"""{WITH_RESULT}
SELECT count(*) AS total_rows FROM result WHERE pickup_location IS NOT NULL""",
    "peek_first5": f"""WITH {TRIPS}
SELECT "partition", "offset", {PAYLOAD} AS value FROM trips ORDER BY "partition", "offset" LIMIT 5""",
    "feed_metrics": """WITH chunks AS (
  SELECT event_id // 1000 AS chunk, count(*) FILTER (event_type <> 'click') AS events_in_chunk
  FROM events GROUP BY ALL
)
SELECT chunk, events_in_chunk,
  CAST(sum(events_in_chunk) OVER (ORDER BY chunk) AS BIGINT) AS total_sent FROM chunks""",
    "feed_throughput": """WITH chunks AS (
  SELECT event_id // 1000 AS chunk, count(*) FILTER (event_type <> 'click') AS events_in_chunk, count(*) AS input_rows
  FROM events GROUP BY ALL
)
SELECT chunk, events_in_chunk, input_rows,
  CAST(sum(events_in_chunk) OVER (ORDER BY chunk) AS BIGINT) AS total_sent, true AS rate_known FROM chunks""",
}
