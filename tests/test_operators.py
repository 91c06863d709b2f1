import json
import random
from collections import defaultdict
from datetime import datetime, timedelta
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from kerbflow.config import WindowSpec
from kerbflow.operators import (
    canonical_trips,
    decode_messages,
    detect_time_column,
    drop_null_location,
    encode_messages,
    latest_versions,
    normalise_columns,
    reject_counts,
    running_totals,
    to_table_types,
    windowed_aggregate,
    with_event_time,
    with_locations,
    with_reject_reason,
)
from kerbflow.plans import newest_windows, peek_messages, raw_events, total_rows, trip_aggregates
from kerbflow.schema import AGGREGATE_FIELDS, AGGREGATE_SCHEMA, AGGREGATE_TABLE_TYPES, EVENT_SCHEMA, changelog_schema

NAN = float("nan")


def messages(spark, *texts):
    rows = [(None if text is None else bytearray(text.encode()), 0, i) for i, text in enumerate(texts)]
    return spark.createDataFrame(rows, "value binary, partition int, offset bigint")


def events(spark, rows):
    """Rows of (time, latitude, longitude, fare, distance)."""
    return spark.createDataFrame(
        rows, "event_time timestamp, pickup_latitude double, pickup_longitude double, fare_amount double, trip_distance double"
    )


# --- headers and files ------------------------------------------------------------------------


def test_normalise_columns(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["VendorID", " Trip Distance ", "PULocationID"])
    assert normalise_columns(df).columns == ["vendorid", "trip_distance", "pulocationid"]


def test_headers_that_collide(spark):
    with pytest.raises(ValueError, match="a_b"):
        normalise_columns(spark.createDataFrame([(1, 2)], ["A b", "a_B"]))


def test_detect_time_column():
    assert detect_time_column(["vendorid", "lpep_pickup_datetime", "tpep_pickup_datetime"]) == "lpep_pickup_datetime"
    assert detect_time_column(["pickup_time"]) == "pickup_time"
    with pytest.raises(ValueError, match="vendorid"):
        detect_time_column(["vendorid", "dropoff_datetime", "pickup_longitude"])


def test_canonical_trips_of_a_zone_file(spark):
    rows = [("1", "2016-02-01 00:10:00", "2.0", "3.5", "100"), ("2", "bad", "1", "1", "7"), ("2", "2016-02-02 00:00:00", "NA", "", "8")]
    raw = spark.createDataFrame(rows, ["VendorID", "Pickup DateTime", "passenger_count", "Trip Distance", "PULocationID"])
    out = canonical_trips(normalise_columns(raw))
    assert out.columns == [*EVENT_SCHEMA.names, "vendorid", "pulocationid"]
    got = [
        (r.tpep_pickup_datetime, r.passenger_count, r.trip_distance, r.pickup_latitude, r.pulocationid)
        for r in out.orderBy("vendorid").collect()
    ]
    assert got == [("2016-02-01T00:10:00", 2, 3.5, None, "100"), ("2016-02-02T00:00:00", None, None, None, "8")]


# --- messages ---------------------------------------------------------------------------------


def test_encode_keeps_nulls_and_drops_nan(spark):
    df = spark.createDataFrame([(1, NAN, None, datetime(2016, 2, 1, 1, 2, 3))], "a int, b double, c string, d timestamp")
    text = encode_messages(df).select(F.col("value").cast("string")).first()[0]
    assert text == '{"a":1,"b":null,"c":null,"d":"2016-02-01T01:02:03"}'


GOOD = {"tpep_pickup_datetime": "2016-02-01T00:00:00", "passenger_count": 2, "fare_amount": 7.5, "store": "N"}


@pytest.mark.parametrize(
    "text, expected",
    [
        (json.dumps(GOOD), ("2016-02-01T00:00:00", 2, 7.5)),
        (json.dumps({**GOOD, "passenger_count": 1.0}), ("2016-02-01T00:00:00", None, 7.5)),
        (json.dumps({**GOOD, "passenger_count": "1"}), ("2016-02-01T00:00:00", None, 7.5)),
        (json.dumps({**GOOD, "fare_amount": "x"}), ("2016-02-01T00:00:00", 2, None)),
        (json.dumps({**GOOD, "tpep_pickup_datetime": 5}), ("5", 2, 7.5)),
        (json.dumps(GOOD).replace("7.5", "NaN"), ("2016-02-01T00:00:00", 2, None)),
        (json.dumps({k.upper(): v for k, v in GOOD.items()}), (None, None, None)),
        (json.dumps(GOOD)[:-20], (None, None, None)),
        ("[" + json.dumps(GOOD) + "]", (None, None, None)),
        ("plain text", (None, None, None)),
        ("", (None, None, None)),
        (None, (None, None, None)),
    ],
)
def test_decode(spark, text, expected):
    full = decode_messages(messages(spark, text)).select("tpep_pickup_datetime", "passenger_count", "fare_amount")
    assert full.collect() == [expected]
    narrow = decode_messages(messages(spark, text), ["tpep_pickup_datetime", "fare_amount"])
    assert narrow.collect() == [(expected[0], expected[2])]


def test_messages_are_parsed_once(spark):
    plan = drop_null_location(trip_aggregates(messages(spark, "{}")))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1
    assert "passenger_count" not in plan and set(AGGREGATE_FIELDS) <= set(plan.replace("(", " ").replace(",", " ").split())


def test_rejects(spark):
    place = {"pickup_latitude": 40.7, "pickup_longitude": -74.0}
    texts = [
        json.dumps({**GOOD, **place}),
        json.dumps(GOOD),
        json.dumps({**GOOD, **place, "tpep_pickup_datetime": "later"}),
        "{",
        None,
        json.dumps({**GOOD, **place}),
    ]
    found = with_reject_reason(with_locations(with_event_time(decode_messages(messages(spark, *texts)))))
    assert dict(reject_counts(found).collect()) == {"accepted": 2, "no_location": 1, "bad_time": 1, "bad_json": 2}


def test_raw_events(spark):
    text = json.dumps({**GOOD, "pickup_latitude": 40.7, "pickup_longitude": -74.0, "trip_distance": 1.23456})
    df = spark.createDataFrame([(bytearray(text.encode()), 2, 5)], "value binary, partition int, offset bigint")
    row = raw_events(df).first()
    assert (row.id, row.pickup_location, row.dropoff_location) == (2 * 2**48 + 5, "40.7,-74.0", None)
    assert (row.passenger_count, row.trip_distance, row.fare_amount) == (2, Decimal("1.2346"), Decimal("7.50"))
    assert raw_events(df.select("value")).first().id == df.select(F.xxhash64("value")).first()[0]


# --- aggregates -------------------------------------------------------------------------------


def half_up(value: Decimal, dp: int) -> float:
    return float(value.quantize(Decimal(1).scaleb(-dp), ROUND_HALF_UP)) + 0.0  # no negative zero


def by_hand(rows, size, slide):
    """Windows in plain Python, with exact decimals; times in whole seconds."""
    groups = defaultdict(list)
    for time, lat, lon, fare, distance in rows:
        seconds = int((time - datetime(1970, 1, 1)).total_seconds())
        start = seconds - seconds % slide
        place = None if lat is None or lon is None else f"{half_up(Decimal(str(lat)), 2)},{half_up(Decimal(str(lon)), 2)}"
        while start > seconds - size:
            groups[start, place].append((fare, distance))
            start -= slide
    result = set()
    for (start, place), values in groups.items():
        begin = datetime(1970, 1, 1) + timedelta(seconds=start)
        fares = [Decimal(str(fare)) for fare, _ in values if fare is not None]
        miles = [Decimal(str(distance)) for _, distance in values if distance is not None]
        result.add(
            (
                begin,
                begin + timedelta(seconds=size),
                place,
                len(values),
                half_up(sum(fares) / len(fares), 2) if fares else None,
                half_up(sum(fares), 2) if fares else None,
                half_up(sum(miles) / len(miles), 4) if miles else None,
            )
        )
    return result


def random_rows(count, seed):
    source = random.Random(seed)
    base = datetime(2016, 2, 1)
    rows = []
    for _ in range(count):
        hot = source.random() < 0.4
        rows.append(
            (
                base + timedelta(seconds=source.randrange(3600)),
                40.71 if hot else source.choice([None, 40.7049, 40.705, 40.72, -0.001]),
                -74.0 if hot else source.choice([None, -73.985, -73.99]),
                source.choice([None, round(source.uniform(-20, 90), 2), 0.01, 2.5]),
                source.choice([None, round(source.uniform(0, 25), 3), 0.0]),
            )
        )
    return rows


@pytest.mark.parametrize("size, slide", [(300, 60), (300, 300), (600, 240), (90, 60)])
@pytest.mark.parametrize("panes", [True, False])
def test_windows_by_hand(spark, size, slide, panes):
    rows = random_rows(1500, size + slide)
    spec = WindowSpec(f"{size} seconds", f"{slide} seconds")
    got = windowed_aggregate(events(spark, rows), spec, panes=panes).collect()
    assert len(got) == len(set(got))
    assert set(map(tuple, got)) == by_hand(rows, size, slide)


def test_result_schema(spark):
    result = windowed_aggregate(events(spark, random_rows(5, 1)))
    assert [(f.name, f.dataType) for f in result.schema] == [(f.name, f.dataType) for f in AGGREGATE_SCHEMA]


def test_window_bounds_are_half_open(spark):
    rows = [(datetime(2016, 2, 1, 0, 5), 1.0, 1.0, 1.0, 1.0)]
    starts = [r.window_start.minute for r in windowed_aggregate(events(spark, rows)).orderBy("window_start").collect()]
    assert starts == [1, 2, 3, 4, 5]


def test_times_before_1970(spark):
    rows = [(datetime(1969, 12, 31, 23, 59, 30), 1.0, 1.0, 1.0, 1.0)]
    assert set(map(tuple, windowed_aggregate(events(spark, rows)).collect())) == by_hand(rows, 300, 60)


def test_half_cent_ties_go_up(spark):
    """Each mean is 7.5 cents, an exact tie that a quotient of doubles may miss."""
    base, rows = datetime(2016, 2, 1), []
    for n in range(2, 60, 2):
        fares = [0.07] * (n // 2) + [0.08] * (n // 2)
        rows += [(base + timedelta(minutes=5 * n), 1.0, 1.0, fare, None) for fare in fares]
    got = windowed_aggregate(events(spark, rows), WindowSpec("5 minutes", None)).collect()
    assert len(got) == 29 and {r.avg_fare for r in got} == {0.08}


def test_nan_huge_and_negative_values(spark):
    time = datetime(2016, 2, 1)
    rows = [(time, 1.0, 1.0, f, None) for f in (NAN, 1e12, -2.675, None, 2.5)] + [(time, 2.0, 2.0, -1.125, 1.0)]
    got = {r.pickup_location: r for r in windowed_aggregate(events(spark, rows), WindowSpec("5 minutes", None)).collect()}
    assert (got["1.0,1.0"].trip_count, got["1.0,1.0"].total_fare) == (5, 999999999999.83)
    assert got["1.0,1.0"].avg_trip_distance is None
    assert (got["2.0,2.0"].avg_fare, got["2.0,2.0"].total_fare) == (-1.13, -1.13)


def test_group_by_another_column(spark):
    rows = events(spark, random_rows(200, 3)).withColumn("pickup_location", F.lit("zone:9"))
    result = windowed_aggregate(rows, by="pickup_location")
    assert result.select("pickup_location").distinct().collect() == [("zone:9",)]
    assert result.agg(F.sum("trip_count")).first()[0] == 1000


def test_hot_location_is_combined_before_the_shuffle(spark):
    """A third of the rows on one key: what is shuffled is one partial row per task, pane and key."""
    rows = [(datetime(2016, 2, 1, 0, 0, i % 60), 40.71, -74.0, 1.0, 1.0) for i in range(4000)]
    df = events(spark, rows).repartition(4)
    plan = windowed_aggregate(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_count(1)") > plan.index("Exchange hashpartitioning(window_start")
    assert {r.trip_count for r in windowed_aggregate(df).collect()} == {4000}


# --- results ----------------------------------------------------------------------------------


def result_rows(spark, rows):
    return spark.createDataFrame(rows, changelog_schema())


def test_latest_versions(spark):
    start = datetime(2016, 2, 1)
    end = start + timedelta(minutes=5)
    log = [
        (start, end, "a", 1, 5.0, 5.0, 1.0, 0),
        (start, end, "a", 3, None, None, 2.0, 10),
        (start, end, "a", 2, 4.0, 8.0, 1.5, 9),
        (start, end, "a", 3, None, None, 2.0, 10),
        (start, end, "b", 1, 1.0, 1.0, 1.0, 4),
    ]
    latest = latest_versions(result_rows(spark, log))
    assert set(map(tuple, latest.collect())) == {(start, end, "a", 3, None, None, 2.0), (start, end, "b", 1, 1.0, 1.0, 1.0)}
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "partial_max_by" in plan


def test_report(spark):
    start = datetime(2016, 2, 1)
    rows = [(start + timedelta(minutes=i // 3), start, f"p{i % 3}", i, 1.0, 1.0, 1.0, 0) for i in range(60)]
    result = result_rows(spark, rows)
    top = newest_windows(result)
    assert top.columns == ["window_start", "window_end", "pickup_location", "trip_count", "avg_fare"]
    assert [r.trip_count for r in top.collect()][:4] == [57, 58, 59, 54]
    assert top.count() == 20 and total_rows(result).first().total_rows == 60
    assert "TakeOrderedAndProject" in top._jdf.queryExecution().executedPlan().toString()


def test_peek(spark):
    df = messages(spark, *[f"m{i}" for i in range(9)])
    assert [r.value for r in peek_messages(df.repartition(3)).collect()] == ["m0", "m1", "m2", "m3", "m4"]


def test_table_types(spark):
    df = spark.createDataFrame([(1.005, 1e9, 2.00005)], "avg_fare double, total_fare double, avg_trip_distance double")
    row = to_table_types(df, AGGREGATE_TABLE_TYPES).first()
    assert tuple(row) == (Decimal("1.01"), Decimal("1000000000.00"), Decimal("2.0001"))
    wide = spark.createDataFrame([(1e8,)], "avg_fare double")
    assert to_table_types(wide, AGGREGATE_TABLE_TYPES, "null").first().avg_fare is None
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        to_table_types(wide, AGGREGATE_TABLE_TYPES).collect()


@pytest.mark.parametrize("rows, chunk", [(0, 10), (1, 10), (95, 10), (5000, 1)])
def test_running_totals(spark, rows, chunk):
    df = spark.range(rows).withColumn("ok", F.col("id") % 3 != 0)
    total, expected = 0, []
    for number in range(-(-rows // chunk)):
        sent = sum(1 for i in range(number * chunk, min(rows, (number + 1) * chunk)) if i % 3)
        total += sent
        expected.append((number, sent, total))
    got = running_totals(df.repartition(3), "id", chunk, keep="ok").orderBy("chunk").collect()
    assert [tuple(row) for row in got] == expected


def test_null_tests_reach_the_scan_with_a_text_time(spark, tmp_path):
    from kerbflow.config import FlowConfig
    from kerbflow.plans import typed_trip_aggregates

    path = str(tmp_path / "trips")
    schema = "tpep_pickup_datetime string, trip_distance double, pickup_longitude double, pickup_latitude double, fare_amount double"
    spark.createDataFrame([("2024-01-01T10:00:30", 1.0, -74.0, 40.7, 2.0)], schema).write.parquet(path)
    result = typed_trip_aggregates(spark.read.parquet(path), FlowConfig(drop_null_location_early=True))
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "IsNotNull(pickup_latitude)" in plan and "IsNotNull(pickup_longitude)" in plan
    assert result.count() == 5


def test_locations_by_zone(spark):
    rows = [(40.71, -74.0, "132"), (None, None, "7.0"), (None, None, "x"), (40.71, None, None)]
    df = spark.createDataFrame(rows, "pickup_latitude double, pickup_longitude double, pulocationid string")
    found = {by: [r.pickup_location for r in with_locations(df, by=by).collect()] for by in ("grid", "zone", "grid_or_zone")}
    assert found["grid"] == ["40.71,-74.0", None, None, None]
    assert found["zone"] == ["zone:132", "zone:7", None, None]
    assert found["grid_or_zone"] == ["40.71,-74.0", "zone:7", None, None]
