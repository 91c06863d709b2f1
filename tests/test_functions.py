import random
from datetime import datetime
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from kerbflow.functions import (
    ExactMeasure,
    grid_cells,
    grid_key,
    iso_text,
    missing_text_to_null,
    missing_to_null,
    parse_time,
    render_key,
    round_half_up,
    valid_gps,
    whole_number,
)


def one_column(spark, values, kind, make):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [row[0] for row in df.orderBy("i").select(make(F.col("v")).alias("r")).collect()]


def test_grid_key_text(spark):
    cases = {40.7: "40.7", 40.0: "40.0", -73.985: "-73.99", -0.001: "0.0", 40.755: "40.76", 1.005: "1.01", 2.675: "2.68"}
    assert one_column(spark, list(cases), "double", lambda v: grid_key(v, F.lit(1.0))) == [
        f"{text},1.0" for text in cases.values()
    ]


def test_grid_key_is_null_when_a_side_is(spark):
    df = spark.createDataFrame([(1.0, None), (None, 1.0), (None, None), (1.0, float("nan"))], "a double, b double")
    lat, lon = grid_cells(missing_to_null(F.col("a")), missing_to_null(F.col("b")))
    key = grid_key(missing_to_null(F.col("a")), missing_to_null(F.col("b")))
    assert df.select(key, render_key(lat, lon)).distinct().collect() == [(None, None)]
    raw = grid_cells(F.col("a"), F.col("b"))
    assert df.select(*raw).distinct().collect() == [(None, None)]


def test_round_half_up_equals_round(spark):
    source = random.Random(7)
    values = [source.uniform(-180, 180) for _ in range(20_000)]
    values += [round(source.uniform(-180, 180), 3) for _ in range(20_000)]
    values += [k / 200 for k in range(-40_000, 40_000, 3)]
    values += [0.0, -0.0, 0.005, -0.005, 1e6 + 0.005, 123456789.125, 9.9e15, -1e20, 1e300, float("inf"), float("-inf")]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for dp in (0, 2, 4):
        ours, theirs = round_half_up(F.col("v"), dp), F.round("v", dp)
        differ = df.filter(~ours.eqNullSafe(theirs) | (ours.cast("string") != theirs.cast("string")))
        assert differ.count() == 0


def test_parse_time(spark):
    texts = [
        "2016-02-01T10:00:30",
        "2016-02-01 10:00:30.250000",
        "2016-02-01",
        "2016",
        "garbage",
        "",
        "2016-13-01 00:00:00",
        "10:00",
        " 10:00:00",
        "T10:00",
        None,
    ]
    assert one_column(spark, texts, "string", parse_time) == [
        datetime(2016, 2, 1, 10, 0, 30),
        datetime(2016, 2, 1, 10, 0, 30, 250000),
        datetime(2016, 2, 1),
        datetime(2016, 1, 1),
        *[None] * 7,
    ]


def test_parse_time_formats(spark):
    texts = ["02/01/2016 03:04:05 PM", "2016-02-01 01:00:00", "1.2.2016 07:08", "nothing"]
    formats = ["MM/dd/yyyy hh:mm:ss a", "d.M.yyyy HH:mm"]
    assert one_column(spark, texts, "string", lambda v: parse_time(v, formats)) == [
        datetime(2016, 2, 1, 15, 4, 5),
        datetime(2016, 2, 1, 1, 0),
        datetime(2016, 2, 1, 7, 8),
        None,
    ]


def test_iso_text(spark):
    times = [datetime(2016, 2, 1, 3, 4, 5), datetime(2016, 2, 1, 3, 4, 5, 120000), datetime(2016, 2, 1, 3, 4, 5, 1), None]
    assert one_column(spark, times, "timestamp", iso_text) == [
        "2016-02-01T03:04:05",
        "2016-02-01T03:04:05.120000",
        "2016-02-01T03:04:05.000001",
        None,
    ]


def test_missing(spark):
    assert one_column(spark, [1.5, float("nan"), None, 0.0], "double", missing_to_null) == [1.5, None, None, 0.0]
    texts = ["a", "", " ", "NA", "nan", "N/A", "None", "null", "nil", None]
    assert one_column(spark, texts, "string", missing_text_to_null) == ["a", *[None] * 7, "nil", None]


def test_whole_number(spark):
    texts = ["3", "3.0", "3.5", "x", "", None, "99999999999"]
    assert one_column(spark, texts, "string", whole_number) == [3, 3, None, None, None, None, None]


@pytest.mark.parametrize("lat, lon, good", [(40.7, -74.0, True), (0.0, 0.0, False), (0.0, 1.0, True), (None, 1.0, False)])
def test_valid_gps(spark, lat, lon, good):
    df = spark.createDataFrame([(lat, lon)], "a double, b double")
    assert df.select(valid_gps(F.col("a"), F.col("b"))).first()[0] is good


def test_exact_measures(spark):
    """Against fractions of the decimals that the doubles show."""
    groups = {
        "fine": [0.0049999999],
        "above": [0.0050000001],
        "tie": [1.01, 1.02],
        "negative tie": [-1.005],
        "large": [999_999_999.0] * 50,
        "ten digits": [123456.795],
        "mixed": [1e12 + 0.5, 0.01, -5.25, 1e20, -1e20],
        "cents": [x / 100 for x in range(-500, 900, 7)],
    }
    rows = [(name, value) for name, values in groups.items() for value in [*values, None, float("nan")]]
    rows += [("none", None), ("huge", 1e300), ("huge", 1e300)]
    measure = ExactMeasure("x")
    cut = spark.createDataFrame(rows, "g string, x double").repartition(5).select("g", *measure.inputs())
    parts = cut.groupBy("g", F.monotonically_increasing_id() % 3).agg(*measure.partial())
    found = {}
    for summed in (cut.groupBy("g").agg(*measure.partial()), parts.groupBy("g").agg(*measure.merge())):
        done = summed.select("g", *measure.carried()).select("g", measure.total(2), measure.mean(2), measure.mean(4))
        found = {row[0]: tuple(row[1:]) for row in done.collect()}
        for name, values in groups.items():
            total = sum((Fraction(repr(v)) for v in values), Fraction(0))
            assert found[name] == tuple(half_up(x, dp) for x, dp in ((total, 2), (total / len(values), 2), (total / len(values), 4)))
        assert found["none"] == (None, None, None)
        assert found["huge"] == (2e300, 1e300, 1e300)


def half_up(x, dp):
    steps = int(abs(x) * 10**dp + Fraction(1, 2))
    return float(Fraction(steps if x >= 0 else -steps, 10**dp))
