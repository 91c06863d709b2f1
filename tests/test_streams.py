import json
import os
from datetime import datetime

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from kerbflow.config import FlowConfig
from kerbflow.operators import drop_null_location, latest_versions
from kerbflow.plans import raw_events, trip_aggregates
from kerbflow.session import scratch_dir, session_settings, shared_dir
from kerbflow.sinks import BatchFolderSink, RawEventSink
from kerbflow.sources import read_changelog, stream_message_files, stream_trips
from kerbflow.streaming import batch_rates, checkpoint_path, run_available_now

PLACES = {"A": (40.71, -74.0), "B": (40.72, -73.99), None: (None, None)}

# One list per micro-batch: minute and second after 10:00, place, fare.
LATE = [
    [("00:30", "A", 1.0), ("00:40", "B", 2.0)],
    [("01:30", "A", 3.0), ("30:00", None, 9.0)],
    [("02:30", "A", 5.0)],
    [("31:00", "B", 7.0)],
    [("18:30", "B", 7.0)],
]


def payload(clock, place, fare):
    lat, lon = PLACES[place]
    return json.dumps(
        {
            "tpep_pickup_datetime": f"2024-01-01T10:{clock}",
            "pickup_latitude": lat,
            "pickup_longitude": lon,
            "fare_amount": fare,
            "trip_distance": 1.0,
        }
    )


def write_topic(spark, folder, batches):
    """One file per batch, with times a second apart, since a stream takes the oldest file first."""
    os.makedirs(folder)
    for number, texts in enumerate(batches):
        rows = [(bytearray(text.encode()), 0, number * 100 + i) for i, text in enumerate(texts)]
        part = f"{folder}-parts/{number}"
        spark.createDataFrame(rows, "value binary, partition int, offset bigint").coalesce(1).write.parquet(part)
        (name,) = [n for n in os.listdir(part) if n.endswith(".parquet")]
        target = f"{folder}/{number}.parquet"
        os.link(f"{part}/{name}", target)
        os.utime(target, (1_700_000_000 + number, 1_700_000_000 + number))


@pytest.fixture
def topic(spark, tmp_path):
    folder = str(tmp_path / "topic")
    write_topic(spark, folder, [[payload(*row) for row in batch] for batch in LATE])
    return folder


def run(spark, topic, out, config=FlowConfig(), sink_type=BatchFolderSink, **options):
    result = trip_aggregates(stream_message_files(spark, topic, max_files=1), config)
    sink = sink_type(f"{out}/log", **options)
    return run_available_now(result, sink, f"{out}/{config.checkpoint_name()}")


def keys_per_batch(spark, out, where="true"):
    log = read_changelog(spark, f"{out}/log").filter(where)
    return dict(log.groupBy("batch_id").count().collect())


def test_late_data(spark, topic, tmp_path):
    run(spark, topic, tmp_path, prepare=lambda df: df)
    assert keys_per_batch(spark, tmp_path) == {0: 10, 1: 10, 2: 5, 3: 5, 4: 3}
    assert keys_per_batch(spark, tmp_path, "pickup_location is null") == {1: 5}


def test_unlocated_events_move_the_watermark(spark, topic, tmp_path):
    run(spark, topic, tmp_path / "in_sink")
    assert keys_per_batch(spark, tmp_path / "in_sink") == {0: 10, 1: 5, 2: 5, 3: 5, 4: 3}
    run(spark, topic, tmp_path / "early", FlowConfig(drop_null_location_early=True))
    assert keys_per_batch(spark, tmp_path / "early") == {0: 10, 1: 5, 2: 5, 3: 5, 4: 5}


def test_versions_and_latest(spark, topic, tmp_path):
    run(spark, topic, tmp_path)
    log = read_changelog(spark, f"{tmp_path}/log")
    one = log.filter("window_start = timestamp '2024-01-01 10:00:00' and pickup_location = '40.71,-74.0'")
    versions = [(r.batch_id, r.trip_count, r.avg_fare, r.total_fare) for r in one.orderBy("batch_id").collect()]
    assert versions == [(0, 1, 1.0, 1.0), (1, 2, 2.0, 4.0), (2, 3, 3.0, 9.0)]
    assert [r.total_fare for r in latest_versions(one).collect()] == [9.0]


def test_one_batch_equals_the_table(spark, topic, tmp_path):
    result = trip_aggregates(stream_message_files(spark, topic))
    run_available_now(result, BatchFolderSink(f"{tmp_path}/log"), f"{tmp_path}/cp")
    table = drop_null_location(trip_aggregates(spark.read.parquet(topic)))
    assert set(read_changelog(spark, f"{tmp_path}/log").drop("batch_id").collect()) == set(table.collect())


class Stops(BatchFolderSink):
    def __call__(self, batch, batch_id):
        super().__call__(batch, batch_id)
        if batch_id == 2:
            raise RuntimeError("power cut")


def test_restart(spark, topic, tmp_path):
    run(spark, topic, tmp_path / "whole")
    with pytest.raises(StreamingQueryException):
        run(spark, topic, tmp_path / "broken", sink_type=Stops)
    assert set(keys_per_batch(spark, tmp_path / "broken")) == {0, 1, 2}
    run(spark, topic, tmp_path / "broken")
    logs = [read_changelog(spark, f"{tmp_path / name}/log") for name in ("whole", "broken")]
    assert sorted(logs[0].collect()) == sorted(logs[1].collect())


def test_stopped_query_goes_on_where_it_was(spark, topic, tmp_path):
    query = run(spark, topic, tmp_path)
    assert sum(rate["input_rows"] for rate in batch_rates(query)) == sum(map(len, LATE))
    before = keys_per_batch(spark, tmp_path)
    again = run(spark, topic, tmp_path)
    assert sum(rate["input_rows"] for rate in batch_rates(again)) == 0
    assert keys_per_batch(spark, tmp_path) == before


def test_same_batch_written_twice(spark, tmp_path):
    sink = BatchFolderSink(str(tmp_path / "log"))
    start = datetime(2024, 1, 1)
    schema = "window_start timestamp, window_end timestamp, pickup_location string, trip_count bigint"
    batch = spark.createDataFrame([(start, start, "a", 1), (start, start, None, 1)], schema)
    assert [sink(batch, 5), sink(batch, 5), sink(batch.limit(0), 6)] == [1, 1, 0]
    log = read_changelog(spark, str(tmp_path / "log"))
    assert [(r.pickup_location, r.batch_id) for r in log.collect()] == [("a", 5)]
    assert spark.read.parquet(f"{tmp_path}/log/batch_id=5").select(F.max("processed_at")).first()[0] is not None


def test_changelog_before_the_first_batch(spark, tmp_path):
    assert read_changelog(spark, str(tmp_path / "none")).count() == 0


def test_raw_events_and_rejects(spark, tmp_path):
    topic = str(tmp_path / "topic")
    late = payload("00:30", "A", 1.0).replace("2024-01-01T10", "soon")
    write_topic(spark, topic, [[payload("00:30", "A", 1.0), late, "{"], [payload("00:40", None, 2.0)]])
    stream = raw_events(stream_message_files(spark, topic, max_files=1))
    run_available_now(stream, RawEventSink(f"{tmp_path}/raw"), f"{tmp_path}/cp", output_mode="append")
    stored = spark.read.parquet(f"{tmp_path}/raw/events")
    assert {(r.id, r.pickup_location) for r in stored.collect()} == {(0, "40.71,-74.0"), (100, None)}
    assert set(stored.columns) >= {"event_time", "dropoff_location", "passenger_count", "ingested_at"}
    rejects = spark.read.parquet(f"{tmp_path}/raw/rejects")
    assert {(r.id, r.reject_reason) for r in rejects.collect()} == {(1, "bad_time"), (2, "bad_json"), (100, "no_location")}
    assert {bytes(r.value) for r in rejects.filter("id = 2").collect()} == {b"{"}


def test_paced_csv(spark, tmp_path):
    folder = tmp_path / "files"
    folder.mkdir()
    for number in range(3):
        (folder / f"{number}.csv").write_text(f" Pickup Time,x\n2016-02-0{number + 1} 00:00:00,{number}\n")
    seen = []
    stream = stream_trips(spark, str(folder), max_files=1)
    assert stream.columns == [" Pickup Time", "x"] or stream.columns == ["Pickup Time", "x"]
    run_available_now(stream, lambda df, i: seen.append(df.count()), f"{tmp_path}/cp", output_mode="append")
    assert seen == [1, 1, 1]


def test_settings_are_put_back(spark):
    key, unset = "spark.sql.shuffle.partitions", "spark.sql.streaming.noDataMicroBatches.enabled"
    before = spark.conf.get(key), spark.conf.get(unset)
    with session_settings(spark, {key: "3", unset: "false"}):
        assert (spark.conf.get(key), spark.conf.get(unset)) == ("3", "false")
    assert (spark.conf.get(key), spark.conf.get(unset)) == before


class Cluster:
    """As much of a session as the folder functions look at."""

    def __init__(self, master, **conf):
        self.conf = self
        self.sparkContext = self
        self.master = master
        self.values = conf

    def get(self, key, default=None):
        return self.values.get(key, default)

    def getConf(self):
        return self


def test_scratch_under_the_named_folder():
    cluster = Cluster("yarn", **{"spark.checkpoint.dir": "hdfs:///shared/"})
    assert shared_dir(cluster) == "hdfs:///shared"
    assert scratch_dir(cluster, "x").startswith("hdfs:///shared/kerbflow/x-")
    assert scratch_dir(cluster, "x") != scratch_dir(cluster, "x")
    assert checkpoint_path(cluster, FlowConfig()) == f"hdfs:///shared/{FlowConfig().checkpoint_name()}"
    assert checkpoint_path(cluster, FlowConfig(checkpoint_dir="/c/")) == f"/c/{FlowConfig().checkpoint_name()}"


def test_a_checkpoint_needs_a_named_folder():
    with pytest.raises(ValueError, match="CHECKPOINT_DIR"):
        checkpoint_path(Cluster("local[2]"), FlowConfig())


def test_no_local_folder_on_a_cluster():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(Cluster("yarn"))
    assert os.path.isdir(shared_dir(Cluster("local[2]")))


class FailsOnce(BatchFolderSink):
    """Fails after batch 2 is written and before the query can commit it."""

    failed = False

    def __call__(self, batch, batch_id):
        written = super().__call__(batch, batch_id)
        if batch_id == 2 and not self.failed:
            self.failed = True
            raise RuntimeError("stopped between write and commit")
        return written


def test_a_batch_written_but_not_committed_is_written_once(spark, topic, tmp_path):
    def run(sink, checkpoint):
        result = trip_aggregates(stream_message_files(spark, topic, max_files=1), FlowConfig())
        run_available_now(result, sink, str(tmp_path / checkpoint))

    failing = FailsOnce(str(tmp_path / "failing"))
    with pytest.raises(StreamingQueryException):
        run(failing, "one")
    run(failing, "one")
    run(BatchFolderSink(str(tmp_path / "whole")), "two")
    stored = [sorted(read_changelog(spark, str(tmp_path / name)).collect()) for name in ("failing", "whole")]
    assert failing.failed and stored[0] == stored[1] and stored[0]
