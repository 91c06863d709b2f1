"""Batches that appear at once, snapshots, late rows, chained panes, state and metrics."""

import json

import os
import random
from datetime import datetime, timedelta

import pytest
from pyspark.errors import AnalysisException, StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbflow.config import FlowConfig
from kerbflow.operators import canonical_trips, drop_null_location, latest_versions, normalise_columns
from kerbflow.plans import (
    aggregates_with_events,
    compact,
    newest_results,
    newest_windows,
    raw_events,
    read_latest,
    remove_compacted,
    snapshot_of,
    trip_aggregates,
    write_chunks,
)
from kerbflow.schema import AGGREGATE_SCHEMA
from kerbflow.sinks import CommittedRawSink, CommittedSink, LateRowsSink, commits, read_late_rows, read_raw_events, read_rejects, read_results
from kerbflow.sources import MixedTripsSink, files_by_header, read_committed, read_mixed_trips, stream_file_names, stream_message_files
from kerbflow.storage import get_text, names_in, put_text
from kerbflow.streaming import FeedMetrics, open_windows, read_feed_metrics, run_available_now, state_operators, with_feed_metrics
from test_streams import LATE, payload, write_topic

START = datetime(2024, 1, 1)


def batch_of(spark, *rows):
    """Window rows from (minutes after START, location, count)."""
    made = [(START + timedelta(minutes=m), START + timedelta(minutes=m + 5), where, n, n * 1.0, n * 1.0, 0.5) for m, where, n in rows]
    return spark.createDataFrame(made, AGGREGATE_SCHEMA)


def rows_of(df):
    return sorted((r.window_start, r.pickup_location, r.trip_count, r.batch_id) for r in df.collect())


# --- commits ------------------------------------------------------------------------------------------


def test_batches_and_empty_batches(spark, tmp_path):
    sink, path = CommittedSink(str(tmp_path)), str(tmp_path)
    assert read_committed(spark, path).count() == 0
    assert [sink(batch_of(spark, (0, "a", 1), (0, None, 9)), 0), sink(batch_of(spark), 1), sink(batch_of(spark, (1, "a", 2)), 2)] == [1, 0, 1]
    assert [(c.batch_id, c.attempt is None, c.rows, c.total) for c in commits(spark, path)] == [(0, False, 1, 1), (1, True, 0, 1), (2, False, 1, 2)]
    assert not os.path.exists(f"{path}/data/batch_id=1") or names_in(spark, f"{path}/data/batch_id=1") == []
    assert [r[1:] for r in rows_of(read_committed(spark, path))] == [("a", 1, 0), ("a", 2, 2)]
    assert [r[1:] for r in rows_of(read_committed(spark, path, after=0))] == [("a", 2, 2)]


class Dies(CommittedSink):
    """Ends after its rows are stored and before the commit, or while they are being stored."""

    def __init__(self, path, after_write):
        super().__init__(path)
        self.after_write = after_write

    def write(self, rows, folder):
        if self.after_write:
            super().write(rows, folder)
        else:
            rows.limit(1).write.parquet(folder)
        raise RuntimeError("killed")


@pytest.mark.parametrize("after_write", [True, False])
def test_a_killed_second_attempt_leaves_the_first_version(spark, tmp_path, after_write):
    path = str(tmp_path)
    CommittedSink(path)(batch_of(spark, (0, "a", 1), (1, "b", 2)), 0)
    before = rows_of(read_committed(spark, path))
    with pytest.raises(RuntimeError, match="killed"):
        Dies(path, after_write)(batch_of(spark, (0, "a", 7), (1, "b", 8), (2, "c", 9)), 0)
    assert rows_of(read_committed(spark, path)) == before
    CommittedSink(path)(batch_of(spark, (0, "a", 7)), 0)
    assert [r[1:] for r in rows_of(read_committed(spark, path))] == [("a", 7, 0)]


def test_a_killed_first_attempt_is_not_seen(spark, tmp_path):
    with pytest.raises(RuntimeError, match="killed"):
        Dies(str(tmp_path), True)(batch_of(spark, (0, "a", 1)), 0)
    assert read_committed(spark, str(tmp_path)).count() == 0 and commits(spark, str(tmp_path)) == []


def test_numbers_go_on_and_stay_on_replay(spark, tmp_path):
    sink = CommittedSink(str(tmp_path), number_by=[F.asc("pickup_location")])
    batches = [batch_of(spark, (0, "b", 1), (0, "a", 1)), batch_of(spark), batch_of(spark, (0, "d", 1), (0, "c", 1))]
    for number in (0, 1, 2, 2):
        sink(batches[number], number)
    stored = spark.read.option("basePath", f"{tmp_path}/data").parquet(
        *[f"{tmp_path}/data/batch_id={c.batch_id}/attempt={c.attempt}" for c in commits(spark, str(tmp_path)) if c.attempt]
    )
    assert {(r.pickup_location, r.id) for r in stored.collect()} == {("a", 1), ("b", 2), ("c", 3), ("d", 4)}


def test_small_files_are_replaced_as_a_whole(spark, tmp_path):
    assert get_text(spark, f"{tmp_path}/x/a.json") is None and names_in(spark, f"{tmp_path}/x") == []
    for text in ("one", "zwölf"):
        put_text(spark, f"{tmp_path}/x/a.json", text)
        assert get_text(spark, f"{tmp_path}/x/a.json") == text
    assert names_in(spark, f"{tmp_path}/x") == ["a.json"]


# --- snapshot ------------------------------------------------------------------------------------------

DAY = 24 * 60


def some_batches(spark, seed=1, n=6):
    draw = random.Random(seed)
    for _ in range(n):
        keys = {(draw.randrange(4) * DAY + draw.randrange(3) * 10, draw.choice("abc")) for _ in range(draw.randrange(8))}
        yield batch_of(spark, *[(m, where, draw.randrange(1, 100)) for m, where in keys])


@pytest.mark.parametrize("compacted_after", [(0,), (2,), (0, 1, 4), (0, 1, 2, 3, 4, 5), ()])
def test_snapshot_and_tail_equal_all_versions(spark, tmp_path, compacted_after):
    path, all_rows = str(tmp_path / "results"), str(tmp_path / "all")
    for number, batch in enumerate(some_batches(spark)):
        CommittedSink(path)(batch, number)
        CommittedSink(all_rows)(batch, number)
        if number in compacted_after:
            assert compact(spark, path).high_water == number
            assert compact(spark, path) == snapshot_of(spark, path)
            remove_compacted(spark, path)
        want = latest_versions(read_committed(spark, all_rows))
        assert sorted(read_latest(spark, path).collect()) == sorted(want.collect())
        for limit in (1, 5, 100):
            assert newest_results(spark, path, limit).collect() == newest_windows(want, limit).collect()


def test_only_the_tail_and_the_days_it_needs_are_listed(spark, tmp_path):
    path = str(tmp_path)
    for number, day in enumerate((0, 1, 2)):
        CommittedSink(path)(batch_of(spark, *[(day * DAY + m, "a", 1) for m in range(30)]), number)
    before = compact(spark, path)
    CommittedSink(path)(batch_of(spark, (1 * DAY, "a", 5)), 3)
    files = read_latest(spark, path).inputFiles()
    assert not any(f"batch_id={n}/" in f for f in files for n in (0, 1, 2)) and any("batch_id=3/" in f for f in files)
    newest = newest_results(spark, path)
    assert {f.split("day=")[1][:10] for f in newest.inputFiles() if "day=" in f} == {"2024-01-03"}
    plan = newest._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(day" in plan.replace("\n", " ") or "day >= 2024-01-03" in plan
    after = compact(spark, path)
    # Days that the tail does not touch are carried over, not written again.
    assert [a.attempt == b.attempt for a, b in zip(before.days, after.days)] == [True, False, True]
    assert remove_compacted(spark, path) > 0 and remove_compacted(spark, path) == 0
    assert read_latest(spark, path).count() == 90 and newest_results(spark, path, 100).count() == 90


def test_a_day_that_ends_up_empty_does_not_stop_the_report(spark, tmp_path):
    path = str(tmp_path)
    CommittedSink(path)(batch_of(spark, *[(m, "a", 1) for m in range(30)]), 0)
    snapshot = compact(spark, path)
    days = [{"day": d.day, "attempt": d.attempt, "rows": d.rows} for d in snapshot.days]
    days.append({"day": "2024-01-09", "attempt": "none", "rows": 0})
    put_text(spark, f"{path}/snapshot.json", json.dumps({"high_water": 0, "days": days}))
    assert newest_results(spark, path).count() == 20


# --- late rows -----------------------------------------------------------------------------------------


@pytest.fixture
def topic(spark, tmp_path):
    folder = str(tmp_path / "topic")
    write_topic(spark, folder, [[payload(*row) for row in batch] for batch in LATE])
    return folder


def run_late(spark, topic, out, sink_type=LateRowsSink):
    both = aggregates_with_events(stream_message_files(spark, topic, max_files=1))
    run_available_now(both, sink_type(f"{out}/results"), f"{out}/cp")


def test_late_rows_and_results(spark, topic, tmp_path):
    run_late(spark, topic, tmp_path)
    late = read_late_rows(spark, f"{tmp_path}/results").collect()
    # The mark is 10:20 for batch 3 (10:30 two batches before) and 10:20 for batch 4.
    assert {(r.batch_id, r.window_end.strftime("%H:%M"), r.pickup_location, r.fare_amount) for r in late} == {
        (4, "10:19", "40.72,-73.99", 7.0),
        (4, "10:20", "40.72,-73.99", 7.0),
    }
    plain = trip_aggregates(stream_message_files(spark, topic, max_files=1))
    run_available_now(plain, CommittedSink(f"{tmp_path}/plain"), f"{tmp_path}/cp-plain")
    assert rows_of(read_results(spark, f"{tmp_path}/results")) == rows_of(read_committed(spark, f"{tmp_path}/plain"))
    marks = {c.batch_id: c.late_mark for c in commits(spark, f"{tmp_path}/results")}
    assert marks[0] is None and marks[1] is None
    assert datetime.fromtimestamp(marks[3] / 1e6, tz=None).minute == 20


class FailsOnce(LateRowsSink):
    failed = False

    def __call__(self, batch, batch_id):
        written = super().__call__(batch, batch_id)
        if batch_id == 4 and not FailsOnce.failed:
            FailsOnce.failed = True
            raise RuntimeError("stopped between commit and checkpoint")
        return written


def test_late_rows_of_a_batch_that_is_run_again(spark, topic, tmp_path):
    with pytest.raises(StreamingQueryException):
        run_late(spark, topic, tmp_path / "broken", FailsOnce)
    run_late(spark, topic, tmp_path / "broken", FailsOnce)
    run_late(spark, topic, tmp_path / "whole")
    found = [sorted(read_late_rows(spark, f"{tmp_path / name}/results").collect()) for name in ("broken", "whole")]
    assert FailsOnce.failed and found[0] == found[1] and len(found[0]) == 2


def test_windows_that_are_no_whole_number_of_slides(spark, topic, tmp_path):
    config = FlowConfig(window_duration="5 minutes", slide_duration="2 minutes")
    both = aggregates_with_events(stream_message_files(spark, topic, max_files=1), config)
    run_available_now(both, LateRowsSink(f"{tmp_path}/results", config), f"{tmp_path}/cp")
    late = {(r.batch_id, r.window_start.minute, r.window_end.minute) for r in read_late_rows(spark, f"{tmp_path}/results").collect()}
    # 10:18:30 lies in the windows from 10:14 and 10:16 and 10:18, of which the first ends by 10:20.
    assert late == {(4, 14, 19)}


# --- chained panes, state, metrics ---------------------------------------------------------------------------


def test_chained_panes_need_fewer_state_rows(spark, topic, tmp_path):
    closed, states = [], []
    for panes in (False, True):
        out = f"{tmp_path}/{panes}"
        result = trip_aggregates(stream_message_files(spark, topic), panes=panes)
        query = run_available_now(result, CommittedSink(f"{out}/results"), f"{out}/cp", output_mode="append", state_store="memory")
        closed.append(sorted(read_committed(spark, f"{out}/results").collect()))
        states.append(max(sum(s.numRowsTotal for s in p.stateOperators) for p in query.recentProgress))
    assert closed[0] == closed[1] and closed[0]
    assert states[1] * 3 < states[0]


def test_chained_panes_are_refused_in_update_mode(spark, topic, tmp_path):
    result = trip_aggregates(stream_message_files(spark, topic), panes=True)
    with pytest.raises(AnalysisException, match="correctness"):
        run_available_now(result, CommittedSink(f"{tmp_path}/results"), f"{tmp_path}/cp")


@pytest.mark.parametrize("store", ["rocksdb", "memory"])
def test_open_and_closed_windows_are_all_windows(spark, topic, tmp_path, store):
    result = trip_aggregates(stream_message_files(spark, topic))
    run_available_now(result, CommittedSink(f"{tmp_path}/r", prepare=lambda df: df), f"{tmp_path}/cp", output_mode="append", state_store=store)
    still = open_windows(spark, f"{tmp_path}/cp")
    table = trip_aggregates(spark.read.parquet(topic))
    assert sorted(still.union(read_committed(spark, f"{tmp_path}/r").drop("batch_id")).collect(), key=repr) == sorted(table.collect(), key=repr)
    assert {r.operatorName for r in state_operators(spark, f"{tmp_path}/cp").collect()} == {"stateStoreSave"}
    whole = open_windows(spark, f"{tmp_path}/cp", 0)
    assert drop_null_location(whole).count() == drop_null_location(table).count()


def test_chunks_come_in_order_and_are_measured(spark, tmp_path):
    rows = spark.range(95).select(F.col("id"), (95 - F.col("id")).alias("at"), F.col("id").cast("string").cast("binary").alias("value"))
    assert write_chunks(rows.repartition(5), [F.asc("at")], 20, f"{tmp_path}/topic", position="offset") == 5
    stream = spark.readStream.schema("id bigint, at bigint, offset bigint").option("maxFilesPerTrigger", 2).parquet(f"{tmp_path}/topic")
    seen = []
    metrics = FeedMetrics(spark, f"{tmp_path}/metrics")
    spark.streams.addListener(metrics)
    try:
        sink = lambda df, i: seen.append(df.agg(F.min("offset"), F.max("offset"), F.min(F.col("at") - F.col("offset"))).first())
        metrics.wait_for(run_available_now(with_feed_metrics(stream), sink, f"{tmp_path}/cp", output_mode="append"))
    finally:
        spark.streams.removeListener(metrics)
    assert [tuple(s) for s in seen] == [(0, 39, 1), (40, 79, 1), (80, 94, 1)]
    stored = read_feed_metrics(spark, f"{tmp_path}/metrics").orderBy("batch_id").collect()
    assert [(r.events_in_chunk, r.input_rows, r.total_sent) for r in stored] == [(40, 40, 40), (40, 40, 80), (15, 15, 95)]
    assert all(r.rows_per_second > 0 and r.seconds > 0 for r in stored)
    assert read_feed_metrics(spark, f"{tmp_path}/none").count() == 0


# --- files by header -------------------------------------------------------------------------------------------


def test_files_of_several_headers(spark, tmp_path):
    files = {
        "a.csv": "tpep_pickup_datetime,fare_amount,trip_distance\n2016-02-01 00:00:00,1.5,9.0\n2016-02-01 00:01:00,2.5,8.0\n",
        "b.csv": "trip_distance,tpep_pickup_datetime,fare_amount\n7.0,2016-02-02 00:00:00,3.5\n",
        "c.csv": ' Lpep Pickup DateTime ,PULocationID,"Fare Amount"\r\n2019-02-01 00:00:00,132.0,4.5\r\n',
        "d.csv": "tpep_pickup_datetime,fare_amount,trip_distance\n2016-02-03 00:00:00,5.5,6.0\n",
        "e.csv": "",
        "f.csv": "﻿fare_amount,tpep_pickup_datetime\n6.5,2016-02-04 00:00:00\n",
    }
    for name, text in files.items():
        (tmp_path / name).write_bytes(text.encode())
    groups = files_by_header(spark, str(tmp_path))
    assert sorted(len(found) for found in groups.values()) == [1, 1, 1, 2]
    trips = read_mixed_trips(spark, str(tmp_path), lambda df: canonical_trips(normalise_columns(df)))
    assert {(r.tpep_pickup_datetime, r.fare_amount, r.trip_distance, r.pulocationid) for r in trips.collect()} == {
        ("2016-02-01T00:00:00", 1.5, 9.0, None),
        ("2016-02-01T00:01:00", 2.5, 8.0, None),
        ("2016-02-02T00:00:00", 3.5, 7.0, None),
        ("2016-02-03T00:00:00", 5.5, 6.0, None),
        ("2019-02-01T00:00:00", 4.5, None, "132.0"),
        ("2016-02-04T00:00:00", 6.5, None, None),
    }


def test_only_the_first_lines_are_read(spark, tmp_path):
    for n in range(3):
        (tmp_path / f"{n}.csv").write_text("a,b\n" + "1,2\n" * 200_000)
    with_small_splits = {"spark.sql.files.maxPartitionBytes": "64k"}
    from kerbflow.session import session_settings

    with session_settings(spark, with_small_splits):
        groups = files_by_header(spark, str(tmp_path))
    assert {k: len(v) for k, v in groups.items()} == {("a", "b"): 3}


def test_a_folder_without_files(spark, tmp_path):
    (tmp_path / "empty.csv").write_text("")
    with pytest.raises(ValueError, match="header"):
        read_mixed_trips(spark, str(tmp_path), canonical_trips)


def test_files_of_new_headers_join_a_stream(spark, tmp_path):
    """Headers that nobody knew at the start, names with odd signs, empty files; a second run reads nothing twice."""
    folder, names = tmp_path / "files", ["pickup_longitude", "pulocationid", "trip_distance"]
    folder.mkdir()
    prepare = lambda df: canonical_trips(normalise_columns(df))
    fixed = lambda df: df.select(*[(F.col(c) if c in df.columns else F.lit(None)).cast("string").alias(c) for c in names])
    counts = []
    sink = CommittedSink(f"{tmp_path}/trips", prepare=lambda df: df, stamp=None)
    follow = lambda: run_available_now(
        stream_file_names(spark, str(folder), max_files=2), MixedTripsSink(sink, lambda df: fixed(prepare(df))), f"{tmp_path}/cp", output_mode="append"
    )
    arrivals = [
        {"a b%20 [1].csv": "tpep_pickup_datetime,pickup_longitude\n2024-01-01 10:00:00,1\n", "c.csv": "Trip_Distance,Pickup Time\n7,2024-01-01 11:00:00\n"},
        {"d{x}.csv": "PULocationID,tpep_pickup_datetime\n5,2024-01-01 12:00:00\n6,never\n", "e.csv": ""},
        {"f.csv": ""},
        {},
        {"g?.csv": "tpep_pickup_datetime,pulocationid\n2024-01-01 12:00:00,8\n"},
    ]
    for files in arrivals:
        for name, text in files.items():
            (folder / name).write_text(text)
        follow()
        counts.append([c.rows for c in commits(spark, f"{tmp_path}/trips")])
    assert counts == [[2], [2, 1], [2, 1, 0], [2, 1, 0], [2, 1, 0, 1]]
    schema = T.StructType([T.StructField(name, T.StringType()) for name in names])
    found = {tuple(r) for r in read_committed(spark, f"{tmp_path}/trips", schema).select(*names).collect()}
    assert found == {("1.0", None, None), (None, None, "7.0"), (None, "5", None), (None, "8", None)}
    assert read_mixed_trips(spark, str(folder), prepare).count() == 4


# --- raw events ------------------------------------------------------------------------------------------------


def test_events_and_rejects_in_one_commit(spark, tmp_path):
    folder = str(tmp_path / "topic")
    bad_time = payload("00:30", "A", 1.0).replace("2024-01-01T10", "soon")
    write_topic(spark, folder, [[payload("00:30", "A", 1.0), bad_time, "{"], [payload("00:40", None, 2.0)]])
    stream = raw_events(stream_message_files(spark, folder, max_files=1))
    run_available_now(stream, CommittedRawSink(f"{tmp_path}/raw"), f"{tmp_path}/cp", output_mode="append")
    events, rejects = read_raw_events(spark, f"{tmp_path}/raw"), read_rejects(spark, f"{tmp_path}/raw")
    assert {(r.id, r.pickup_location, r.batch_id) for r in events.collect()} == {(0, "40.71,-74.0", 0), (100, None, 1)}
    assert events.filter("ingested_at is null").isEmpty()
    assert {(r.id, r.reject_reason) for r in rejects.collect()} == {(1, "bad_time"), (2, "bad_json"), (100, "no_location")}
    assert [bytes(r.value) for r in rejects.filter("id = 2").collect()] == [b"{"]


def test_snapshot_of_batches_with_late_rows(spark, topic, tmp_path):
    run_late(spark, topic, tmp_path)
    path = f"{tmp_path}/results"
    before = sorted(read_latest(spark, path).collect())
    assert before == sorted(latest_versions(read_results(spark, path)).collect()) and before
    compact(spark, path)
    assert sorted(read_latest(spark, path).collect()) == before
