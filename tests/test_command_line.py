import pytest
from pyspark.sql import SparkSession

from kerbflow.__main__ import main
from kerbflow.streaming import read_feed_metrics


def test_file_to_report(spark, tmp_path, monkeypatch, capsys):
    monkeypatch.setattr(SparkSession, "stop", lambda self: None)
    path = tmp_path / "trips.csv"
    lines = ["TPEP Pickup DateTime,Fare Amount,Trip Distance,Pickup Latitude,Pickup Longitude"]
    lines += [f"2016-02-01 00:0{i}:30,{i}.50,1.25,40.71,-74.0" for i in range(3)] + ["never,1,1,1,1"]
    path.write_text("\n".join(lines) + "\n")
    monkeypatch.setenv("DATA_PATH", str(path))
    monkeypatch.setenv("CHECKPOINT_DIR", str(tmp_path / "checkpoints"))
    folders = ["--topic-dir", str(tmp_path / "topic"), "--out", str(tmp_path / "results")]

    main(["feed", *folders])
    assert spark.read.parquet(str(tmp_path / "topic")).count() == 3
    main(["stream", "--once", *folders])
    main(["raw", "--once", "--topic-dir", str(tmp_path / "topic"), "--out", str(tmp_path / "raw")])
    assert spark.read.parquet(f"{tmp_path}/raw/events").count() == 3
    capsys.readouterr()

    main(["count", *folders])
    assert "|         7|" in capsys.readouterr().out
    main(["verify", *folders])
    shown = capsys.readouterr().out
    assert shown.index("2016-02-01 00:02:00") < shown.index("2016-02-01 00:01:00")
    assert "|2016-02-01 00:00:00|2016-02-01 00:05:00|40.71,-74.0    |3         |1.5     |" in shown


@pytest.mark.parametrize("command", ["raw", "metrics", "late", "compact"])
def test_some_commands_need_a_folder(command):
    with pytest.raises(SystemExit):
        main([command])


def test_chunks_batches_and_snapshot(spark, tmp_path, monkeypatch, capsys):
    monkeypatch.setattr(SparkSession, "stop", lambda self: None)
    (tmp_path / "trips").mkdir()
    for name, header, place in (
        ("a", "Pickup DateTime,Fare Amount,Pickup Latitude,Pickup Longitude", "{time},{fare},40.71,-74.0"),
        ("b", "fare_amount,pickup_longitude,pickup_latitude,tpep_pickup_datetime", "{fare},-74.0,40.71,{time}"),
    ):
        rows = [place.format(time=f"2016-02-0{1 + i % 3} 00:0{i}:30", fare=i) for i in range(5)]
        (tmp_path / "trips" / f"{name}.csv").write_text("\n".join([header, *rows]) + "\n")
    settings = {"DATA_PATH": tmp_path / "trips", "CHECKPOINT_DIR": tmp_path / "cp", "CHUNK_SIZE": 4, "MAX_OFFSETS_PER_TRIGGER": 4}
    for name, value in settings.items():
        monkeypatch.setenv(name, str(value))
    folders = ["--topic-dir", str(tmp_path / "topic"), "--out", str(tmp_path / "results")]
    main(["feed", *folders])
    assert len(list((tmp_path / "topic").glob("chunk-*.parquet"))) == 3
    main(["stream", "--once", "--keep-late", *folders])
    (results,) = (tmp_path / "results").glob("run-*")
    assert sum(bool(list(batch.iterdir())) for batch in (results / "data").iterdir()) == 3

    def said(command):
        capsys.readouterr()
        main([command, *folders])
        return capsys.readouterr().out

    measured = read_feed_metrics(spark, f"{results}/metrics")
    assert [r.events_in_chunk for r in measured.orderBy("batch_id").collect()][:2] == [4, 4] and "rows_per_second" in said("metrics")
    assert "late_rows" in said("late")
    before = said("verify"), said("count")
    main(["compact", *folders])
    assert not any(list(batch.iterdir()) for batch in (results / "data").iterdir())
    assert (said("verify"), said("count")) == before
    assert "2016-02-03 00:02:00" in before[0]


def test_two_topics_and_two_shapes_keep_apart(spark, tmp_path, monkeypatch, capsys):
    monkeypatch.setattr(SparkSession, "stop", lambda self: None)
    monkeypatch.setenv("CHECKPOINT_DIR", str(tmp_path / "checkpoints"))
    monkeypatch.setenv("TIME_FORMATS", "MM/dd/yyyy hh:mm:ss a")
    out = ["--out", str(tmp_path / "results")]
    for name, fare in (("a", 10), ("b", 1)):
        path = tmp_path / f"{name}.csv"
        path.write_text(f"Pickup Time,Fare Amount,Pickup Latitude,Pickup Longitude\n02/01/2016 10:00:00 AM,{fare},40.71,-74.0\n")
        monkeypatch.setenv("DATA_PATH", str(path))
        main(["feed", "--topic-dir", str(tmp_path / name)])
        main(["stream", "--once", "--topic-dir", str(tmp_path / name), *out])

    def shown(topic):
        capsys.readouterr()
        main(["verify", "--topic-dir", str(tmp_path / topic), *out])
        return capsys.readouterr().out

    assert shown("a").count("|1         |10.0    |") == 5
    assert shown("b").count("|1         |1.0     |") == 5
    monkeypatch.setenv("WINDOW_DURATION", "10 minutes")
    main(["stream", "--once", "--topic-dir", str(tmp_path / "a"), *out])
    assert shown("a").count("|1         |10.0    |") == 10
    monkeypatch.setenv("WINDOW_DURATION", "5 minutes")
    assert shown("a").count("|1         |10.0    |") == 5


def test_zone_file_to_report(spark, tmp_path, monkeypatch, capsys):
    monkeypatch.setattr(SparkSession, "stop", lambda self: None)
    path = tmp_path / "trips.csv"
    lines = ["VendorID,tpep_pickup_datetime,tpep_dropoff_datetime,passenger_count,trip_distance,PULocationID,DOLocationID,fare_amount"]
    lines += [f"1,2016-02-01 00:0{i}:30,2016-02-01 00:20:00,1,{d},132,{i + 1}.0,{i}.50" for i, d in enumerate(("1.25", "1.25", "12000"))]
    path.write_text("\n".join([*lines, "1,never,,1,1,132,7,1"]) + "\n")
    for name, value in (("DATA_PATH", str(path)), ("CHECKPOINT_DIR", str(tmp_path / "checkpoints")), ("LOCATION_KEY", "zone")):
        monkeypatch.setenv(name, value)
    folders = ["--topic-dir", str(tmp_path / "topic"), "--out", str(tmp_path / "results")]

    main(["feed", *folders])
    (lost,) = spark.read.parquet(f"{tmp_path}/results/feed-rejects").collect()
    assert lost.reject_reason == "bad_time" and '"tpep_pickup_datetime":"never"' in lost.value
    main(["stream", "--once", *folders])
    main(["raw", "--once", "--topic-dir", str(tmp_path / "topic"), "--out", str(tmp_path / "raw")])
    events = spark.read.parquet(f"{tmp_path}/raw/events").orderBy("event_time").collect()
    assert [(r.pickup_location, r.dropoff_location) for r in events] == [("zone:132", f"zone:{i}") for i in (1, 2, 3)]
    assert [r.trip_distance is None for r in events] == [False, False, True]
    (far,) = spark.read.parquet(f"{tmp_path}/raw/rejects").collect()
    assert far.reject_reason == "out_of_range" and far.id == events[2].id
    capsys.readouterr()
    main(["verify", *folders])
    assert "|2016-02-01 00:00:00|2016-02-01 00:05:00|zone:132       |3         |1.5     |" in capsys.readouterr().out


def test_raw_events_of_two_topics_do_not_replace_each_other(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(SparkSession, "stop", lambda self: None)
    monkeypatch.setenv("CHECKPOINT_DIR", str(tmp_path / "checkpoints"))
    for number, topic in enumerate(("first", "second")):
        path = tmp_path / f"{topic}.csv"
        path.write_text(f"Pickup Time,Fare Amount,Pickup Latitude,Pickup Longitude\n2016-02-01 00:0{number}:30,1.5,40.71,-74.0\n")
        monkeypatch.setenv("DATA_PATH", str(path))
        main(["feed", "--topic-dir", str(tmp_path / topic)])
    raw = lambda topic, out: main(["raw", "--once", "--topic-dir", str(tmp_path / topic), "--out", str(tmp_path / out)])
    raw("first", "raw")
    with pytest.raises(ValueError, match="name another folder"):
        raw("second", "raw")
    raw("second", "other")
    raw("first", "raw")
    for out, minute in (("raw", 0), ("other", 1)):
        (event,) = spark.read.parquet(f"{tmp_path}/{out}/events").collect()
        assert event.event_time.minute == minute
