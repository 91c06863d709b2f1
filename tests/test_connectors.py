"""Connectors without a server: what they would ask for."""

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrameWriter

from kerbflow.config import FlowConfig
from kerbflow.sinks import JdbcSink, create_aggregate_table, create_raw_table, jdbc_options, kafka_write_options
from kerbflow.sources import kafka_read_options, kafka_stream_options, read_kafka, stream_kafka

CONFIG = FlowConfig(jdbc_password="secret")


def test_kafka_options():
    read = {
        "kafka.bootstrap.servers": "kafka:29092",
        "subscribe": "taxi-events",
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
    }
    assert kafka_read_options(CONFIG) == read
    assert kafka_stream_options(CONFIG) == read
    bounded = FlowConfig.from_env({"MAX_OFFSETS_PER_TRIGGER": "50000", "JDBC_MAX_CONNECTIONS": "64"})
    assert kafka_stream_options(bounded)["maxOffsetsPerTrigger"] == "50000"
    assert bounded.jdbc_max_connections == 64
    assert kafka_write_options(CONFIG) == {
        "kafka.bootstrap.servers": "kafka:29092",
        "topic": "taxi-events",
        "kafka.acks": "all",
        "kafka.retries": "5",
        "kafka.linger.ms": "5",
        "kafka.compression.type": "gzip",
    }


def test_kafka_needs_its_jar(spark):
    for reader in (read_kafka, stream_kafka):
        with pytest.raises(AnalysisException, match="kafka"):
            reader(spark, CONFIG)


def test_jdbc_options():
    assert jdbc_options(CONFIG, "t") == {
        "url": "jdbc:postgresql://postgres:5432/taxi_pipeline",
        "dbtable": "t",
        "driver": "org.postgresql.Driver",
        "batchsize": "1000",
        "numPartitions": "8",
        "user": "pipeline",
        "password": "secret",
    }
    assert "password" not in jdbc_options(FlowConfig(), "t")


def test_jdbc_sink(spark, monkeypatch):
    """What reaches the writer, without a database."""
    saved = []

    def save(self, *args, **kwargs):
        saved.append((self._df.schema.simpleString(), self._df.drop("processed_at").collect()))

    monkeypatch.setattr(DataFrameWriter, "save", save)
    start = datetime(2024, 1, 1)
    schema = """window_start timestamp, window_end timestamp, pickup_location string, trip_count bigint,
        avg_fare double, total_fare double, avg_trip_distance double"""
    batch = spark.createDataFrame([(start, start, "a", 2, 1.25, 2.5, 0.125), (start, start, None, 1, 1.0, 1.0, 1.0)], schema)

    assert JdbcSink(CONFIG)(batch, 3) == 1
    kind, rows = saved.pop()
    types = "avg_fare:decimal(10,2),total_fare:decimal(12,2),avg_trip_distance:decimal(8,4),processed_at:timestamp"
    assert f"{types},batch_id:bigint" in kind
    assert [tuple(r) for r in rows] == [(start, start, "a", 2, Decimal("1.25"), Decimal("2.50"), Decimal("0.1250"), 3)]

    assert JdbcSink(CONFIG)(batch.filter("pickup_location is null"), 4) == 0
    assert saved == []

    JdbcSink(CONFIG, with_batch_id=False)(batch, 5)
    assert "batch_id" not in saved.pop()[0]


def test_table_definitions(spark, tmp_path):
    create_aggregate_table(spark, "kerb_aggregates", f"{tmp_path}/a")
    create_aggregate_table(spark, "kerb_aggregates", f"{tmp_path}/a")
    create_raw_table(spark, "kerb_raw", f"{tmp_path}/r")
    try:
        assert dict(spark.table("kerb_aggregates").dtypes)["avg_trip_distance"] == "decimal(8,4)"
        assert spark.table("kerb_raw").columns[:2] == ["id", "event_time"]
    finally:
        spark.sql("DROP TABLE kerb_aggregates")
        spark.sql("DROP TABLE kerb_raw")


def test_files_with_another_header_order_are_refused(spark, tmp_path):
    from kerbflow.sources import read_trips

    (tmp_path / "a.csv").write_text("fare_amount,trip_distance\n1.5,9.0\n")
    (tmp_path / "b.csv").write_text("trip_distance,fare_amount\n9.0,1.5\n")
    with pytest.raises(Exception, match="header"):
        read_trips(spark, str(tmp_path)).collect()
