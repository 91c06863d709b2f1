"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession


def build_session(
    app_name: str = "kerbflow", master: str | None = None, shuffle_partitions: int | None = None, **settings: str
) -> SparkSession:
    """Session with UTC event times. Cluster sizes are left to spark-submit unless given."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def use_utc(spark: SparkSession) -> SparkSession:
    """Texts without a zone are read as UTC and windows are aligned to it."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def named_dir(spark: SparkSession) -> str | None:
    """The folder every executor can reach, if the cluster names one in ``spark.checkpoint.dir``."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    return named.rstrip("/") if named else None


def shared_dir(spark: SparkSession) -> str:
    """``named_dir``; only a local session, as in tests, may fall back on a temporary folder of the machine."""
    named = named_dir(spark)
    if named:
        return named
    if spark.sparkContext.master.startswith("local"):
        return tempfile.mkdtemp(prefix="kerbflow-")
    raise ValueError("set spark.checkpoint.dir to a folder that all executors share")


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A folder of its own for one run, under the shared folder."""
    return f"{shared_dir(spark)}/kerbflow/{label}-{uuid.uuid4().hex}"


@contextmanager
def session_settings(spark: SparkSession, settings: dict[str, str]):
    """Set session options for the time of a block. A streaming query keeps those it was started with."""
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        yield spark
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
