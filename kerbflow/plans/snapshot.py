"""Current value of each window from a snapshot and the batches since, instead of from all versions ever written.

    <path>/snapshots/attempt=X/day=D/   the windows that start on day D
    <path>/snapshot.json                the attempt that counts for each day, and the last batch that is in it

A compaction reads the batches since the last one and the days they touch, and writes those days anew. All other days are
carried over by name, so its cost goes with what has changed. The record is replaced in one step.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbflow.operators.latest import latest_versions
from kerbflow.plans.report import REPORT_COLUMNS, newest_windows
from kerbflow.schema import AGGREGATE_KEYS, AGGREGATE_MEASURES, AGGREGATE_SCHEMA, changelog_schema
from kerbflow.sinks.committed import Commit, attempt_path, commit_path, commits
from kerbflow.sources.committed import read_attempts
from kerbflow.storage import delete, get_text, names_in, put_text


@dataclass(frozen=True)
class Day:
    day: str
    attempt: str
    rows: int


@dataclass(frozen=True)
class Snapshot:
    """``days`` in order; ``high_water`` is the last batch that is in them, -1 for none."""

    high_water: int = -1
    days: list[Day] = field(default_factory=list)


def snapshot_of(spark: SparkSession, path: str) -> Snapshot:
    text = get_text(spark, f"{path}/snapshot.json")
    if not text:
        return Snapshot()
    stored = json.loads(text)
    return Snapshot(stored["high_water"], [Day(**day) for day in stored["days"]])


def _day_path(path: str, day: Day) -> str:
    return f"{path}/snapshots/attempt={day.attempt}/day={day.day}"


def _read_days(spark: SparkSession, path: str, days: Sequence[Day]) -> DataFrame:
    full = changelog_schema(AGGREGATE_SCHEMA)
    folders = [_day_path(path, day) for day in days if day.rows]
    if not folders:
        return spark.createDataFrame([], full)
    typed = T.StructType([*full.fields, T.StructField("day", T.DateType())])
    return spark.read.schema(typed).option("basePath", f"{path}/snapshots").parquet(*folders)


def _newest(versions: DataFrame) -> DataFrame:
    """``latest_versions`` with the batch that each comes from."""
    newest = [F.max_by(name, "batch_id").alias(name) for name in AGGREGATE_MEASURES]
    return versions.groupBy(*AGGREGATE_KEYS).agg(*newest, F.max("batch_id").alias("batch_id"))


def compact(spark: SparkSession, path: str) -> Snapshot:
    """Take the batches committed since the last compaction into the snapshot. Without any, nothing is written.

    Run by one job at a time. One that dies leaves the snapshot before it, and folders that ``remove_compacted`` clears away.
    """
    path = path.rstrip("/")
    before = snapshot_of(spark, path)
    tail = commits(spark, path, before.high_water)
    if not tail:
        return before
    fresh = read_attempts(spark, path, tail)
    day = F.to_date("window_start")
    # One row a day that the batches touch.
    touched = {str(row.day) for row in fresh.select(day.alias("day")).distinct().collect()}
    old = _read_days(spark, path, [d for d in before.days if d.day in touched]).select(*fresh.columns)
    attempt = uuid.uuid4().hex
    merged = _newest(old.unionByName(fresh)).withColumn("day", day)
    folder = f"{path}/snapshots/attempt={attempt}"
    merged.repartition("day", F.pmod(F.xxhash64(*AGGREGATE_KEYS), F.lit(8))).write.partitionBy("day").parquet(folder)
    counts = {}
    if touched:
        stored = spark.read.schema(merged.schema).parquet(folder)
        counts = {str(row.day): row["count"] for row in stored.groupBy("day").count().collect()}
    kept = [d for d in before.days if d.day not in touched]
    days = sorted([*kept, *(Day(d, attempt, n) for d, n in counts.items())], key=lambda d: d.day)
    after = Snapshot(tail[-1].batch_id, days)
    put_text(spark, f"{path}/snapshot.json", json.dumps(asdict(after)))
    return after


def _tail(spark: SparkSession, path: str, snapshot: Snapshot) -> list[Commit]:
    return commits(spark, path, snapshot.high_water)


def read_latest(spark: SparkSession, path: str) -> DataFrame:
    """The current value of each window: the snapshot and the batches after it, and no older batch."""
    path = path.rstrip("/")
    snapshot = snapshot_of(spark, path)
    fresh = read_attempts(spark, path, _tail(spark, path, snapshot))
    return latest_versions(_read_days(spark, path, snapshot.days).select(*fresh.columns).unionByName(fresh))


def newest_results(spark: SparkSession, path: str, limit: int = 20, columns: tuple[str, ...] = REPORT_COLUMNS) -> DataFrame:
    """``newest_windows`` of ``read_latest`` from as few of the newest days as are certain to hold ``limit`` windows.

    The snapshot knows the windows of each day. Whatever starts on an earlier day starts before all of those, and
    windows that are new since are read in any case.
    """
    path = path.rstrip("/")
    snapshot = snapshot_of(spark, path)
    held, chosen = 0, []
    for day in reversed(snapshot.days):
        if held >= limit:
            break
        chosen.append(day)
        held += day.rows
    fresh = read_attempts(spark, path, _tail(spark, path, snapshot))
    stored = _read_days(spark, path, chosen)
    if chosen and "day" in stored.columns:
        stored = stored.filter(F.col("day") >= F.lit(chosen[-1].day).cast("date"))
    return newest_windows(latest_versions(stored.select(*fresh.columns).unionByName(fresh)), limit, columns)


#: Commits that stay when older ones are removed: a batch looks back at two.
KEPT_COMMITS = 2


def remove_compacted(spark: SparkSession, path: str) -> int:
    """Delete what no reader that starts now would read: batches in the snapshot, attempts and days that do not count.

    Returns the number of folders and records removed. Not for a time when a batch or a compaction is being written, or a long read is under way.
    """
    path = path.rstrip("/")
    snapshot = snapshot_of(spark, path)
    all_commits, removed = commits(spark, path), 0
    live = {(c.batch_id, c.attempt) for c in all_commits if c.batch_id > snapshot.high_water}
    for folder in names_in(spark, f"{path}/data"):
        batch_id = int(folder.split("=")[1])
        attempts = [name.split("=")[1] for name in names_in(spark, f"{path}/data/{folder}")]
        dead = [a for a in attempts if (batch_id, a) not in live]
        for attempt in dead:
            delete(spark, attempt_path(path, batch_id, attempt))
        if len(dead) == len(attempts):
            delete(spark, f"{path}/data/{folder}")
        removed += len(dead)
    for commit in all_commits:
        if commit.batch_id <= snapshot.high_water - KEPT_COMMITS:
            delete(spark, commit_path(path, commit.batch_id))
            removed += 1
    days = {(d.attempt, d.day) for d in snapshot.days}
    for folder in names_in(spark, f"{path}/snapshots"):
        attempt = folder.split("=")[1]
        stored = [name.split("=")[1] for name in names_in(spark, f"{path}/snapshots/{folder}")]
        dead = [d for d in stored if (attempt, d) not in days]
        for day in dead:
            delete(spark, _day_path(path, Day(day, attempt, 0)))
        if len(dead) == len(stored):
            delete(spark, f"{path}/snapshots/{folder}")
        removed += len(dead)
    return removed
