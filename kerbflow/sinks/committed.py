"""Micro-batches that become visible at once or not at all.

    <path>/data/batch_id=N/attempt=X/   what one attempt at batch N wrote
    <path>/commits/N.json               names the attempt that counts, replaced in one step

A reader takes the attempts that commits name and nothing else. So a batch that is being written, or whose writer died, is not seen;
while a batch is written again its first version stays readable, and a batch without rows leaves a commit alone.
"""

from __future__ import annotations

import json
import logging
import uuid
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from kerbflow.operators.numbering import dense_numbers
from kerbflow.operators.windows import drop_null_location
from kerbflow.storage import delete, get_text, names_in, put_text

log = logging.getLogger(__name__)

# Rows of several kinds may lie side by side in a batch.
KIND, RESULT, LATE = "kind", "result", "late"
EVENT, REJECT = "event", "reject"


@dataclass(frozen=True)
class Commit:
    """``attempt`` is None for a batch without rows; ``total`` counts the rows up to this batch.

    ``newest`` is the latest event time so far and ``late_mark`` the time up to which windows were closed to this
    batch, both in microseconds and only for sinks that keep late rows.
    """

    batch_id: int
    attempt: str | None
    rows: int
    total: int
    newest: int | None = None
    late_mark: int | None = None


COMMIT_SCHEMA = "batch_id bigint, attempt string, rows bigint, total bigint, newest bigint, late_mark bigint"


def commit_path(path: str, batch_id: int) -> str:
    return f"{path}/commits/{batch_id:019d}.json"


def attempt_path(path: str, batch_id: int, attempt: str) -> str:
    return f"{path}/data/batch_id={batch_id}/attempt={attempt}"


def commit_of(spark: SparkSession, path: str, batch_id: int) -> Commit | None:
    text = get_text(spark, commit_path(path, batch_id)) if batch_id >= 0 else None
    return Commit(**json.loads(text)) if text else None


def commits(spark: SparkSession, path: str, after: int = -1) -> list[Commit]:
    """The commits of batches above ``after``, in order; one small record for each."""
    found = [name for name in names_in(spark, f"{path}/commits") if int(name.split(".")[0]) > after]
    if not found:
        return []
    rows = spark.read.schema(COMMIT_SCHEMA).json([f"{path}/commits/{name}" for name in found]).collect()
    return sorted((Commit(**row.asDict()) for row in rows), key=lambda c: c.batch_id)


class CommittedSink:
    """Callback for ``foreachBatch``. A folder belongs to one checkpoint.

    ``number_by`` gives the rows numbers without a gap in ``id``, in that order and on from the batch before; a batch
    that is run again gets the same ones. ``watched`` are aggregates over the whole batch that ``committed`` may use.
    """

    watched: Sequence[Column] = ()

    def __init__(
        self,
        path: str,
        prepare: Callable[[DataFrame], DataFrame] = drop_null_location,
        stamp: str | None = "processed_at",
        number_by: Sequence[Column] | None = None,
    ):
        self.path = path.rstrip("/")
        self.prepare = prepare
        self.stamp = stamp
        self.number_by = number_by

    def rows_of(self, batch: DataFrame, batch_id: int, before: Commit | None) -> DataFrame:
        return self.prepare(batch)

    def write(self, rows: DataFrame, folder: str) -> None:
        rows.write.parquet(folder)

    def committed(self, commit: Commit, before: Commit | None, seen: dict) -> Commit:
        return commit

    def __call__(self, batch: DataFrame, batch_id: int) -> int:
        spark, attempt = batch.sparkSession, uuid.uuid4().hex
        before = commit_of(spark, self.path, batch_id - 1)
        total = before.total if before else 0
        seen = Observation()
        if self.watched:
            batch = batch.observe(seen, *self.watched)
        rows = self.rows_of(batch, batch_id, before)
        if self.number_by:
            rows = dense_numbers(rows, self.number_by, "id", total)
        if self.stamp:
            rows = rows.withColumn(self.stamp, F.current_timestamp())
        counted = Observation()
        folder = attempt_path(self.path, batch_id, attempt)
        self.write(rows.observe(counted, F.count(F.lit(1)).alias("written")), folder)
        written = counted.get["written"]
        if not written:
            delete(spark, folder)
        commit = Commit(batch_id, attempt if written else None, written, total + written)
        commit = self.committed(commit, before, seen.get if self.watched else {})
        put_text(spark, commit_path(self.path, batch_id), json.dumps(asdict(commit)))
        log.info("batch %d: %s", batch_id, f"{written} rows committed" if written else "no rows")
        return written
