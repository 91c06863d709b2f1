"""Helpers shared by the operators: worker path, scratch tables, text columns, files, connected classes."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import os
from collections.abc import Callable, Iterable
from pathlib import Path

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbflow.session import scratch_dir

SLICE = 256


BATCH_SETTING, BATCH_DEFAULT, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000", "1000"


def ready(spark: SparkSession) -> SparkSession:
    """Let the Python workers find this package where the driver found it, and send them small batches.

    Ten thousand whole texts a batch are more than a worker should hold, so unless the session states a batch size
    of its own it is set to ``BATCH_ROWS`` for the session.

    A cluster installs the package on its nodes; this matters for a local session whose driver put the folder on its
    own ``sys.path``.
    """
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    known = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in known:
        environment["PYTHONPATH"] = os.pathsep.join([*known, root])
    if spark.conf.get(BATCH_SETTING) == BATCH_DEFAULT:
        spark.conf.set(BATCH_SETTING, BATCH_ROWS)
    return spark


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows as a table in the shared folder: cuts the lineage, survives a lost executor."""
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_column(function: Callable[[list], Iterable], returns: str, kind: pa.DataType):
    """A column made from a text column, a slice of rows at a time.

    ``function`` maps a list of texts (or None) to as many values. Marked nondeterministic so that a filter on the
    result does not compute it twice.
    """

    def run(texts: pa.Array) -> pa.Array:
        out: list = []
        for at in range(0, len(texts), SLICE):
            out.extend(function(texts.slice(at, SLICE).to_pylist()))
        return pa.array(out, type=kind)

    return F.arrow_udf(run, returns).asNondeterministic()


def put(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with the column ``name`` last; a column of that name in the input is replaced."""
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() != name.lower()], value.alias(name))


def store(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder and the folder's path in it."""
    return fs.FileSystem.from_uri(uri)


class Memo(dict):
    """Results of ``make`` for recent keys, at most ``2 * limit`` of them.

    When the young generation is full it becomes the old one; what is used again moves back.
    """

    def __init__(self, make: Callable, limit: int = 120_000, longest: int = 64):
        super().__init__()
        self.make, self.limit, self.longest, self.old = make, limit, longest, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
            if len(key) > self.longest:
                return value
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


_RESIDENT: dict = {}


def give_back() -> None:
    """Return free memory of this process to the system, as far as its allocators can."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)  # glibc alone has it


def resident(key, make: Callable):
    """What a worker keeps between batches: the state of the operator that it ran last, and no other.

    Workers outlive stages, so without this each operator of a pipeline would leave its tables in every worker. What
    the operator before has left free is given back to the system.
    """
    if key not in _RESIDENT:
        _RESIDENT.clear()
        give_back()
        _RESIDENT[key] = make()
    return _RESIDENT[key]


def connected_classes(links: DataFrame, label: str) -> DataFrame:
    """Classes of vertices joined by ``links`` (columns ``a`` and ``b``, any one type).

    Returns ``id`` and ``root``, one row per vertex that has a link. Each round maps every vertex to the smallest of its
    closed neighbourhood in a new random order and contracts the links along that map, so a chain shrinks by a constant
    factor and a star in one round. Smallest neighbours are combined on the map side and a hub's links are only joined
    with single rows, so no neighbourhood is collected. Every round ends in a written table.
    """
    links = links.select("a", "b").where("a <> b")
    live = written(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), f"{label}-links")
    roots: DataFrame | None = None
    turn = 0
    while roots is None or not live.isEmpty():
        both = live.union(live.select(F.col("b").alias("a"), F.col("a").alias("b")))
        order = lambda c: F.struct(F.xxhash64(F.col(c), F.lit(turn)).alias("h"), F.col(c).alias("v"))
        nearest = both.groupBy("a").agg(F.min(order("b")).alias("m"))
        low = written(nearest.select("a", F.least(order("a"), "m")["v"].alias("to")), f"{label}-low")
        if roots is None:
            roots = low.select(F.col("a").alias("id"), F.col("to").alias("root"))
        else:
            moved = roots.join(low, roots["root"] == low["a"], "left")
            roots = written(moved.select("id", F.coalesce("to", "root").alias("root")), f"{label}-roots")
        first = live.join(low, "a").select(F.col("to").alias("x"), "b")
        ends = first.join(low, first["b"] == low["a"]).select("x", F.col("to").alias("y")).where("x <> y")
        live = written(ends.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), f"{label}-links")
        turn += 1
    return roots
