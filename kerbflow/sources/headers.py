"""Folders whose trip files have several kinds of header."""

from __future__ import annotations

import csv
from collections.abc import Callable, Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbflow.schema import PICKUP_TIME
from kerbflow.session import session_settings


Prepare = Callable[[DataFrame], DataFrame]

# What a listing of files gives, and the signs that a path pattern may hold.
FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"
PATTERN_SIGNS = str.maketrans({sign: f"\\{sign}" for sign in "\\*?[]{}"})


def as_pattern(path: str) -> str:
    """A path pattern that means this very file, whatever signs its name has."""
    return path.translate(PATTERN_SIGNS)


def first_lines(spark: SparkSession, path: str | Sequence[str]) -> dict[str, str]:
    """The first line of each file that has one, by the file's address. ``path`` is a folder or pattern, or several.

    Each split of a file is a partition of its own for this, and a task stops after the first rows, so files are opened and
    hardly read. The driver holds one line per file, as it does for their names in any scan.
    """

    # Defined here, so that workers do not need this package.
    def first_of_each(batches):
        """The first row of a partition, and no more of it is read; nothing if that is inside a file."""
        for batch in batches:
            if batch.num_rows:
                if batch.column(1)[0].as_py() == 0:
                    yield batch.slice(0, 1)
                return

    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"), "value")
    # No two splits fit into one partition when opening one counts as much as many.
    apart = {"spark.sql.files.openCostInBytes": "16g", "spark.sql.execution.arrow.maxRecordsPerBatch": "16"}
    with session_settings(spark, apart):
        found = lines.mapInArrow(first_of_each, "file string, at bigint, value string").select("file", "value").collect()
        return {unquote(row.file): row.value.removeprefix("\ufeff") for row in found}


def files_by_header(spark: SparkSession, path: str | Sequence[str]) -> dict[tuple[str, ...], list[str]]:
    """The files of a folder by their header; those without a line are left out."""
    groups: dict[tuple[str, ...], list[str]] = {}
    for file, line in sorted(first_lines(spark, path).items()):
        groups.setdefault(tuple(next(csv.reader([line]))), []).append(file)
    return groups


def read_trip_groups(spark: SparkSession, path: str | Sequence[str]) -> list[DataFrame]:
    """The files of a folder as one table per header, all columns as text under the file's own names.

    Columns are told by the header of their own file, so files with the same columns in another order, of another
    generation, or with more columns may lie side by side.
    """
    reader = spark.read.option("header", True).option("enforceSchema", False)
    return [reader.csv([as_pattern(file) for file in files]) for _, files in sorted(files_by_header(spark, path).items())]


def read_mixed_trips(spark: SparkSession, path: str | Sequence[str], prepare: Prepare) -> DataFrame:
    """``prepare`` (``canonical_trips`` of ``normalise_columns``, say) of each group, put together by name.

    A column that a group lacks is NULL in its rows. A folder without files gives no table, as any scan of it does.
    """
    groups = [prepare(group) for group in read_trip_groups(spark, path)]
    if not groups:
        raise ValueError(f"no file with a header in {path}")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), groups)


def stream_file_names(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """The files of a folder as a stream of their addresses, oldest first; ``max_files`` bounds a micro-batch.

    Names alone are taken, nothing of the files is read. Which of them a batch has seen is kept in the checkpoint.
    """
    reader = spark.readStream.format("binaryFile").schema(FILE_SCHEMA)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path).select("path")


class MixedTripsSink:
    """Callback for batches of ``stream_file_names``: reads the files of a batch by their headers, and hands the rows on.

    Each batch has the groups of its own files, so a generation of files that nobody knew when the stream began is read
    under its own header when it comes. ``prepare`` gives every group the columns that ``sink``, a callback too,
    takes. A batch whose files are all empty is handed on without rows. The driver holds the names of one batch, as in any scan.
    A file must not change once it is there: a batch that is run again reads it again.
    """

    def __init__(self, sink: Callable[[DataFrame, int], object], prepare: Prepare):
        self.sink = sink
        self.prepare = prepare

    def __call__(self, batch: DataFrame, batch_id: int) -> object:
        spark = batch.sparkSession
        files = [as_pattern(row.path) for row in batch.select("path").collect()]
        groups = read_trip_groups(spark, files) if files else []
        none = spark.createDataFrame([], f"{PICKUP_TIME} string")
        prepared = [self.prepare(group) for group in groups or [none]]
        return self.sink(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), prepared), batch_id)
