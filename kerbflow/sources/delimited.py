"""Trip files with a header line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_trips(spark: SparkSession, path: str) -> DataFrame:
    """All columns as text, under the file's own headers.

    Types are not inferred: that would read everything once more, and ``canonical_trips`` knows them. Columns are told by
    their place, so a folder whose files have other headers, or the same in another order, is refused.
    """
    return spark.read.option("header", True).option("enforceSchema", False).csv(path)


def stream_trips(
    spark: SparkSession, path: str, max_files: int | None = None, file_name: str | None = None
) -> DataFrame:
    """The files of a folder as a stream, oldest first; ``max_files`` bounds a micro-batch, ``file_name`` names a column for each row's file."""
    header = read_trips(spark, path).columns
    schema = T.StructType([T.StructField(name, T.StringType()) for name in header])
    reader = spark.readStream.schema(schema).option("header", True).option("enforceSchema", False)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    stream = reader.csv(path)
    return stream.select("*", F.col("_metadata.file_name").alias(file_name)) if file_name else stream
