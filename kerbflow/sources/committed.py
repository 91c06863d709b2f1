"""What a committed sink has made visible."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbflow.schema import AGGREGATE_SCHEMA, changelog_schema
from kerbflow.sinks.committed import KIND, RESULT, Commit, attempt_path, commits


def read_attempts(
    spark: SparkSession, path: str, chosen: Sequence[Commit], schema: T.StructType = AGGREGATE_SCHEMA, kind: str = RESULT
) -> DataFrame:
    """Rows of the attempts that these commits name, with their ``batch_id``. No other folder is listed.

    Where batches hold rows of several kinds, those of ``kind``.
    """
    full = changelog_schema(schema)
    folders = [attempt_path(path, c.batch_id, c.attempt) for c in chosen if c.attempt]
    if not folders:
        return spark.createDataFrame([], full)
    stored = spark.read.schema(full).option("basePath", f"{path}/data").parquet(*folders)
    if KIND in stored.columns and KIND not in full.names:
        stored = stored.filter(F.col(KIND) == kind)
    return stored.select(*[F.col(spec.name).cast(spec.dataType).alias(spec.name) for spec in full])


def read_committed(
    spark: SparkSession, path: str, schema: T.StructType = AGGREGATE_SCHEMA, after: int = -1, kind: str = RESULT
) -> DataFrame:
    """Rows of every committed batch above ``after``; none when no batch has been committed yet."""
    path = path.rstrip("/")
    return read_attempts(spark, path, commits(spark, path, after), schema, kind)
