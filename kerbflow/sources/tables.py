"""Results that a sink has written."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from kerbflow.config import FlowConfig
from kerbflow.schema import AGGREGATE_SCHEMA, changelog_schema


def read_changelog(spark: SparkSession, path: str, schema: T.StructType = AGGREGATE_SCHEMA) -> DataFrame:
    """Rows of every ``batch_id=N`` folder; none when no batch has been written yet."""
    full = changelog_schema(schema)
    try:
        return spark.read.schema(full).parquet(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], full)


def read_jdbc_table(spark: SparkSession, config: FlowConfig, table: str | None = None) -> DataFrame:
    from kerbflow.sinks.jdbc import jdbc_options

    return spark.read.format("jdbc").options(**jdbc_options(config, table or config.aggregate_table)).load()
