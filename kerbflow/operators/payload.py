"""Rows to JSON messages and back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbflow.functions import iso_text, missing_to_null
from kerbflow.schema import EVENT_SCHEMA, ZONE_SCHEMA


def encode_messages(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """One JSON object per row in ``value``, with ``null`` for missing values.

    Columns in ``keep`` (a message's partition and offset, say) stay beside it, outside the JSON.
    """

    def printable(spec: T.StructField):
        column = F.col(spec.name)
        if isinstance(spec.dataType, (T.TimestampType, T.TimestampNTZType)):
            column = iso_text(column)
        elif isinstance(spec.dataType, (T.DoubleType, T.FloatType)):
            column = missing_to_null(column)
        return column.alias(spec.name)

    fields = [printable(spec) for spec in df.schema if spec.name not in keep]
    text = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    return df.select(text.cast("binary").alias("value"), *keep)


def decode_messages(
    messages: DataFrame, fields: Sequence[str] | None = None, keep: Sequence[str] = ()
) -> DataFrame:
    """Event fields from the ``value`` of each message.

    Malformed text gives NULL in every field, a value of the wrong type in its own field only, and a
    bare ``NaN`` is a missing value.
    ``fields`` narrows the parse to those a later step reads; it may name the two zone fields as well.
    """
    names = EVENT_SCHEMA.names if fields is None else list(fields)
    schema = T.StructType([ZONE_SCHEMA[name] if name in ZONE_SCHEMA.names else EVENT_SCHEMA[name] for name in names])
    parsed = F.from_json(F.col("value").cast("string"), schema).alias("data")

    def field(spec: T.StructField):
        column = F.col(f"data.{spec.name}")
        return (missing_to_null(column) if isinstance(spec.dataType, T.DoubleType) else column).alias(spec.name)

    return messages.select(parsed, *keep).select(*[field(spec) for spec in schema], *keep)
