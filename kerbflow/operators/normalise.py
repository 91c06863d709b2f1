"""From a delimited file's own headers and texts to the event fields."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbflow.functions import iso_text, missing_text_to_null, missing_to_null, parse_time, whole_number
from kerbflow.operators.rejects import BAD_TIME
from kerbflow.schema import EVENT_SCHEMA, PICKUP_TIME


def normalise_columns(df: DataFrame) -> DataFrame:
    """Headers stripped, in lower case, with ``_`` for each space."""
    names = [name.strip().lower().replace(" ", "_") for name in df.columns]
    twice = sorted({name for name in names if names.count(name) > 1})
    if twice:
        raise ValueError(f"headers that become equal: {', '.join(twice)}")
    return df.toDF(*names)


def detect_time_column(columns: Sequence[str]) -> str:
    """First header that speaks of a pickup and of a time (``datetime`` included)."""
    found = next((name for name in columns if "pickup" in name and "time" in name), None)
    if found is None:
        raise ValueError(f"no pickup time column among: {', '.join(columns)}")
    return found


def unread_trips(df: DataFrame, time_formats: Sequence[str] = ()) -> DataFrame:
    """The rows that ``canonical_trips`` drops, each as a JSON text in ``value``, with ``reject_reason``.

    Takes normalised headers, as that does.
    """
    time = F.col(PICKUP_TIME if PICKUP_TIME in df.columns else detect_time_column(df.columns))
    if dict(df.select(time).dtypes).popitem()[1] == "string":
        time = parse_time(missing_text_to_null(time), time_formats)
    lost = df.filter(time.cast("timestamp").isNull())
    return lost.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"), F.lit(BAD_TIME).alias("reject_reason"))


def canonical_trips(df: DataFrame, time_formats: Sequence[str] = (), unread: bool = False) -> DataFrame:
    """Event fields under their fixed names and types, other columns kept behind them.

    Takes normalised headers. A pickup time column of another name is renamed; rows whose
    pickup time cannot be read are dropped, or with ``unread`` stay without a time; event fields the file lacks are NULL.
    """
    if PICKUP_TIME not in df.columns:
        df = df.withColumnRenamed(detect_time_column(df.columns), PICKUP_TIME)
    types = dict(df.dtypes)

    def cleaned(name: str):
        return missing_text_to_null(F.col(name)) if types[name] == "string" else F.col(name)

    def event_field(spec: T.StructField):
        if spec.name not in types:
            return F.lit(None).cast(spec.dataType)
        column, is_text = cleaned(spec.name), types[spec.name] == "string"
        if spec.name == PICKUP_TIME:
            return parse_time(column, time_formats) if is_text else column.cast("timestamp")
        if isinstance(spec.dataType, T.IntegerType):
            return whole_number(column.cast("string"))
        if isinstance(spec.dataType, T.DoubleType):
            return missing_to_null(column.try_cast("double"))
        return column.cast(spec.dataType)

    extra = [name for name in df.columns if name not in EVENT_SCHEMA.names]
    read = df.select(
        *[event_field(spec).alias(spec.name) for spec in EVENT_SCHEMA],
        *[cleaned(name).alias(name) for name in extra],
    )
    kept = read if unread else read.dropna(subset=[PICKUP_TIME])
    return kept.withColumn(PICKUP_TIME, iso_text(F.col(PICKUP_TIME)))
