"""Types of the sink tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def out_of_range(df: DataFrame, types: Mapping[str, str]) -> Column:
    """Whether a row holds a number that is too large for its column; never NULL."""
    numbers = [name for name, target in types.items() if name in df.columns and target.startswith("decimal")]
    lost = [F.col(name).isNotNull() & F.col(name).try_cast(types[name]).isNull() for name in numbers]
    return F.greatest(F.lit(False), F.lit(False), *lost)


def to_table_types(df: DataFrame, types: Mapping[str, str], on_overflow: str = "error") -> DataFrame:
    """Columns of ``types`` that ``df`` has, in that order, as the table stores them.

    A number too large for its column fails the write, as a database does, unless
    ``on_overflow="null"``.
    """
    if on_overflow not in ("error", "null"):
        raise ValueError("on_overflow is 'error' or 'null'")

    def coerced(name: str):
        column, target = F.col(name), types[name]
        if target.startswith("varchar"):
            return column
        cast = column.try_cast(target) if on_overflow == "null" else column.cast(target)
        return cast.alias(name)

    return df.select(*[coerced(name) for name in types if name in df.columns])
