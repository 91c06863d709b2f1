"""Comparison of a query with its SQL, on sorted rows and columns."""

from __future__ import annotations

import datetime
import decimal
import math
from pathlib import Path

import duckdb


def _plain(value):
    if value is None:
        return None
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    if isinstance(value, decimal.Decimal):
        return ("decimal", str(value))
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [names[i] for i in order], sorted(plain, key=repr)


def spark_rows(df):
    return rows_of(df.columns, df.collect())


def duck_rows(sql: str, sf_dir: str):
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    found = con.execute(sql)
    return rows_of([column[0] for column in found.description], found.fetchall())
