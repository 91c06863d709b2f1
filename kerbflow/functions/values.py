"""Missing values, numbers and times."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts a delimited file uses for "no value".
MISSING_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)


def missing_to_null(number: Column) -> Column:
    """NaN to NULL: one NaN would turn the sum and the mean of its whole group into NaN."""
    return F.when(~F.isnan(number), number)


def missing_text_to_null(text: Column) -> Column:
    return F.when(~F.trim(text).isin(*MISSING_TOKENS), text)


def whole_number(text: Column) -> Column:
    """Integer from text, also from ``3.0``, which a column with gaps holds. NULL for other text."""
    number = text.try_cast("double")
    return F.when(number == F.floor(number), number.try_cast("int"))


def parse_time(text: Column, formats: Sequence[str] = ()) -> Column:
    """Timestamp from text, NULL when it is not one.

    The ISO-like forms that a cast reads come first, then each of ``formats``. A time of day
    without a date is refused: it would read as today and change when a job is replayed.
    """
    has_date = ~F.instr(F.ltrim(text), ":").between(1, 4)
    readings = [F.when(has_date, F.try_to_timestamp(text))]
    readings += [F.try_to_timestamp(text, F.lit(form)) for form in formats]
    return F.coalesce(*readings) if len(readings) > 1 else readings[0]


def iso_text(time: Column) -> Column:
    """``yyyy-MM-ddTHH:mm:ss``, with six decimals unless the fraction is zero."""
    fraction = F.when(F.date_format(time, "SSSSSS") != "000000", F.date_format(time, ".SSSSSS")).otherwise("")
    return F.concat(F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss"), fraction)
