"""Location keys: a grid cell about 1 km wide, or a zone number."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_up(number: Column, dp: int = 2) -> Column:
    """Same value as ``F.round(number, dp)`` for every double, without a decimal object per row.

    Away from a tie, scaling and flooring cannot land on the wrong side, so only values next
    to a tie (and very large ones) take the decimal route.
    """
    scale = float(10**dp)
    scaled = F.abs(number) * scale
    near_tie = F.abs(scaled - F.floor(scaled) - 0.5) < 1e-6
    steps = F.floor(scaled + 0.5)
    # Integer steps have no negative zero, so -0.001 becomes 0.0 as it does with F.round.
    quick = F.when(number < 0, -steps).otherwise(steps) / F.lit(scale)
    return F.when(near_tie | (F.abs(number) > 1e6), F.round(number, dp)).otherwise(quick)


def grid_cells(latitude: Column, longitude: Column, dp: int = 2) -> tuple[Column, Column]:
    """The two sides of the grid key as numbers, both NULL when either coordinate is missing.

    Grouping on two doubles is cheaper than on text, and gives the same groups.
    """
    known = latitude.isNotNull() & longitude.isNotNull() & ~F.isnan(latitude) & ~F.isnan(longitude)
    return F.when(known, round_half_up(latitude, dp)), F.when(known, round_half_up(longitude, dp))


def render_key(latitude_cell: Column, longitude_cell: Column) -> Column:
    """``lat,lon`` with the shortest digits (``40.7,-74.0``). NULL if either side is NULL."""
    return F.concat(latitude_cell.cast("string"), F.lit(","), longitude_cell.cast("string"))


def grid_key(latitude: Column, longitude: Column, dp: int = 2) -> Column:
    return render_key(round_half_up(latitude, dp), round_half_up(longitude, dp))


def zone_key(zone: Column) -> Column:
    """Key for files that carry zone numbers in place of coordinates."""
    return F.concat(F.lit("zone:"), zone.cast("string"))


def valid_gps(latitude: Column, longitude: Column) -> Column:
    """False for missing positions and for 0,0, which a receiver without a fix reports."""
    return latitude.isNotNull() & longitude.isNotNull() & ~((latitude == 0) & (longitude == 0))
