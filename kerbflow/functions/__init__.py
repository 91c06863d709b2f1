"""Column functions: text and time, location keys, exact measures."""

from kerbflow.functions.location import grid_cells, grid_key, render_key, round_half_up, valid_gps, zone_key
from kerbflow.functions.measures import ExactMeasure
from kerbflow.functions.values import iso_text, missing_text_to_null, missing_to_null, parse_time, whole_number

__all__ = [
    "ExactMeasure",
    "grid_cells",
    "grid_key",
    "iso_text",
    "missing_text_to_null",
    "missing_to_null",
    "parse_time",
    "render_key",
    "round_half_up",
    "valid_gps",
    "whole_number",
    "zone_key",
]
