"""Windowed analytics over trip events, on tables and on streams, as Spark DataFrame transforms."""
