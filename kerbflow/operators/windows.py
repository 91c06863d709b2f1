"""Trip count, fares and distance per sliding window and pickup location."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbflow.config import WindowSpec
from kerbflow.functions import ExactMeasure, grid_cells, render_key
from kerbflow.operators.barrier import computed_once

FARE = ExactMeasure("fare_amount")
DISTANCE = ExactMeasure("trip_distance")
MEASURES = (FARE, DISTANCE)
#: What a group is made of until it is finished.
PARTIALS = ["trip_count", *[part for m in MEASURES for part in m.parts]]

GRID = "grid"


def _prepared(events: DataFrame, by: str, keep: tuple[str, ...] = ()) -> tuple[DataFrame, list[str], Column]:
    """Columns the aggregate needs, the names to group on, and the location they stand for."""
    if by == GRID:
        lat, lon = grid_cells(F.col("pickup_latitude"), F.col("pickup_longitude"))
        keys, location = [lat.alias("lat_cell"), lon.alias("lon_cell")], render_key(F.col("lat_cell"), F.col("lon_cell"))
        names = ["lat_cell", "lon_cell"]
    else:
        keys, location, names = [F.col(by)], F.col(by), [by]
    return events.select("event_time", *keys, *keep, *[c for m in MEASURES for c in m.inputs()]), names, location


def _partials() -> list[Column]:
    return [F.count(F.lit(1)).alias("trip_count"), *[c for m in MEASURES for c in m.partial()]]


def _merged() -> list[Column]:
    return [F.sum("trip_count").alias("trip_count"), *[c for m in MEASURES for c in m.merge()]]


def window_of(time: str, size: int, slide: int) -> Column:
    """``[start, end)`` windows of ``size`` microseconds, aligned to 1970-01-01 00:00 UTC."""
    return F.window(time, f"{size} microseconds", f"{slide} microseconds")


def _by_start(rows: DataFrame, time: str, size: int, slide: int, names: list[str], aggregates: list[Column]) -> DataFrame:
    """Aggregates per window start. A plain timestamp hashes faster than a window struct."""
    started = rows.withColumn("window_start", window_of(time, size, slide).getField("start"))
    return started.groupBy("window_start", *names).agg(*aggregates)


def windowed_partials(events: DataFrame, spec: WindowSpec, part: str, *, by: str = GRID) -> DataFrame:
    """The merged parts of each window, location and ``part`` of a stream, for ``running_versions``.

    In update mode a micro-batch may hold any number of whole parts: each part's share of a window is a group of its own.
    """
    rows, names, location = _prepared(events.withColumn("__part", F.col(part)), by, ("__part",))
    grouped = rows.groupBy(window_of("event_time", spec.size_micros, spec.slide_micros), *names, "__part").agg(*_partials())
    times = [F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end")]
    return grouped.select(*times, location.alias("pickup_location"), F.col("__part").alias(part), *PARTIALS)


def running_versions(partials: DataFrame, part: str) -> DataFrame:
    """One row per window, location and part that it has rows in: the values over this part and those before it."""
    so_far = Window.partitionBy("window_start", "window_end", "pickup_location").orderBy(part)
    so_far = so_far.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = partials.select(
        "window_start", "window_end", "pickup_location", part, *[F.sum(name).over(so_far).alias(name) for name in PARTIALS]
    )
    return _finished(totals, F.col("pickup_location"), (part,))


def windowed_aggregate(
    events: DataFrame, spec: WindowSpec = WindowSpec(), *, by: str = GRID, panes: bool | None = None
) -> DataFrame:
    """One row per window and location; a missing location is a group of its own.

    ``by="grid"`` takes the location from the pickup coordinates and groups on the two cell
    numbers; any other value names the column to group on.

    With ``panes`` (the default on tables) each event is first added to its one pane, and only
    the panes, far fewer than the events, are copied into the windows that hold them. Both forms combine on the map
    side before each shuffle, so one very frequent location costs no more than another.

    Streams take the direct form unless ``panes=True``, since update mode allows a single stateful step. In append mode the
    steps can be chained: the state then holds one row per open pane instead of one per window that the pane is in,
    and a closed pane is added to its windows, which leave as soon as the watermark passes their end.
    """
    if panes is None:
        panes = not events.isStreaming and spec.panes_per_window > 1
    if not events.isStreaming:
        events = events.withColumn("event_time", F.col("event_time").cast("timestamp"))
    size, slide, pane = spec.size_micros, spec.slide_micros, spec.pane_micros
    rows, names, location = _prepared(events, by)
    # Plain arithmetic: adding an interval goes through the calendar for every row.
    window_end = F.timestamp_micros(F.unix_micros("window_start") + size)
    if events.isStreaming:
        # The window itself must be the key: it carries the watermark that closes the group.
        if panes and spec.panes_per_window > 1:
            small = rows.groupBy(window_of("event_time", pane, pane), *names).agg(*_partials())
            # Time of a closed pane: its last microsecond, under the watermark of the events.
            small = small.withColumn("pane_time", F.window_time("window")).drop("window")
            grouped = small.groupBy(window_of("pane_time", size, slide), *names).agg(*_merged())
        else:
            grouped = rows.groupBy(window_of("event_time", size, slide), *names).agg(*_partials())
        grouped = grouped.withColumns({"window_start": F.col("window.start"), "window_end": F.col("window.end")})
    elif panes:
        small = _by_start(rows, "event_time", pane, pane, names, _partials())
        small = small.withColumnRenamed("window_start", "pane_start")
        grouped = _by_start(small, "pane_start", size, slide, names, _merged()).withColumn("window_end", window_end)
    else:
        grouped = _by_start(rows, "event_time", size, slide, names, _partials()).withColumn("window_end", window_end)

    return _finished(grouped, location)


def _finished(grouped: DataFrame, location: Column, keep: tuple[str, ...] = ()) -> DataFrame:
    """Result rows from the merged parts of each group."""
    carried = [c for m in MEASURES for c in m.carried()]
    finished = grouped.select("window_start", "window_end", location.alias("pickup_location"), "trip_count", *carried, *keep)
    return finished.select(
        "window_start",
        "window_end",
        "pickup_location",
        "trip_count",
        FARE.mean(2).alias("avg_fare"),
        FARE.total(2).alias("total_fare"),
        DISTANCE.mean(4).alias("avg_trip_distance"),
        *keep,
    )


def results_of_state(state: DataFrame) -> DataFrame:
    """Result rows from stored groups of a stream: ``key`` as it is grouped on, ``value`` with the parts by position."""
    names = PARTIALS
    stored = [spec.dataType for spec in state.schema["value"].dataType]
    if len(stored) != len(names):
        raise ValueError(f"not the state of a windowed aggregate: {len(stored)} values a group")
    parts = T.StructType([T.StructField(name, kind) for name, kind in zip(names, stored)])
    keys = [spec.name for spec in state.schema["key"].dataType if spec.name != "window"]
    location = render_key(F.col("lat_cell"), F.col("lon_cell")) if keys == ["lat_cell", "lon_cell"] else F.col(keys[0])
    groups = state.select("key.*", F.col("value").cast(parts).alias("value"))
    # A part that no value had is stored as NULL until the group is finished.
    missing = {m.picos: F.coalesce(m.picos, F.lit(0)) for m in MEASURES}
    times = [F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end")]
    return _finished(groups.select(*times, *keys, "value.*").withColumns(missing), location)


def drop_null_location(result: DataFrame) -> DataFrame:
    """Results with a known location.

    On a stream, call this on the micro-batch and not in the query: there the optimizer moves the
    test below the watermark, which then no longer sees the events without a location. On a table it is
    tested on the finished rows; ``only_located`` on the events is cheaper where nothing else needs them.
    """
    return computed_once(result).filter(F.col("pickup_location").isNotNull())


def only_located(events: DataFrame) -> DataFrame:
    """Events whose pickup position is known; the NULL tests reach a columnar scan."""
    sides = [F.col("pickup_latitude"), F.col("pickup_longitude")]
    return events.filter(
        sides[0].isNotNull() & sides[1].isNotNull() & ~F.isnan(sides[0]) & ~F.isnan(sides[1])
    )

