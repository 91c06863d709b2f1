"""Settings of the feed and of the aggregate job, read once from the environment."""

from __future__ import annotations

import hashlib
import math
import os
import re
from collections.abc import Mapping
from dataclasses import dataclass, field, fields

# Length of each duration unit in microseconds.
UNIT_MICROS = {
    "microsecond": 1,
    "millisecond": 1_000,
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
    "week": 604_800_000_000,
}

LOCATION_KEYS = ("grid", "zone", "grid_or_zone")

_PART = re.compile(r"(\d+)\s*([a-z]+?)s?(?=\s|\d|$)")


def duration_micros(text: str) -> int:
    """Length of a duration such as ``5 minutes`` or ``1 hour 30 minutes``.

    Months and years have no fixed length, so event-time windows cannot use them.
    """
    clean = text.strip().lower().removeprefix("interval ").strip()
    parts = _PART.findall(clean)
    if not parts or _PART.sub("", clean).strip():
        raise ValueError(f"not a duration: {text!r}")
    unknown = [unit for _, unit in parts if unit not in UNIT_MICROS]
    if unknown:
        raise ValueError(f"unit without a fixed length in {text!r}: {unknown[0]}")
    return sum(int(amount) * UNIT_MICROS[unit] for amount, unit in parts)


@dataclass(frozen=True)
class WindowSpec:
    """Window length and step. ``slide`` equal to ``size`` (or left out) gives tumbling windows."""

    size: str = "5 minutes"
    slide: str | None = "1 minute"

    def __post_init__(self) -> None:
        if self.size_micros <= 0 or self.slide_micros <= 0:
            raise ValueError("window size and slide must be positive")
        if self.slide_micros > self.size_micros:
            raise ValueError(f"slide {self.slide!r} is longer than the window {self.size!r}")

    @property
    def size_micros(self) -> int:
        return duration_micros(self.size)

    @property
    def slide_micros(self) -> int:
        return duration_micros(self.slide or self.size)

    @property
    def pane_micros(self) -> int:
        """Longest step that cuts every window into whole panes."""
        return math.gcd(self.size_micros, self.slide_micros)

    @property
    def panes_per_window(self) -> int:
        return self.size_micros // self.pane_micros


def _env(name: str, default: str | None = None):
    return field(default=default, metadata={"env": name})


@dataclass(frozen=True)
class FlowConfig:
    """All knobs. Names of the variables and their defaults are fixed values that users rely on."""

    kafka_servers: str = _env("KAFKA_BOOTSTRAP_SERVERS", "kafka:29092")
    kafka_topic: str = _env("KAFKA_TOPIC", "taxi-events")
    jdbc_url: str = _env("POSTGRES_URL", "jdbc:postgresql://postgres:5432/taxi_pipeline")
    jdbc_user: str | None = _env("POSTGRES_USER", "pipeline")
    jdbc_password: str | None = _env("POSTGRES_PASSWORD")
    checkpoint_dir: str | None = _env("CHECKPOINT_DIR")
    window_duration: str = _env("WINDOW_DURATION", "5 minutes")
    slide_duration: str = _env("SLIDE_DURATION", "1 minute")
    watermark_delay: str = _env("WATERMARK_DELAY", "10 minutes")
    trigger_interval: str = _env("TRIGGER_INTERVAL", "30 seconds")
    data_path: str = _env("DATA_PATH", "/data/taxi_data.csv")
    chunk_size: int = _env("CHUNK_SIZE", "10000")
    jdbc_max_connections: int = _env("JDBC_MAX_CONNECTIONS", "8")
    max_offsets_per_trigger: int | None = _env("MAX_OFFSETS_PER_TRIGGER")
    time_formats: str = _env("TIME_FORMATS", "")
    location_key: str = _env("LOCATION_KEY", "grid")
    on_overflow: str = _env("ON_OVERFLOW", "null")

    # Not environment settings.
    jdbc_driver: str = "org.postgresql.Driver"
    aggregate_table: str = "taxi_aggregates"
    raw_table: str = "taxi_events_raw"
    jdbc_batch_rows: int = 1000
    drop_null_location_early: bool = False
    state_store: str = "rocksdb"

    def __post_init__(self) -> None:
        for name in ("chunk_size", "jdbc_max_connections", "max_offsets_per_trigger"):
            if getattr(self, name) is not None:
                object.__setattr__(self, name, int(getattr(self, name)))
        if self.chunk_size <= 0:
            raise ValueError("CHUNK_SIZE must be positive")
        if self.state_store not in ("rocksdb", "memory"):
            raise ValueError("state_store is 'rocksdb' or 'memory'")
        if self.location_key not in LOCATION_KEYS:
            raise ValueError(f"LOCATION_KEY is one of: {', '.join(LOCATION_KEYS)}")
        if self.on_overflow not in ("error", "null"):
            raise ValueError("ON_OVERFLOW is 'error' or 'null'")
        self.window  # refuse a bad window before any job starts
        for text in (self.watermark_delay, self.trigger_interval):
            duration_micros(text)

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None, **overrides) -> "FlowConfig":
        env = os.environ if env is None else env
        found = {
            f.name: env[f.metadata["env"]]
            for f in fields(cls)
            if f.metadata.get("env") and env.get(f.metadata["env"])
        }
        return cls(**{**found, **overrides})

    @property
    def window(self) -> WindowSpec:
        return WindowSpec(self.window_duration, self.slide_duration)

    @property
    def time_patterns(self) -> tuple[str, ...]:
        """Forms of the pickup time in trip files, tried after the ISO-like ones; ``TIME_FORMATS`` has a ``|`` between them."""
        return tuple(form for form in self.time_formats.split("|") if form)

    def checkpoint_name(self, label: str = "trip-aggregates", source: str = "", sink: str = "") -> str:
        """Folder name of one run: different for each window shape, watermark delay, source and sink.

        Spark accepts an old checkpoint after any of these was changed. It would then mix windows of both lengths, or
        the events of two topics, in one state, or skip what another sink has read. So the name carries a digest of them.
        """
        shape = (self.window.size_micros, self.window.slide_micros, self.drop_null_location_early)
        run = (*shape, duration_micros(self.watermark_delay), source, sink)
        if self.location_key != "grid":
            run = (*run, self.location_key)
        return f"{label}-{hashlib.sha256(repr(run).encode()).hexdigest()[:12]}"
