"""Options of the gate: how records become points, what is checked, what is written.

Everything here is a small driver-side description; no option holds data.
"""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class TimeSpec:
    """Where the time of a record comes from.

    ``field`` names the column or JSON path (None: the run's ``as_of``).  With ``format`` the value is
    date-time text, otherwise a number in ``unit`` (s, ms, ns or tick at ``tick_hz``).
    """

    field: str | None = None
    unit: str = "ms"
    tick_hz: float = 64.0
    format: str | None = None
    date_override: str | None = None

    def __post_init__(self):
        if self.unit not in ("s", "ms", "ns", "tick"):
            raise ValueError(f"unsupported timestamp unit: {self.unit}")
        if self.format == "time_utc" and not self.date_override:
            raise ValueError("time_utc needs date_override (YYYY-MM-DD)")


@dataclass(frozen=True)
class PointMapping:
    """Named source fields -> metric positions (``field_map``), plus the time."""

    field_map: dict[str, int]
    field_count: int
    time: TimeSpec = field(default_factory=TimeSpec)

    def __post_init__(self):
        if self.field_count <= 0:
            raise ValueError("field_count must be positive")
        for name, index in self.field_map.items():
            if not 0 <= index < self.field_count:
                raise ValueError(f"field_map index {index} of {name} exceeds field_count {self.field_count}")

    @classmethod
    def price_volume(cls, price_field: str, volume_field: str, time: TimeSpec | None = None) -> "PointMapping":
        """The old two-field form: price is metric 0, volume is metric 1."""
        return cls({price_field: 0, volume_field: 1}, 2, time or TimeSpec())

    @classmethod
    def from_config(cls, cfg: dict) -> "PointMapping":
        """Accept both the N-field keys and the old two-field keys; N-field keys win when complete."""
        time = TimeSpec(
            field=cfg.get("timestamp_field"),
            unit=cfg.get("timestamp_unit") or "ms",
            tick_hz=cfg.get("timestamp_tick_hz") or 64.0,
            format=cfg.get("timestamp_format"),
            date_override=cfg.get("timestamp_date_override"),
        )
        if cfg.get("field_count") is not None and cfg.get("field_map") is not None:
            return cls(dict(cfg["field_map"]), int(cfg["field_count"]), time)
        if cfg.get("price_field") and cfg.get("volume_field"):
            return cls.price_volume(cfg["price_field"], cfg["volume_field"], time)
        raise ValueError("need field_count and field_map, or price_field and volume_field")

    def by_index(self) -> list[tuple[str, int]]:
        """Mapped fields, lowest metric first, so that the first bad one is reported."""
        return sorted(self.field_map.items(), key=lambda kv: (kv[1], kv[0]))


@dataclass(frozen=True)
class PathMapping:
    """Ordered JSON paths -> metrics, plus an optional time path."""

    field_paths: tuple[str, ...]
    timestamp_path: str | None = None

    @classmethod
    def price_volume(cls, price_path: str, volume_path: str, timestamp_path: str | None = None) -> "PathMapping":
        return cls((price_path, volume_path), timestamp_path)

    @classmethod
    def from_config(cls, cfg: dict) -> "PathMapping":
        if cfg.get("field_paths") is not None:
            return cls(tuple(cfg["field_paths"]), cfg.get("timestamp_path"))
        return cls.price_volume(cfg["price_path"], cfg["volume_path"], cfg.get("timestamp_path"))


@dataclass(frozen=True)
class Bound:
    min: float | None = None
    max: float | None = None


@dataclass(frozen=True)
class GateOptions:
    """The chain finite -> bounds -> future -> stale -> spike."""

    future_tolerance_ms: int
    stale_tolerance_ms: int
    reject_nan_inf: bool = True
    replay_mode: bool = False
    drop_on_parse_error: bool = True
    fail_fast: bool = True
    price_min: float | None = None
    price_max: float | None = None
    volume_min: float | None = None
    volume_max: float | None = None
    bounds: dict[int, Bound] = field(default_factory=dict)
    spike_max_delta: dict[int, float] = field(default_factory=dict)
    ema_alpha: float | None = None
    burst_ema_alpha: float | None = None

    def __post_init__(self):
        # A tolerance beyond BIGINT accepts everything a BIGINT can say.
        for name in ("future_tolerance_ms", "stale_tolerance_ms"):
            object.__setattr__(self, name, min(getattr(self, name), 2**63 - 1))

    def metric_bounds(self, index: int) -> tuple[float | None, float | None]:
        """(min, max) of a metric; None is unbounded.  Metric 1 is never negative unless told otherwise."""
        if index in self.bounds:
            return self.bounds[index].min, self.bounds[index].max
        if index == 0:
            return self.price_min, self.price_max
        if index == 1:
            return (0.0 if self.volume_min is None else self.volume_min), self.volume_max
        return None, None

    def bounded_metrics(self) -> list[int]:
        """Ascending metric positions that have at least one bound."""
        return [i for i in sorted({0, 1, *self.bounds}) if self.metric_bounds(i) != (None, None)]

    @property
    def alpha(self) -> float:
        """Smoothing factor: the spike section's when that section exists, else the older setting."""
        chosen = self.ema_alpha if self.spike_max_delta or self.ema_alpha is not None else self.burst_ema_alpha
        return 0.05 if chosen is None else chosen

    @property
    def spikes_active(self) -> bool:
        """Whether the stateful check can reject anything."""
        return bool(self.spike_max_delta) and self.fail_fast and not self.replay_mode


@dataclass(frozen=True)
class LimitOptions:
    max_records: int | None = None
    max_duration_sec: int | None = None
    max_pages: int | None = None


@dataclass(frozen=True)
class OutputOptions:
    """How accepted and rejected records are written."""

    format: str = "parquet"
    headers: tuple[str, ...] | None = None
    channel_scoped: bool = False
    prefix_by_feed: dict[str, str] = field(default_factory=dict)
    path_by_feed: dict[str, str] = field(default_factory=dict)
    daily: bool = False
    truncate_raw: bool = False
    max_raw_bytes: int = 512
    hash_raw: bool = False

    def __post_init__(self):
        if self.format not in ("csv", "jsonl", "canonical_jsonl", "parquet"):
            raise ValueError(f"unsupported output format: {self.format}")

    @property
    def routes(self) -> dict[str, str]:
        """feed -> route; the prefix form wins when it is not empty."""
        return dict(self.prefix_by_feed or self.path_by_feed)

    def header_names(self, field_count: int) -> list[str]:
        if self.headers is not None:
            return ["timestamp_ns", *self.headers]
        if field_count == 2:
            return ["timestamp_ns", "price", "volume"]
        return ["timestamp_ns", *(f"metric_{i}" for i in range(field_count))]
