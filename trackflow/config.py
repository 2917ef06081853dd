"""Validated settings. Every default below is a fixed value of the pipeline's contract."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, fields

# Fixed values.
FLEET_SIZE = 10357  # taxis of the published data set
REPLAY_MODES = ("actual", "simulated")
REPLAY_SPEEDS = (1.0, 1.5, 2.0, 2.5, 3.0)
ACTIVE, INACTIVE, END = "active", "inactive", "end"
GEOFENCE_ALERT = "GEOFENCE_VIOLATION"
SPEED_ALERT = "SPEED_VIOLATION"

# Setting name -> environment variable.
ENV_NAMES = {
    "emit_interval_s": "TRIP_EMIT_INTERVAL_IN_SECONDS",
    "inactivity_timeout_s": "TRIP_INACTIVITY_TIMEOUT_IN_SECONDS",
    "centre_lat": "FORBIDDEN_CITY_LAT",
    "centre_lon": "FORBIDDEN_CITY_LON",
    "warning_km": "GEOFENCE_WARNING_KM",
    "range_km": "GEOFENCE_RANGE_KM",
    "speed_limit_kmph": "SPEED_THRESHOLD_KMPH",
    "file_limit": "DATASET_SIZE_LIMIT",
    "replay_mode": "DATA_REPLAY_MODE",
    "replay_speed": "DATA_REPLAY_SPEED",
    "flush_rows": "KAFKA_REDIS_CONSUMER_BATCH_SIZE_LIMIT",
    "flush_s": "KAFKA_REDIS_CONSUMER_BATCH_INTERVAL_IN_SECONDS",
    "source_topics": "KAFKA_SOURCE_TOPICS",
    "processed_topic": "KAFKA_TAXI_PROCESSED_DATA_SINK_TOPIC",
    "alerts_topic": "KAFKA_TAXI_VIOLATION_ALERTS_SINK_TOPIC",
    "fleet_topic": "KAFKA_TAXI_FLEET_METRICS_SINK_TOPIC",
}


@dataclass(frozen=True)
class Settings:
    emit_interval_s: int = 5
    inactivity_timeout_s: int = 180
    centre_lat: float = 39.9163
    centre_lon: float = 116.3972
    warning_km: float = 10.0
    range_km: float = 15.0
    speed_limit_kmph: int = 50
    max_valid_kmph: float = 300.0
    stationary_kmph: float = 0.1
    in_transit_kmph: float = 0.1
    rebaseline_s: int = 5
    file_limit: int | None = None  # only so many files are cleaned; none: all
    fleet_size: int = FLEET_SIZE
    replay_mode: str = "actual"
    replay_speed: float = 1.0
    trend_window_s: int = 300
    refresh_interval_s: int = 1
    bench_window_ms: int = 60_000
    bench_max_rows: int | None = None  # only so many messages are analysed; none: all
    # A key with more rows than this is cut into ordered chunks (operators/ordered.py).
    max_group_rows: int = 2_000_000
    # Forget a silent taxi's streaming state after this long; 0 keeps it until the trip ends.
    state_ttl_s: int = 0
    # A micro-batch closes when so many messages wait, or when the oldest has waited so long.
    flush_rows: int = 500
    flush_s: int = 1
    # Partitions of all source topics together; of more than one, messages are merged by sending time.
    source_partitions: int = 1
    source_topics: str = ""
    processed_topic: str = ""
    alerts_topic: str = ""
    fleet_topic: str = ""

    def __post_init__(self) -> None:
        for name in ("file_limit", "bench_max_rows"):
            if getattr(self, name) is not None and getattr(self, name) < 1:
                raise ValueError(f"{name} must be positive")
        if self.replay_mode not in REPLAY_MODES:
            raise ValueError(f"replay_mode must be one of {REPLAY_MODES}")
        if self.replay_speed not in REPLAY_SPEEDS:
            raise ValueError(f"replay_speed must be one of {REPLAY_SPEEDS}")
        if not 1 <= self.refresh_interval_s <= 10:
            raise ValueError("refresh_interval_s must be between 1 and 10")
        if self.emit_interval_s < 1 or self.rebaseline_s < 1:
            raise ValueError("intervals must be at least one second")
        if self.source_partitions < 1 or self.flush_rows < 1 or self.flush_s < 0:
            raise ValueError("source_partitions and flush_rows must be positive")
        if self.max_group_rows < 1:
            raise ValueError("max_group_rows must be positive")

    @classmethod
    def from_env(cls, env: Mapping[str, str], **overrides) -> "Settings":
        kinds = {f.name: int if f.default is None else type(f.default) for f in fields(cls)}
        values = {
            name: kinds[name](env[var].lower() if name == "replay_mode" else env[var])
            for name, var in ENV_NAMES.items()
            if var in env
        }
        return cls(**{**values, **overrides})

    def require_topics(self) -> "Settings":
        names = ("source_topics", "processed_topic", "alerts_topic", "fleet_topic")
        missing = [n for n in names if not getattr(self, n).strip()]
        if missing:
            raise ValueError(f"missing required topics: {', '.join(missing)}")
        return self

    def source_idleness_s(self) -> int:
        """Idle-source allowance derived from the inactivity timeout."""
        if self.inactivity_timeout_s > 30:
            return self.inactivity_timeout_s - 10
        return self.inactivity_timeout_s - 5 if self.inactivity_timeout_s >= 10 else 0


DEFAULTS = Settings()
