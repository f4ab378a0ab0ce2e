"""Parameters of ingest, training and detection."""

from __future__ import annotations

from dataclasses import dataclass, field

DEFAULT_METRICS = ("cpu_usage_percent", "memory_usage_percent", "cpu_temperature_celsius")


@dataclass(frozen=True)
class TopicConfig:
    """One consumer of the metrics topic."""

    bootstrap_servers: str = "localhost:9092"
    topic: str = "datacenter-metrics"
    group_id: str = "storage-consumer-group"
    starting_offsets: str = "earliest"
    # Bounds one micro-batch. A broker-side poll size of 500 would cap a 5 s trigger at
    # 100 events/s, so the bound is set for throughput; lower it to bound memory.
    max_records_per_trigger: int | None = 1_000_000
    # Splits long offset ranges, so that a topic partition holding most of the messages is
    # read by several tasks. None: one task per topic partition.
    min_partitions: int | None = None

    def __post_init__(self):
        if self.starting_offsets not in ("earliest", "latest"):
            raise ValueError("starting_offsets must be 'earliest' or 'latest'")


@dataclass(frozen=True)
class StlConfig:
    """Seasonal-trend z-score method."""

    seasonal_period: int = 288  # one day of 5-minute buckets
    trend_period: int = 577  # odd, longer than the seasonal period
    z_score_threshold: float = 3.0
    min_points: int = 2016
    # Index convention of the stored cycle: "series_order" keeps the last cycle as it
    # stands; "time_of_day" rotates it so that element 0 belongs to midnight.
    phase: str = "series_order"
    inner_passes: int = 5

    def __post_init__(self):
        if self.phase not in ("series_order", "time_of_day"):
            raise ValueError("phase must be 'series_order' or 'time_of_day'")
        if self.seasonal_period < 2:
            raise ValueError("seasonal_period must be at least 2")
        if self.trend_period % 2 == 0 or self.trend_period <= self.seasonal_period:
            raise ValueError("trend_period must be odd and longer than seasonal_period")


@dataclass(frozen=True)
class DetectionConfig:
    method_name: str = "stl_zscore"
    method_config: dict = field(default_factory=dict)
    history_days: int = 14
    aggregation_interval: str = "5min"
    metrics: tuple[str, ...] = DEFAULT_METRICS
    # Series with fewer buckets are skipped before the method sees them; the method itself
    # fails below its own ``min_points``. None means "as the method's min_points if that is
    # given explicitly, else 100".
    skip_below: int | None = None
    model_ttl_seconds: int | None = 900
    topic: TopicConfig = field(
        default_factory=lambda: TopicConfig(
            group_id="anomaly-detection-consumer-group", starting_offsets="latest"
        )
    )
    trigger_seconds: float = 10.0

    @property
    def skip_threshold(self) -> int:
        if self.skip_below is not None:
            return self.skip_below
        return int(self.method_config.get("min_points", 100))
