"""Declared schemas: messages on the wire, stored tables, models."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


_S, _D, _I, _TS = T.StringType(), T.DoubleType(), T.IntegerType(), T.TimestampType()
_L = T.LongType()

SERVER_VALUES = (
    "cpu_usage_percent",
    "memory_usage_percent",
    "memory_available_gb",
    "disk_usage_percent",
    "disk_read_mbps",
    "disk_write_mbps",
    "network_rx_mbps",
    "network_tx_mbps",
    "cpu_temperature_celsius",
    "power_consumption_watts",
)
APPLICATION_RATES = (
    "request_rate_per_sec",
    "response_time_p50_ms",
    "response_time_p95_ms",
    "response_time_p99_ms",
    "error_rate_percent",
)
APPLICATION_COUNTS = ("error_count", "active_connections", "queue_depth")

SERVER_EVENT = _struct(
    ("type", _S),
    ("timestamp", _S),
    ("server_id", _S),
    ("rack_id", _S),
    ("datacenter_zone", _S),
    *((name, _D) for name in SERVER_VALUES),
)
APPLICATION_EVENT = _struct(
    ("type", _S),
    ("timestamp", _S),
    ("service_name", _S),
    ("server_id", _S),
    *((name, _D) for name in APPLICATION_RATES),
    *((name, _I) for name in APPLICATION_COUNTS),
    ("endpoint", _S),
)
# Both record kinds share one topic, so one parse covers the union of their fields.
MESSAGE = T.StructType(
    SERVER_EVENT.fields
    + [f for f in APPLICATION_EVENT.fields if f.name not in SERVER_EVENT.fieldNames()]
    + [T.StructField("_corrupt_record", _S)]
)

SERVER_METRICS = _struct(
    ("timestamp", _TS),
    ("server_id", _S),
    *((name, _D) for name in SERVER_VALUES),
    ("fan_speed_rpm", _I),
    ("rack_id", _S),
    ("datacenter_zone", _S),
    ("created_at", _TS),
)
APPLICATION_METRICS = _struct(
    ("timestamp", _TS),
    ("service_name", _S),
    *((name, _D) for name in APPLICATION_RATES),
    *((name, _I) for name in APPLICATION_COUNTS),
    ("server_id", _S),
    ("endpoint", _S),
    ("created_at", _TS),
)
PREDICTIONS = _struct(
    ("timestamp", _TS),
    ("server_id", _S),
    ("predicted_power_watts", _D),
    ("actual_power_watts", _D),
    ("prediction_error_percent", _D),
    ("model_version", _S),
    ("confidence_score", _D),
    ("created_at", _TS),
)
ANOMALY_DETAILS = _struct(
    ("metric_name", _S),
    ("actual_value", _D),
    ("expected_value", _D),
    ("z_score", _D),
    ("residual", _D),
    ("trend", _D),
    ("seasonal", _D),
    ("threshold", _D),
)
ANOMALIES = _struct(
    ("timestamp", _TS),
    ("entity_type", _S),
    ("entity_id", _S),
    ("anomaly_type", _S),
    ("severity", _S),
    ("anomaly_score", _D),
    ("details", ANOMALY_DETAILS),
    ("resolved", T.BooleanType()),
    ("resolved_at", _TS),
    ("created_at", _TS),
)
DEAD_LETTER = _struct(("raw", _S), ("reason", _S))


_MODEL_BODY = (
    ("seasonal_pattern", T.ArrayType(_D)),
    ("trend_last_value", _D),
    ("trend_slope", _D),
    ("trend_last_timestamp", _TS),
    ("residual_mean", _D),
    ("residual_std", _D),
    ("interval_seconds", _I),
    ("seasonal_period", _I),
    ("trend_period", _I),
    ("n_training_points", _I),
    ("training_start", _TS),
    ("training_end", _TS),
)
MODEL_FIELDS = tuple(name for name, _ in _MODEL_BODY)
MODELS = _struct(
    ("method_name", _S),
    ("entity_id", _S),
    ("metric_name", _S),
    ("trained_at", _TS),
    ("saved_at", _TS),
    *_MODEL_BODY,
)
STREAM_COUNTS = _struct(("stream", _S), ("counter", _S), ("value", T.LongType()))
MODEL_PINS = _struct(("stream_batch", _S), ("as_of", _TS))


def _states(key: str, values: tuple[str, ...]) -> T.StructType:
    """Mergeable figures of one key and bucket: rows, and per column the sum and number of its
    values and the greatest of them."""
    figures = [(f"{v}_{part}", kind) for v in values for part, kind in (("sum", _D), ("n", _L), ("max", _D))]
    return _struct(("timestamp", _TS), (key, _S), ("rows", _L), *figures)


SERVER_STATES = _states("server_id", SERVER_VALUES)
APPLICATION_STATES = _states("service_name", APPLICATION_RATES + APPLICATION_COUNTS)


def fit_outcome(timestamp: T.DataType) -> T.StructType:
    """A fit's row: keys, verdict, model. ``timestamp`` follows the history's type."""
    return _struct(
        ("entity_id", _S),
        ("metric_name", _S),
        ("status", _S),
        ("reason", _S),
        ("n_rows", _I),
        *((name, timestamp if kind is _TS else kind) for name, kind in _MODEL_BODY),
    )


def decomposition(timestamp: T.DataType) -> T.StructType:
    return _struct(
        ("entity_id", _S),
        ("metric_name", _S),
        ("timestamp", timestamp),
        *((name, _D) for name in ("value", "trend", "seasonal", "resid")),
    )
