"""The driver's ``events`` table read as telemetry: metric tables, messages, models."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.clock import bucket

# Fixed values: (trend level, residual spread) of the baseline models.
BASELINES = {
    "cpu_usage_percent": (50.0, 15.0),
    "memory_usage_percent": (35.0, 12.0),
    "cpu_temperature_celsius": (35.0, 4.0),
}

EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)


def read_events(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(EVENTS).parquet(f"{folder}/events.parquet")


def newest(events: DataFrame) -> datetime:
    """Time of the newest event."""
    return events.agg(F.max("ts")).first()[0]


SERVER_ID = "concat('srv-', lpad(CAST(user_id % 10 + 1 AS STRING), 3, '0'))"


def server_metrics(events: DataFrame, *extra: str) -> DataFrame:
    return events.selectExpr(
        "event_id",
        "ts AS timestamp",
        f"{SERVER_ID} AS server_id",
        "if(user_id % 7 <> 0, concat('R0', CAST(user_id % 5 + 1 AS STRING)), NULL) AS rack_id",
        "concat('zone-', CAST(user_id % 2 + 1 AS STRING)) AS datacenter_zone",
        "least(value, 100D) AS cpu_usage_percent",
        "least(value * 0.5D + 10, 100D) AS memory_usage_percent",
        "value * 0.1D + 30 AS cpu_temperature_celsius",
        "value + 200 AS power_consumption_watts",
        "value * 2 AS network_rx_mbps",
        "value * 3 AS network_tx_mbps",
        "value * 0.4D AS disk_read_mbps",
        "value * 0.3D AS disk_write_mbps",
        *extra,
    )


def application_metrics(events: DataFrame) -> DataFrame:
    return events.selectExpr(
        "event_id",
        "ts AS timestamp",
        "event_type AS service_name",
        "value * 10 AS request_rate_per_sec",
        "value * 2 AS response_time_p95_ms",
        "value * 4 AS response_time_p99_ms",
        "least(value * 0.1D, 100D) AS error_rate_percent",
        "try_cast(get_json_object(props, '$.k') AS INT) AS error_count",
    )


def messages(events: DataFrame) -> DataFrame:
    """Events as JSON messages of both kinds, with unknown kinds, missing kinds, readings out of
    range and texts with a stray first character among them."""
    return events.selectExpr(
        f"""to_json(named_struct(
              'type', CASE event_type WHEN 'error' THEN NULL WHEN 'signup' THEN 'unknown_type'
                        WHEN 'view' THEN 'application_metric' ELSE 'server_metric' END,
              'timestamp', concat(date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), 'Z'),
              'server_id', {SERVER_ID},
              'service_name', event_type,
              'cpu_usage_percent', value,
              'memory_usage_percent', least(value * 0.5D + 10, 100D),
              'cpu_temperature_celsius', value * 0.1D + 30,
              'response_time_p95_ms', value * 2,
              'error_rate_percent', value * 0.1D)) AS text""",
        "get_json_object(props, '$.k') = '0' AS broken",
    ).selectExpr("if(broken, concat('}', text), text) AS value")


def baseline_models(metrics: DataFrame, untrained: tuple[str, ...] = ()) -> DataFrame:
    """One fixed-shape model per metric and server of the table, but for the ``untrained``."""
    shapes = ", ".join(
        f"named_struct('metric_name', '{m}', 'level', {level}D, 'spread', {spread}D)"
        for m, (level, spread) in BASELINES.items()
    )
    trained = "timestamp_ntz'2024-01-15 00:00:00'"
    return (
        metrics.selectExpr("server_id AS entity_id")
        .distinct()
        .filter(~F.col("entity_id").isin(*untrained))
        .selectExpr("entity_id", f"inline(array({shapes}))")
        .selectExpr(
            "'stl_zscore' AS method_name",
            "entity_id",
            "metric_name",
            f"{trained} AS trained_at",
            f"{trained} AS saved_at",
            "transform(sequence(0, 23), i -> i * 0.1D) AS seasonal_pattern",
            "level AS trend_last_value",
            "0.001D AS trend_slope",
            f"{trained} AS trend_last_timestamp",
            "0D AS residual_mean",
            "spread AS residual_std",
            "3600 AS interval_seconds",
            "24 AS seasonal_period",
            "49 AS trend_period",
            "336 AS n_training_points",
            f"{trained} - INTERVAL '14' DAY AS training_start",
            f"{trained} AS training_end",
        )
    )


def weekly_models(metrics: DataFrame) -> DataFrame:
    """A flat model per server, metric and week: the week's mean and sample deviation."""
    figures = ", ".join(
        f"named_struct('metric_name', '{m}', 'mean', avg({m}), 'spread', stddev_samp({m}))"
        for m in BASELINES
    )
    weeks = metrics.groupBy("server_id", bucket("timestamp", "1 week").alias("week")).agg(
        F.expr(f"array({figures})").alias("figures"),
        F.expr("CAST(count(*) AS INT)").alias("n_training_points"),
        F.min("timestamp").alias("training_start"),
        F.max("timestamp").alias("training_end"),
    )
    return weeks.selectExpr("*", "inline(figures)", "week + INTERVAL '7' DAY AS week_end").selectExpr(
        "'stl_zscore' AS method_name",
        "server_id AS entity_id",
        "metric_name",
        "week_end AS trained_at",
        "week_end AS saved_at",
        "array(0D) AS seasonal_pattern",
        "mean AS trend_last_value",
        "0D AS trend_slope",
        "week_end AS trend_last_timestamp",
        "0D AS residual_mean",
        "spread AS residual_std",
        "3600 AS interval_seconds",
        "1 AS seasonal_period",
        "3 AS trend_period",
        "n_training_points",
        "training_start",
        "training_end",
    )
