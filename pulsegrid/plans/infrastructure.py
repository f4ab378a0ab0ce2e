"""Infrastructure questions: views over recent metrics, current values, series by rack/service.

``as_of`` is the moment the question is asked, now by default. Averages and sums are combined
map-side, so what is shuffled is one row per group and task, whatever the skew of the keys.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.bands import panel_status
from ..functions.clock import bucket, in_range, within_last
from ..operators.series import latest_per_key

Moment = Column | datetime | None


def recent_server_health(metrics: DataFrame, as_of: Moment = None, lookback: str = "1 hour"):
    """Readings of the last hour, newest first."""
    return (
        within_last(metrics, lookback, as_of)
        .select(
            "server_id",
            "timestamp",
            "cpu_usage_percent",
            "memory_usage_percent",
            "cpu_temperature_celsius",
            "power_consumption_watts",
            "rack_id",
            "datacenter_zone",
        )
        .orderBy(F.desc("timestamp"))
    )


def recent_application_performance(
    applications: DataFrame, as_of: Moment = None, lookback: str = "15 minutes"
):
    return (
        within_last(applications, lookback, as_of)
        .groupBy("service_name")
        .agg(
            F.avg("request_rate_per_sec").alias("avg_request_rate"),
            F.avg("response_time_p95_ms").alias("avg_p95_latency"),
            F.avg("error_rate_percent").alias("avg_error_rate"),
            F.max("timestamp").alias("last_updated"),
        )
    )


def current_average(
    metrics: DataFrame, column: str, as_of: Moment = None, lookback: str = "2 minutes"
):
    """Average over the last moments and its panel status; NULL when nothing came in."""
    value = within_last(metrics, lookback, as_of).agg(F.avg(column).alias("value"))
    return value.withColumn("status", panel_status(F.col("value"), column))


def active_count(df: DataFrame, key: str, as_of: Moment = None, lookback: str = "2 minutes"):
    """Exact number of distinct keys seen lately."""
    return within_last(df, lookback, as_of).agg(F.countDistinct(key).alias("value"))


def total_power_now(metrics: DataFrame, as_of: Moment = None, lookback: str = "1 minute"):
    """Sum of each server's latest draw."""
    recent = within_last(metrics, lookback, as_of)
    latest = latest_per_key(recent, "server_id", ["power_consumption_watts"])
    value = latest.agg(F.sum("power_consumption_watts").alias("value"))
    return value.withColumn("status", panel_status(F.col("value"), "total_power_watts"))


def rack_label() -> Column:
    return F.coalesce("rack_id", F.lit("unknown"))


def rack_series(
    metrics: DataFrame, column: str, start: Moment, end: Moment, width: str, how: str = "avg"
):
    """(time, metric, value) per bucket and rack; racks without a name share one label.

    ``how="sum"`` adds up samples, so its level grows with the bucket width.
    """
    measure = F.sum(column) if how == "sum" else F.avg(column)
    return (
        in_range(metrics, start, end)
        .groupBy(bucket("timestamp", width).alias("time"), "rack_id")
        .agg(measure.alias("value"))
        .select("time", rack_label().alias("metric"), "value")
        .orderBy("time")
    )


def service_series(
    applications: DataFrame, column: str, start: Moment, end: Moment, width: str
):
    return (
        in_range(applications, start, end)
        .groupBy(bucket("timestamp", width).alias("time"), F.col("service_name").alias("metric"))
        .agg(F.avg(column).alias("value"))
        .orderBy("time")
    )


def network_by_rack(metrics: DataFrame, start: Moment, end: Moment, width: str):
    """Received and sent sums as two series per rack, from one pass over the readings."""
    sums = (
        in_range(metrics, start, end)
        .groupBy(bucket("timestamp", width).alias("time"), "rack_id")
        .agg(F.sum("network_rx_mbps").alias("_rx"), F.sum("network_tx_mbps").alias("_tx"))
    )
    return (
        sums.unpivot(["time", "rack_id"], ["_rx", "_tx"], "direction", "value")
        .select("time", F.concat(rack_label(), "direction").alias("metric"), "value")
        .orderBy("time")
    )


def top_servers(
    metrics: DataFrame, as_of: Moment = None, lookback: str = "5 minutes", count: int = 10
):
    """Busiest servers by average CPU; equal averages go by name."""
    return (
        within_last(metrics, lookback, as_of)
        .groupBy("server_id")
        .agg(F.avg("cpu_usage_percent").alias("cpu"))
        .orderBy(F.desc_nulls_first("cpu"), "server_id")
        .limit(count)
        .select("server_id")
    )


def top_servers_series(
    metrics: DataFrame,
    start: Moment,
    end: Moment,
    width: str,
    as_of: Moment = None,
    lookback: str = "5 minutes",
    count: int = 10,
):
    """CPU series of the busiest servers. The broadcast side holds ``count`` ids at most."""
    busiest = top_servers(metrics, as_of, lookback, count)
    return (
        in_range(metrics, start, end)
        .join(F.broadcast(busiest), "server_id", "left_semi")
        .groupBy(bucket("timestamp", width).alias("time"), F.col("server_id").alias("metric"))
        .agg(F.avg("cpu_usage_percent").alias("value"))
        .orderBy("time")
    )
