"""Anomaly questions: open list, counts, timeline, latest, and the drill-down of one metric."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.bands import panel_status, severity_rank
from ..functions.clock import bucket, in_range, within_last

Moment = Column | datetime | None


def active_anomalies(anomalies: DataFrame):
    """Unresolved anomalies. Severity sorts as text here (medium, low, high, critical)."""
    return (
        anomalies.filter(~F.col("resolved"))
        .select(
            "entity_type",
            "entity_id",
            "anomaly_type",
            "severity",
            "anomaly_score",
            "details",
            "timestamp",
            "created_at",
        )
        .orderBy(F.desc_nulls_first("severity"), F.desc("timestamp"))
    )


def anomaly_count(anomalies: DataFrame, as_of: Moment = None, lookback: str = "1 hour"):
    value = within_last(anomalies, lookback, as_of).agg(F.count("*").alias("value"))
    return value.withColumn("status", panel_status(F.col("value"), "anomalies_per_hour"))


def critical_entities(anomalies: DataFrame, as_of: Moment = None, lookback: str = "1 hour"):
    value = (
        within_last(anomalies, lookback, as_of)
        .filter(F.col("severity") == "critical")
        .agg(F.countDistinct("entity_id").alias("value"))
    )
    return value.withColumn("status", panel_status(F.col("value"), "critical_entities"))


def by_severity(anomalies: DataFrame, as_of: Moment = None, lookback: str = "24 hours"):
    """Worst severity first."""
    return (
        within_last(anomalies, lookback, as_of)
        .groupBy("severity")
        .agg(F.count("*").alias("value"))
        .orderBy(severity_rank(F.col("severity")))
    )


def by_metric(anomalies: DataFrame, as_of: Moment = None, lookback: str = "24 hours"):
    return (
        within_last(anomalies, lookback, as_of)
        .groupBy(F.col("details.metric_name").alias("metric"))
        .agg(F.count("*").alias("value"))
        .orderBy(F.desc("value"))
    )


def timeline(anomalies: DataFrame, start: Moment, end: Moment, width: str):
    return (
        in_range(anomalies, start, end)
        .groupBy(bucket("timestamp", width).alias("time"), F.col("severity").alias("metric"))
        .agg(F.count("*").alias("value"))
        .orderBy("time")
    )


def recent(anomalies: DataFrame, start: Moment, end: Moment, count: int = 100):
    """Latest anomalies as shown in the table panel; ties go by entity and metric."""
    rounded = lambda name, digits: F.round(f"details.{name}", digits)
    return (
        in_range(anomalies, start, end)
        .orderBy(F.desc("timestamp"), "entity_id", "details.metric_name")
        .limit(count)
        .select(
            F.col("timestamp").alias("Time"),
            F.col("entity_id").alias("Entity"),
            F.col("details.metric_name").alias("Metric"),
            F.col("severity").alias("Severity"),
            F.round("anomaly_score", 3).alias("Score"),
            rounded("actual_value", 2).alias("Actual"),
            rounded("expected_value", 2).alias("Expected"),
            rounded("z_score", 2).alias("Z-Score"),
            rounded("residual", 2).alias("Residual"),
        )
    )


def anomaly_entities(anomalies: DataFrame):
    return anomalies.select("entity_id").distinct().orderBy("entity_id")


def metrics_of_entity(anomalies: DataFrame, entity_id: str):
    return (
        anomalies.filter(F.col("entity_id") == entity_id)
        .select(F.col("details.metric_name").alias("metric_name"))
        .distinct()
        .orderBy("metric_name")
    )


def investigate(
    metrics: DataFrame,
    anomalies: DataFrame,
    entity_id: str,
    metric: str,
    start: Moment,
    end: Moment,
    width: str = "5 minutes",
):
    """Five series of one entity's metric: actual, expected, the anomalies, and two bounds.

    The bounds lie three times the average residual of *all* its anomalies, of any time, around
    the expectation. Expectation and bounds come from one aggregate.
    """
    if metric not in metrics.columns:
        raise ValueError(f"no such metric: {metric}")
    actual = (
        in_range(metrics.filter(F.col("server_id") == entity_id), start, end)
        .groupBy(bucket("timestamp", width).alias("time"))
        .agg(F.avg(metric).cast("double").alias("value"))
        .select("time", F.lit("actual").alias("metric"), "value")
    )
    of_metric = anomalies.filter(
        (F.col("entity_id") == entity_id) & (F.col("details.metric_name") == metric)
    )
    # A global aggregate yields exactly one row, whatever the number of anomalies.
    margin = of_metric.agg((3 * F.avg("details.residual")).alias("margin")).scalar()
    inside = in_range(of_metric, start, end)
    expected = (
        inside.groupBy(bucket("timestamp", width).alias("time"))
        .agg(F.avg("details.expected_value").alias("expected"))
        .withColumn("margin", margin)
        .withColumn("upper_bound", F.col("expected") + F.col("margin"))
        .withColumn("lower_bound", F.col("expected") - F.col("margin"))
        .unpivot("time", ["expected", "upper_bound", "lower_bound"], "metric", "value")
    )
    points = inside.select(
        F.col("timestamp").alias("time"),
        F.lit("anomaly_points").alias("metric"),
        F.col("details.actual_value").alias("value"),
    )
    return actual.unionByName(expected).unionByName(points).orderBy("time")
