"""Training runs: history -> outcomes -> models, and the run's totals."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DetectionConfig
from ..operators.fitting import as_models
from ..operators.methods import make_detector
from ..operators.series import training_history


def discover_entities(metrics_table: DataFrame, entity: str = "server_id") -> DataFrame:
    """Every entity the table has ever held."""
    return metrics_table.select(entity).distinct().orderBy(entity)


def train_outcomes(
    metrics_table: DataFrame,
    config: DetectionConfig,
    as_of: Column | datetime | None = None,
    entity: str = "server_id",
    partitions: int | None = None,
) -> DataFrame:
    """One row per series with recent readings: fitted, failed or skipped."""
    history = training_history(
        metrics_table,
        config.metrics,
        config.history_days,
        as_of,
        config.aggregation_interval,
        entity,
    )
    method = make_detector(config.method_name, config.method_config)
    return method.fit(history, config.skip_threshold, partitions)


def train_models(
    metrics_table: DataFrame,
    config: DetectionConfig,
    as_of: Column | datetime | None = None,
    entity: str = "server_id",
    partitions: int | None = None,
) -> DataFrame:
    """Models of all series that could be fitted."""
    outcomes = train_outcomes(metrics_table, config, as_of, entity, partitions)
    return as_models(outcomes, config.method_name)


def train_single(
    metrics_table: DataFrame,
    config: DetectionConfig,
    entity_id: str,
    metric: str,
    as_of: Column | datetime | None = None,
    entity: str = "server_id",
) -> DataFrame:
    """Outcome of one series."""
    if metric not in metrics_table.columns:
        raise ValueError(f"no such metric: {metric}")
    one = metrics_table.filter(F.col(entity) == entity_id)
    history = training_history(
        one, [metric], config.history_days, as_of, config.aggregation_interval, entity
    )
    method = make_detector(config.method_name, config.method_config)
    return method.fit(history, config.skip_threshold)


def all_outcomes(
    metrics_table: DataFrame,
    outcomes: DataFrame,
    config: DetectionConfig,
    entity: str = "server_id",
) -> DataFrame:
    """Outcome per discovered entity and metric; no recent readings means skipped."""
    names = F.array(*(F.lit(m) for m in config.metrics))
    wanted = (
        metrics_table.select(F.col(entity).alias("entity_id"))
        .distinct()
        .withColumn("metric_name", F.explode(names))
    )
    known = outcomes.select("entity_id", "metric_name", "status", "reason", "n_rows")
    return wanted.join(known, ["entity_id", "metric_name"], "left").select(
        "entity_id",
        "metric_name",
        F.coalesce("status", F.lit("skipped")).alias("status"),
        F.when(F.col("status").isNull(), "insufficient_data")
        .otherwise(F.col("reason"))
        .alias("reason"),
        F.coalesce("n_rows", F.lit(0)).alias("n_rows"),
    )


def training_stats(outcomes: DataFrame) -> DataFrame:
    """Totals of a run over the rows of :func:`all_outcomes`."""
    status = F.col("status")
    return outcomes.agg(
        F.countDistinct("entity_id").alias("total_entities"),
        F.count("*").alias("total_models"),
        F.count_if(status == "ok").alias("successful"),
        F.count_if(status == "failed").alias("failed"),
        F.count_if(status == "skipped").alias("skipped"),
    )
