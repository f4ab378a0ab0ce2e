"""Z-score of readings against their models, as Column expressions.

Readings stay wide (one row per entity and moment) until after the model join, so the join
probes, or shuffles, one row per reading and not one per metric. The models of an entity are
packed into one row with a struct per metric.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.bands import severity
from ..functions.clock import slot_of_day
from ..functions.documents import encode
from .lookup import BROADCAST_LIMIT_BYTES, SALT_BUCKETS, lookup_left, measured_bytes
from .series import known_metrics

_SCALARS = (
    "trend_last_value",
    "trend_slope",
    "trend_last_timestamp",
    "residual_mean",
    "residual_std",
    "interval_seconds",
)


def pack_models(models: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """One row per entity with a struct ``model_<metric>`` per metric (NULL where untrained).

    Expects at most one model per (entity, metric), so a group holds ``len(metrics)`` rows.
    """
    body = F.struct(*_SCALARS, "seasonal_pattern")
    return (
        models.filter(F.col("metric_name").isin(*metrics))
        .groupBy("entity_id")
        .agg(
            *(
                F.first(F.when(F.col("metric_name") == m, body), ignorenulls=True).alias(
                    f"model_{m}"
                )
                for m in metrics
            )
        )
    )


def _reading_of(metric: str) -> str:
    """SQL struct of one metric's value and what its model says about the moment."""
    model = f"model_{metric}"
    cycle = f"{model}.seasonal_pattern"
    slot = slot_of_day("timestamp", f"{model}.interval_seconds", f"size({cycle})")
    scalars = ", ".join(f"'{name}', {model}.{name}" for name in _SCALARS)
    return (
        f"named_struct('metric_name', '{metric}', 'actual_value', CAST({metric} AS DOUBLE), "
        f"'model_found', {model} IS NOT NULL, 'seasonal', get({cycle}, {slot}), {scalars})"
    )


def score(
    readings: DataFrame,
    models: DataFrame,
    metrics: Sequence[str],
    threshold: float = 3.0,
    entity: str = "server_id",
    carry: Sequence[str] = (),
    broadcast_limit: int = BROADCAST_LIMIT_BYTES,
    salt_buckets: int = SALT_BUCKETS,
) -> DataFrame:
    """One row per reading and non-NULL metric, with expectation, z-score and verdict.

    Readings without a model come out with ``model_found = false`` and no z-score. A z-score
    that is undefined (the model's residual spread is zero) is NULL, which is no anomaly.
    ``models`` is read twice, to measure it and to join it, so pass a stored table.
    """
    names = known_metrics(readings, metrics)
    facts = readings.select(F.col(entity).alias("entity_id"), "timestamp", *carry, *names)
    joined = lookup_left(
        facts,
        pack_models(models, names),
        "entity_id",
        side_bytes=measured_bytes(models, "8 * size(seasonal_pattern) + 160"),
        spread_by="timestamp",
        limit=broadcast_limit,
        salt_buckets=salt_buckets,
    )
    keep = ["entity_id", "timestamp", *carry]
    structs = ", ".join(_reading_of(m) for m in names)
    return (
        joined.selectExpr(*keep, f"inline(array({structs}))")
        .filter("actual_value IS NOT NULL")
        .selectExpr(
            *keep,
            "metric_name",
            "actual_value",
            "model_found",
            "seasonal",
            "(unix_micros(CAST(timestamp AS TIMESTAMP))"
            " - unix_micros(CAST(trend_last_timestamp AS TIMESTAMP))) / 1e6D AS _seconds",
            "trend_last_value + trend_slope * try_divide(_seconds, interval_seconds) AS trend",
            "trend + seasonal AS expected_value",
            "actual_value - expected_value AS residual",
            "nullif(try_divide(residual - residual_mean, residual_std), double('NaN')) AS z_score",
            "if(z_score IS NULL, NULL, least(1D, abs(z_score) / 5D)) AS anomaly_score",
            f"coalesce(abs(z_score) > {float(threshold)}D, false) AS is_anomaly",
            f"{float(threshold)}D AS threshold",
        )
        .drop("_seconds")
    )


def details() -> Column:
    """Supporting figures; rounded here only, every comparison uses the exact ones."""
    return F.struct(
        "metric_name",
        "actual_value",
        "expected_value",
        *(F.round(name, 4).alias(name) for name in ("z_score", "residual", "trend", "seasonal")),
        "threshold",
    )


def anomaly_records(
    scored: DataFrame,
    method_name: str = "stl_zscore",
    entity_type: str = "server",
    carry: Sequence[str] = (),
) -> DataFrame:
    """Anomalies in their stored shape."""
    return scored.filter("is_anomaly").select(
        *carry,
        "timestamp",
        F.lit(entity_type).alias("entity_type"),
        "entity_id",
        F.concat_ws("_", F.lit(method_name), "metric_name").alias("anomaly_type"),
        severity(F.col("anomaly_score")).alias("severity"),
        "anomaly_score",
        details().alias("details"),
    )


def export_details(anomalies: DataFrame) -> DataFrame:
    """Anomalies with ``details`` as JSON text, for sinks that take documents."""
    return anomalies.withColumn("details", encode("details.*"))


def counters() -> dict[str, Column]:
    """Detection counters over scored rows, for ``agg``."""
    return {
        "total_analyzed": F.count("*"),
        "models_not_found": F.count_if(~F.col("model_found")),
        "undefined_scores": F.count_if(F.col("model_found") & F.col("z_score").isNull()),
        "anomalies_detected": F.count_if("is_anomaly"),
    }


def detection_stats(scored: DataFrame) -> DataFrame:
    totals = scored.agg(*(c.alias(name) for name, c in counters().items()))
    rate = F.try_divide(F.col("anomalies_detected") * 100.0, F.col("total_analyzed"))
    return totals.withColumn(
        "detection_rate_percent", F.round(F.coalesce(rate, F.lit(0.0)), 2)
    )
