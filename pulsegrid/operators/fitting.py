"""Seasonal-trend fit of every series as one distributed grouped job.

A group is one bucketed series: at most ``history / bucket width`` rows (4,032 by default),
whatever the number of readings behind it. Parallelism is the number of series.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import StlConfig
from ..schemas import MODEL_FIELDS, decomposition, fit_outcome
from . import loess
from .series import SERIES

# The fit ships with the task, so executors need no installed copy of this package.
cloudpickle.register_pickle_by_value(loess)


def _decomposer(config: StlConfig):
    decompose = loess.decompose
    period = config.seasonal_period
    seasonal_span = period + (period + 1) % 2
    trend_span, passes = config.trend_period, config.inner_passes

    def run(values: np.ndarray):
        return decompose(values, period, seasonal_span, trend_span, passes=passes)

    return run


def _grouped(history: DataFrame, partitions: int | None):
    if partitions:
        history = history.repartition(partitions, *SERIES)
    return history.select(*SERIES, "timestamp", "value").groupBy(*SERIES)


def fit_series(
    history: DataFrame, config: StlConfig, skip_below: int = 100, partitions: int | None = None
) -> DataFrame:
    """One row per series: ``status``/``reason``, and the model where the status is ``ok``.

    A series that cannot be fitted yields a row saying so and never stops the others. AQE
    sizes the fit's tasks by bytes; ``partitions`` fixes their number where series are few and
    long.
    """
    run = _decomposer(config)
    period, trend_period = config.seasonal_period, config.trend_period
    min_points, rotate = config.min_points, config.phase == "time_of_day"
    schema = fit_outcome(history.schema["timestamp"].dataType)
    columns = schema.fieldNames()

    def verdict(values: pd.Series) -> tuple[str, str] | None:
        if len(values) < skip_below:
            return "skipped", "insufficient_data"
        present = int(values.notna().sum())
        if present == 0:
            return "failed", "no_valid_values"
        if len(values) < min_points:
            return "failed", "below_min_points"
        if present < 2 * period:
            return "failed", "below_two_periods"
        return None

    def model(frame: pd.DataFrame) -> dict:
        frame = frame.dropna(subset=["value"]).sort_values("timestamp")
        stamps = frame["timestamp"]
        nanos = stamps.to_numpy("datetime64[ns]").astype("int64")
        gap = int(np.median(np.diff(nanos)) // 1_000_000_000) if len(nanos) > 1 else 300
        if gap < 60:
            raise ValueError("interval_below_one_minute")
        values = frame["value"].to_numpy(float)
        trend, seasonal, residual = run(values)
        recent = trend[-max(10, len(trend) // 5) :]
        steps = np.arange(len(recent)) - (len(recent) - 1) / 2
        cycle = seasonal[-period:]
        if rotate:
            first = stamps.iloc[-period]
            cycle = np.roll(cycle, (first.hour * 60 + first.minute) // (gap // 60) % period)
        return {
            "seasonal_pattern": cycle,
            "trend_last_value": float(trend[-1]),
            "trend_slope": float((steps * recent).sum() / (steps**2).sum()),
            "trend_last_timestamp": stamps.iloc[-1],
            "residual_mean": float(residual.mean()),
            "residual_std": float(residual.std(ddof=1)),
            "interval_seconds": gap,
            "seasonal_period": period,
            "trend_period": trend_period,
            "n_training_points": len(values),
            "training_start": stamps.iloc[0],
            "training_end": stamps.iloc[-1],
        }

    def fit(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        row = dict.fromkeys(columns)
        row.update(entity_id=key[0], metric_name=key[1], n_rows=len(frame))
        refused = verdict(frame["value"])
        if refused:
            row["status"], row["reason"] = refused
        else:
            try:
                row.update(model(frame), status="ok")
            except Exception as error:  # one bad series must not stop the run
                row.update(status="failed", reason=str(error))
        return pd.DataFrame([row], columns=columns)

    return _grouped(history, partitions).applyInPandas(fit, schema)


def decompose_series(
    history: DataFrame, config: StlConfig, partitions: int | None = None
) -> DataFrame:
    """Trend, seasonal part and residual of every point; series too short to fit are left out."""
    run = _decomposer(config)
    shortest = max(config.min_points, 2 * config.seasonal_period)

    def split(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.dropna(subset=["value"]).sort_values("timestamp")
        if len(frame) < shortest:
            return frame.assign(trend=0.0, seasonal=0.0, resid=0.0).iloc[:0]
        trend, seasonal, resid = run(frame["value"].to_numpy(float))
        return frame.assign(trend=trend, seasonal=seasonal, resid=resid)

    schema = decomposition(history.schema["timestamp"].dataType)
    return _grouped(history, partitions).applyInPandas(split, schema)


def as_models(outcomes: DataFrame, method_name: str) -> DataFrame:
    """Fitted models in the stored shape."""
    return (
        outcomes.filter(F.col("status") == "ok")
        .drop("status", "reason", "n_rows")
        .select(
            F.lit(method_name).alias("method_name"),
            *SERIES,
            F.current_timestamp().alias("trained_at"),
            F.current_timestamp().alias("saved_at"),
            *MODEL_FIELDS,
        )
    )
