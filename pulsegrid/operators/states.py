"""Partial states: figures of one key and time bucket that can be added up in any order.

A batch of readings becomes a few rows of sums, numbers and maxima. They are stored by batch, so a
replayed batch replaces its own; averages over any coarser bucket, of the training history and of
the hourly rollups alike, then come from them without reading the readings again. Late and
reordered batches need nothing special, since adding up has no order.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.clock import bucket, bucket_width, interval, moment, seconds
from ..schemas import APPLICATION_COUNTS, APPLICATION_RATES, SERVER_VALUES
from .series import known_metrics, to_long

WIDTH = "5 minutes"
#: Table of states: table of readings, key, columns.
STATES = {
    "server_states": ("server_metrics", "server_id", SERVER_VALUES),
    "application_states": ("application_metrics", "service_name", APPLICATION_RATES + APPLICATION_COUNTS),
}


def partial_states(rows: DataFrame, key: str, values: Sequence[str], width: str = WIDTH) -> DataFrame:
    """One row per bucket and key of some readings; columns that are absent count as null."""
    figures = [F.count("*").alias("rows")]
    for v in values:
        x = (F.col(v) if v in rows.columns else F.lit(None)).cast("double")
        figures += [F.sum(x).alias(f"{v}_sum"), F.count(x).alias(f"{v}_n"), F.max(x).alias(f"{v}_max")]
    return rows.groupBy(bucket("timestamp", width).alias("timestamp"), key).agg(*figures)


def merge_states(states: DataFrame, key: str, width: str = WIDTH) -> DataFrame:
    """States of a coarser bucket, or of the same one with one row per bucket and key."""
    if seconds(width) % seconds(WIDTH):
        raise ValueError(f"{width} is no multiple of {WIDTH}")
    figures = [c for c in states.columns if c == "rows" or c.endswith(("_sum", "_n", "_max"))]
    return states.groupBy(bucket("timestamp", width).alias("timestamp"), key).agg(
        *((F.max(c) if c.endswith("_max") else F.sum(c)).alias(c) for c in figures)
    )


def average(value: str) -> Column:
    """Average of a column from its merged state; null without values."""
    return F.try_divide(f"{value}_sum", f"{value}_n")


def history_from_states(
    states: DataFrame,
    readings: DataFrame,
    metrics: Sequence[str],
    days: int,
    as_of: Column | datetime | None = None,
    aggregation: str = "5min",
    entity: str = "server_id",
) -> DataFrame:
    """The rows of ``training_history`` from stored states.

    The look-back begins inside a bucket as a rule. That one bucket is averaged from its readings,
    for which one day of them is opened; all later ones come from states.
    """
    width = bucket_width(aggregation)
    if seconds(width) % seconds(WIDTH):
        raise ValueError(f"{aggregation} is no multiple of {WIDTH}")
    kind = readings.schema["timestamp"].dataType
    start = (moment(as_of) - interval(f"{days} days")).cast(kind)
    step = F.lit(seconds(width) * 1_000_000)
    micros = F.unix_micros(start.cast("timestamp"))
    after = F.timestamp_micros(micros - F.pmod(micros, step) + step).cast(kind)
    at = F.col("timestamp")
    edge = readings.where((at > start) & (at < after))
    if "event_date" in readings.columns:
        edge = edge.where(F.col("event_date").between(F.to_date(start), F.to_date(after)))
    full = states.where(at >= after.cast(states.schema["timestamp"].dataType))
    if "event_date" in states.columns:
        full = full.where(F.col("event_date") >= F.to_date(after))
    names = known_metrics(readings, metrics)
    parts = [
        merge_states(full, entity, width),
        partial_states(edge, entity, names, width),
    ]
    averages = [
        p.select(F.col(entity).alias("entity_id"), F.col("timestamp").cast(kind).alias("timestamp"), *(average(m).alias(m) for m in names))
        for p in parts
    ]
    return to_long(averages[0].unionByName(averages[1]), ["entity_id", "timestamp"], names)
