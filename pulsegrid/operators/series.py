"""Series operators: long form, bucket averages, ordered-per-series measures, time grid.

The ordered measures run on bucketed series. A bucketed series has at most
``range / bucket width`` rows however many readings stand behind it, because the average is
pre-aggregated before the shuffle; so no window partition grows with the data.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.clock import bucket, bucket_width, interval, micros, seconds, within_last

SERIES = ("entity_id", "metric_name")
#: Slots of keys for the bounds of ``newest_rows``: at most 4 MB in all.
NEWEST_SLOTS = 1 << 18


def known_metrics(df: DataFrame, metrics: Sequence[str]) -> list[str]:
    """The requested metrics the table has; absent ones are left out."""
    return [m for m in metrics if m in df.columns]


def to_long(df: DataFrame, keys: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """One row per key and non-NULL metric."""
    long = df.unpivot(list(keys), known_metrics(df, metrics), "metric_name", "value")
    return long.filter(F.col("value").isNotNull())


def training_history(
    metrics_table: DataFrame,
    metrics: Sequence[str],
    days: int,
    as_of: Column | datetime | None = None,
    aggregation: str = "5min",
    entity: str = "server_id",
) -> DataFrame:
    """Bucket average per entity and metric over the last ``days``, for all series at once.

    All metrics are averaged wide, in one pass and one shuffle, and turned long afterwards:
    the wide rows are few by then. A bucket whose readings are all NULL has no average and
    drops out.
    """
    recent = within_last(metrics_table, f"{days} days", as_of)
    names = known_metrics(metrics_table, metrics)
    averages = recent.groupBy(
        F.col(entity).alias("entity_id"),
        bucket("timestamp", bucket_width(aggregation)).alias("timestamp"),
    ).agg(*(F.avg(m).alias(m) for m in names))
    return to_long(averages, ["entity_id", "timestamp"], names)


def _ordered(descending: bool = False):
    order = F.col("timestamp").desc() if descending else F.col("timestamp")
    return Window.partitionBy(*SERIES).orderBy(order)


def infer_interval(history: DataFrame, default_seconds: int = 300) -> DataFrame:
    """Median gap between successive buckets, whole seconds."""
    gap = (micros(F.col("timestamp")) - micros(F.lag("timestamp").over(_ordered()))) / 1e6
    return (
        history.withColumn("gap", gap)
        .groupBy(*SERIES)
        .agg(
            F.coalesce(F.floor(F.median("gap")).cast("int"), F.lit(default_seconds)).alias(
                "interval_seconds"
            )
        )
    )


def tail(history: DataFrame, length: int) -> DataFrame:
    """Last ``length`` points of each series, numbered from 0 in series order."""
    back = F.row_number().over(_ordered(descending=True))
    kept = history.withColumn("back", back).filter(F.col("back") <= length)
    size = F.count("*").over(Window.partitionBy(*SERIES))
    return kept.withColumn("position", (size - F.col("back")).cast("int")).drop("back")


def tail_slope(history: DataFrame) -> DataFrame:
    """Least-squares slope per step over the last fifth of each series, ten points at least."""
    size = F.count("*").over(Window.partitionBy(*SERIES))
    numbered = history.withColumn("n", size).withColumn(
        "position", F.row_number().over(_ordered())
    )
    used = F.greatest(F.lit(10), F.floor(F.col("n") / 5))
    return (
        numbered.filter(F.col("position") > F.col("n") - used)
        .groupBy(*SERIES)
        .agg(F.regr_slope("value", "position").alias("slope"), F.count("*").alias("points"))
    )


def extent(history: DataFrame) -> DataFrame:
    return history.groupBy(*SERIES).agg(
        F.min("timestamp").alias("training_start"),
        F.max("timestamp").alias("training_end"),
        F.count("*").alias("n_training_points"),
        F.max_by("value", "timestamp").alias("last_value"),
    )


def validate(
    history: DataFrame, skip_below: int, min_points: int, seasonal_period: int
) -> DataFrame:
    """Verdict per series by its size: ``ok``, ``skipped`` or ``failed``, with the reason."""
    rows, valid = F.col("n_rows"), F.col("n_values")
    reason = (
        F.when(rows < skip_below, "insufficient_data")
        .when(valid == 0, "no_valid_values")
        .when(rows < min_points, "below_min_points")
        .when(valid < 2 * seasonal_period, "below_two_periods")
    )
    return (
        history.groupBy(*SERIES)
        .agg(F.count("*").alias("n_rows"), F.count("value").alias("n_values"))
        .withColumn("reason", reason)
        .withColumn(
            "status",
            F.when(F.col("reason").isNull(), "ok")
            .when(F.col("reason") == "insufficient_data", "skipped")
            .otherwise("failed"),
        )
    )


def time_grid(
    entities: DataFrame, start: Column, end: Column, step: str, keys: Sequence[str]
) -> DataFrame:
    """Every key at every step from ``start`` to ``end`` inclusive."""
    steps = F.sequence(start, end, interval(step))
    return entities.select(*keys, F.explode(steps).alias("timestamp"))


def grid_gaps(history: DataFrame, step: str) -> DataFrame:
    """Buckets a series lacks between its own first and last point."""
    spans = history.groupBy(*SERIES).agg(
        F.min("timestamp").alias("first"), F.max("timestamp").alias("last")
    )
    grid = time_grid(spans, F.col("first"), F.col("last"), step, SERIES)
    present = history.select(*SERIES, "timestamp")
    return grid.join(present, [*SERIES, "timestamp"], "left_anti")


def fill_gaps(history: DataFrame, step: str) -> DataFrame:
    """History with missing buckets filled by the straight line between their neighbours.

    Never applied by default: training takes series with their gaps.
    """
    # After a grid join the two neighbours of a gap are one lag away in the sparse series,
    # so each pair of successive points is expanded to the steps between them.
    ahead = history.withColumn("next_ts", F.lead("timestamp").over(_ordered())).withColumn(
        "next_value", F.lead("value").over(_ordered())
    )
    last_step = F.coalesce(F.col("next_ts") - interval(step), F.col("timestamp"))
    steps = F.sequence(F.col("timestamp"), last_step, interval(step))
    done = (micros(F.col("at")) - micros(F.col("timestamp"))) / (
        F.lit(1e6) * F.lit(seconds(step))
    )
    total = (micros(F.col("next_ts")) - micros(F.col("timestamp"))) / (
        F.lit(1e6) * F.lit(seconds(step))
    )
    filled = F.col("value") + F.coalesce(
        (F.col("next_value") - F.col("value")) * F.try_divide(done, total), F.lit(0.0)
    )
    return ahead.withColumn("at", F.explode(steps)).select(
        *SERIES, F.col("at").alias("timestamp"), filled.alias("value")
    )


def summarize(series: DataFrame) -> DataFrame:
    """Legend figures per series of (time, metric, value)."""
    present = F.col("value").isNotNull()
    return series.groupBy("metric").agg(
        F.avg("value").alias("mean"),
        F.max("value").alias("max"),
        F.min("value").alias("min"),
        F.sum("value").alias("sum"),
        F.max_by("value", "time").alias("last"),
        F.max_by("value", F.when(present, F.col("time"))).alias("last_not_null"),
    )


def newest_rows(
    df: DataFrame, keys: Sequence[str], order: str, slots: int = NEWEST_SLOTS
) -> DataFrame:
    """The newest row per key; rows tied on ``order`` resolve to the greatest.

    The newest ``order`` per key is a hash aggregate over two columns, combined map-side, so a hot
    key is one row a task. Keys fall into ``slots`` by hash, and a row older than the newest of
    every key in its slot cannot win. These bounds are at most ``slots`` rows of 16 bytes, so they
    are broadcast whatever the number of keys; only the rows that pass carry their other columns
    on and are sorted. With fewer keys than slots that is hardly more than one row a key; a key
    long silent lets the later rows of its slot pass as well.
    """
    rest = [c for c in df.columns if c not in keys and c != order]
    slot = F.pmod(F.xxhash64(*keys), F.lit(slots))
    newest = df.groupBy(*keys).agg(F.max(order).alias("_newest"))
    dated = F.count_if(F.col("_newest").isNull()) == 0
    bounds = newest.groupBy(slot.alias("_slot")).agg(
        F.when(dated, F.min("_newest")).alias("_bound")
    )
    may_win = F.col("_bound").isNull() | (F.col(order) >= F.col("_bound"))
    return (
        df.join(F.broadcast(bounds), (slot == F.col("_slot")) & may_win, "left_semi")
        .groupBy(*keys)
        .agg(F.max(F.struct(order, *rest)).alias("newest"))
        .select(*keys, "newest.*")
        .select(*df.columns)
    )


def latest_per_key(
    df: DataFrame, key: str | Sequence[str], columns: Sequence[str], order: str = "timestamp"
) -> DataFrame:
    """Newest values per key; see ``newest_rows``."""
    keys = [key] if isinstance(key, str) else list(key)
    return newest_rows(df.select(*keys, order, *columns), keys, order)
