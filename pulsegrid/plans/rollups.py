"""Hourly rollups and their incremental refresh."""

from __future__ import annotations

from datetime import UTC, date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.clock import bucket, interval, moment
from ..operators.states import STATES, average, merge_states, partial_states
from ..sources.tables import BATCH, DATE, VERSIONS, TableStore

SERVER_MEASURES = {
    "avg_cpu": F.avg,
    "max_cpu": F.max,
    "avg_memory": F.avg,
    "max_memory": F.max,
    "avg_temperature": F.avg,
    "max_temperature": F.max,
    "avg_power": F.avg,
}
_SOURCE = {
    "cpu": "cpu_usage_percent",
    "memory": "memory_usage_percent",
    "temperature": "cpu_temperature_celsius",
    "power": "power_consumption_watts",
}


def server_measures() -> list[Column]:
    return [
        *(f(_SOURCE[name.split("_")[1]]).alias(name) for name, f in SERVER_MEASURES.items()),
        F.count("*").alias("sample_count"),
    ]


def application_measures() -> list[Column]:
    return [
        F.avg("request_rate_per_sec").alias("avg_request_rate"),
        F.avg("response_time_p95_ms").alias("avg_p95_latency"),
        F.max("response_time_p99_ms").alias("max_p99_latency"),
        F.avg("error_rate_percent").alias("avg_error_rate"),
        F.sum("error_count").alias("total_errors"),
        F.count("*").alias("sample_count"),
    ]


def server_hourly(metrics: DataFrame) -> DataFrame:
    return metrics.groupBy(bucket("timestamp", "1 hour").alias("hour"), "server_id").agg(
        *server_measures()
    )


def application_hourly(applications: DataFrame) -> DataFrame:
    return applications.groupBy(bucket("timestamp", "1 hour").alias("hour"), "service_name").agg(
        *application_measures()
    )


def refresh_window(
    df: DataFrame,
    as_of: Column | datetime | None = None,
    start_offset: str = "3 hours",
    end_offset: str = "1 hour",
) -> DataFrame:
    """Rows of the hours that lie wholly inside [as_of - start, as_of - end).

    The bounds are whole hours, so the filter is on the raw timestamp and reaches the scan.
    """
    now = moment(as_of)
    low, high = now - interval(start_offset), now - interval(end_offset)
    floor_low = F.date_trunc("hour", low)
    first = F.when(floor_low == low, low).otherwise(floor_low + F.expr("INTERVAL '1' HOUR"))
    first = first.cast(df.schema["timestamp"].dataType)
    stop = F.date_trunc("hour", high).cast(df.schema["timestamp"].dataType)
    keep = (F.col("timestamp") >= first) & (F.col("timestamp") < stop)
    if "event_date" in df.columns:
        keep = keep & F.col("event_date").between(F.to_date(first), F.to_date(stop))
    return df.filter(keep)


def write_rollup(rollup: DataFrame, path: str, files_per_hour: int = 1) -> None:
    """Replace exactly the hours present in ``rollup``, leaving all others as they are.

    Rows are brought together by hour first, so an hour is at most ``files_per_hour`` files; raise
    that where one hour's keys are too many for one task.
    """
    keys = [c for c in rollup.columns if c in ("server_id", "service_name")]
    piece = F.pmod(F.xxhash64(*keys), F.lit(files_per_hour)) if keys else F.lit(0)
    (
        rollup.withColumn("event_date", F.to_date("hour"))
        .withColumn("event_hour", F.hour("hour"))
        .repartition("event_date", "event_hour", piece)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("event_date", "event_hour")
        .parquet(path)
    )


_DOUBLES = {
    "server_metrics_hourly": [*SERVER_MEASURES],
    "application_metrics_hourly": [
        "avg_request_rate",
        "avg_p95_latency",
        "max_p99_latency",
        "avg_error_rate",
    ],
}


def rollup_schema(name: str) -> str:
    server = name == "server_metrics_hourly"
    fields = ["hour timestamp", f"{'server_id' if server else 'service_name'} string"]
    fields += [f"{c} double" for c in _DOUBLES[name]]
    fields += [] if server else ["total_errors long"]
    return ", ".join([*fields, "sample_count long", "event_date date", "event_hour int"])


def read_rollup(spark, path: str, name: str = "server_metrics_hourly") -> DataFrame:
    return (
        spark.read.schema(rollup_schema(name)).parquet(path).drop("event_date", "event_hour")
    )


ROLLUPS = {
    "server_metrics_hourly": ("server_metrics", server_hourly),
    "application_metrics_hourly": ("application_metrics", application_hourly),
}


def build_rollups(store: TableStore) -> None:
    """Write both rollups over all stored hours."""
    for name, (source, hourly) in ROLLUPS.items():
        write_rollup(hourly(store.read(source)), f"{store.root}/{name}")


def refresh_rollups(
    store: TableStore,
    as_of: Column | datetime | None = None,
    start_offset: str = "3 hours",
    end_offset: str = "1 hour",
) -> None:
    """Recompute the hours inside the refresh window; meant to run once an hour."""
    for name, (source, hourly) in ROLLUPS.items():
        window = refresh_window(store.read(source), as_of, start_offset, end_offset)
        write_rollup(hourly(window), f"{store.root}/{name}")


def server_hourly_from_states(states: DataFrame) -> DataFrame:
    """The rows of :func:`server_hourly` from partial states."""
    merged = merge_states(states, "server_id", "1 hour")
    measures = []
    for name in SERVER_MEASURES:
        kind, short = name.split("_")
        column = _SOURCE[short]
        value = average(column) if kind == "avg" else F.col(f"{column}_max")
        measures.append(value.alias(name))
    return merged.select(
        F.col("timestamp").alias("hour"), "server_id", *measures, F.col("rows").alias("sample_count")
    )


def application_hourly_from_states(states: DataFrame) -> DataFrame:
    """The rows of :func:`application_hourly` from partial states."""
    return merge_states(states, "service_name", "1 hour").select(
        F.col("timestamp").alias("hour"),
        "service_name",
        average("request_rate_per_sec").alias("avg_request_rate"),
        average("response_time_p95_ms").alias("avg_p95_latency"),
        F.col("response_time_p99_ms_max").alias("max_p99_latency"),
        average("error_rate_percent").alias("avg_error_rate"),
        F.col("error_count_sum").cast("long").alias("total_errors"),
        F.col("rows").alias("sample_count"),
    )


#: Rollup: table of states, function.
FROM_STATES = {
    "server_metrics_hourly": ("server_states", server_hourly_from_states),
    "application_metrics_hourly": ("application_states", application_hourly_from_states),
}


def hourly_from_states(
    store: TableStore, name: str, since: date | None = None, until: date | None = None
) -> DataFrame:
    """A rollup as of now, of some days or all, from the states that ingest has stored. Whatever
    was late, replayed or out of order is in it; no reading is read."""
    states, hourly = FROM_STATES[name]
    return hourly(store.read(states, since, until))


def rebuild_states(store: TableStore, name: str, days: list[date] | None = None) -> None:
    """Compute states anew from the stored readings, day by day, each switched in at one stroke;
    for readings stored before there were states."""
    source, key, values = STATES[name]
    for day in store.days(source) if days is None else days:
        stamp = datetime.now(UTC).strftime("%Y%m%d%H%M%S%f")
        target = f"{store.path(name)}/{VERSIONS}/{DATE}={day}/{stamp}"
        states = partial_states(store.read(source, day, day), key, values)
        states.withColumn(BATCH, F.lit("rebuilt-0")).write.parquet(target)
        store.switch_day(name, day, target)
