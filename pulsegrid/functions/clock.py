"""Time buckets, time filters and timestamp arithmetic as Column expressions."""

from __future__ import annotations

import re
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}

# Short bucket names; any other name means five minutes.
BUCKET_NAMES = {
    "1min": "1 minute",
    "5min": "5 minutes",
    "10min": "10 minutes",
    "15min": "15 minutes",
    "1hour": "1 hour",
}
# Buckets wider than a day count from Monday 2000-01-03 (seconds since the epoch).
BUCKET_ORIGIN = 946857600


def bucket_width(name: str) -> str:
    return BUCKET_NAMES.get(name, "5 minutes")


def seconds(width: str) -> int:
    """``"5 minutes"`` -> 300."""
    match = re.fullmatch(r"\s*(\d+)\s*([a-z]+?)s?\s*", width.lower())
    if not match or match[2] not in _SECONDS or int(match[1]) == 0:
        raise ValueError(f"not a fixed time width: {width!r}")
    return int(match[1]) * _SECONDS[match[2]]


def interval(width: str) -> Column:
    return F.expr(f"INTERVAL '{seconds(width)}' SECOND")


def bucket(ts: Column | str, width: str) -> Column:
    """Start of the bucket a timestamp falls in."""
    size = seconds(width)
    offset = BUCKET_ORIGIN % size
    start = f"{offset} seconds" if offset else None
    return F.window(ts, f"{size} seconds", startTime=start)["start"]


def moment(value: Column | datetime | None) -> Column:
    """A point in time: a column, a datetime (UTC if it names no zone), or now."""
    if value is None:
        return F.current_timestamp()
    if isinstance(value, Column):
        return value
    return F.lit(value if value.tzinfo else value.replace(tzinfo=UTC))


def _like(df: DataFrame, column: str, bound: Column) -> Column:
    """The bound in the column's own type: a cast on the column would keep the filter out of
    the scan."""
    return bound.cast(df.schema[column].dataType)


def within_last(
    df: DataFrame,
    lookback: str,
    as_of: Column | datetime | None = None,
    column: str = "timestamp",
) -> DataFrame:
    """Rows strictly younger than ``as_of - lookback``.

    On tables partitioned by ``event_date`` the bound is repeated on that column, so
    files of earlier days are not opened. To not even list their folders, read the table with
    ``TableStore.read(name, since, until)``.
    """
    since = _like(df, column, moment(as_of) - interval(lookback))
    keep = F.col(column) > since
    if "event_date" in df.columns:
        keep = keep & (F.col("event_date") >= F.to_date(since))
    return df.filter(keep)


def in_range(
    df: DataFrame,
    start: Column | datetime,
    end: Column | datetime,
    column: str = "timestamp",
) -> DataFrame:
    """Rows between two moments, both included, with the same partition pruning."""
    start, end = (_like(df, column, moment(m)) for m in (start, end))
    keep = F.col(column).between(start, end)
    if "event_date" in df.columns:
        keep = keep & F.col("event_date").between(F.to_date(start), F.to_date(end))
    return df.filter(keep)


def parse_iso(text: Column | str) -> Column:
    """ISO-8601 with ``Z`` or an offset, fraction optional; NULL when unreadable."""
    return F.try_to_timestamp(F.col(text) if isinstance(text, str) else text)


def format_iso(ts: Column | str) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")


def micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def slot_of_day(ts: str, interval_seconds: str, slots: str) -> str:
    """SQL for the position of a timestamp in a daily cycle of ``slots`` entries.

    NULL when the interval is shorter than a minute or the cycle is empty.
    """
    minute = f"(hour({ts}) * 60 + minute({ts}))"
    step = f"nullif(CAST({interval_seconds} AS INT) div 60, 0)"
    return f"CAST({minute} div {step} % nullif({slots}, 0) AS INT)"
