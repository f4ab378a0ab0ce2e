"""Care of the stored tables: fold closed days into few sorted files, drop expired days."""

from __future__ import annotations

from datetime import UTC, date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.clock import moment
from ..operators.states import STATES, merge_states
from ..sources.files import Files
from ..sources.tables import BATCH, DATE, TABLES, VERSIONS, TableStore, folder_days

RETENTION_DAYS = 90
COMPACT_AFTER_DAYS = 7
COMPACTED = "compacted"
STAMP = "%Y%m%d%H%M%S%f"


def retention_kept(
    df: DataFrame, as_of: Column | datetime | None = None, days: int = RETENTION_DAYS
) -> DataFrame:
    """Rows of the days retention keeps."""
    first = F.date_sub(F.to_date(moment(as_of)), days)
    if DATE in df.columns:
        return df.filter(F.col(DATE) >= first)
    return df.filter(F.col("timestamp") >= first.cast(df.schema["timestamp"].dataType))


def drop_expired(
    store: TableStore, name: str, as_of: datetime, days: int = RETENTION_DAYS
) -> list[date]:
    """Drop whole days older than ``days``; rows are never read."""
    limit = as_of.date() - timedelta(days=days)
    expired = [d for d in store.days(name) if d < limit]
    for day in expired:
        store.drop_day(name, day)
    return expired


def compact(
    store: TableStore,
    name: str,
    as_of: datetime,
    older_than_days: int = COMPACT_AFTER_DAYS,
    settle: timedelta = timedelta(hours=1),
    rows_per_file: int = 5_000_000,
) -> list[date]:
    """Rewrite each closed day into files sorted by key and time, and switch the day to them.

    Rows are range-partitioned by (key, time): a key that holds a third of the rows spreads over as
    many tasks as its rows need, and the files' min/max statistics let scans for one key or hour
    skip the rest. Partial states of one key and bucket become one row. A day whose folder changed
    within ``settle`` is left for the next run, and so is one that changes while it is rewritten.

    The switch is one change of the catalog: readers see all of the old files or all of the new.
    The old folder stays, for readers that have begun, until :func:`drop_replaced`. A run that dies
    leaves at most a version nobody reads, which goes the same way.
    """
    files, done = Files(store.spark), []
    for day in _uncompacted(store, name, as_of.date() - timedelta(days=older_than_days)):
        folder = store.location(name, day)
        before = files.modified(folder)
        if before > as_of - settle:
            continue
        target = f"{store.path(name)}/{VERSIONS}/{DATE}={day}/{datetime.now(UTC):{STAMP}}"
        _rewrite(store, name, day, target, rows_per_file)
        if files.modified(folder) == before:
            store.switch_day(name, day, target)
            done.append(day)
    return done


def _uncompacted(store: TableStore, name: str, limit: date) -> list[date]:
    """Days before ``limit`` that hold rows as batches wrote them; only footers are read."""
    days = (
        store.read(name, until=limit - timedelta(days=1))
        .where(F.col(BATCH) != COMPACTED)
        .select(DATE)
        .distinct()
    )
    return sorted(r[0] for r in days.where(F.col(DATE).isNotNull()).collect())


def _rewrite(store: TableStore, name: str, day: date, target: str, rows_per_file: int) -> None:
    rows, table = store.read(name, day, day), TABLES[name]
    if name in STATES:
        rows = merge_states(rows, table.key)
    order = [table.key, "timestamp"] if table.timed else rows.columns[:1]
    pieces = max(1, -(-rows.count() // rows_per_file))
    (
        rows.withColumn(BATCH, F.lit(COMPACTED))
        .select(*table.schema.fieldNames(), BATCH)
        .repartitionByRange(pieces, *order)
        .sortWithinPartitions(*order)
        .write.option("compression", "zstd")
        .parquet(target)
    )


def drop_replaced(
    store: TableStore, name: str, as_of: datetime, grace: timedelta = timedelta(days=1)
) -> list[str]:
    """Delete folders that days were switched away from, ``grace`` after the switch.

    A write that was planned before a switch and ended after it left its rows in the old folder:
    they are written to the day first. Such files are younger than the version that took over.
    """
    files, gone = Files(store.spark), []
    for day in folder_days(store.spark, f"{store.path(name)}/{VERSIONS}"):
        if day not in store.days(name):
            continue
        now = store.location(name, day)
        versions = store.versions(name, day)
        current = next((v for v in versions if now.endswith(v.split(":")[-1])), None)
        if current is None:
            continue
        since = datetime.strptime(current.rsplit("/", 1)[1], STAMP)
        if since > as_of - grace:
            continue
        for folder in [f"{store.path(name)}/{DATE}={day}", *versions[: versions.index(current)]]:
            if not files.exists(folder):
                continue
            rows = store.spark.read.schema(store.read(name).drop(DATE).schema).parquet(folder)
            late = rows.where(F.col("_metadata.file_modification_time") > F.lit(since))
            if not late.isEmpty():
                late.withColumn(DATE, F.lit(day)).write.insertInto(store.table(name))
            files.delete(folder)
            gone.append(folder)
    return gone
