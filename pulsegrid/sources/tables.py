"""Stored tables: Parquet in the session's catalog, one partition a day.

The catalog knows where each day lies. Questions therefore list only the days they ask for, rows
written later are seen without registering anything again, and a day's files can be replaced by
others at one stroke (``switch_day``). A day's rows carry the id of the batch that wrote them, so
that a batch replayed after a failure replaces its first attempt instead of adding to it. Batch ids
end in the stream's batch number and begin with the stream's name, because every new checkpoint
counts from zero.
"""

from __future__ import annotations

import hashlib
from datetime import date
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from .files import Files

DATE, BATCH = "event_date", "batch_id"
VERSIONS = "_days"  # below a table's folder; listings pass over names that begin like this


class Table(NamedTuple):
    schema: T.StructType
    key: str | None
    timed: bool = True  # the day is that of ``timestamp``, otherwise that of writing


TABLES = {
    "server_metrics": Table(schemas.SERVER_METRICS, "server_id"),
    "application_metrics": Table(schemas.APPLICATION_METRICS, "service_name"),
    "predictions": Table(schemas.PREDICTIONS, "server_id"),
    "anomalies": Table(schemas.ANOMALIES, "entity_id"),
    "server_states": Table(schemas.SERVER_STATES, "server_id"),
    "application_states": Table(schemas.APPLICATION_STATES, "service_name"),
    "dead_letter": Table(schemas.DEAD_LETTER, None, timed=False),
    "stream_counts": Table(schemas.STREAM_COUNTS, None, timed=False),
    "model_pins": Table(schemas.MODEL_PINS, None, timed=False),
}


class TableStore:
    """All tables under one root folder, as tables of one catalog database.

    With a metastore the catalog outlives the application. With Spark's own catalog, which does
    not, ``create`` finds the days and their newest versions again in the folders.
    """

    def __init__(self, spark: SparkSession, root: str, database: str | None = None):
        self.spark, self.root = spark, root.rstrip("/")
        own = hashlib.sha256(self.root.encode()).hexdigest()[:12]
        self.database = database or f"pulsegrid_{own}"
        self._last: dict[tuple[str, str], int] = {}

    def path(self, name: str) -> str:
        if name not in TABLES:
            raise ValueError(f"no such table: {name}")
        return f"{self.root}/{name}"

    def table(self, name: str) -> str:
        """The table's name in SQL."""
        self.path(name)
        return f"`{self.database}`.`{name}`"

    def _schema(self, name: str) -> T.StructType:
        schema = T.StructType(list(TABLES[name].schema.fields))
        return schema.add(BATCH, T.StringType()).add(DATE, T.DateType())

    def create(self) -> TableStore:
        """Create whatever tables do not exist yet."""
        spark = self.spark
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{self.database}`")
        for name in TABLES:
            if spark.catalog.tableExists(self.table(name)):
                continue
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self._schema(name))
            spark.sql(
                f"CREATE TABLE {self.table(name)} ({columns}) USING parquet "
                f"PARTITIONED BY ({DATE}) LOCATION '{self.path(name)}'"
            )
            if Files(spark).exists(self.path(name)):
                self._recover(name)
        return self

    def _recover(self, name: str) -> None:
        """Days and their newest complete versions, from the folders."""
        self.spark.sql(f"ALTER TABLE {self.table(name)} RECOVER PARTITIONS")
        for day in folder_days(self.spark, f"{self.path(name)}/{VERSIONS}"):
            complete = [v for v in self.versions(name, day) if Files(self.spark).exists(f"{v}/_SUCCESS")]
            if complete:
                self.switch_day(name, day, complete[-1])

    # ---- days ------------------------------------------------------------------------

    def days(self, name: str) -> list[date]:
        """The days the catalog knows, in order."""
        rows = self.spark.sql(f"SHOW PARTITIONS {self.table(name)}").collect()
        values = (r[0].split("=", 1)[1] for r in rows)
        return sorted(date.fromisoformat(v) for v in values if not v.startswith("__HIVE"))

    def location(self, name: str, day: date) -> str:
        """Folder that holds a day now."""
        rows = self.spark.sql(
            f"DESCRIBE EXTENDED {self.table(name)} PARTITION ({DATE} = DATE'{day}')"
        ).collect()
        return next(r.data_type for r in rows if r.col_name == "Location")

    def versions(self, name: str, day: date) -> list[str]:
        """Folders of rewritten versions of a day, oldest first."""
        folder = f"{self.path(name)}/{VERSIONS}/{DATE}={day}"
        return [f"{folder}/{v}" for v in sorted(e.name for e in Files(self.spark).list(folder))]

    def switch_day(self, name: str, day: date, folder: str) -> None:
        """Make another folder the day's. Questions planned before go on reading the old one, all
        later ones read the new one; none sees a part of either."""
        spec = f"PARTITION ({DATE} = DATE'{day}')"
        if day in self.days(name):
            self.spark.sql(f"ALTER TABLE {self.table(name)} {spec} SET LOCATION '{folder}'")
        else:
            self.spark.sql(f"ALTER TABLE {self.table(name)} ADD {spec} LOCATION '{folder}'")
        self.spark.catalog.refreshTable(self.table(name))

    def drop_day(self, name: str, day: date) -> None:
        """Forget a day and delete its files, all versions of them."""
        self.spark.sql(f"ALTER TABLE {self.table(name)} DROP IF EXISTS PARTITION ({DATE} = DATE'{day}')")
        for folder in (f"{DATE}={day}", f"{VERSIONS}/{DATE}={day}"):
            Files(self.spark).delete(f"{self.path(name)}/{folder}")

    # ---- rows ------------------------------------------------------------------------

    def read(self, name: str, since: date | None = None, until: date | None = None) -> DataFrame:
        """The table, or its days from ``since`` to ``until``, both included. Which days are listed
        follows from the filters on ``event_date``; pruning comes before listing."""
        rows = self.spark.table(self.table(name))
        if since is not None:
            rows = rows.where(F.col(DATE) >= F.lit(since))
        if until is not None:
            rows = rows.where(F.col(DATE) <= F.lit(until))
        return rows

    def append(
        self, name: str, rows: DataFrame, batch_id: str, replayed: bool | None = None
    ) -> None:
        """Write the rows of one batch; columns the rows lack take their defaults.

        Every task that holds rows of a day writes one file for it, so callers merge the
        partitions of small batches first. If the batch may have been written before
        (``replayed``; by default as :meth:`may_be_replayed` says) its earlier rows go first.
        """
        table = TABLES[name]
        defaults = {"created_at": F.current_timestamp(), "resolved": F.lit(False)}
        present = set(rows.columns)

        def column(field: T.StructField):
            fallback = defaults.get(field.name, F.lit(None)).cast(field.dataType)
            if field.name not in present:
                return fallback.alias(field.name)
            if field.name in defaults:
                return F.coalesce(F.col(field.name), fallback).alias(field.name)
            return F.col(field.name).cast(field.dataType).alias(field.name)

        day = F.to_date("timestamp") if table.timed else F.current_date()
        out = rows.select(*(column(f) for f in table.schema.fields), F.lit(batch_id).alias(BATCH))
        out = out.withColumn(DATE, day)
        if self.may_be_replayed(name, batch_id) if replayed is None else replayed:
            # a replay has the rows of the first attempt, but not its moment of writing
            days = [r[0] for r in out.select(DATE).distinct().collect()] if table.timed else None
            self.remove_batch(name, batch_id, days)
        out.write.insertInto(self.table(name))

    def may_be_replayed(self, name: str, batch_id: str) -> bool:
        """Whether an earlier attempt may have written a batch to the table: not if this store has
        asked for an earlier batch of the same stream, since a stream goes on only behind a batch
        that it has finished. Remembers the batch."""
        stream, _, number = batch_id.rpartition("-")
        if not number.isdigit():
            return True
        last = self._last.get((name, stream))
        self._last[name, stream] = int(number)
        return last is None or int(number) <= last

    def remove_batch(self, name: str, batch_id: str, days: list[date] | None = None) -> None:
        """Delete whatever an earlier attempt of a batch wrote, on some days or all.

        A file holds rows of one batch, until compaction gives it a batch id of its own; so the
        batch's files go. They are found by the files' own statistics of the batch id.
        """
        rows = self.read(name) if days is None else self.read(name).where(F.col(DATE).isin(days))
        found = rows.where(F.col(BATCH) == batch_id).select("_metadata.file_path")
        files = Files(self.spark)
        for row in found.distinct().collect():  # one attempt's files
            files.delete(row[0])
        self.spark.catalog.refreshTable(self.table(name))

    def register(self) -> TableStore:
        """Make every table available to ``spark.sql`` under its plain name, too."""
        for name in TABLES:
            self.spark.sql(f"CREATE OR REPLACE TEMP VIEW `{name}` AS SELECT * FROM {self.table(name)}")
        return self


def folder_days(spark: SparkSession, folder: str) -> list[date]:
    """Days that have a folder below ``folder``, in order."""
    names = (e.name for e in Files(spark).list(folder))
    values = (n[len(DATE) + 1 :] for n in names if n.startswith(f"{DATE}="))
    return sorted(date.fromisoformat(v) for v in values if not v.startswith("__HIVE"))


def append_jdbc(
    rows: DataFrame, url: str, table: str, properties: dict | None = None, batch_size: int = 100
) -> None:
    """Append rows to a relational table in batches of ``batch_size`` inserts.

    The matching JDBC driver must be on the class path. JSON columns are to be encoded first.
    """
    rows.write.option("batchsize", batch_size).jdbc(
        url, table, mode="append", properties=properties or {}
    )
