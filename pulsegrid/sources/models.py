"""Model table: append-only history of fitted models, or a snapshot with one row per key."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.clock import interval, moment
from ..functions.documents import decode, encode
from ..schemas import MODELS
from .files import Files

KEY = ("method_name", "entity_id", "metric_name")


def newest_models(models: DataFrame, by: str = "saved_at") -> DataFrame:
    """Newest model per key; ties resolve to the greatest.

    One aggregate in one pass: models are few against readings, so that sorting them costs less
    than reading them twice.
    """
    rest = [c for c in models.columns if c not in KEY and c != by]
    newest = models.groupBy(*KEY).agg(F.max(F.struct(by, *rest)).alias("newest"))
    return newest.select(*KEY, "newest.*").select(*models.columns)


def fresh_models(
    models: DataFrame, ttl_seconds: int | None = 900, as_of: Column | datetime | None = None
) -> DataFrame:
    """Models saved within the last ``ttl_seconds``; ``None`` never expires one.

    Training less often than the ttl leaves readings without a model in between.
    """
    if ttl_seconds is None:
        return models
    since = moment(as_of) - interval(f"{ttl_seconds} seconds")
    keep = F.col("saved_at") > since
    if "saved_date" in models.columns:
        keep = keep & (F.col("saved_date") >= F.to_date(since))
    return models.filter(keep)


def upsert_models(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """Stored models with the incoming ones put in; the newest training wins per key."""
    return newest_models(stored.unionByName(incoming), by="trained_at")


def model_key(method: Column, entity: Column, metric: Column) -> Column:
    """Text key of a model in an external key-value store."""
    return F.concat_ws(":", F.lit("anomaly"), F.lit("model"), method, entity, metric)


def to_documents(models: DataFrame) -> DataFrame:
    """(key, value) with the model as JSON text, for export."""
    key = model_key(*(F.col(c) for c in KEY))
    return models.select(key.alias("key"), encode(*MODELS.fieldNames()).alias("value"))


def from_documents(documents: DataFrame) -> DataFrame:
    """Models back from their JSON text."""
    return documents.select(decode(F.col("value"), MODELS).alias("m")).select("m.*")


class ModelStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._log = f"{self.root}/model_log"
        self._snapshots = f"{self.root}/model_snapshots"

    def save(self, models: DataFrame) -> None:
        """Append freshly trained models."""
        models.withColumn("saved_date", F.to_date("saved_at")).write.mode("append").partitionBy(
            "saved_date"
        ).parquet(self._log)

    def load(
        self, method: str, ttl_seconds: int | None = 900, as_of: Column | datetime | None = None
    ) -> DataFrame:
        """Newest unexpired model per key, of those saved until ``as_of``. Call it per micro-batch:
        it lists files anew."""
        if not Files(self.spark).exists(self._log):
            return self.spark.createDataFrame([], MODELS)
        fresh = fresh_models(
            self._logged().filter(F.col("method_name") == method), ttl_seconds, as_of
        )
        if as_of is not None:
            fresh = fresh.filter(F.col("saved_at") <= moment(as_of))
        return newest_models(fresh.select(*MODELS.fieldNames()))

    def _logged(self) -> DataFrame:
        schema = T.StructType(list(MODELS.fields)).add("saved_date", T.DateType())
        return self.spark.read.schema(schema).parquet(self._log)

    def prune(self, as_of: datetime, days: int = 1) -> None:
        """Delete whole days of saved models older than ``days``, so the log stays short.

        A day on which some key was saved last stays, however old it is.
        """
        files, prefix = Files(self.spark), "saved_date="
        oldest = as_of.date() - timedelta(days=days)
        old = [d.name for d in files.list(self._log) if d.name.startswith(prefix)]
        old = [name for name in old if date.fromisoformat(name[len(prefix) :]) < oldest]
        if not old:
            return
        last = self._logged().groupBy(*KEY).agg(F.max("saved_date").alias("day"))
        needed = {f"{prefix}{r.day}" for r in last.select("day").distinct().collect()}  # days
        for name in old:
            if name not in needed:
                files.delete(f"{self._log}/{name}")

    def upsert(self, models: DataFrame) -> None:
        """Write the next snapshot: current models with these put in.

        A snapshot counts once it is complete, so readers never see half of one.
        """
        known = self._complete()
        merged = upsert_models(self.current(), models) if known else newest_models(models)
        number = known[-1] + 1 if known else 0
        merged.write.mode("overwrite").parquet(f"{self._snapshots}/{number:08d}")

    def current(self) -> DataFrame:
        known = self._complete()
        if not known:
            return self.spark.createDataFrame([], MODELS)
        return self.spark.read.schema(MODELS).parquet(f"{self._snapshots}/{known[-1]:08d}")

    def _complete(self) -> list[int]:
        files = Files(self.spark)
        return sorted(
            int(d.name)
            for d in files.list(self._snapshots)
            if d.name.isdigit() and files.exists(f"{self._snapshots}/{d.name}/_SUCCESS")
        )
