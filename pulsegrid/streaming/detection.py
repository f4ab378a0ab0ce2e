"""Detection: topic -> server readings -> scores against fresh models -> anomalies."""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..config import DetectionConfig
from ..operators.methods import make_detector
from ..operators.quality import SERVER, anomaly_rules, parse_messages, split
from ..operators.scoring import anomaly_records, counters
from ..sources.models import ModelStore
from ..sources.tables import TableStore
from .ingest import ROWS_PER_FILE, write_counts


def message_counters() -> dict[str, Column]:
    """Counters over parsed messages, for ``agg``."""
    unreadable = F.col("_corrupt_record").isNotNull()
    undated = (F.col("type") == SERVER) & F.col("timestamp").isNull()
    return {
        "total_consumed": F.count("*"),
        "parse_errors": F.count_if(F.coalesce(unreadable | undated, F.lit(False))),
    }


def server_readings(parsed: DataFrame) -> DataFrame:
    """Server records among parsed messages; other kinds and unreadable ones drop out.

    A NULL metric drops that metric only; the reading's other metrics are still scored.
    """
    return parsed.filter(
        (F.col("type") == SERVER)
        & F.col("_corrupt_record").isNull()
        & F.col("timestamp").isNotNull()
    )


def pinned_moment(store: TableStore, batch: str) -> Column:
    """The moment whose models score a batch: now, or, if the batch was begun before, that of its
    first attempt. It is on record before anything is scored, so a replay scores alike whatever was
    trained in between."""
    if store.may_be_replayed("model_pins", batch):
        known = store.read("model_pins").filter(F.col("stream_batch") == batch)
        micros = known.agg(F.unix_micros(F.min("as_of"))).first()[0]
        if micros is not None:
            return F.timestamp_micros(F.lit(micros))
    micros = time.time_ns() // 1000
    pin = store.spark.range(1).select(
        F.lit(batch).alias("stream_batch"), F.timestamp_micros(F.lit(micros)).alias("as_of")
    )
    store.append("model_pins", pin, batch, replayed=False)
    return F.timestamp_micros(F.lit(micros))


def detect_batch(
    store: TableStore,
    models: ModelStore,
    messages: DataFrame,
    config: DetectionConfig,
    batch: str,
) -> dict[str, int]:
    """Score one micro-batch and write its anomalies; those that break a rule of their table go
    to the dead letter.

    Models are read here, per batch, so that retraining takes effect without a restart. Messages
    are parsed and scored once: the counters are observed on the way, and of the result only the
    anomalies are kept until they are written.
    """
    if messages.isEmpty():
        return {name: 0 for name in (*message_counters(), *counters())}
    method = make_detector(config.method_name, config.method_config)
    moment = pinned_moment(store, batch)
    fresh = models.load(method.name, config.model_ttl_seconds, moment).persist()
    parsed, read = _observed(parse_messages(messages), message_counters())
    scored, judged = _observed(
        method.predict(server_readings(parsed), fresh, list(config.metrics)), counters()
    )
    found = anomaly_records(scored, method.name).persist()
    try:
        written = found.count()
        counts = read.get | judged.get
        if store.may_be_replayed("anomalies", batch):
            store.remove_batch("anomalies", batch)
        if written:
            kept, refused = split(found.coalesce(-(-written // ROWS_PER_FILE)), anomaly_rules())
            store.append("anomalies", kept, batch, replayed=False)
            letters = refused.select(
                F.to_json(F.struct(*found.columns)).alias("raw"), "reason"
            ).coalesce(1)
            store.append("dead_letter", letters, batch)
        write_counts(store, "detection", counts, batch)
        return counts
    finally:
        found.unpersist()
        fresh.unpersist()


def _observed(df: DataFrame, columns: dict[str, Column]) -> tuple[DataFrame, Observation]:
    observation = Observation()
    return df.observe(observation, *(c.alias(name) for name, c in columns.items())), observation


def start_detection(
    messages: DataFrame,
    store: TableStore,
    models: ModelStore,
    config: DetectionConfig,
    checkpoint: str,
    stream: str = "detection",
    available_now: bool = False,
) -> StreamingQuery:
    """Run detection over a stream of ``value`` text, with its own position in the topic."""

    def write(batch: DataFrame, number: int) -> None:
        detect_batch(store, models, batch, config, f"{stream}-{number}")

    writer = messages.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    trigger = (
        {"availableNow": True}
        if available_now
        else {"processingTime": f"{config.trigger_seconds} seconds"}
    )
    return writer.queryName(stream).trigger(**trigger).start()
