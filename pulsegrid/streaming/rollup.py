"""Hourly rollups kept up by a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.states import STATES, partial_states
from ..plans.rollups import write_rollup
from ..sources.tables import TableStore


def hourly_stream(
    rows: DataFrame, key: str, measures: Sequence[Column], lateness: str = "3 hours"
) -> DataFrame:
    """Hours as they close: each is emitted once, when the stream is ``lateness`` past its end.

    State is one row per open hour and key. Rows later than that are not in the rollup, though
    ingest stores them, and their partial states: ``hourly_from_states`` misses none.
    """
    return (
        rows.withWatermark("timestamp", lateness)
        .groupBy(F.window("timestamp", "1 hour"), key)
        .agg(*measures)
        .withColumn("hour", F.col("window.start"))
        .drop("window")
    )


def start_rollup(
    hourly: DataFrame, path: str, checkpoint: str, stream: str, available_now: bool = False
) -> StreamingQuery:
    """Write closed hours; a replayed batch replaces the same hours."""

    def write(batch: DataFrame, number: int) -> None:
        write_rollup(batch, path)

    writer = (
        hourly.writeStream.outputMode("append")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .queryName(stream)
    )
    trigger = {"availableNow": True} if available_now else {"processingTime": "1 minute"}
    return writer.trigger(**trigger).start()


def start_states(
    rows: DataFrame,
    store: TableStore,
    name: str,
    checkpoint: str,
    stream: str,
    available_now: bool = False,
) -> StreamingQuery:
    """Keep the partial states ``name`` of a stream of readings, for tables that ingest does not
    fill. Every batch stores its own: rows of any age count, and a replayed batch counts once."""
    _, key, values = STATES[name]

    def write(batch: DataFrame, number: int) -> None:
        store.append(name, partial_states(batch, key, values), f"{stream}-{number}")

    writer = (
        rows.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .queryName(stream)
    )
    trigger = {"availableNow": True} if available_now else {"processingTime": "1 minute"}
    return writer.trigger(**trigger).start()
