"""Ingest: topic -> checked and routed rows -> tables, dead letter, counters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.quality import (
    APPLICATION,
    DEAD,
    MALFORMED,
    SERVER,
    UNKNOWN_TYPE,
    application_records,
    dead_letters,
    route_messages,
    routed_counts,
    server_records,
)
from ..operators.states import STATES, partial_states
from ..sources.tables import TableStore

ROWS_PER_FILE = 250_000
_SINKS = (
    (SERVER, "server_metrics", server_records),
    (APPLICATION, "application_metrics", application_records),
    (DEAD, "dead_letter", dead_letters),
)


def counters_of(counts: dict[tuple[str, str | None], int]) -> dict[str, int]:
    """Ingest counters from messages per (route, reason)."""
    dead = {reason: n for (route, reason), n in counts.items() if route == DEAD}
    return {
        "total_consumed": sum(counts.values()),
        "server_metrics": counts.get((SERVER, None), 0),
        "application_metrics": counts.get((APPLICATION, None), 0),
        "unknown_type": dead.pop(UNKNOWN_TYPE, 0),
        "parse_errors": dead.pop(MALFORMED, 0),
        "insert_errors": sum(dead.values()),
    }


def write_counts(store: TableStore, stream: str, counters: dict[str, int], batch: str) -> None:
    rows = [(stream, name, value) for name, value in counters.items()]
    store.append(
        "stream_counts",
        store.spark.createDataFrame(rows, "stream string, counter string, value long").coalesce(1),
        batch,
    )


def ingest_batch(store: TableStore, messages: DataFrame, batch: str) -> dict[str, int]:
    """Route one micro-batch and write each kind once, with its partial states beside it; kinds
    without rows write nothing.

    The batch is parsed once and kept for its outputs; a lost executor's part is recomputed
    from the source. Its counts are at most one row per rule.
    """
    routed = route_messages(messages).persist()
    try:
        counts = {(r.route, r.reason): r.messages for r in routed_counts(routed).collect()}
        for route, table, records in _SINKS:
            size = sum(n for (to, _), n in counts.items() if to == route)
            if size:
                # The rows are parsed and kept by now: merging partitions costs no parallelism
                # of the parse and saves a file per source task.
                files = -(-size // ROWS_PER_FILE)
                store.append(table, records(routed).coalesce(files), batch)
                for states, (source, key, values) in STATES.items():
                    if source == table:
                        figures = partial_states(records(routed), key, values)
                        store.append(states, figures.coalesce(files), batch)
        counters = counters_of(counts)
        if counters["total_consumed"]:
            write_counts(store, "ingest", counters, batch)
        return counters
    finally:
        routed.unpersist()


def start_ingest(
    messages: DataFrame,
    store: TableStore,
    checkpoint: str,
    stream: str = "ingest",
    trigger_seconds: float = 5.0,
    available_now: bool = False,
) -> StreamingQuery:
    """Run ingest over a stream of ``value`` text.

    A failed write fails its micro-batch, which is retried with the same id and replaces
    whatever its first attempt left. ``available_now`` drains what is there and stops.
    """

    def write(batch: DataFrame, number: int) -> None:
        ingest_batch(store, batch, f"{stream}-{number}")

    writer = messages.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    trigger = (
        {"availableNow": True} if available_now else {"processingTime": f"{trigger_seconds} seconds"}
    )
    return writer.queryName(stream).trigger(**trigger).start()


def totals(store: TableStore, stream: str) -> DataFrame:
    """Counters of a stream summed over its batches."""
    return (
        store.read("stream_counts")
        .filter(F.col("stream") == stream)
        .groupBy("counter")
        .agg(F.sum("value").alias("value"))
    )
