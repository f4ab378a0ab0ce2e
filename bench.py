"""Time the registered queries and the streaming paths; print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS the local cores.
"""

from __future__ import annotations

import json
import os
import tempfile
import time
from pathlib import Path

from pyspark.sql import functions as F

from checks import QUERIES
from pulsegrid.config import DetectionConfig
from pulsegrid.session import build_session
from pulsegrid.sources import samples, topics
from pulsegrid.sources.models import MODELS, ModelStore
from pulsegrid.sources.tables import TableStore
from pulsegrid.streaming.detection import start_detection
from pulsegrid.streaming.ingest import start_ingest

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def streaming(spark, folder: str, scratch: str) -> dict[str, float]:
    """Events per second from topic files to tables, and from topic files to anomalies."""
    events = samples.read_events(spark, folder)
    source, count = f"{scratch}/topic", events.count()
    samples.messages(events).repartition(int(CPUS)).write.text(source)
    store = TableStore(spark, f"{scratch}/lake").create()
    stamps = [f.name for f in MODELS.fields if f.dataType.typeName() == "timestamp"]
    models = ModelStore(spark, f"{scratch}/models")
    models.save(
        samples.baseline_models(samples.server_metrics(events)).withColumns(
            {c: F.col(c).cast("timestamp") for c in stamps}
        )
    )

    def ingest():
        stream = topics.folder_stream(spark, source)
        start_ingest(stream, store, f"{scratch}/cp1", available_now=True).awaitTermination()

    def detect():
        stream = topics.folder_stream(spark, source)
        start_detection(
            stream,
            store,
            models,
            DetectionConfig(model_ttl_seconds=None),
            f"{scratch}/cp2",
            available_now=True,
        ).awaitTermination()

    ingest_seconds, detect_seconds = timed(ingest), timed(detect)
    return {
        "stream_ingest_sec": ingest_seconds,
        "stream_ingest_events_per_sec": round(count / ingest_seconds),
        "stream_detect_sec": detect_seconds,
        "stream_detect_events_per_sec": round(count / detect_seconds),
    }


def main() -> None:
    scratch = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark = build_session(
        "bench",
        f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": CPUS,
            "spark.driver.memory": "16g",
            "spark.checkpoint.dir": f"{scratch}/shared",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name):
        QUERIES[name](spark, FOLDER).write.format("noop").mode("overwrite").save()

    run("cpu_by_rack")  # starts the JVM's and Python's machinery
    run("train_models")
    seconds = {name: timed(lambda n=name: run(n)) for name in QUERIES}
    extra = streaming(spark, FOLDER, scratch)
    print(
        json.dumps(
            {
                "metric": "total seconds over all registered queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(FOLDER).name.removeprefix("sf"),
                "cpus": int(CPUS),
                **extra,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
