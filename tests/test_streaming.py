"""Streams: routing, replay, restart, detection parity, rollups, and care of the tables."""

import json
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from pulsegrid.config import DetectionConfig, TopicConfig
from pulsegrid.functions.clock import format_iso
from pulsegrid.operators import quality
from pulsegrid.operators.scoring import anomaly_records, score
from pulsegrid.plans import maintenance, rollups
from pulsegrid.plans.views import register_views
from pulsegrid.sources import samples, topics
from pulsegrid.sources.models import MODELS, ModelStore
from pulsegrid.sources.tables import TABLES, TableStore
from pulsegrid.streaming import detection, ingest, rollup

SERVER = {"type": "server_metric", "timestamp": "2025-10-02T12:00:00Z", "server_id": "srv-001",
          "cpu_usage_percent": 75.0}
APPLICATION = {"type": "application_metric", "timestamp": "2025-10-02T12:00:00+02:00",
               "service_name": "api-gateway", "request_rate_per_sec": 100.0, "error_count": 3}


def lines(folder, name, *messages):
    Path(folder).mkdir(exist_ok=True, parents=True)
    text = "\n".join(m if isinstance(m, str) else json.dumps(m) for m in messages)
    (Path(folder) / name).write_text(text)


def values(spark, *messages):
    return spark.createDataFrame(
        [(m if isinstance(m, str) else json.dumps(m),) for m in messages], "value string"
    )


def drain(query):
    query.awaitTermination(120)
    assert query.exception() is None


@pytest.mark.parametrize(
    "message,route,reason",
    [
        (SERVER, "server_metric", None),
        (APPLICATION, "application_metric", None),
        ({"type": "unknown_type", "data": "something"}, "dead_letter", "unknown_type"),
        ({"data": "invalid"}, "dead_letter", "unknown_type"),
        ('{"type": "server_me', "dead_letter", "malformed_json"),
        ("[1, 2]", "dead_letter", "malformed_json"),
        ({**SERVER, "cpu_usage_percent": None}, "server_metric", None),
        ({**SERVER, "cpu_usage_percent": "abc"}, "dead_letter", "malformed_json"),
        ({**SERVER, "cpu_usage_percent": 101}, "dead_letter", "cpu_usage_percent_out_of_range"),
        ({**SERVER, "timestamp": None}, "dead_letter", "timestamp_missing"),
        ({**SERVER, "timestamp": "yesterday at noon"}, "dead_letter", "timestamp_missing"),
        ({**SERVER, "server_id": "x" * 51}, "dead_letter", "server_id_too_long"),
        ({**APPLICATION, "service_name": None}, "dead_letter", "service_name_missing"),
        ({**APPLICATION, "error_rate_percent": -1}, "dead_letter", "error_rate_percent_out_of_range"),
    ],
)
def test_routing(spark, message, route, reason):
    row = quality.route_messages(values(spark, message)).first()
    assert (row.route, row.reason) == (route, reason)


def test_routed_records_have_the_stored_shape(spark):
    routed = quality.route_messages(values(spark, SERVER, APPLICATION))
    server = quality.server_records(routed)
    assert server.columns == TABLES["server_metrics"].schema.fieldNames()
    row = server.first()
    assert row.timestamp == datetime(2025, 10, 2, 12) and row.fan_speed_rpm is None
    application = quality.application_records(routed).first()
    assert application.timestamp == datetime(2025, 10, 2, 10) and application.error_count == 3


def test_ingest_batch_counts_and_replay(spark, tmp_path):
    store = TableStore(spark, str(tmp_path)).create()
    batch = values(
        spark, SERVER, {**SERVER, "cpu_usage_percent": 101}, APPLICATION, {"data": 1}, "{oops"
    )
    counters = ingest.ingest_batch(store, batch, "ingest-0")
    assert counters == {
        "total_consumed": 5, "server_metrics": 1, "application_metrics": 1,
        "unknown_type": 1, "parse_errors": 1, "insert_errors": 1,
    }
    ingest.ingest_batch(store, batch, "ingest-0")  # replay replaces itself
    assert store.read("server_metrics").count() == 1
    assert store.read("application_metrics").count() == 1
    assert store.read("dead_letter").count() == 3
    ingest.ingest_batch(store, batch, "ingest-1")
    assert store.read("server_metrics").count() == 2
    totals = {r.counter: r.value for r in ingest.totals(store, "ingest").collect()}
    assert totals["total_consumed"] == 10 and totals["insert_errors"] == 2
    assert store.read("server_metrics").filter("created_at IS NULL").count() == 0


def test_empty_batch_writes_nothing(spark, tmp_path):
    store = TableStore(spark, str(tmp_path)).create()
    empty = spark.createDataFrame([], "value string")
    assert ingest.ingest_batch(store, empty, "ingest-0")["total_consumed"] == 0
    shelf = ModelStore(spark, str(tmp_path / "models"))
    assert detection.detect_batch(store, shelf, empty, DetectionConfig(), "d-0")["total_consumed"] == 0
    assert store.read("server_metrics").count() == store.read("stream_counts").count() == 0


def test_ingest_stream_restarts_where_it_stopped(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "lake")).create()
    source, checkpoint = str(tmp_path / "topic"), str(tmp_path / "checkpoint")
    lines(source, "a.json", SERVER, APPLICATION, "{oops")
    for _ in range(2):
        stream = topics.folder_stream(spark, source)
        drain(ingest.start_ingest(stream, store, checkpoint, available_now=True))
    assert store.read("server_metrics").count() == 1
    lines(source, "b.json", SERVER, {**SERVER, "server_id": "srv-002"})
    stream = topics.folder_stream(spark, source)
    drain(ingest.start_ingest(stream, store, checkpoint, available_now=True))
    assert store.read("server_metrics").count() == 3
    assert store.read("dead_letter").count() == 1
    register_views(store)
    assert spark.table("recent_server_health").count() == 0  # nothing that young
    assert spark.table("active_anomalies").columns[0] == "entity_type"
    found = spark.sql(
        "SELECT count(*) AS n FROM server_metrics WHERE server_id = :id", args={"id": "srv-002"}
    )
    assert found.first().n == 1


def test_stream_and_batch_find_the_same_anomalies(spark, events, tmp_path):
    servers = samples.server_metrics(events)
    stamps = [f.name for f in MODELS.fields if f.dataType.typeName() == "timestamp"]
    models = samples.baseline_models(servers, ("srv-009", "srv-010")).withColumns(
        {c: F.col(c).cast("timestamp") for c in stamps}
    )
    store = TableStore(spark, str(tmp_path / "lake")).create()
    shelf = ModelStore(spark, str(tmp_path / "models"))
    shelf.save(models)
    source = str(tmp_path / "topic")
    messages = servers.select(
        F.lit("server_metric").alias("type"),
        format_iso(F.col("timestamp").cast("timestamp")).alias("timestamp"),
        "server_id", *samples.BASELINES,
    )
    topics.write_folder(messages.repartition(3), source)
    lines(source, "noise.json", APPLICATION, "{oops", {**SERVER, "timestamp": "never"})
    config = DetectionConfig(model_ttl_seconds=None)
    stream = topics.folder_stream(spark, source, max_files_per_trigger=2)
    drain(
        detection.start_detection(
            stream, store, shelf, config, str(tmp_path / "cp"), available_now=True
        )
    )
    expected = anomaly_records(
        score(servers.withColumn("timestamp", F.col("timestamp").cast("timestamp")), models,
              list(config.metrics))
    )
    got = store.read("anomalies").select(*expected.columns)
    assert got.count() == expected.count() > 0
    assert got.exceptAll(expected).count() == 0
    totals = {r.counter: r.value for r in ingest.totals(store, "detection").collect()}
    assert totals["anomalies_detected"] == expected.count()
    assert totals["total_analyzed"] == 3 * servers.count() and totals["models_not_found"] > 0
    assert totals["total_consumed"] == servers.count() + 3 and totals["parse_errors"] == 2
    assert store.read("anomalies").filter("NOT resolved").count() == expected.count()


def test_expired_models_find_nothing(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "lake")).create()
    shelf = ModelStore(spark, str(tmp_path / "models"))
    counts = detection.detect_batch(store, shelf, values(spark, SERVER), DetectionConfig(), "d-0")
    assert counts["total_analyzed"] == counts["models_not_found"] == 1
    assert store.read("anomalies").count() == 0


def readings(spark, *rows):
    return spark.createDataFrame(rows, "timestamp timestamp, server_id string, cpu_usage_percent double")


def test_hourly_rollup_stream_matches_batch(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "lake")).create()
    t0 = datetime(2025, 10, 2)
    rows = [(t0 + timedelta(minutes=7 * i), f"srv-{i % 3}", float(i % 50)) for i in range(200)]
    store.append("server_metrics", readings(spark, *rows[:120]), "a-0")
    store.append("server_metrics", readings(spark, *rows[120:]), "a-1")
    stream = spark.readStream.schema(store.read("server_metrics").schema).parquet(
        store.path("server_metrics")
    )
    hourly = rollup.hourly_stream(stream, "server_id", rollups.server_measures())
    path, checkpoint = str(tmp_path / "hourly"), str(tmp_path / "cp")
    drain(rollup.start_rollup(hourly, path, checkpoint, "hourly", available_now=True))
    closed = rows[-1][0] - timedelta(hours=3)
    batch = rollups.server_hourly(store.read("server_metrics"))
    expected = batch.filter(F.col("hour") + F.expr("INTERVAL 1 HOUR") <= F.lit(closed))
    got = rollups.read_rollup(spark, path).select(*expected.columns)
    assert got.count() == expected.count() > 0 and got.exceptAll(expected).count() == 0


def test_refresh_replaces_only_its_hours(spark, tmp_path):
    t0, path = datetime(2025, 10, 2), str(tmp_path / "hourly")
    rows = [(t0 + timedelta(minutes=10 * i), "srv-1", 1.0) for i in range(72)]
    source = readings(spark, *rows)
    for name in ("memory_usage_percent", "cpu_temperature_celsius", "power_consumption_watts"):
        source = source.withColumn(name, F.lit(0.0))
    rollups.write_rollup(rollups.server_hourly(source), path)
    changed = source.withColumn("cpu_usage_percent", F.lit(9.0))
    as_of = t0 + timedelta(hours=8, minutes=30)
    window = rollups.refresh_window(changed, as_of)
    assert window.agg(F.min("timestamp"), F.max("timestamp")).first() == (
        t0 + timedelta(hours=6), t0 + timedelta(hours=6, minutes=50),
    )
    rollups.write_rollup(rollups.server_hourly(window), path)
    got = {r.hour.hour: r.avg_cpu for r in rollups.read_rollup(spark, path).collect()}
    assert got == {h: 9.0 if h == 6 else 1.0 for h in range(12)}
    on_the_hour = rollups.refresh_window(changed, t0 + timedelta(hours=8))
    assert on_the_hour.agg(F.min("timestamp"), F.max("timestamp")).first() == (
        t0 + timedelta(hours=5), t0 + timedelta(hours=6, minutes=50),
    )


def test_rollups_of_a_store(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "lake")).create()
    t0 = datetime(2025, 10, 2)
    store.append("server_metrics", readings(spark, (t0, "srv-1", 1.0)), "a-0")
    later = readings(spark, (t0 + timedelta(hours=5), "srv-1", 7.0), (t0, "srv-1", 3.0))
    rollups.build_rollups(store)
    store.append("server_metrics", later, "a-1")
    rollups.refresh_rollups(store, t0 + timedelta(hours=7))
    got = rollups.read_rollup(spark, f"{store.root}/server_metrics_hourly").collect()
    # Hour 0 lies before the refresh window and keeps its first figures.
    assert {(r.hour.hour, r.avg_cpu, r.sample_count) for r in got} == {(0, 1.0, 1), (5, 7.0, 1)}


def test_topic_options():
    config = TopicConfig(starting_offsets="latest", max_records_per_trigger=500)
    options = topics.read_options(config)
    assert options["subscribe"] == "datacenter-metrics"
    assert options["startingOffsets"] == "latest" and options["maxOffsetsPerTrigger"] == "500"
    assert topics.write_options(config)["kafka.compression.type"] == "gzip"
    assert TopicConfig().starting_offsets == "earliest"
    assert DetectionConfig().topic.starting_offsets == "latest"
    with pytest.raises(ValueError):
        TopicConfig(starting_offsets="middle")


def test_messages_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a", 1.5)], "server_id string, x double")
    topics.write_folder(df, str(tmp_path / "t"))
    assert json.loads(spark.read.text(str(tmp_path / "t")).first().value) == {"server_id": "a", "x": 1.5}
    assert any(p.suffix == ".gz" for p in (tmp_path / "t").iterdir())


def test_rule_sets_match_the_stored_columns():
    for name, rules in (("server_metrics", quality.server_rules()),
                        ("application_metrics", quality.application_rules()),
                        ("predictions", quality.prediction_rules()),
                        ("anomalies", quality.anomaly_rules())):
        fields = TABLES[name].schema.fieldNames()
        assert all(any(rule.name.startswith(f) for f in fields) for rule in rules)


def test_rollup_files_and_names(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "lake")).create()
    t0 = datetime(2025, 10, 2)
    rows = [(t0 + timedelta(minutes=m), f"srv-{m % 9}", 1.0) for m in range(0, 600, 3)]
    store.append("server_metrics", readings(spark, *rows), "a-0")
    rollups.build_rollups(store)
    folder = tmp_path / "lake" / "server_metrics_hourly"
    for hour in folder.glob("event_date=*/event_hour=*"):
        assert len(list(hour.glob("*.parquet"))) == 1
    register_views(store)
    ask = "SELECT count(*) AS n, sum(sample_count) AS rows FROM server_metrics_hourly"
    assert spark.sql(ask).first().n == 0
    rollups.rebuild_states(store, "server_states")  # readings that no ingest has seen
    assert tuple(spark.sql(ask).first()) == (30, 200)
    assert spark.sql("SELECT * FROM application_metrics_hourly").count() == 0


def test_prune_keeps_a_keys_only_model(spark, events, tmp_path):
    stamps = ("trained_at", "saved_at", "trend_last_timestamp", "training_start", "training_end")
    weekly = samples.weekly_models(samples.server_metrics(events))
    weekly = weekly.withColumns({c: F.col(c).cast("timestamp") for c in stamps})
    store = ModelStore(spark, str(tmp_path))
    store.save(weekly)
    before = store.load("stl_zscore", ttl_seconds=None)
    kept = before.collect()
    store.prune(datetime(2030, 1, 1))
    after = store.load("stl_zscore", ttl_seconds=None)
    assert sorted(map(str, after.collect())) == sorted(map(str, kept)) and kept


def trained(spark):
    events = samples.read_events(spark, "/root/testdata/sf0.001")
    models = samples.baseline_models(samples.server_metrics(events))
    stamps = [c for c, t in models.dtypes if t.startswith("timestamp")]
    models = models.withColumns({c: F.col(c).cast("timestamp") for c in stamps})
    return samples.messages(events), models


def test_replay_after_retraining_finds_the_same(spark, tmp_path):
    """A replayed batch is scored with the models of its first attempt, by whatever process."""
    lake, shelf = str(tmp_path / "lake"), ModelStore(spark, str(tmp_path / "models"))
    config = DetectionConfig(model_ttl_seconds=None)
    texts, models = trained(spark)
    shelf.save(models)
    store = TableStore(spark, lake).create()
    first = detection.detect_batch(store, shelf, texts, config, "d-0")
    columns = ["timestamp", "entity_id", "anomaly_type", "severity", "anomaly_score"]
    found = sorted(map(str, store.read("anomalies").select(columns).collect()))
    assert len(found) == first["anomalies_detected"] > 0
    shelf.save(models.withColumns({"residual_std": F.lit(1e9), "saved_at": F.current_timestamp()}))
    restarted = TableStore(spark, lake).create()
    assert detection.detect_batch(restarted, shelf, texts, config, "d-0") == first
    assert sorted(map(str, store.read("anomalies").select(columns).collect())) == found
    later = detection.detect_batch(restarted, shelf, texts, config, "d-1")
    assert later["anomalies_detected"] == 0 and store.read("anomalies").count() == len(found)
    counts = {r.counter: r.value for r in ingest.totals(store, "detection").collect()}
    assert counts["total_consumed"] == 2 * texts.count()


def test_a_replay_without_a_pin_leaves_nothing_stale(spark, tmp_path, monkeypatch):
    store = TableStore(spark, str(tmp_path / "lake")).create()
    shelf = ModelStore(spark, str(tmp_path / "models"))
    config = DetectionConfig(model_ttl_seconds=None)
    texts, models = trained(spark)
    shelf.save(models)
    assert detection.detect_batch(store, shelf, texts, config, "d-0")["anomalies_detected"] > 0
    store.remove_batch("model_pins", "d-0")
    shelf.save(models.withColumns({"residual_std": F.lit(1e9), "saved_at": F.current_timestamp()}))
    assert detection.detect_batch(store, shelf, texts, config, "d-0")["anomalies_detected"] == 0
    assert store.read("anomalies").count() == 0


def test_counters_are_observed_where_nothing_is_scored(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "lake")).create()
    shelf = ModelStore(spark, str(tmp_path / "models"))
    counts = detection.detect_batch(store, shelf, values(spark, APPLICATION, "{oops"), DetectionConfig(), "d-0")
    assert counts == {
        "total_consumed": 2, "parse_errors": 1, "total_analyzed": 0, "models_not_found": 0,
        "undefined_scores": 0, "anomalies_detected": 0,
    }


def test_a_batch_is_scored_once(spark, tmp_path, monkeypatch):
    store = TableStore(spark, str(tmp_path / "lake")).create()
    shelf = ModelStore(spark, str(tmp_path / "models"))
    texts, models = trained(spark)
    shelf.save(models)
    seen = spark.sparkContext.accumulator(0)

    def counted(rows):
        for batch in rows:
            seen.add(batch.num_rows)
            yield batch

    passed = texts.mapInArrow(counted, texts.schema)
    detection.detect_batch(store, shelf, passed, DetectionConfig(model_ttl_seconds=None), "d-0")
    # once for the scores, and part of one batch to see that it is not empty
    assert texts.count() <= seen.value < 2 * texts.count()


def test_anomalies_that_break_a_rule_go_to_the_dead_letter(spark, tmp_path, monkeypatch):
    store = TableStore(spark, str(tmp_path / "lake")).create()
    shelf = ModelStore(spark, str(tmp_path / "models"))
    events = samples.read_events(spark, "/root/testdata/sf0.001")
    models = samples.baseline_models(samples.server_metrics(events))
    stamps = [c for c, t in models.dtypes if t.startswith("timestamp")]
    shelf.save(models.withColumns({c: F.col(c).cast("timestamp") for c in stamps}))
    rules = [*quality.anomaly_rules(), quality.max_length("entity_id", 6)]
    monkeypatch.setattr(detection, "anomaly_rules", lambda: rules)
    config = DetectionConfig(model_ttl_seconds=None)
    counts = detection.detect_batch(store, shelf, samples.messages(events), config, "d-0")
    letters = store.read("dead_letter")
    assert letters.count() == counts["anomalies_detected"] > 0 == store.read("anomalies").count()
    assert letters.where("raw LIKE '%entity_id%' AND reason LIKE 'entity_id%'").count() == letters.count()


def test_a_question_about_one_hour_opens_one_day(spark, tmp_path):
    store = TableStore(spark, str(tmp_path)).create()
    t0 = datetime(2025, 10, 1)
    for batch in range(3):
        rows = [(t0 + timedelta(days=d, hours=batch), "srv-1", float(d)) for d in range(20)]
        store.append("server_metrics", readings(spark, *rows).coalesce(1), f"a-{batch}")
    day = (t0 + timedelta(days=7)).date()
    found = store.read("server_metrics", day, day)
    assert len(found.inputFiles()) == 3 and len(store.read("server_metrics").inputFiles()) >= 60
    assert found.where(F.hour("timestamp") == 1).count() == 1
    assert store.read("server_metrics", since=day).select("event_date").distinct().count() == 13
    assert store.read("server_metrics", until=t0.date() - timedelta(days=1)).count() == 0


def test_every_table_is_kept_up(spark, tmp_path):
    """Dead letters and counters have days as well: replayed, folded and dropped like the others."""
    store = TableStore(spark, str(tmp_path)).create()
    batch = values(spark, SERVER, "{oops")
    for number in (0, 0, 1):
        ingest.ingest_batch(store, batch, f"ingest-{number}")
    assert store.read("dead_letter").count() == 2
    later = datetime.now() + timedelta(days=30)
    for name in ("dead_letter", "stream_counts"):
        before = store.read(name).count()
        assert maintenance.compact(store, name, later, settle=timedelta(days=-9999))
        assert store.read(name).count() == before
        assert maintenance.drop_expired(store, name, later, days=7)
        assert store.read(name).count() == 0
