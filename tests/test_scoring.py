"""Scores, severities, and the join strategies behind them."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from pulsegrid.functions.bands import panel_status, severity, severity_rank
from pulsegrid.functions.clock import bucket, bucket_width, seconds
from pulsegrid.operators import lookup
from pulsegrid.operators.scoring import anomaly_records, detection_stats, export_details, score
from pulsegrid.sources import samples
from pulsegrid.sources.models import (
    ModelStore,
    from_documents,
    newest_models,
    to_documents,
)

METRICS = list(samples.BASELINES)


def scored(events, **options):
    servers = samples.server_metrics(events)
    return score(
        servers, samples.baseline_models(servers), METRICS, carry=("event_id",), **options
    )


def test_salted_shuffle_join_equals_broadcast(events):
    kept = scored(events)
    moved = scored(events, broadcast_limit=0, salt_buckets=5)
    plan = moved._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in plan and "_salt" not in kept._jdf.queryExecution().optimizedPlan().toString()
    assert kept.exceptAll(moved).count() == 0 and moved.exceptAll(kept).count() == 0


def test_hot_entity_is_spread_by_the_salt(spark):
    hot = spark.range(4000).select(
        F.lit("hot").alias("entity_id"),
        F.timestamp_seconds(F.col("id") * 7).alias("timestamp"),
    )
    side = spark.createDataFrame([("hot", 1.0)], "entity_id string, x double")
    joined = lookup.lookup_left(hot, side, "entity_id", 1e12, "timestamp", salt_buckets=16)
    assert joined.count() == 4000 and joined.filter("x = 1").count() == 4000
    sizes = (
        hot.selectExpr("pmod(xxhash64(timestamp), 16) AS s").groupBy("s").count().collect()
    )
    assert len(sizes) == 16 and max(r["count"] for r in sizes) < 4000 / 16 * 1.5


def shares(spark):
    """Readings of which a third has one key, a tenth none, and 500 keys hold the rest."""
    key = "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 10 = 1 THEN NULL ELSE concat('k', id % 500) END"
    facts = spark.range(30_000).selectExpr(f"{key} AS entity_id", "timestamp_seconds(id * 7) AS timestamp")
    side = facts.select("entity_id").distinct().where("entity_id <> 'k7'")
    return facts, side.selectExpr("entity_id", "xxhash64(entity_id) AS x")


def test_only_hot_keys_are_copied(spark):
    facts, side = shares(spark)
    assert lookup.hot_keys(facts, "entity_id") == ["hot"]
    assert lookup.hot_keys(facts.limit(0), "entity_id") == []
    left, right = lookup.salted_sides(facts, side, "entity_id", ["hot"], "timestamp", 16)
    assert right.count() == side.count() + 15
    tasks = left.groupBy("entity_id", "_salt").count().collect()
    assert max(r["count"] for r in tasks if r.entity_id in ("hot", None)) < 10_000 / 16 * 1.5
    assert {r["_salt"] for r in tasks if r.entity_id not in ("hot", None)} == {0}


def test_salting_hot_keys_changes_no_row(spark):
    facts, side = shares(spark)
    kept = lookup.lookup_left(facts, side, "entity_id", 0, "timestamp")
    moved = lookup.lookup_left(facts, side, "entity_id", 1e12, "timestamp", salt_buckets=16)
    assert moved.columns == kept.columns and moved.count() == 30_000
    assert kept.exceptAll(moved).count() == 0 and moved.exceptAll(kept).count() == 0
    assert moved.where("x IS NULL").count() == facts.where("entity_id IS NULL OR entity_id = 'k7'").count()


def literal_model(spark, std=2.0, interval=3600, metric="cpu_usage_percent"):
    at = datetime(2025, 1, 1)
    return spark.createDataFrame(
        [("srv-001", metric, [0.0, 1.0, 2.0], 10.0, 0.5, at, 0.0, std, interval)],
        "entity_id string, metric_name string, seasonal_pattern array<double>, "
        "trend_last_value double, trend_slope double, trend_last_timestamp timestamp, "
        "residual_mean double, residual_std double, interval_seconds int",
    )


def readings(spark, *values, at=datetime(2025, 1, 1, 4, 30)):
    return spark.createDataFrame(
        [("srv-001", at, v) for v in values],
        "server_id string, timestamp timestamp, cpu_usage_percent double",
    )


def test_prediction_arithmetic(spark):
    row = score(readings(spark, 20.0), literal_model(spark), METRICS).first()
    # 4.5 periods at 0.5, slot 4 of a cycle of 3
    assert row.trend == pytest.approx(12.25) and row.seasonal == 1.0
    assert row.expected_value == pytest.approx(13.25) and row.residual == pytest.approx(6.75)
    assert row.z_score == pytest.approx(3.375) and row.anomaly_score == pytest.approx(0.675)
    assert row.is_anomaly


def test_threshold_is_strict_and_score_is_capped(spark):
    exact = score(readings(spark, 13.25 + 6.0), literal_model(spark), METRICS).first()
    assert exact.z_score == 3.0 and not exact.is_anomaly
    far = score(readings(spark, 1000.0), literal_model(spark), METRICS).first()
    assert far.anomaly_score == 1.0 and far.is_anomaly
    below = score(readings(spark, 0.0), literal_model(spark), METRICS).first()
    assert below.z_score < -3 and below.is_anomaly


@pytest.mark.parametrize("options", [{"std": 0.0}, {"interval": 30}])
def test_undefined_scores_are_no_anomalies(spark, options):
    found = score(readings(spark, 50.0), literal_model(spark, **options), METRICS)
    row = found.first()
    assert row.model_found and row.z_score is None and not row.is_anomaly
    stats = detection_stats(found).first()
    assert (stats.total_analyzed, stats.undefined_scores, stats.models_not_found) == (1, 1, 0)


def test_null_metric_and_missing_model(spark):
    found = score(readings(spark, None, 5.0), literal_model(spark, metric="other"), METRICS)
    assert [(r.actual_value, r.model_found) for r in found.collect()] == [(5.0, False)]


def test_details_as_json(spark):
    record = export_details(
        anomaly_records(score(readings(spark, 20.0), literal_model(spark), METRICS))
    ).first()
    assert '"metric_name":"cpu_usage_percent"' in record.details
    assert '"z_score":3.375' in record.details


def test_bands(spark):
    scores = [0.39, 0.4, 0.59, 0.6, 0.79, 0.8, 1.0]
    df = spark.createDataFrame([(s,) for s in scores], "s double")
    got = [r[0] for r in df.select(severity(F.col("s"))).collect()]
    assert got == ["low", "medium", "medium", "high", "high", "critical", "critical"]
    names = spark.createDataFrame([("low",), ("critical",), ("odd",)], "n string")
    assert [r[0] for r in names.select(severity_rank(F.col("n"))).collect()] == [4, 1, None]
    values = spark.createDataFrame([(59.9,), (60.0,), (80.0,), (None,), (-5.0,)], "v double")
    got = [r[0] for r in values.select(panel_status(F.col("v"), "cpu_usage_percent")).collect()]
    assert got == ["green", "yellow", "red", None, "green"]


def test_bucket_widths(spark):
    assert bucket_width("15min") == "15 minutes" and bucket_width("nonsense") == "5 minutes"
    assert seconds("2 hours") == 7200
    for bad in ("1 month", "five minutes", "0 seconds"):
        with pytest.raises(ValueError):
            seconds(bad)
    at = spark.createDataFrame([(datetime(2025, 1, 1, 13, 7),)], "t timestamp")
    assert at.select(bucket("t", "1 week")).first()[0] == datetime(2024, 12, 30)  # a Monday
    assert at.select(bucket("t", "5 minutes")).first()[0] == datetime(2025, 1, 1, 13, 5)


def test_model_store(spark, events, tmp_path):
    servers = samples.server_metrics(events)
    weekly = samples.weekly_models(servers)
    stamps = ("trained_at", "saved_at", "trend_last_timestamp", "training_start", "training_end")
    weekly = weekly.withColumns({c: F.col(c).cast("timestamp") for c in stamps})
    store = ModelStore(spark, str(tmp_path))
    assert store.load("stl_zscore").count() == 0 and store.current().count() == 0
    store.save(weekly)
    newest = newest_models(weekly)
    loaded = store.load("stl_zscore", ttl_seconds=None)
    assert loaded.count() == newest.count() == weekly.select("entity_id", "metric_name").distinct().count()
    assert store.load("other", ttl_seconds=None).count() == 0
    assert store.load("stl_zscore", ttl_seconds=900).count() == 0  # saved in 2024
    last = weekly.agg(F.max("saved_at")).first()[0]
    assert store.load("stl_zscore", 900, last + timedelta(seconds=899)).count() > 0
    assert store.load("stl_zscore", 900, last + timedelta(seconds=900)).count() == 0
    cut = last - timedelta(days=7)
    store.prune(last, days=7)
    kept = store.load("stl_zscore", None, last)
    assert kept.count() == newest.filter(F.col("saved_at") >= F.lit(cut)).count() > 0
    store.upsert(weekly.filter(F.col("trained_at") <= F.lit(cut)))
    before = store.current().count()
    store.upsert(weekly)
    assert store.current().count() == newest.count() >= before
    assert store.current().exceptAll(newest.select(*store.current().columns)).count() == 0
    back = from_documents(to_documents(weekly))
    assert back.exceptAll(weekly).count() == 0 and back.count() == weekly.count()
    assert to_documents(weekly).first().key.startswith("anomaly:model:stl_zscore:srv-")
