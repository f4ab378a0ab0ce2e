"""Fits, their outcomes, and detection with what they learned."""

from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from pulsegrid.config import DetectionConfig, StlConfig
from pulsegrid.operators import fitting, series
from pulsegrid.operators.methods import StlZscore, detector, detectors, make_detector
from pulsegrid.operators.scoring import anomaly_records, score
from pulsegrid.plans import training

START = datetime(2025, 9, 1)
METRIC = "cpu_usage_percent"


def made(spark, entity, n, noise=0.0, step=300, start=START, level=20.0, keep=None):
    t = np.arange(n)
    values = level + 0.001 * t + 5 * np.sin(2 * np.pi * t / 288)
    if noise:
        values = values + np.random.default_rng(7).normal(scale=noise, size=n)
    frame = pd.DataFrame(
        {
            "server_id": entity,
            "timestamp": [start + timedelta(seconds=step * int(i)) for i in t],
            METRIC: values,
        }
    )
    return spark.createDataFrame(frame if keep is None else frame[keep(t)])


def long(df):
    return series.to_long(
        df.withColumnRenamed("server_id", "entity_id"), ["entity_id", "timestamp"], [METRIC]
    )


def fitted(spark, df, skip_below=100, **config):
    return fitting.fit_series(long(df), StlConfig(**config), skip_below)


def test_components_of_a_clean_series(spark):
    row = fitted(spark, made(spark, "srv-001", 4032)).first()
    assert row.status == "ok" and row.n_training_points == 4032
    assert row.interval_seconds == 300 and len(row.seasonal_pattern) == 288
    assert row.trend_slope == pytest.approx(0.001, abs=1e-6)
    assert row.trend_last_value == pytest.approx(20 + 0.001 * 4031, abs=1e-6)
    assert abs(row.residual_mean) < 1e-9 and row.residual_std < 1e-9
    assert row.training_start == START
    assert row.training_end == row.trend_last_timestamp == START + timedelta(seconds=300 * 4031)
    expected = 5 * np.sin(2 * np.pi * np.arange(4032 - 288, 4032) / 288)
    assert np.allclose(row.seasonal_pattern, expected, atol=1e-6)


def test_fit_is_independent_of_row_order_and_slope_matches_polyfit(spark):
    df = made(spark, "srv-001", 2500, noise=1.0)
    row = fitted(spark, df.orderBy(F.rand(3))).first()
    parts = fitting.decompose_series(long(df), StlConfig()).toPandas().sort_values("timestamp")
    tail = parts["trend"].to_numpy()[-500:]
    assert row.trend_slope == pytest.approx(np.polyfit(np.arange(500), tail, 1)[0], abs=1e-9)
    assert row.residual_std == pytest.approx(parts["resid"].std(), rel=1e-9)
    assert np.allclose(parts["value"], parts[["trend", "seasonal", "resid"]].sum(axis=1))


def test_constant_series(spark):
    flat = made(spark, "srv-001", 4032).withColumn(METRIC, F.lit(42.0))
    row = fitted(spark, flat).first()
    assert row.status == "ok" and row.trend_last_value == pytest.approx(42)
    assert np.allclose(row.seasonal_pattern, 0, atol=1e-9)


@pytest.mark.parametrize(
    "points,status,reason",
    [
        (99, "skipped", "insufficient_data"),
        (100, "failed", "below_min_points"),
        (2015, "failed", "below_min_points"),
        (2016, "ok", None),
    ],
)
def test_size_verdicts(spark, points, status, reason):
    df = made(spark, "srv-001", points)
    row = fitted(spark, df).first()
    assert (row.status, row.reason, row.n_rows) == (status, reason, points)
    check = series.validate(long(df), 100, 2016, 288).first()
    assert (check.status, check.reason, check.n_rows) == (status, reason, points)


def test_below_two_periods_and_below_one_minute(spark):
    short = fitted(spark, made(spark, "a", 300), min_points=100).first()
    assert (short.status, short.reason) == ("failed", "below_two_periods")
    fast = fitted(spark, made(spark, "a", 2016, step=30)).first()
    assert (fast.status, fast.reason) == ("failed", "interval_below_one_minute")


def test_one_bad_series_does_not_stop_the_others(spark):
    both = made(spark, "bad", 2016, step=30).unionByName(made(spark, "good", 2016))
    outcome = {r.entity_id: r.status for r in fitted(spark, both).collect()}
    assert outcome == {"bad": "failed", "good": "ok"}


def test_gaps_are_not_filled(spark):
    holes = made(spark, "srv-001", 4032, keep=lambda t: t % 20 != 3)
    row = fitted(spark, holes).first()
    assert row.interval_seconds == 300 and row.n_training_points == 4032 - 4032 // 20 - 1
    filled = series.fill_gaps(long(holes), "5 minutes")
    assert filled.count() == 4032
    assert series.grid_gaps(long(holes), "5 minutes").count() == 202
    worst = (
        filled.join(long(made(spark, "srv-001", 4032)).withColumnRenamed("value", "v"),
                    ["entity_id", "metric_name", "timestamp"])
        .agg(F.max(F.abs(F.col("value") - F.col("v"))))
        .first()[0]
    )
    assert worst < 0.01


@pytest.mark.parametrize("end,agree", [(datetime(2025, 9, 14, 23, 55), True),
                                       (datetime(2025, 9, 14, 11, 55), False)])
def test_phase_of_the_stored_cycle(spark, end, agree):
    start = end - timedelta(seconds=300 * 4031)
    df = made(spark, "a", 4032, start=start)
    literal = fitted(spark, df).first().seasonal_pattern
    by_day = fitted(spark, df, phase="time_of_day").first().seasonal_pattern
    assert np.allclose(literal, by_day) is agree
    # Element 0 of the rotated cycle belongs to midnight.
    offset = (datetime(2025, 9, 14) - start).total_seconds() / 300
    expected = 5 * np.sin(2 * np.pi * (np.arange(288) + offset) / 288)
    assert np.allclose(by_day, expected, atol=1e-6)


def test_history_skips_nulls_and_old_rows(spark):
    df = spark.createDataFrame(
        [
            ("a", datetime(2025, 9, 1, 0, 1), 10.0, None),
            ("a", datetime(2025, 9, 1, 0, 4), 20.0, None),
            ("a", datetime(2025, 9, 1, 0, 6), None, 3.0),
            ("a", datetime(2025, 8, 1), 99.0, 99.0),
        ],
        "server_id string, timestamp timestamp, cpu_usage_percent double, memory_usage_percent double",
    )
    history = series.training_history(
        df, [METRIC, "memory_usage_percent", "absent"], 14, datetime(2025, 9, 2), "5min"
    )
    got = {(r.metric_name, r.timestamp, r.value) for r in history.collect()}
    assert got == {
        (METRIC, datetime(2025, 9, 1), 15.0),
        ("memory_usage_percent", datetime(2025, 9, 1, 0, 5), 3.0),
    }


def test_training_run_totals(spark):
    table = made(spark, "ok", 2016).unionByName(made(spark, "short", 50))
    gone = made(spark, "gone", 10, start=datetime(2020, 1, 1))
    table = table.unionByName(gone)
    config = DetectionConfig(metrics=(METRIC,), method_config={"seasonal_period": 288})
    as_of = START + timedelta(days=7)
    outcomes = training.train_outcomes(table, config, as_of)
    stats = training.training_stats(training.all_outcomes(table, outcomes, config)).first()
    assert stats.asDict() == {
        "total_entities": 3, "total_models": 3, "successful": 1, "failed": 0, "skipped": 2,
    }
    single = training.train_single(table, config, "ok", METRIC, as_of).first()
    assert single.status == "ok" and single.entity_id == "ok"
    with pytest.raises(ValueError):
        training.train_single(table, config, "ok", "nonsense", as_of)
    assert [r.server_id for r in training.discover_entities(table).collect()] == ["gone", "ok", "short"]


def test_ten_sigma_is_the_only_anomaly(spark):
    df = made(spark, "srv-001", 4032, noise=0.5)
    config = DetectionConfig(metrics=(METRIC,), method_config={"phase": "time_of_day"})
    models = training.train_models(df, config, START + timedelta(days=14)).persist()
    model = models.first()
    times = [START + timedelta(days=14, seconds=300 * i) for i in range(20)]
    readings = []
    for i, at in enumerate(times):
        slot = (at.hour * 60 + at.minute) // 5 % 288
        steps = (at - model.trend_last_timestamp).total_seconds() / 300
        value = model.trend_last_value + model.trend_slope * steps + model.seasonal_pattern[slot]
        value += model.residual_mean + (10 * model.residual_std if i == 11 else 0.0)
        readings.append(("srv-001", at, float(value)))
    stream = spark.createDataFrame(readings, "server_id string, timestamp timestamp, cpu_usage_percent double")
    found = anomaly_records(score(stream, models, [METRIC])).collect()
    assert len(found) == 1
    assert found[0].timestamp == times[11] and found[0].severity == "critical"
    assert found[0].anomaly_type == "stl_zscore_cpu_usage_percent"
    assert found[0].details.z_score == pytest.approx(10, abs=1e-3)
    assert found[0].details.threshold == 3.0


def test_method_registry():
    assert detectors() == {"stl_zscore"}
    method = make_detector("stl_zscore", {"seasonal_period": 24, "trend_period": 49})
    assert isinstance(method, StlZscore) and method.get_config()["seasonal_period"] == 24
    with pytest.raises(LookupError, match="stl_zscore"):
        make_detector("lstm")
    assert detector(StlZscore) is StlZscore
    with pytest.raises(ValueError):
        detector(type("Other", (), {"name": "stl_zscore"}))


def test_config_defaults_and_checks():
    stl, run = StlConfig(), DetectionConfig()
    assert (stl.seasonal_period, stl.trend_period, stl.z_score_threshold, stl.min_points) == (
        288, 577, 3.0, 2016,
    )
    assert (run.history_days, run.aggregation_interval, run.model_ttl_seconds) == (14, "5min", 900)
    assert run.skip_threshold == 100
    assert DetectionConfig(method_config={"min_points": 2016}).skip_threshold == 2016
    for bad in ({"trend_period": 578}, {"trend_period": 287}, {"phase": "moon"}):
        with pytest.raises(ValueError):
            StlConfig(**bad)


@pytest.mark.parametrize("slots", [1, 2, 1 << 18])
def test_newest_rows_against_plain_maxima(spark, slots):
    """Whatever shares a slot: tied, undated and silent keys, a null key, repeated rows."""
    rows = [(f"k{i % 7}", i % 40 if i % 7 else 3, i % 5, None if i % 11 == 0 else f"v{i % 13}") for i in range(300)]
    rows += [(None, 5, 1, "a"), (None, 5, 2, "a"), ("undated", None, 1, "b"), ("undated", None, 0, "c"), ("half", None, 9, "z"), ("half", 2, 1, "d")]
    rows += rows[:20]
    df = spark.createDataFrame(rows, "k string, at int, n int, text string")
    rank = lambda r: tuple((x is not None, x if x is not None else 0) for x in r[1:3]) + ((r[3] is not None, r[3] or ""),)
    expected = {}
    for row in rows:
        if row[0] not in expected or rank(row) > rank(expected[row[0]]):
            expected[row[0]] = row
    got = [tuple(r) for r in series.newest_rows(df, ["k"], "at", slots).collect()]
    assert len(got) == len(expected) and {r[0]: r for r in got} == expected
    assert series.newest_rows(df.limit(0), ["k"], "at", slots).count() == 0
