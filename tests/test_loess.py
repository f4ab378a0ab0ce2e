"""The decomposition against brute-force local regression and its own invariants."""

import tracemalloc

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pulsegrid.operators import loess
from pulsegrid.operators.loess import Smoother, decompose, moving_average, smooth_cycles


def line_at(values, span, at):
    """Tricube-weighted local line at one position, by least squares."""
    n = len(values)
    x = np.arange(n)
    low = 0 if span >= n else int(min(max(at - (span - 1) // 2, 0), n - span))
    high = n if span >= n else low + span
    reach = max(at - low, high - 1 - at) + max(0, (span - n) // 2)
    distance = np.abs(x[low:high] - at)
    weights = np.where(distance <= 0.999 * reach, (1 - np.minimum(distance / reach, 1) ** 3) ** 3, 0)
    return np.polyfit(x[low:high] - at, values[low:high], 1, w=np.sqrt(weights))[1]


@pytest.mark.parametrize("length,span", [(50, 7), (50, 21), (14, 289), (20, 19), (20, 21), (9, 9)])
def test_smoother_matches_least_squares(length, span):
    values = np.random.default_rng(length * span).normal(size=length)
    smooth = Smoother(length, span, extend=True)(values)
    expected = [line_at(values, span, at) for at in range(-1, length + 1)]
    assert np.allclose(smooth, expected, atol=1e-10)


@pytest.mark.parametrize("length,span", [(50, 7), (50, 21), (14, 289), (20, 19), (20, 21), (9, 9), (900, 301)])
def test_slices_equal_the_matrix(monkeypatch, length, span):
    values = 1e3 + np.random.default_rng(length * span).normal(size=(length, 3))
    whole = Smoother(length, span, extend=True)(values)
    monkeypatch.setattr(loess, "MATRIX", 0)
    monkeypatch.setattr(loess, "SLICE", 640)
    sliced = Smoother(length, span, extend=True)
    assert np.allclose(sliced(values), whole, rtol=0, atol=1e-9)
    assert np.allclose(sliced(values[:, 1]), whole[:, 1], rtol=0, atol=1e-9)


def test_memory_of_a_weekly_cycle_of_minutes():
    period, t = 7 * 1440, np.arange(3 * 7 * 1440)
    values = 20 + 1e-4 * t + 5 * np.sin(2 * np.pi * t / period)
    tracemalloc.start()
    trend, seasonal, residual = decompose(values, period, period + 1, 2 * period + 1, passes=1)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 200e6
    assert np.allclose(trend + seasonal + residual, values) and np.abs(residual).max() < 1e-6


def brute_decompose(values, period, seasonal_span, trend_span, passes):
    n = len(values)
    low_span = period + 1 + period % 2
    trend = np.zeros(n)
    for _ in range(passes):
        left = values - trend
        cycle = np.zeros(n + 2 * period)
        for phase in range(period):
            sub = left[phase::period]
            for i in range(-1, len(sub) + 1):
                cycle[phase + (i + 1) * period] = line_at(sub, seasonal_span, i)
        means = lambda v, w: np.array([v[i : i + w].mean() for i in range(len(v) - w + 1)])
        level = means(means(means(cycle, period), period), 3)
        level = np.array([line_at(level, low_span, i) for i in range(n)])
        seasonal = cycle[period : period + n] - level
        free = values - seasonal
        trend = np.array([line_at(free, trend_span, i) for i in range(n)])
    return trend, seasonal


@pytest.mark.parametrize("n,period", [(60, 6), (64, 6), (71, 7), (40, 12)])
def test_decomposition_matches_brute_force(n, period):
    rng = np.random.default_rng(n)
    values = np.sin(np.arange(n) * 2 * np.pi / period) + 0.05 * np.arange(n) + rng.normal(size=n)
    span = period + (period + 1) % 2
    trend, seasonal, resid = decompose(values, period, span, 2 * period + 1, passes=3)
    expected_trend, expected_seasonal = brute_decompose(values, period, span, 2 * period + 1, 3)
    assert np.allclose(trend, expected_trend, atol=1e-8)
    assert np.allclose(seasonal, expected_seasonal, atol=1e-8)
    assert np.allclose(trend + seasonal + resid, values)


@pytest.mark.parametrize("n", [4032, 4000, 3839])
def test_line_plus_sine_is_recovered(n):
    t = np.arange(n)
    values = 20 + 0.001 * t + 5 * np.sin(2 * np.pi * t / 288)
    trend, seasonal, resid = decompose(values, 288, 289, 577)
    assert np.abs(resid).max() < 1e-9
    assert np.allclose(np.polyfit(t, trend, 1), [0.001, 20], atol=1e-6)


@settings(max_examples=25, deadline=None)
@given(
    st.integers(2, 9).flatmap(
        lambda p: st.tuples(
            st.just(p),
            st.lists(st.floats(-1e3, 1e3), min_size=2 * p + 1, max_size=6 * p + 5),
        )
    )
)
def test_parts_add_up(case):
    period, values = case[0], np.array(case[1])
    span = period + (period + 1) % 2
    trend, seasonal, resid = decompose(values, period, span, 2 * period + 1)
    assert np.allclose(trend + seasonal + resid, values, atol=1e-6)
    assert np.isfinite(trend).all() and np.isfinite(seasonal).all()


def test_lengths():
    assert len(smooth_cycles(np.arange(29.0), 6, 7)) == 29 + 12
    assert len(moving_average(np.arange(10.0), 3)) == 8
